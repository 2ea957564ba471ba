"""The streaming job and what it leaves behind."""
