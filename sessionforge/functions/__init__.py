"""Column functions and small arithmetic."""
