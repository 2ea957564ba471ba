"""Pseudonyms of the registered rows against the same keyed permutations written in plain Python."""

import datetime as dt
import hashlib
import re

from sessionforge.llm import pii, queries

FIRST = dt.date(1800, 1, 1)


def _bytes(name, i, other):
    return bytes.fromhex(hashlib.sha512(f"{pii.KEY}|{name}|{i}|{other}".encode()).hexdigest())


def _text(s, name):
    """Eight rounds: the halves by turns, each character moved within its class."""

    def moved(half, stream):
        out = ""
        for j, c in enumerate(half):
            low, size = (48, 10) if "0" <= c <= "9" else (97, 26) if "a" <= c <= "z" else (65, 26) if "A" <= c <= "Z" else (0, 0)
            out += chr(low + (ord(c) - low + stream[j % 64]) % size) if size else c
        return out

    left, right = s[: len(s) // 2], s[len(s) // 2 :]
    for i in range(1, pii.ROUNDS + 1):
        if i % 2:
            left = moved(left, _bytes(name, i, right))
        else:
            right = moved(right, _bytes(name, i, left))
    return left + right


def _number(n, a, b, name):
    left, right = divmod(n, b)
    for i in range(1, pii.ROUNDS + 1):
        by = int.from_bytes(_bytes(name, i, right if i % 2 else left)[:6])
        left, right = ((left + by) % a, right) if i % 2 else (left, (right + by) % b)
    return left * b + right


def _luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


def _mod97(plain):
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _day(s):
    """(the date, how it is written), or None."""
    tries = [("%Y-%m-%d", s)] if s[4] == "-" else [(f"%d{s[2]}%m{s[5]}%Y", s)] + ([("%m/%d/%Y", s)] if "/" in s else [])
    for form, text in tries:
        try:
            day = dt.datetime.strptime(text, form).date()
        except ValueError:
            continue
        return (day, form) if 1800 <= day.year <= 2199 else None
    return None


def _dealt(digits, form):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


def _pseudonym(s):
    """(kind, pseudonym) of a match, or None where it doesn't hold up."""
    full = lambda pattern: re.fullmatch(pattern, s, re.ASCII)
    plain = re.sub(r"\D", "", s, flags=re.ASCII)
    if "@" in s:
        name, host = s.split("@")
        return "mail", f"{_text(name, 'mail')}@{host}"
    if full(pii._IBAN):
        account = s.replace(" ", "")
        if _mod97(account) != 1:
            return None
        body = _text(account[4:], "iban")
        whole = iter(account[:2] + f"{98 - _mod97(account[:2] + '00' + body):02d}" + body)
        return "iban", "".join(" " if c == " " else next(whole) for c in s)
    if full(r"\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4}"):
        got = _day(s)
        return got and ("date", (FIRST + dt.timedelta(_number((got[0] - FIRST).days, 189, 773, "date"))).strftime(got[1]))
    if full(r"\d{1,3}(?:\.\d{1,3}){3}"):
        parts = s.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        return "ip", ".".join(map(str, _number(int.from_bytes(bytes(map(int, parts))), 1 << 16, 1 << 16, "ip").to_bytes(4)))
    if full(pii._NANP):
        area, exchange, line = int(plain[-10:-7]), int(plain[-7:-4]), int(plain[-4:])
        v = _number((area - 200) * 8_000_000 + (exchange - 200) * 10_000 + line, 800, 8_000_000, "nanp")
        return "nanp", _dealt(plain[:-10] + f"{v // 8_000_000 + 200}{v % 8_000_000 // 10_000 + 200}{v % 10_000:04d}", s)
    if full(r"\d{3}-\d{2}-\d{4}"):
        area, group, serial = map(int, s.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        v = _number(((area - 1 - (area > 666)) * 99 + group - 1) * 9_999 + serial - 1, 898, 989_901, "ssn")
        a = v // 989_901
        return "ssn", f"{a + 1 + (a >= 665):03d}-{v % 989_901 // 9_999 + 1:02d}-{v % 9_999 + 1:04d}"
    if s[0] == "+":
        return ("phone", s[:2] + _dealt(_text(re.sub(r"\D", "", s[2:]), "phone"), s[2:])) if 8 <= len(plain) <= 15 else None
    if _luhn(plain) % 10 or plain[0] == "0":
        return None
    body = plain[0] + _text(plain[1:-1], "card")
    return "card", _dealt(body + str(-_luhn(body + "0") % 10), s)


def test_registered_pseudonyms_equal_the_rounds_in_plain_python(spark, sf):
    pattern = re.compile(pii.PATTERN, re.ASCII)
    seen = {}
    got = {r.doc_id: r for r in queries.op4_pseudonyms(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        kinds = []

        def replaced(m, kinds=kinds):
            found = _pseudonym(m[0])
            if not found:
                return m[0]
            kinds.append(found[0])
            seen.setdefault(found[0], set()).add(m[0])
            return found[1]

        want = None if r.text is None else pattern.sub(replaced, r.text)
        counted = ",".join(f"{k}:{kinds.count(k)}" for k in sorted(set(kinds)))
        assert (got[r.doc_id].text, got[r.doc_id].n_found, got[r.doc_id].kinds) == (want, len(kinds), counted)
    assert len(seen) >= 4, seen.keys()


def test_pseudonyms_of_every_kind_equal_plain_python(spark):
    values = ["ann.b@mail.example.org", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "2024-02-29", "31.12.1999", "02/30/2024", "12/25/2023", "192.168.0.1", "256.1.1.1", "(212) 555-0147", "+1 415-555-2671", "123-45-6789", "666-12-1234", "667-12-1234", "+49 30 901820", "4111 1111 1111 1111", "4111 1111 1111 1112"]
    docs = spark.createDataFrame([(i, f"see {v} now") for i, v in enumerate(values)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.kinds) for r in pii.pseudonymise(docs).collect()}
    for i, v in enumerate(values):
        found = _pseudonym(v)
        assert got[i] == ((f"see {found[1]} now", f"{found[0]}:1") if found else (f"see {v} now", "")), v
