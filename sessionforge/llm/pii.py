"""Personal numbers, dates and addresses replaced by format-preserving Feistel pseudonyms, in DataFrame functions only.

Found values are validated first: card numbers by their check digit, account numbers (IBAN) modulo 97, network addresses, dates, phone and social
security numbers by their ranges. A keyed Feistel network then permutes each within its own format, so the pseudonym
is again valid and equal values get equal pseudonyms in all documents, without any table of them:

- strings (card, account and phone digits, mail names): each half in turn is shifted, character by character within its
  class, by bytes of SHA-512 of key, kind, round and the other half; signs stay in place;
- ranges (dates, network addresses, North American phone numbers, social security numbers): the same on two numbers
  whose sizes multiply to the size of the range.

Keys belong in a secret store; ``KEY`` is for tests. Dates are permuted within 1800-01-01 to 2199-12-31.

Defined cases: a null text stays null with nothing found; an empty one stays empty; values that fail validation and all
other text stay as they are; repeated rows and null doc_ids are treated like any other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import joined, let, matches, pieces

KEY = "sessionforge-test-key"
ROUNDS = 8

# The shapes of the values. A longer shape stands before one that could match its beginning.
_MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_DATE = r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\w-]|\.\d)"
_IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
_NANP = r"(?<![\w+])(?:\+1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[.-])[2-9]\d{2}[ .-]\d{4}(?!\w)"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_PHONE = r"(?<!\w)\+\d{1,3}(?:[ .()-]{0,2}\d{1,4}){2,6}(?!\w)"
_CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"
PATTERN = "|".join((_MAIL, _IBAN, _DATE, _IP, _NANP, _SSN, _PHONE, _CARD))

_Z = "0123456789"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of the digits, the last one being the check digit's place."""
    back = F.split(F.reverse(digits), "")
    each = F.transform(back, lambda c, i: let(c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda d: d - F.when(d > 9, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d)


def _mod97(account: Column) -> Column:
    """An account number modulo 97, letters as 10 to 35, the first four characters last."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, 5, 99), F.substring(plain, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c.rlike(r"\d"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _date(s: Column) -> Column:
    """The date, or null for one that doesn't exist or lies outside the range; day first, unless only month first exists."""
    iso = F.when(s.rlike(r"^\d{4}-"), s).otherwise(F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 4, 2), F.lit("-"), F.substring(s, 1, 2)))
    us = F.when(s.rlike("/"), F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 1, 2), F.lit("-"), F.substring(s, 4, 2)))
    day = F.coalesce(iso.try_cast("date"), us.try_cast("date"))
    return F.when(F.year(day).between(1800, 2199), day)


def kind(s: Column) -> Column:
    """What a match is, or null if it doesn't hold up."""
    plain = _digits(s)
    octets = F.split(s, r"\.")
    return (
        F.when(s.contains("@"), "mail")
        .when(s.rlike(f"^(?:{_IBAN})$"), F.when(_mod97(s) == 1, "iban"))
        .when(s.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})$"), F.when(_date(s).isNotNull(), "date"))
        .when(s.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), F.when(F.forall(octets, lambda o: (o.cast("int") <= 255) & (o == o.cast("int").cast("string"))), "ip"))
        .when(s.rlike(f"^(?:{_NANP})$"), "nanp")
        .when(s.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(s.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"), "ssn"))
        .when(s.startswith("+"), F.when(F.length(plain).between(8, 15), "phone"))
        .otherwise(F.when((_luhn(plain) % 10 == 0) & ~plain.rlike(r"^0"), "card"))
    )


def _stream(key: str, name: str, i: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(name), i.cast("string"), other), 512)


def _shifted(half: Column, stream: Column, sign: int) -> Column:
    """Each letter or digit moved within its class by a byte of the stream."""

    def moved(c: Column, j: Column) -> Column:
        by = sign * F.conv(F.substring(stream, (j % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        turn = lambda low, size: F.chr((low + F.pmod(F.ascii(c) - low + by, F.lit(size))).cast("long"))
        return F.when(c.rlike("^[0-9]$"), turn(48, 10)).when(c.rlike("^[a-z]$"), turn(97, 26)).when(c.rlike("^[A-Z]$"), turn(65, 26)).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: c != ""), moved), "")


def feistel_text(s: Column, key: str, name: str, back: bool = False) -> Column:
    """A permutation of the strings of one pattern of digits, letters and signs; ``back`` inverts it."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))
    sign = -1 if back else 1

    def step(x: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(x["l"].alias("l"), _shifted(x["r"], _stream(key, name, i, x["l"]), sign).alias("r"))).otherwise(F.struct(_shifted(x["l"], _stream(key, name, i, x["r"]), sign).alias("l"), x["r"].alias("r")))

    order = F.reverse(F.sequence(F.lit(1), F.lit(ROUNDS))) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(order, start, step, lambda x: F.concat(x["l"], x["r"]))


def feistel_number(n: Column, a: int, b: int, key: str, name: str, back: bool = False) -> Column:
    """A permutation of 0 to a * b - 1; ``back`` inverts it."""
    sign = -1 if back else 1
    start = F.struct(F.floor(n / F.lit(b)).cast("long").alias("l"), (n % b).cast("long").alias("r"))
    by = lambda i, other: sign * F.conv(F.substring(_stream(key, name, i, other.cast("string")), 1, 12), 16, 10).cast("long")

    def step(x: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(x["l"].alias("l"), F.pmod(x["r"] + by(i, x["l"]), F.lit(b)).alias("r"))).otherwise(F.struct(F.pmod(x["l"] + by(i, x["r"]), F.lit(a)).alias("l"), x["r"].alias("r")))

    order = F.reverse(F.sequence(F.lit(1), F.lit(ROUNDS))) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(order, start, step, lambda x: x["l"] * b + x["r"])


def _dealt(digits: Column, form: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    places = F.split(form, "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

    def step(x: Column, c: Column) -> Column:
        return F.when(c.rlike(r"^\d$"), F.struct(F.concat(x["out"], F.substring(digits, x["i"] + 1, F.lit(1))).alias("out"), (x["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(x["out"], c).alias("out"), x["i"].alias("i")))

    return F.aggregate(places, start, step, lambda x: x["out"])


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _card(s: Column, key: str) -> Column:
    def checked(body: Column) -> Column:
        return _dealt(F.concat(body, F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")), s)

    plain = _digits(s)
    middle = F.substring(plain, F.lit(2), F.length(plain) - 2)
    return let(F.concat(F.substring(plain, 1, 1), feistel_text(middle, key, "card")), checked)


def _iban(s: Column, key: str) -> Column:
    plain = F.regexp_replace(s, " ", "")
    country = F.substring(plain, 1, 2)

    def checked(body: Column) -> Column:
        check = _pad(98 - _mod97(F.concat(country, F.lit("00"), body)), 2)
        whole = F.concat(country, check, body)
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))
        step = lambda x, c: F.when(c == " ", F.struct(F.concat(x["out"], c).alias("out"), x["i"].alias("i"))).otherwise(F.struct(F.concat(x["out"], F.substring(whole, x["i"] + 1, F.lit(1))).alias("out"), (x["i"] + 1).alias("i")))
        return F.aggregate(F.split(s, ""), start, step, lambda x: x["out"])

    return let(feistel_text(F.substring(plain, 5, 99), key, "iban"), checked)


def _day(s: Column, key: str) -> Column:
    # 400 years have 146,097 = 189 * 773 days.
    first = F.lit("1800-01-01").cast("date")
    moved = F.date_add(first, feistel_number(F.datediff(_date(s), first), 189, 773, key, "date").cast("int"))
    iso = s.rlike(r"^\d{4}-")
    day_first = ~iso & F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 4, 2), F.lit("-"), F.substring(s, 1, 2)).try_cast("date").isNotNull()
    mark = F.substring(s, 3, 1)
    return let(F.date_format(moved, "yyyyMMdd"), lambda d: F.when(iso, F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))).when(day_first, F.concat(F.substring(d, 7, 2), mark, F.substring(d, 5, 2), mark, F.substring(d, 1, 4))).otherwise(F.concat(F.substring(d, 5, 2), mark, F.substring(d, 7, 2), mark, F.substring(d, 1, 4))))


def _address(s: Column, key: str) -> Column:
    n = F.aggregate(F.split(s, r"\."), F.lit(0).cast("long"), lambda a, o: a * 256 + o.cast("long"))
    return let(feistel_number(n, 1 << 16, 1 << 16, key, "ip"), lambda v: F.concat_ws(".", *[F.pmod(F.shiftright(v, shift), F.lit(256)).cast("string") for shift in (24, 16, 8, 0)]))


def _north_american(s: Column, key: str) -> Column:
    plain = F.right(_digits(s), F.lit(10))
    country = F.when(F.length(_digits(s)) > 10, F.lit("1")).otherwise(F.lit(""))
    # Area and exchange begin with 2 to 9: 800 of each, with 10,000 lines.
    n = (F.substring(plain, 1, 3).cast("long") - 200) * 8_000_000 + (F.substring(plain, 4, 3).cast("long") - 200) * 10_000 + F.substring(plain, 7, 4).cast("long")
    return let(feistel_number(n, 800, 8_000_000, key, "nanp"), lambda v: _dealt(F.concat(country, F.floor(v / 8_000_000) + 200, F.floor(v % 8_000_000 / 10_000) + 200, _pad(v % 10_000, 4)), s))


def _social(s: Column, key: str) -> Column:
    # Areas 001 to 899 without 666: 898; groups 01 to 99; serials 0001 to 9999.
    area = F.substring(s, 1, 3).cast("long")
    n = (area - F.when(area > 666, 2).otherwise(1)) * 989_901 + (F.substring(s, 5, 2).cast("long") - 1) * 9_999 + F.substring(s, 8, 4).cast("long") - 1
    return let(feistel_number(n, 898, 989_901, key, "ssn"), lambda v: let(F.floor(v / 989_901), lambda a: F.concat(_pad(a + F.when(a >= 665, 2).otherwise(1), 3), F.lit("-"), _pad(F.floor(v % 989_901 / 9_999) + 1, 2), F.lit("-"), _pad(v % 9_999 + 1, 4))))


def pseudonym(s: Column, kind: Column, key: str = KEY) -> Column:
    """The pseudonym of a value of this kind; a value of no kind stays."""
    country = F.regexp_extract(s, r"^\+\d", 0)
    return (
        F.when(kind == "mail", F.concat(feistel_text(F.substring_index(s, "@", 1), key, "mail"), F.lit("@"), F.substring_index(s, "@", -1)))
        .when(kind == "iban", _iban(s, key))
        .when(kind == "date", _day(s, key))
        .when(kind == "ip", _address(s, key))
        .when(kind == "nanp", _north_american(s, key))
        .when(kind == "ssn", _social(s, key))
        .when(kind == "phone", F.concat(country, _dealt(feistel_text(_digits(F.substring(s, 3, 99)), key, "phone"), F.substring(s, 3, 99))))
        .when(kind == "card", _card(s, key))
        .otherwise(s)
    )


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with pseudonyms, n_found and kinds (how many of which, in order of their names) of every document."""
    text = F.col("text")
    some = text.rlike(r"\d|@")
    found = F.transform(F.when(some, matches(text, PATTERN)), lambda m: F.struct(m.alias("value"), kind(m).alias("kind")))
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, found.alias("found"))
    valid = F.coalesce(F.filter("found", lambda x: x["kind"].isNotNull()), F.array().cast("array<struct<value:string,kind:string>>"))
    new = joined(pieces(text, PATTERN), F.transform("found", lambda x: pseudonym(x["value"], x["kind"], key)))
    kinds = F.transform(F.array_sort(F.array_distinct(F.transform(valid, lambda x: x["kind"]))), lambda k: F.concat(k, F.lit(":"), F.size(F.filter(valid, lambda x: x["kind"] == k))))
    return marked.select("doc_id", F.when(F.size(valid) > 0, new).otherwise(text).alias("text"), F.size(valid).cast("long").alias("n_found"), F.array_join(kinds, ",").alias("kinds"))
