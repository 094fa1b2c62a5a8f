"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Candidates are found by one pattern, validated by their own rules (check digits, calendar, ranges),
and replaced by a keyed permutation of their format: a Luhn-valid card number becomes another
Luhn-valid one, a date another date written alike.  Permutations are Feistel networks, so different
values never share a pseudonym within a format, and equal values get equal pseudonyms in all
documents without any table of them.  Rows are rewritten in place; nothing is shuffled.

Numbers with a range of their own are pairs (x, y) of Z_a x Z_b, where rounds alternately add a keyed
hash of one part to the other.  Longer values are strings whose halves shift each other's characters
within their classes (digit, small letter, capital letter).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

# Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def _iban() -> str:
    """IBANs, compact or in groups of four.  The country tells the length, so words that follow in capitals
    are no part of it; other countries' codes take as many groups as there are."""
    by_length: dict[int, list[str]] = {}
    for land, length in IBAN_LENGTHS.items():
        by_length.setdefault(length - 4, []).append(land)
    known = []
    for rest, lands in sorted(by_length.items()):
        tail = f" ?[A-Z0-9]{{{rest % 4}}}" if rest % 4 else ""
        known.append(rf"(?:{'|'.join(lands)})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{rest // 4}}}{tail}")
    other = rf"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join([*known, other])})(?![A-Za-z0-9])"


# What the kinds look like.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAMED = r"(?i:password|passwd|secret|token|api_key)\s{0,3}[=:]\s{0,3}\"?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": rf"(?<![A-Za-z0-9])AKIA[0-9A-Z]{{16}}(?![A-Za-z0-9])|(?<![A-Za-z]){_NAMED}[A-Za-z0-9_+/-][A-Za-z0-9_+/.-]{{6,}}[A-Za-z0-9_+/-]",
    "iban": _iban(),
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/-]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)",
    "card": r"(?<![\w+-])(?<!\d\.)(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4} \d{6} \d{5})(?![\w-]|\.\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Days of the 400 years after which the calendar repeats, as a product.
_CALENDAR = (189, 773)


def _keyed(key: str, *parts: Column | str) -> Column:
    """Hex digits of an HMAC with SHA-256."""
    secret = key.encode()
    block = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    message = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def permuted_pair(key: str, domain: str, x: Column, y: Column, a: int, b: int) -> Column:
    """A struct (x, y): the keyed permutation of Z_a x Z_b."""

    def step(state: Column, k: Column) -> Column:
        left, right = state["x"], state["y"]
        other = F.when(k % 2 == 0, right).otherwise(left)
        number = F.conv(F.substring(_keyed(key, domain, k, other), 1, 15), 16, 10).cast("long")
        return F.struct(
            F.when(k % 2 == 0, F.pmod(left + number, F.lit(a).cast("long"))).otherwise(left).alias("x"),
            F.when(k % 2 == 1, F.pmod(right + number, F.lit(b).cast("long"))).otherwise(right).alias("y"),
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1)), start, step)


def permuted_number(key: str, domain: str, value: Column, a: int, b: int) -> Column:
    """The keyed permutation of the numbers below a * b."""
    pair = permuted_pair(key, domain, F.floor(value / b).cast("long"), F.pmod(value, F.lit(b).cast("long")), a, b)
    return F.transform(F.array(pair), lambda p: p["x"] * b + p["y"])[0]


def _shifted(key: str, domain: str, half: Column, digest: Column) -> Column:
    """Each character moved within its class by two digits of the hash; every 32 characters after the
    first have a hash of their own.  Hashes are bound to variables, so each is computed once."""
    further = lambda d, b: F.when(b == 0, d).otherwise(_keyed(key, domain, d, b))
    blocks = lambda d: F.transform(F.sequence(F.lit(0), F.floor((F.length(half) - 1) / 32).cast("int")), lambda b: further(d, b))

    def move(hashes: Column, c: Column, at: Column) -> Column:
        digits = F.get(hashes, F.floor(at / 32).cast("int"))
        by = F.conv(F.substring(digits, (F.pmod(at, F.lit(32)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        out = c
        for first, size in (("0", 10), ("a", 26), ("A", 26)):
            inside = (code >= ord(first)) & (code < ord(first) + size) & (F.octet_length(c) == 1)
            out = F.when(inside, F.char(ord(first) + F.pmod(code - ord(first) + by, F.lit(size)))).otherwise(out)
        return out

    whole = lambda hashes: F.array_join(F.transform(F.split(half, ""), lambda c, at: move(hashes, c, at)), "")
    bound = F.transform(F.transform(F.array(digest), blocks), whole)[0]
    return F.when(half == "", half).otherwise(bound)


def permuted_text(key: str, domain: str, value: Column) -> Column:
    """The keyed permutation of strings with the same character classes."""
    cut = F.floor(F.length(value) / 2).cast("int")

    def step(state: Column, k: Column) -> Column:
        left, right = state["l"], state["r"]
        digest = _keyed(key, domain, k, F.length(value), F.when(k % 2 == 0, right).otherwise(left))
        return F.struct(
            F.when(k % 2 == 0, _shifted(key, domain, left, digest)).otherwise(left).alias("l"),
            F.when(k % 2 == 1, _shifted(key, domain, right, digest)).otherwise(right).alias("r"),
        )

    start = F.struct(F.substr(value, F.lit(1), cut).alias("l"), F.substr(value, cut + 1).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["l"], s["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _laid(value: Column, digits: Column) -> Column:
    """The value with its digits replaced by others, in order."""
    at = lambda i: F.length(_digits(F.substr(value, F.lit(1), i + 1)))
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substr(digits, at(i), F.lit(1))).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    weigh = lambda d, i: F.when(i % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int"))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weigh), F.lit(0), lambda s, d: s + d) % 10


def _mod97(iban: Column) -> Column:
    """The remainder of an IBAN without blanks, its first four characters at the end."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    add = lambda rest, c: F.pmod(F.when(c.rlike("^[0-9]$"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55), F.lit(97))
    return F.aggregate(F.split(turned, ""), F.lit(0), add)


def _date(value: Column) -> Column:
    """The date meant by one of the formats, null if there is no such day."""
    parts = F.when(value.rlike("^....-"), F.array(*[F.substr(value, F.lit(s), F.lit(n)) for s, n in ((1, 4), (6, 2), (9, 2))]))
    parts = parts.when(value.rlike(r"^..\."), F.array(*[F.substr(value, F.lit(s), F.lit(n)) for s, n in ((7, 4), (4, 2), (1, 2))]))
    parts = parts.otherwise(F.array(*[F.substr(value, F.lit(s), F.lit(n)) for s, n in ((7, 4), (1, 2), (4, 2))]))
    return F.try_to_date(F.array_join(parts, "-"), "yyyy-MM-dd")


_EPOCH = 719_528  # days from 0000-01-01 to 1970-01-01


def _moved_date(key: str, value: Column) -> Column:
    a, b = _CALENDAR
    days = F.unix_date(_date(value)).cast("long") + _EPOCH
    cycle = F.floor(days / (a * b)).cast("long")
    moved = permuted_number(key, "date", F.pmod(days, F.lit(a * b).cast("long")), a, b) + cycle * (a * b) - _EPOCH
    day = F.date_from_unix_date(moved.cast("int"))
    shape = F.when(value.rlike("^....-"), F.date_format(day, "yyyy-MM-dd")).when(value.rlike(r"^..\."), F.date_format(day, "dd.MM.yyyy"))
    return shape.otherwise(F.date_format(day, "MM/dd/yyyy"))


def _moved_ip(key: str, value: Column) -> Column:
    part = lambda k: F.substring_index(F.substring_index(value, ".", k), ".", -1).cast("long")
    pair = permuted_pair(key, "ip", part(1) * 256 + part(2), part(3) * 256 + part(4), 65536, 65536)
    high, low = (lambda v: F.floor(v / 256).cast("string")), (lambda v: (v % 256).cast("string"))
    return F.transform(F.array(pair), lambda p: F.concat_ws(".", high(p["x"]), low(p["x"]), high(p["y"]), low(p["y"])))[0]


def _moved_ssn(key: str, value: Column) -> Column:
    area, group, serial = (F.substr(value, F.lit(s), F.lit(n)).cast("long") for s, n in ((1, 3), (5, 2), (8, 4)))
    x = area - 1 - (area > 666).cast("long")
    pair = permuted_pair(key, "ssn", x, (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
    area_of = lambda x: x + 1 + (x >= 665).cast("long")
    parts = lambda p: (F.lpad(area_of(p["x"]).cast("string"), 3, "0"), F.lpad((F.floor(p["y"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((p["y"] % 9999 + 1).cast("string"), 4, "0"))
    return F.transform(F.array(pair), lambda p: F.concat_ws("-", *parts(p)))[0]


_NORTH_AMERICAN = r"^(?:\+1[ .-]?)?\(?[2-9]\d\d\)?[ .-]?[2-9]\d\d[ .-]?\d{4}$"


def _moved_phone(key: str, value: Column) -> Column:
    digits = _digits(value)
    own = F.substr(digits, F.length(digits) - 9)
    area, exchange, line = (F.substr(own, F.lit(s), F.lit(n)).cast("long") for s, n in ((1, 3), (4, 3), (7, 4)))
    number = ((area - 200) * 800 + exchange - 200) * 10_000 + line
    moved = permuted_number(key, "phone", number, 80_000, 80_000)
    shown = lambda n: F.concat(
        F.substr(digits, F.lit(1), F.length(digits) - 10),
        (F.floor(n / 8_000_000) + 200).cast("string"),
        (F.pmod(F.floor(n / 10_000), F.lit(800)) + 200).cast("string"),
        F.lpad((n % 10_000).cast("string"), 4, "0"),
    )
    american = _laid(value, F.transform(F.array(moved), shown)[0])
    code = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0)
    other = F.concat(code, permuted_text(key, "phone", F.substr(value, F.length(code) + 1)))
    return F.when(value.rlike(_NORTH_AMERICAN), american).otherwise(other)


def _moved_card(key: str, value: Column) -> Column:
    digits = _digits(value)
    inner = permuted_text(key, "card", F.substr(digits, F.lit(2), F.length(digits) - 2))
    shown = lambda head: F.concat(head, F.pmod(10 - _luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string"))
    return _laid(value, F.transform(F.array(F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner)), shown)[0])


def _moved_iban(key: str, value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    land, account = F.substr(plain, F.lit(1), F.lit(2)), permuted_text(key, "iban", F.substr(plain, F.lit(5)))

    def shown(body: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(land, F.lit("00"), body))).cast("string"), 2, "0")
        whole = F.concat(land, check, body)
        at = lambda i: F.length(F.replace(F.substr(value, F.lit(1), i + 1), F.lit(" "), F.lit("")))
        return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(whole, at(i), F.lit(1)))), "")

    return F.transform(F.array(account), shown)[0]


def _cased(value: Column, like: Column) -> Column:
    """The value with capitals where another of the same length has them."""
    put = lambda c, old: F.when((F.ascii(old) >= 65) & (F.ascii(old) <= 90), F.upper(c)).otherwise(c)
    return F.array_join(F.zip_with(F.split(value, ""), F.split(like, ""), put), "")


def _moved_email(key: str, value: Column, domains: bool = False) -> Column:
    """Names, and on request domains but for their last part, are permuted in small letters: spellings that
    differ in capitals are one address."""
    local = F.substring_index(value, "@", 1)
    host = F.substr(value, F.length(local) + 2)
    if domains:
        top = F.substring_index(host, ".", -1)
        front = F.substr(host, F.lit(1), F.length(host) - F.length(top) - 1)
        host = F.concat(_cased(permuted_text(key, "domain", F.lower(front)), front), F.lit("."), top)
    return F.concat(_cased(permuted_text(key, "email", F.lower(local)), local), F.lit("@"), host)


def _moved_secret(key: str, value: Column) -> Column:
    head = F.regexp_extract(value, rf"^(?:AKIA|{_NAMED})", 0)
    return F.concat(head, permuted_text(key, "secret", F.substr(value, F.length(head) + 1)))


_VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "secret": lambda v: F.lit(True),
    "iban": lambda v: _mod97(F.replace(v, F.lit(" "), F.lit(""))) == 1,
    "date": lambda v: _date(v).isNotNull(),
    "ssn": lambda v: ~v.rlike("^(000|666|9)|-00-|-0000$"),
    "ip": lambda v: F.lit(True),
    "phone": lambda v: F.length(_digits(v)).between(7, 15),
    "card": lambda v: _luhn(_digits(v)) == 0,
}
_MOVED = {
    "email": _moved_email,
    "secret": _moved_secret,
    "iban": _moved_iban,
    "date": _moved_date,
    "ssn": _moved_ssn,
    "ip": _moved_ip,
    "phone": _moved_phone,
    "card": _moved_card,
}


def kind_of(value: Column) -> Column:
    """The first kind whose pattern is the whole value and whose rules it meets, else null."""
    kind = F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        fits = value.rlike(rf"^(?:{PATTERNS[name]})$")
        kind = F.when(fits, F.when(_VALID[name](value), F.lit(name)).otherwise(kind)).otherwise(kind)
    return kind


def moved(key: str, kind: Column, value: Column, domains: bool = False) -> Column:
    """The pseudonym of a value of a kind; the value itself without one."""
    out = F.when(kind.isNull(), value)
    for name, move in _MOVED.items():
        out = out.when(kind == name, move(key, value, domains) if name == "email" else move(key, value))
    return out


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text", result: str = "private", domains: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with the pseudonymised text, and an array ``result`` of the
    kinds found in it, in order.

    Texts without personal data come back unchanged, so do candidates that are not valid.  Null
    texts stay null, with an empty array.  Slash dates are month first.  Repeated rows are treated
    alike.  With ``domains`` the domains of addresses are moved as well.  A column named like ``result``
    is replaced; names that begin with ``__`` are not free.
    """
    text = F.col(f"`{text_column}`").cast("string")
    source = docs.drop(result)
    found = source.withColumn("__found", F.coalesce(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.array().cast("array<string>")))
    some = F.size("__found") > 0
    none = F.array().cast("array<string>")
    kinds = found.withColumn("__kinds", F.when(some, F.transform("__found", kind_of)).otherwise(none))
    new = kinds.withColumn("__new", F.when(some, F.zip_with("__found", "__kinds", lambda v, k: moved(key, k, v, domains))).otherwise(none))
    between = new.withColumn("__between", F.when(some, F.split(text, ANY, -1)).otherwise(none))
    tail = F.zip_with("__new", F.slice("__between", F.lit(2), F.size("__found")), lambda value, after: F.concat(value, after))
    whole = F.when(some, F.concat(F.col("__between")[0], F.array_join(tail, ""))).otherwise(text)
    out = between.withColumns({text_column: whole, result: F.filter("__kinds", lambda k: k.isNotNull())})
    return out.select(*source.columns, result)
