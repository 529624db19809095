"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

Card numbers, phone numbers, IPv4 addresses, account numbers, social security numbers, dates, e-mail names and access tokens
are found by pattern, validated, and mapped by a keyed Feistel permutation within their kind: digits stay digits, letters that
are hexadecimal stay so, separators stay in place. The map depends on key, kind and the characters alone, so one value has one
pseudonym in all documents and formats, and different values have different ones.

Feistel: the characters are cut in halves, and in each of ``ROUNDS`` rounds one half is shifted by a keyed hash (SHA-256) of the
other, modulo the number of strings of its length. This is a bijection on strings of a given length. Check digits are left
out of the permutation and computed anew. Dates are day numbers from 1900-01-01 in a range of 270 * 271 days, permuted as two
digits of bases 270 and 271.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DAY_ZERO, BASE_A, BASE_B = "1900-01-01", 270, 271
_HALF = 15  # digits of the longer half must fit a long

#: Kinds in the order in which a place in a text is tried; a kind's validity test follows in ``_pseudonym``.
PATTERNS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])|(?<![0-9A-Za-z/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9A-Za-z/])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{13,28}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])",
    "token": r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
}
EMAIL_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def _keyed(key: str, *parts: Column | str) -> Column:
    """A keyed number below 2**60."""
    joined = F.concat_ws("|", F.lit(key), *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(joined, 256), 1, 15), 16, 10).cast("long")


def _power(n: Column) -> Column:
    out = F.lit(1).cast("long")
    for k in range(1, _HALF + 1):
        out = F.when(n == k, F.lit(10**k).cast("long")).otherwise(out)
    return out


def _feistel(state: Column, key: str, kind: str, low: Column, high: Column, length: Column, inverse: bool) -> Column:
    """``ROUNDS`` rounds on a struct (a below ``low``, b below ``high``)."""
    def one(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        other = F.when(even, s["b"]).otherwise(s["a"])
        size = F.when(even, low).otherwise(high)
        shift = _keyed(key, kind, length, r, other) % size
        moved = F.when(even, s["a"]).otherwise(s["b"]) + (-shift if inverse else shift)
        return _let(F.pmod(moved, size), lambda m: F.struct(F.when(even, m).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(m).alias("b")))

    rounds = F.array(*(F.lit(r) for r in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))))
    return F.aggregate(rounds, state, one)


def digits(value: Column, key: str, kind: str, inverse: bool = False) -> Column:
    """The permuted digits of a string of 2 to 30 digits."""
    n = F.length(value)
    left = (n / 2).cast("int")
    state = F.struct(F.substring(value, F.lit(1), left).cast("long").alias("a"), F.substring(value, left + 1, n).cast("long").alias("b"))
    out = _feistel(state, key, kind, _power(left), _power(n - left), n, inverse)
    return _let(out, lambda x: F.concat(F.lpad(x["a"].cast("string"), left, "0"), F.lpad(x["b"].cast("string"), n - left, "0")))


def _luhn_sum(value: Column) -> Column:
    """Luhn sum of a string of digits whose check digit is still to follow."""
    n = F.length(value)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(value, k, F.lit(1)).cast("int") * F.when((n - k) % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def luhn_valid(value: Column) -> Column:
    body = F.substring(value, F.lit(1), F.length(value) - 1)
    return (_luhn_sum(body) + F.substring(value, F.length(value), F.lit(1)).cast("int")) % 10 == 0


def _card(value: Column, key: str, inverse: bool) -> Column:
    new = digits(F.substring(value, F.lit(1), F.length(value) - 1), key, "card", inverse)
    return _let(new, lambda x: F.concat(x, ((10 - _luhn_sum(x) % 10) % 10).cast("string")))


def _mod97(value: Column) -> Column:
    """Remainder by 97 of a string of digits."""
    return F.aggregate(F.split(value, ""), F.lit(0), lambda t, c: (t * 10 + c.cast("int")) % 97)


def _country(value: Column) -> Column:
    two = [F.ascii(F.substring(value, k, 1)) - 55 for k in (1, 2)]
    return F.concat(two[0].cast("string"), two[1].cast("string"))


def iban_valid(value: Column) -> Column:
    rest = F.substring(value, F.lit(5), F.length(value))
    return _mod97(F.concat(rest, _country(value), F.substring(value, 3, 2))) == 1


def _iban(value: Column, key: str, inverse: bool) -> Column:
    rest = digits(F.substring(value, F.lit(5), F.length(value)), key, "iban", inverse)
    check = lambda x: F.lit(98) - _mod97(F.concat(x, _country(value), F.lit("00")))
    return _let(rest, lambda x: F.concat(F.substring(value, 1, 2), F.lpad(check(x).cast("string"), 2, "0"), x))


def _ip(value: Column, key: str, inverse: bool) -> Column:
    p = [F.get(F.split(value, r"\."), F.lit(k)).cast("long") for k in range(4)]
    state = F.struct((p[0] * 256 + p[1]).alias("a"), (p[2] * 256 + p[3]).alias("b"))
    out = _feistel(state, key, "ip", F.lit(65536).cast("long"), F.lit(65536).cast("long"), F.lit(4), inverse)
    return _let(out, lambda y: F.concat_ws(".", *((x / 256).cast("int").cast("string") if top else (x % 256).cast("string") for x in (y["a"], y["b"]) for top in (True, False))))


def _day(value: Column) -> Column:
    iso = F.substring(value, 5, 1) == "-"
    return F.when(iso, F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))).otherwise(F.try_to_timestamp(value, F.lit("MM/dd/yyyy"))).cast("date")


def _day_number(value: Column) -> Column:
    return F.datediff(_day(value), F.lit(DAY_ZERO).cast("date")).cast("long")


def _date(value: Column, key: str, inverse: bool) -> Column:
    n = _day_number(value)
    state = F.struct((n / BASE_B).cast("long").alias("a"), (n % BASE_B).alias("b"))
    out = _feistel(state, key, "date", F.lit(BASE_A).cast("long"), F.lit(BASE_B).cast("long"), F.lit(0), inverse)
    day = _let(out, lambda x: F.date_add(F.lit(DAY_ZERO).cast("date"), (x["a"] * BASE_B + x["b"]).cast("int")))
    return F.when(F.substring(value, 5, 1) == "-", F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "MM/dd/yyyy"))


def _refill(value: Column, new: Column) -> Column:
    """``value`` with its digits replaced, in order, by those of ``new``."""
    digit = lambda c: (c >= "0") & (c <= "9")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))
    put = lambda x: F.aggregate(F.split(value, ""), start, lambda t, c: F.struct(
        F.concat(t["out"], F.when(digit(c), F.substring(x, t["used"] + 1, F.lit(1))).otherwise(c)).alias("out"), (t["used"] + F.when(digit(c), 1).otherwise(0)).alias("used")))["out"]
    return _let(new, put)


def _letters(value: Column, alphabet: str, key: str, kind: str, inverse: bool) -> Column:
    """Characters of an alphabet, shifted round after round: halves of the string key each other's shifts."""
    n, base = F.length(value), len(alphabet)
    left = (n / 2).cast("int")

    def shifted(own: Column, other: Column, r: int) -> Column:
        move = lambda c, k: F.pmod(F.instr(F.lit(alphabet), c).cast("long") - 1 + (F.lit(-1) if inverse else F.lit(1)) * (_keyed(key, kind, n, F.lit(r), k, other) % base), F.lit(base)) + 1
        return F.array_join(F.transform(F.split(own, ""), lambda c, k: F.when(F.instr(F.lit(alphabet), c) > 0, F.substring(F.lit(alphabet), move(c, k).cast("int"), F.lit(1))).otherwise(c)), "")

    def one(r: int):
        def turn(_: Column, s: Column) -> Column:
            a = shifted(s["a"], s["b"], r) if r % 2 == 0 else s["a"]
            b = s["b"] if r % 2 == 0 else shifted(s["b"], s["a"], r)
            return F.struct(a.alias("a"), b.alias("b"))

        return turn

    parts = F.struct(F.substring(value, F.lit(1), left).alias("a"), F.substring(value, left + 1, n).alias("b"))
    for r in reversed(range(4)) if inverse else range(4):
        # Each round is an aggregate over one element, so that what it starts from is computed once, not copied.
        parts = F.aggregate(F.array(parts), F.struct(F.lit("").alias("a"), F.lit("").alias("b")), one(r))
    return F.concat(parts["a"], parts["b"])


def kind_of(value: Column) -> Column:
    """Kind of a found value, null if it fails the kind's validity test."""
    bare = F.regexp_replace(value, "[^0-9]", "")
    is_ = lambda kind: value.rlike(f"^(?:{PATTERNS[kind]})$")
    octets = F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & ((F.length(x) == 1) | (F.substring(x, 1, 1) != "0")))
    day = _day_number(value)
    return (
        F.when(is_("email"), "email")
        .when(is_("ip"), F.when(octets, "ip"))
        .when(is_("date"), F.when((day >= 0) & (day < BASE_A * BASE_B), "date"))
        .when(is_("phone"), F.when(F.length(bare).between(7, 15), "phone"))
        .when(is_("ssn"), F.when(~bare.rlike("^(000|666|9)|^...00|0000$"), "ssn"))
        .when(is_("iban"), F.when(iban_valid(value), "iban"))
        .when(is_("card"), F.when(F.length(bare).between(13, 19) & luhn_valid(bare), "card"))
        .when(is_("token"), "token")
    )


def pseudonym(value: Column, kind: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of a value of a kind, in the value's format."""
    parts = F.struct(
        F.regexp_replace(value, "[^0-9]", "").alias("bare"), F.substring_index(value, "@", 1).alias("local"), F.regexp_extract(value, r"^\+([0-9]{1,3})[ .(-]", 1).alias("country"))

    def of(x: Column) -> Column:
        bare, country = x["bare"], x["country"]
        rest = F.substring(bare, F.length(country) + 1, F.length(bare))
        return (
            F.when(kind == "email", F.concat(_letters(x["local"], EMAIL_LETTERS, key, "email", inverse), F.lit("@"), F.substring_index(value, "@", -1)))
            .when(kind == "ip", _ip(value, key, inverse))
            .when(kind == "date", _date(value, key, inverse))
            .when(kind == "phone", _refill(value, F.concat(country, digits(rest, key, "phone", inverse))))
            .when(kind == "ssn", _refill(value, digits(bare, key, "ssn", inverse)))
            .when(kind == "iban", _iban(value, key, inverse))
            .when(kind == "card", _refill(value, _card(bare, key, inverse)))
            .when(kind == "token", _letters(value, "0123456789abcdef", key, "token", inverse))
        )

    return _let(parts, of)


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """doc_id, text with every valid value replaced, and the number of values of each kind.

    Values are found in whole texts. A value that fails its validity test stays as it is. Null texts stay null, empty ones
    empty; repeated rows are treated alike; null ids stay null; other columns are not read. The key is a secret of the caller;
    with it, ``inverse`` gives the original texts.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = F.col("text").rlike("[0-9@]")
    found = own.select("doc_id", "text", F.when(some, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("values"))
    kinds = F.transform("values", lambda v: F.struct(v.alias("v"), kind_of(v).alias("kind")))
    found = found.select("doc_id", "text", F.when(F.size("values") > 0, kinds).alias("values"))
    new = F.transform("values", lambda x: F.when(x["kind"].isNull(), x["v"]).otherwise(pseudonym(x["v"], x["kind"], key, inverse)))
    between = F.split("text", ANY, -1)
    filled = F.array_join(F.zip_with(between, F.concat(F.col("new"), F.array(F.lit(""))), lambda s, m: F.concat(s, m)), "")
    found = found.select("doc_id", "text", "values", new.alias("new"))
    count = lambda kind: F.coalesce(F.size(F.filter("values", lambda x: x["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", F.when(F.size("values") > 0, filled).otherwise(F.col("text")).alias("text"), *(
        F.when(F.col("values").isNull(), F.lit(0).cast("long")).otherwise(count(kind)).alias(f"n_{kind}") for kind in PATTERNS))
