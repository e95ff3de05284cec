"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions only (operator 8).

Each validated value is permuted, under a key, within the values of its own format: a card number gives a
number of the same network digit and a right check digit, a date gives a date. Equal values give equal
pseudonyms in all documents, different values different ones. The permutation is a Feistel network on two
halves of the value, A in [0, a) and B in [0, b): ten rounds add a keyed hash of one half to the other.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import passed_columns

ROUNDS = 10

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What is looked for. The first alternative that matches at a place wins; every one starts at a token's start.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+",
    "phone": r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z+])\+[1-9][0-9]{7,14}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}"
            r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9]{2}:|(?![0-9A-Za-z]))|[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9A-Za-z]))",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z])(?!\.[0-9])",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Dates from this day on, so many: 200 whole years.
FIRST_DAY, DAYS = "1900-01-01", 73_049
DAY_HALVES = (17, 4297)
#: Strings NN/NN/YYYY that are a date of those years: MM/DD (one for each day), and DD/MM with a day above 12.
SLASH_DATES, SLASH_HALVES, MONTHS = 117_298, (263, 446), 2400
#: A deployment's key: a setting whose name Spark redacts in its own output.
KEY_SETTING = "spark.tessera.pii.secret"


def _of(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def key_of(spark: SparkSession, otherwise: str) -> str:
    """The session's key, or ``otherwise`` where none is set (tests, demonstrations)."""
    return spark.conf.get(KEY_SETTING, otherwise)


def _hash(key, kind, i: Column, half: Column) -> Column:
    """48 keyed bits of a half, as a long."""
    made = F.sha2(F.concat_ws("|", _of(key), _of(kind), i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(made, 1, 12), 16, 10).cast("long")


def feistel(value: Column, a, b, key, kind) -> Column:
    """Keyed permutation of the longs in [0, a * b): ten Feistel rounds on (value div b, value mod b). All may be columns."""
    a, b = _of(a), _of(b)

    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(acc["a"] + _hash(key, kind, i, acc["b"]), a)).otherwise(acc["a"]).alias("a"),
            F.when(even, acc["b"]).otherwise(F.pmod(acc["b"] + _hash(key, kind, i, acc["a"]), b)).alias("b"))

    low = F.pmod(value, b.cast("long"))
    halves = F.struct(((value - low) / b).cast("long").alias("a"), low.alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, step, lambda acc: acc["a"] * b + acc["b"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _permuted_digits(d: Column, n: Column, key: Column, kind) -> Column:
    """A string of n digits, permuted among those."""
    half = F.floor(n / 2)
    a, b = (F.pow(F.lit(10), x).cast("long") for x in (half, n - half))
    return F.lpad(feistel(d.cast("long"), a, b, key, kind).cast("string"), n, F.lit("0"))


def _refilled(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced by ``digits``, in order; all else stays."""
    return F.array_join(F.transform(F.split(m, "(?!^)(?!$)"), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(m, F.lit(1), i + 1))), F.lit(1)))
        .otherwise(c)), "")


def _luhn(d: Column, doubled: int) -> Column:
    """Luhn sum of a digit string; ``doubled``: 1 if the last digit counts twice, else 0."""
    return F.aggregate(F.transform(F.split(F.reverse(d), "(?!^)(?!$)"), lambda c, i: F.when(
        i % 2 == 1 - doubled, F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") / 5).cast("int"))
        .otherwise(c.cast("int"))), F.lit(0), lambda x, y: x + y)


def _card(m: Column, key: Column) -> Column:
    d = _digits(m)
    n = F.length(d)
    inner = _permuted_digits(F.substring(d, F.lit(2), n - 2), n - 2, key, F.concat(F.lit("card"), n.cast("string")))
    body = F.concat(F.substring(d, 1, 1), inner)
    check = F.pmod(-_luhn(body, 1), F.lit(10)).cast("string")
    return F.when(F.pmod(_luhn(d, 0), F.lit(10)) == 0, _refilled(m, F.concat(body, check))).otherwise(m)


def _phone(m: Column, key: Column) -> Column:
    """Country code, and first digits of area and exchange, stay; eight digits (all after the third of E.164) move."""
    d = _digits(m)
    n = F.length(d)
    tail = F.right(d, F.lit(10))
    moved = F.concat(F.substring(tail, 2, 2), F.substring(tail, 5, 6))
    p = _permuted_digits(moved, F.lit(8), key, "phone")
    local = F.concat(F.substring(tail, 1, 1), F.substring(p, 1, 2), F.substring(tail, 4, 1), F.substring(p, 3, 6))
    q = _permuted_digits(F.substring(d, F.lit(4), n - 3), n - 3, key, F.concat(F.lit("phone"), n.cast("string")))
    other = F.concat(F.substring(d, 1, 3), q)
    nanp = (n == 10) | ((n == 11) & d.startswith("1"))
    return _refilled(m, F.when(nanp, F.concat(F.substring(d, F.lit(1), n - 10), local)).otherwise(other))


def _ssn(m: Column, key: Column) -> Column:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (F.substring(m, i, n).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    ok = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    index = (area - 1 - (area > 666).cast("long")) * 99 + group - 1
    moved = feistel(index * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
    head, low = F.floor(moved / 9999).cast("long"), F.pmod(moved, F.lit(9999)) + 1
    no = F.floor(head / 99).cast("long") + 1
    no = no + (no >= 666).cast("long")
    parts = [F.lpad(x.cast("string"), n, "0") for x, n in ((no, 3), (F.pmod(head, F.lit(99)) + 1, 2), (low, 4))]
    return F.when(ok, F.concat_ws("-", *parts)).otherwise(m)


def _date(m: Column, key: Column) -> Column:
    """ISO dates, DD.MM.YYYY and MM/DD/YYYY (DD/MM/YYYY if that alone is a date) from 1900 to 2099.

    The first two are permuted among the days. The slash dates are numbered, first MM/DD by their day, then DD/MM with a
    day above 12 by their place among such days, and permuted among all of these strings.
    """
    first = F.to_date(F.lit(FIRST_DAY))

    def parsed(form: str) -> Column:
        day = F.try_to_timestamp(m, F.lit(form)).cast("date")
        return F.when(F.datediff(day, first).between(0, DAYS - 1), day)

    def number(day: Column) -> Column:
        return F.datediff(day, first).cast("long")

    def on(n: Column, form: str) -> Column:
        return F.date_format(F.date_add(first, n.cast("int")), form)

    out = m
    for sign, form in (("-", "yyyy-MM-dd"), (r"\.", "dd.MM.yyyy")):
        day = parsed(form)
        out = F.when(m.rlike(sign) & day.isNotNull(), on(feistel(number(day), *DAY_HALVES, key, "date"), form)).otherwise(out)
    by_month, by_day = parsed("MM/dd/yyyy"), parsed("dd/MM/yyyy")
    months = (F.year(by_day) - 1900) * 12 + F.month(by_day)
    index = F.coalesce(number(by_month), DAYS + number(by_day) - 12 * months)
    # one element: the network is one expression, its result is used several times
    moved = F.transform(F.array(feistel(index, *SLASH_HALVES, key, "slash")), lambda x: _slash(x, first, on))
    return F.when(m.rlike("/") & index.isNotNull(), moved[0]).otherwise(out)


def _slash(x: Column, first: Column, on) -> Column:
    """The slash date of number x."""
    rest = x - DAYS
    guess = F.floor(rest * MONTHS / (SLASH_DATES - DAYS))
    near = F.sequence(F.greatest(guess - 3, F.lit(0)), F.least(guess + 3, F.lit(MONTHS - 1)))
    month = F.element_at(F.filter(near, lambda q: F.datediff(F.add_months(first, q.cast("int")), first) - 12 * q <= rest), -1)
    return F.when(x < DAYS, on(x, "MM/dd/yyyy")).otherwise(on(rest + 12 * (month + 1), "dd/MM/yyyy"))


def _ip(m: Column, key: Column) -> Column:
    value = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda x, o: x * 256 + o.cast("long"))
    moved = feistel(value, 1 << 16, 1 << 16, key, "ip")
    return F.concat_ws(".", *(F.pmod(F.shiftright(moved, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)))


def _email(m: Column, key: Column) -> Column:
    """Letters and digits of the name and the host move within their class; the last label and signs stay.

    A Feistel network on two halves of the string: a round turns each character of one half, within a-z, A-Z or
    0-9, by a keyed hash of the other half and its place. Upper and lower case of an address link.
    """
    end = F.length(F.substring_index(m, ".", -1)) + 1
    s = F.substring(m, F.lit(1), F.length(m) - end)
    at = F.floor(F.length(s) / 2).cast("int")

    def turned(x: Column, by: Column, i: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            k = _hash(key, "email", F.concat_ws(",", i.cast("string"), j.cast("string")), F.lower(by))
            low, up, num = (F.char(F.pmod(F.ascii(c) - o + k, F.lit(n)) + o) for o, n in ((97, 26), (65, 26), (48, 10)))
            return F.when(c.rlike("[a-z]"), low).when(c.rlike("[A-Z]"), up).when(c.rlike("[0-9]"), num).otherwise(c)
        return F.array_join(F.transform(F.split(x, "(?!^)(?!$)"), one), "")

    halves = F.struct(F.substring(s, F.lit(1), at).alias("a"), F.substring(s, at + 1, F.length(s)).alias("b"))
    moved = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, lambda acc, i: F.struct(
        F.when(i % 2 == 0, turned(acc["a"], acc["b"], i)).otherwise(acc["a"]).alias("a"),
        F.when(i % 2 == 0, acc["b"]).otherwise(turned(acc["b"], acc["a"], i)).alias("b")),
        lambda acc: F.concat(acc["a"], acc["b"]))
    return F.concat(moved, F.right(m, end))


_MOVES = {"email": _email, "phone": _phone, "ssn": _ssn, "card": _card, "date": _date, "ip": _ip}


def _kind(m: Column) -> Column:
    """The kind of a match: the first pattern that matches all of it."""
    out = F.lit(None).cast("string")
    for kind, p in reversed(PATTERNS.items()):
        out = F.when(m.rlike(f"^(?:{p})$"), F.lit(kind)).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_email`` ... ``n_ip``: the values replaced of each kind.

    E-mail addresses, phone numbers (NANP and +E.164), US social security numbers, payment cards (Luhn), dates
    and IPv4 addresses that pass their kind's check are permuted within their format; others stay. NULL texts
    stay NULL with counts 0, empty ones empty. Columns named like the counts are replaced, others stay; each
    row is mapped by itself, so repeated rows map alike, and nothing is shuffled. Texts of any length are mapped whole, in a
    row's memory. An empty table gives an empty one with the same columns. Columns named ``__found``, ``__moved``,
    ``__one`` or ``__key`` are dropped. The key comes by a broadcast row, so it is in no plan.
    """
    spark = docs.sparkSession
    counts = [f"n_{k}" for k in KINDS]
    keep = passed_columns(docs, [*counts, "__found", "__moved", "__one", "__key"])
    some = F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    held = spark.createDataFrame(pa.table({"__one": pa.array([0], pa.int32()), "__key": [key]}))
    # always 0, but no constant: an equality join with one row
    found = (docs.select(*keep, some.alias("__found")).withColumn("__one", F.pmod(F.coalesce(F.size("__found"), F.lit(0)), F.lit(1)))
             .join(F.broadcast(held), "__one"))

    def move(m: Column) -> Column:
        to, kind = m, _kind(m)
        for k, f in _MOVES.items():
            to = F.when(kind == k, f(m, F.col("__key"))).otherwise(to)
        return F.struct(kind.alias("kind"), to.alias("to"), (to != m).alias("moved"))

    moved = found.withColumn("__moved", F.when(F.size("__found") > 0, F.transform("__found", move)))
    pieces = F.split(F.col(text), ANY, -1)
    whole = F.concat(F.array_join(F.zip_with(F.slice(pieces, 1, F.size("__moved")), "__moved",
                                             lambda p, x: F.concat(p, x["to"])), ""), F.element_at(pieces, -1))

    def count(kind: str) -> Column:
        return F.size(F.filter("__moved", lambda x: (x["kind"] == kind) & x["moved"]))

    n = [F.coalesce(count(k), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    out = [F.when(F.col("__moved").isNotNull(), whole).otherwise(F.col(text)).alias(c) if c == text else F.col(c)
           for c in keep]
    return moved.select(*out, *n)
