import datetime
import hashlib
import re

import brute
import pytest

from tessera.llm import pii
from tessera.llm.common import table
from tessera.llm.queries import PII_KEY, op8_pii


def hashed(key, kind, i, half):
    return int(hashlib.sha256(f"{key}|{kind}|{i}|{half}".encode()).hexdigest()[:12], 16)


def feistel(x, a, b, key, kind):
    x, y = x // b, x % b
    for i in range(pii.ROUNDS):
        if i % 2:
            y = (y + hashed(key, kind, i, x)) % b
        else:
            x = (x + hashed(key, kind, i, y)) % a
    return x * b + y


def digits(d, key, kind):
    n = len(d)
    return str(feistel(int(d), 10 ** (n // 2), 10 ** (n - n // 2), key, kind)).zfill(n)


def refilled(m, d):
    d = iter(d)
    return "".join(next(d) if c in "0123456789" else c for c in m)


def card(m, key):
    d = re.sub("[^0-9]", "", m)
    if not brute.luhn(d):
        return m
    body = d[0] + digits(d[1:-1], key, f"card{len(d)}")
    return refilled(m, body + next(c for c in "0123456789" if brute.luhn(body + c)))


def phone(m, key):
    d = re.sub("[^0-9]", "", m)
    if len(d) == 10 or len(d) == 11 and d[0] == "1":
        t = d[-10:]
        p = digits(t[1:3] + t[4:], key, "phone")
        return refilled(m, d[:-10] + t[0] + p[:2] + t[3] + p[2:])
    return refilled(m, d[:3] + digits(d[3:], key, f"phone{len(d)}"))


def ssn(m, key):
    a, g, s = map(int, m.split("-"))
    if not (0 < a < 900 and a != 666 and g and s):
        return m
    x = feistel(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999, key, "ssn")
    a = x // 9999 // 99 + 1
    return f"{a + (a >= 666):03}-{x // 9999 % 99 + 1:02}-{x % 9999 + 1:04}"


FIRST = datetime.date(1900, 1, 1)


def slash_dates():
    """All slash dates by their number, written out."""
    days = [FIRST + datetime.timedelta(n) for n in range(pii.DAYS)]
    return [d.strftime("%m/%d/%Y") for d in days] + [d.strftime("%d/%m/%Y") for d in days if d.day > 12]


SLASH = slash_dates()
NUMBER = {t: i for i, t in enumerate(SLASH)}


def date(m, key):
    if "/" in m and m in NUMBER:
        return SLASH[feistel(NUMBER[m], *pii.SLASH_HALVES, key, "slash")]
    form = "%Y-%m-%d" if "-" in m else "%d.%m.%Y"
    try:
        x = (datetime.datetime.strptime(m, form).date() - FIRST).days
    except ValueError:
        return m
    return (FIRST + datetime.timedelta(feistel(x, *pii.DAY_HALVES, key, "date"))).strftime(form) if 0 <= x < pii.DAYS else m


def ip(m, key):
    x = feistel(sum(int(o) << s for o, s in zip(m.split("."), (24, 16, 8, 0))), 1 << 16, 1 << 16, key, "ip")
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def email(m, key):
    s, _, end = m.rpartition(".")
    x, y = s[:len(s) // 2], s[len(s) // 2:]

    def turned(half, by, i):
        out = ""
        for j, c in enumerate(half):
            k = hashed(key, "email", f"{i},{j}", by.lower())
            for o, n, some in ((97, 26, "[a-z]"), (65, 26, "[A-Z]"), (48, 10, "[0-9]")):
                if re.match(some, c):
                    c = chr((ord(c) - o + k) % n + o)
                    break
            out += c
        return out

    for i in range(pii.ROUNDS):
        x, y = (x, turned(y, x, i)) if i % 2 else (turned(x, y, i), y)
    return f"{x}{y}.{end}"


MOVES = {"email": email, "phone": phone, "ssn": ssn, "card": card, "date": date, "ip": ip}


def plain(text, key):
    n = dict.fromkeys(pii.KINDS, 0)

    def move(m):
        kind = next(k for k, p in pii.PATTERNS.items() if re.fullmatch(p, m[0]))
        to = MOVES[kind](m[0], key)
        n[kind] += to != m[0]
        return to

    return None if text is None else re.sub(ANY, move, text), *n.values()


#: The patterns' groups, numbered through as the alternatives of one pattern.
ANY = pii.ANY


def test_query_matches_brute_force(spark):
    want = {r.doc_id: plain(r.text, PII_KEY) for r in table(spark, brute.SF, "documents").collect()}
    assert {r[0]: tuple(r)[1:] for r in op8_pii(spark, brute.SF).collect()} == want
    assert sum(sum(v[1:]) for v in want.values()) > 0


TEXTS = ["mail a.b.12@Mail9.example.com and +1 (640) 555-0953, 4041894974608795 ip 70.123.182.155.", None, "", "nothing here", "no 123 @ all", "13-19 digits: 4222222222222 6304000000000000000 30569309025904",
         "2024-02-29 2023-02-29 31.12.1999 02/13/2001 31/12/2001 99/99/2000 1899-12-31 2100-01-01 1900-01-01 2099-12-31",
         "123-45-6789 666-12-1234 900-11-1111 665-01-0001 667-99-9999 000-11-1111", "4041-8949-7460-8795 4041 8949 7460 8795 4041894974608796 378282246310005 3782 822463 10005",
         "+491711234567 640-555-0953 1 640 555 0953 (640)555-0953 12345678", "1.2.3.4.5 256.1.1.1 0.0.0.0 255.255.255.255 v1.2.3.4", "a@b a@b.c x@y.zz A.B@C.Org.UK ünï@ex.com",
         "4041894974608795 " * 2000, "a" * 50_000 + "@", "é4041894974608795é 4041894974608795",
         "2024-03-05T10:00:00Z 2024-03-05T10 2024-03-05X 2024-03-05 at 25/12/2020, 12/25/2020 30/02/2020 02/29/2023"]


def test_edges(spark):
    df = spark.createDataFrame([(k if k != 3 else None, t, "x") for k, t in enumerate(TEXTS + TEXTS[:1])], "doc_id long, text string, n_ip string")
    out = pii.pseudonymize(df, "key")
    assert out.columns == ["doc_id", "text", *(f"n_{k}" for k in pii.KINDS)]
    got = sorted((tuple(r)[1:] for r in out.collect()), key=repr)
    assert got == sorted((plain(t, "key") for t in TEXTS + TEXTS[:1]), key=repr)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert pii.pseudonymize(df.limit(0), "key").count() == 0


def test_equal_values_link_and_keys_differ(spark):
    df = spark.createDataFrame([("4041-8949-7460-8795 x",), ("4041894974608795",)], "text string")
    a, b = (r.text for r in pii.pseudonymize(df, "k").collect())
    assert a.split()[0].replace("-", "") == b != "4041894974608795" and brute.luhn(b) and b[0] == "4"
    assert pii.pseudonymize(df, "other").collect()[1].text != b


@pytest.mark.parametrize("a,b", [(10, 10), (1, 7), (271, 270)])
def test_feistel_is_a_permutation(spark, a, b):
    x = pii.feistel(pii.F.col("id"), a, b, "k", "t").alias("x")
    n = min(a * b, 3000)
    assert [r.x for r in spark.range(n).select(x).collect()] == [feistel(i, a, b, "k", "t") for i in range(n)]
    assert len({feistel(i, a, b, "k", "t") for i in range(a * b)}) == a * b


def test_every_slash_date_has_a_pseudonym_of_its_own(spark):
    assert len(SLASH) == len(NUMBER) == pii.SLASH_DATES == pii.SLASH_HALVES[0] * pii.SLASH_HALVES[1]
    df = spark.createDataFrame([(t,) for t in SLASH], "m string").repartition(8)
    got = df.select("m", pii._date(pii.F.col("m"), pii.F.lit("k")).alias("to")).collect()
    assert {r.to for r in got} == set(SLASH)
    assert all(r.to == date(r.m, "k") for r in got[::50])


def test_days_are_permuted():
    assert len({feistel(i, *pii.DAY_HALVES, "k", "date") for i in range(pii.DAYS)}) == pii.DAYS


def test_the_key_is_in_no_plan_and_comes_from_a_setting(spark):
    df = spark.createDataFrame([("on 2020-05-06",)], "text string")
    out = pii.pseudonymize(df, "a-very-secret-key")
    assert out.first().text == "on " + date("2020-05-06", "a-very-secret-key")
    plan = out._jdf.queryExecution().toString() + out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    assert "a-very-secret-key" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    spark.conf.set(pii.KEY_SETTING, "set")
    assert pii.key_of(spark, "other") == "set"
    spark.conf.unset(pii.KEY_SETTING)
    assert pii.key_of(spark, "other") == "other"
