import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from meterstar.llm import pii
from tests.llm.cases import no_docs, odd_docs

KEY = "k1"


def digest(kind, turn, other):
    return hashlib.sha512(f"{KEY}|{kind}|{turn}|{other}".encode()).hexdigest()


def pair(a, b, m, n, kind):
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            a = (a + int(digest(kind, i, b)[:14], 16)) % m
        else:
            b = (b + int(digest(kind, i, a)[:14], 16)) % n
    return a, b


def symbols(values, sizes, kind):
    half = len(values) // 2
    left, right = list(values[:half]), list(values[half:])
    for i in range(pii.ROUNDS):
        mine, other, base = (left, right, 0) if i % 2 == 0 else (right, left, half)
        d = digest(kind, i, ",".join(map(str, other)))
        new = [(x + int(d[3 * (j % 42): 3 * (j % 42) + 3], 16) + j // 42) % sizes[base + j] for j, x in enumerate(mine)]
        left, right = (new, right) if i % 2 == 0 else (left, new)
    return left + right


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def by_class(s, kind):
    base = [48 if c in "0123456789" else 97 if "a" <= c <= "z" else 65 if "A" <= c <= "Z" else None for c in s]
    new = symbols([0 if b is None else ord(c) - b for c, b in zip(s, base)], [1 if b is None else 10 if b == 48 else 26 for b in base], kind)
    return "".join(c if b is None else chr(b + v) for c, b, v in zip(s, base, new))


def expected(kind, s):
    if kind == "email":
        local, at, host = s.partition("@")
        return by_class(local, "email") + at + host
    if kind in ("card", "phone"):
        code = re.match(r"(\+[0-9]{1,3}(?=[ .(-]))?", s).group() if kind == "phone" else ""
        d = [int(c) for c in s[len(code):] if c.isdigit()]
        if kind == "card":
            new = symbols(d[:-1], [10] * (len(d) - 1), "card")
            new += [c for c in range(10) if luhn(new + [c])]
        else:
            new = symbols(d, [10] * len(d), "phone")
        put = iter(new)
        return code + "".join(str(next(put)) if c.isdigit() else c for c in s[len(code):])
    if kind == "ip":
        x = [int(p) for p in s.split(".")]
        a, b = pair(x[0] * 256 + x[1], x[2] * 256 + x[3], 65536, 65536, "ip")
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "date":
        n = (date.fromisoformat(s) - date(1900, 1, 1)).days
        a, b = pair(n // 270, n % 270, 271, 270, "date")
        return (date(1900, 1, 1) + timedelta(a * 270 + b)).isoformat()
    if kind == "secret":
        new = "".join(f"{v:x}" for v in symbols([int(c, 16) for c in s], [16] * len(s), "secret"))
        return new if s == s.lower() else new.upper()


VALUES = {
    "email": ["und.34@mail7.example.com", "Ab+c_1@x.org"], "card": ["4539578763621486", "4539 5787 6362 1486", "378282246310005"],
    "phone": ["+1 (017) 555-7713", "(212) 555-0100", "+44 205 555 0199"], "ip": ["97.51.17.173", "0.0.0.0", "255.255.255.255"],
    "date": ["1999-12-31", "2024-02-29"], "secret": ["04dbebab91ab85687d33eeaaf9ac699e1188f962", "A1" * 16],
}


def test_equals_a_plain_feistel_network(spark):
    cases = [(k, v) for k, vs in VALUES.items() for v in vs]
    df = spark.createDataFrame([(i, f"see {v}, ok") for i, (_, v) in enumerate(cases)], "doc_id long, text string")
    got = [r["text"] for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]
    assert got == [f"see {expected(k, v)}, ok" for k, v in cases]
    assert all(v not in t for (_, v), t in zip(cases, got))


def pseudonyms(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]


def test_valid_stays_valid_and_permutation(spark):
    ibans = ["DE89370400440532013000", "GB29NWBK60161331926819"]
    ssns = [f"{a:03d}-{g:02d}-{n:04d}" for a, g, n in [(1, 1, 1), (899, 99, 9999), (665, 10, 5), (667, 10, 5), (123, 45, 6789)]]
    dates = [(date(2000, 1, 1) + timedelta(i)).isoformat() for i in range(300)]
    new = pseudonyms(spark, ibans + ssns + dates)
    for old, got in zip(ibans, new):
        n = "".join(str(int(c, 36)) for c in got[4:] + got[:4])
        assert got != old and got[:2] == old[:2] and int(n) % 97 == 1
    for got in new[2:7]:
        a, g, n = map(int, got.split("-"))
        assert 1 <= a <= 899 and a != 666 and 1 <= g and 1 <= n
    assert len(set(new[2:7])) == 5 and not set(new[2:7]) & set(ssns)
    assert len({date.fromisoformat(d) for d in new[7:]}) == 300


def test_equal_dates_stay_linked_across_formats(spark):
    a, b = pseudonyms(spark, ["1984-03-09", "09/03/1984"])
    assert b == f"{a[8:]}/{a[5:7]}/{a[:4]}"


@pytest.mark.parametrize("text", ["9807915762804490", "2023-02-30", "000-12-3456", "version 4.0.1.2.3", "1.2.3.4567", "GB00NWBK60161331926819",
                                  "12345678", "a4539578763621486", "no data", "0000000000000000"])
def test_what_does_not_validate_stays(spark, text):
    assert pseudonyms(spark, [text]) == [text]


def test_several_values_and_order(spark):
    v = VALUES["card"][0]
    got = pseudonyms(spark, [f"{v} {v}\n{VALUES['ip'][0]}!!"])[0]
    c = expected("card", v)
    assert got == f"{c} {c}\n{expected('ip', VALUES['ip'][0])}!!"


def test_other_keys_give_other_pseudonyms(spark):
    df = spark.createDataFrame([(1, VALUES["card"][0])], "doc_id long, text string")
    assert pii.pseudonymise(df, "x").first()["text"] != pii.pseudonymise(df, "y").first()["text"]


def test_odd_rows_and_count(spark):
    docs = odd_docs(spark).withColumn("text", F.when(F.col("doc_id") == 8, F.lit("mail a.b@c.org and 97.51.17.173")).otherwise(F.col("text")))
    got = pii.pseudonymise(docs, count_col="n_replaced")
    assert got.columns == docs.columns + ["n_replaced"]
    assert {r["doc_id"]: r["n_replaced"] for r in got.collect() if r["n_replaced"]} == {8: 2}
    assert got.where("doc_id is null or doc_id <> 8").drop("n_replaced").exceptAll(docs.where("doc_id is null or doc_id <> 8")).count() == 0
    assert pii.pseudonymise(no_docs(spark)).count() == 0


def test_a_value_that_fails_in_one_format_is_tried_in_the_next(spark):
    secret = "AB12" + "0123456789ABCDEF" * 2  # fits the pattern of an IBAN, not its check digits
    values = [secret[:n] for n in (32, 33, 34)]
    assert pseudonyms(spark, values) == [expected("secret", v) for v in values]


def test_names_with_very_many_labels(spark):
    labels = ".b" * 100_000
    texts = [f"see jane.doe@a{labels}.com now", "x@" + "a" * 200_000 + ".com", "x@" + "a-" * 100_000 + "b.com", "x@a" + "." * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]
    assert got[0] != texts[0] and got[0].endswith(f"@a{labels}.com now") and len(got[0]) == len(texts[0])
    assert got[1][1:] == texts[1][1:] and got[2][1:] == texts[2][1:] and got[3] == texts[3]


def test_secrets_of_any_length_and_case(spark):
    secrets = ["0f" * 16, "0F" * 70, "0f" * 5000, "0fAb" * 10, "a1" * 16 + "B"]
    df = spark.createDataFrame([(i, f"key {s}.") for i, s in enumerate(secrets)], "doc_id long, text string")
    got = [r.text[4:-1] for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]
    for old, new in zip(secrets, got):
        assert new != old and len(new) == len(old) and re.fullmatch("[0-9a-f]+" if old == old.lower() else "[0-9A-F]+", new)
