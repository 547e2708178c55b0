"""Very long tokens, texts full of spans, and several texts under one id."""
import random
import time

import pytest
from pyspark.sql import functions as F

from faultline.llm import jaccard, pii, secret_scan
from faultline.llm import spans as sp

from llm_fixtures import docs_of  # noqa: F401


def test_cut_is_a_slice(spark):
    text = "".join(random.Random(1).choice("aé😀\n ") for _ in range(1700))
    places = [(a, z) for a in (0, 1, 511, 512, 513, 1023, 1024, 1699, 1700, 1800) for z in (0, 1, 512, 513, 1024, 1025, 1700, 2048)]
    df = spark.createDataFrame([(text, a, z) for a, z in places], "text string, a int, z int").withColumn("p", sp.chunks(F.col("text")))
    for r in df.select("a", "z", sp.cut(F.col("p"), F.col("a"), F.col("z")).alias("got")).collect():
        assert r["got"] == text[r["a"]:r["z"]]
    assert [r[0] for r in spark.createDataFrame([("",)], "text string").select(sp.cut(sp.chunks(F.col("text")), F.lit(0), F.lit(5))).collect()] == [""]


def spans_of(rng, n, width=400):
    out = []
    for _ in range(n):
        a = rng.randrange(width)
        out.append((a, rng.randrange(9), a + rng.randint(1, 12), rng.choice("xy")))
    return out


def test_apart_and_merged_are_the_definitions(spark):
    rng = random.Random(4)
    rows = [(spans_of(rng, rng.choice([0, 1, 5, 150])), spans_of(rng, rng.choice([0, 1, 30, 90]))) for _ in range(25)]
    kind = "array<struct<begin:int,order:int,end:int,kind:string>>"
    got = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], f"i int, a {kind}, b {kind}").select(
        "i", sp.apart(F.col("a"), F.col("b")).alias("apart"), sp.merged(F.col("a")).alias("merged")).orderBy("i").collect()
    for r, (a, b) in zip(got, rows, strict=True):
        assert [tuple(s) for s in r["apart"]] == [s for s in a if not any(o[0] < s[2] and s[0] < o[2] for o in b)]
        want = []
        for begin, _, end, kind_ in sorted(a):
            if want and want[-1][1] > begin:
                want[-1] = (want[-1][0], max(want[-1][1], end), want[-1][2])
            else:
                want.append((begin, end, kind_))
        assert [tuple(s) for s in r["merged"]] == want


@pytest.mark.parametrize("size", [300_000])
def test_one_very_long_token(docs_of, size):
    rng = random.Random(2)
    token = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(size))
    start = time.time()
    row = secret_scan.summary(secret_scan.find_secrets(docs_of([f"key {token} password=abcdef end"]))).first()
    assert f"assign:{size + 5}:{size + 20}" in row["spans"] and time.time() - start < 60


def test_a_text_full_of_spans(docs_of):
    n = 5000
    text = " ".join(f"user{i}@example{i % 7}.com 10.0.{i % 250}.7 x" for i in range(n))
    start = time.time()
    found = pii.find_personal_data(docs_of([text]))
    row = pii.summary(found).first()
    assert (row["n_email"], row["n_ip"]) == (n, n)
    assert pii.redact(found).first()["text"] == " ".join(["[EMAIL] [IP] x"] * n)
    assert time.time() - start < 90


def test_texts_under_one_id_link_on_their_own(spark):
    rng = random.Random(7)
    a, b = (" ".join(f"{p}{rng.randrange(9999)}" for _ in range(200)) for p in "wv")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (1, a), (4, "alone here with no other text at all")]
    want = sorted([(1, 2, 1), (1, 1, 1), (2, 2, 1), (3, 1, 1), (1, 2, 1), (4, 0, 4)])
    for k in range(4):
        rng.shuffle(rows)
        got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(1 + k))
        assert sorted(tuple(r) for r in got.collect()) == want
