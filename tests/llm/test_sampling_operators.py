"""Importance resampling, license notices and fill-in-the-middle against plain Python."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from faultline.llm import fill_in_middle as fim
from faultline.llm import license_scan, resampling
from faultline.llm.normal import normalised
from faultline.llm.text import utf8

import pyarrow as pa

from llm_fixtures import docs_of  # noqa: F401


def words(text):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


HARD = [None, "", "\n", "\n\n\n", "One line", "Ünïcode wörds — naïve café 中文 字", "a\nb\nc", "a\nb\n", "x" * 70_000, "word " * 30_000, "😀\n😀😀\nü", "É é", "a\nb\nc", " tail \r\n mid\x00dle"]


def test_normalised_texts():
    data, offsets = utf8(pa.array(HARD))
    normal = normalised(data, offsets)
    want = b"\n" + b"".join(" ".join(words(t)).encode() + b"\n" for t in HARD if words(t))
    assert normal.data.tobytes() == want
    assert np.diff(normal.first).tolist() == [len(words(t)) for t in HARD]


# ---- importance resampling

def test_running_crc_of_any_range():
    rng = np.random.default_rng(5)
    for n in (2, 255, 256, 257, 5000, 140_000):
        data = rng.integers(0, 256, n, dtype=np.uint8)
        start = rng.integers(1, n, 300)
        end = np.array([rng.integers(s, n + 1) for s in start])
        got = resampling.RunningCrc(data).ranges(start, end)
        assert got.tolist() == [zlib.crc32(data[a:z].tobytes()) for a, z in zip(start, end, strict=True)]


def resampled(texts, target, shortest, longest, buckets, least, percent, seed):
    """The definition, one document at a time."""
    def features(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]
    own, other = [0] * buckets, [0] * buckets
    for counts, rows in ((own, texts), (other, target)):
        for t in rows:
            for b in features(t):
                counts[b] += 1
    s, t = sum(own), sum(other)
    gains = [math.floor(1000 * math.log((y + 1) * (s + buckets) / ((x + 1) * (t + buckets)))) for x, y in zip(own, other, strict=True)]
    rows = []
    for i, text in enumerate(texts, 1):
        f = features(text)
        weight = sum(gains[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    large = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: k for k, r in enumerate(large[:len(large) * percent // 100], 1)}
    return [(*r[:4], rank.get(r[0])) for r in rows]


@pytest.mark.parametrize("ngrams,percent", [((1, 1), 10), ((1, 3), 50), ((2, 2), 100), ((1, 1), 0)])
def test_resampling_is_the_definition(spark, docs_of, ngrams, percent):
    rng = random.Random(ngrams[1])
    vocabulary = ["alpha", "Beta", "gamma", "DELTA", "épsilon", "zeta9", "η"]
    texts = HARD + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(80)]
    target = ["alpha alpha beta gamma", None, "zeta9 η new words"]
    got = resampling.importance_resample(docs_of(texts), spark.createDataFrame([(t,) for t in target], "text string"), ngrams=ngrams, buckets=97, least_words=5, percent=percent, seed=11)
    rows = sorted((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect())
    assert rows == resampled(texts, target, *ngrams, 97, 5, percent, 11)
    assert "text" in got.columns and got.columns.count("score") == 1 and "label" in got.columns


def test_resampling_prefers_the_target(spark, docs_of):
    texts = ["wanted words " * 10] * 30 + ["other things " * 10] * 300
    got = resampling.importance_resample(docs_of(texts), spark.createDataFrame([("wanted words " * 50,)] * 40, "text string"), buckets=200).where("rank IS NOT NULL").collect()
    assert len(got) == 33 and sum(r["doc_id"] <= 30 for r in got) == 30


def test_ties_repeated_rows_and_nothing(spark, docs_of):
    rows = spark.createDataFrame([(i, "same words here") for i in (7, 7, 7, 7, None, None, 3, 3)], "doc_id long, text string")
    got = resampling.importance_resample(rows, rows.limit(0), least_words=1, percent=50).collect()
    assert len(got) == 8 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]
    order = sorted(got, key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["score"], str(r["doc_id"])) for r in got if r["rank"]) == sorted((r["score"], str(r["doc_id"])) for r in order[:4])
    none = resampling.importance_resample(rows.limit(0), rows)
    assert none.count() == 0 and {"n_words", "n_features", "weight", "score", "rank"} < set(none.columns)


def test_last_drawn_score(spark):
    scores = [random.Random(2).randint(-5000, 5000) for _ in range(500)] + [77] * 50
    df = spark.createDataFrame([(s,) for s in scores], "score long")
    want = sorted(scores, reverse=True)
    assert [resampling.score_at(df, k) for k in (1, 250, 550)] == [want[0], want[249], want[549]]


# ---- license notices

def base_places(t):
    w, out = words(t), []
    for phrase, label in license_scan.BASE_NOTICES:
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return out


LICENSED = [
    "Released under the MIT License.", "relesed under the MIT licence", "GNU\n * General-Public  LICENSE, and the gnu general public license.", "the GNU genral publik License v3",
    "CC BY-NC 4.0 and cc-by", "ccby xcc by", "Apache License Apache License apache licens", "mit license", "MITLICENSE", "gnu general mit license public license", "mit license " * 3000,
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "Permission is hereby granted to any person obtaining a copy", "license", "cc", "é mit é license mit license é"]


def test_base_places(docs_of):
    texts = HARD + LICENSED
    found = license_scan.summary(license_scan.find_notices(docs_of(texts))).orderBy("doc_id").collect()
    for row, t in zip(found, texts, strict=True):
        want = base_places(t)
        assert row["n_words"] == len(words(t)) and row["n_base"] == len(want)
        assert [row["first_word"], row["last_word"]] == ([min(i for i, _ in want), max(i for i, _ in want)] if want else [None, None])
        assert row["base_labels"] == ",".join(sorted({x for _, x in want}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert (row["score"] == 1) if want else (0 <= row["score"] <= 1)


def best_edits(notice, text):
    """Fewest edits of the notice to any run of whole words: the usual table over all places."""
    best = len(notice)
    for begin in [i + 1 for i, c in enumerate(text) if c in b" \n" and i + 1 < len(text)]:
        row = list(range(len(notice) + 1))
        for at in range(begin, min(len(text), begin + len(notice) + 5)):
            if text[at] in b" \n" and at > begin:
                best = min(best, row[-1])
            if text[at] == 10:
                break
            new = [row[0] + 1]
            for k, c in enumerate(notice):
                new.append(min(row[k + 1] + 1, new[k] + 1, row[k] + (c != text[at])))
            row = new
    return best


def test_edits_are_the_fewest(docs_of):
    rng = random.Random(9)
    texts = list(LICENSED[:6])
    for _ in range(150):
        notice = list(rng.choice(license_scan.NOTICES)[0])
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(notice))
            notice[i:i + 1] = rng.choice([[], ["q"], [notice[i], "z"], [" "]])
        texts.append(f"some words {''.join(notice)} more words")
    rows = license_scan.find_notices(docs_of(texts)).orderBy("doc_id").collect()
    search = license_scan.Notices(license_scan.NOTICES, 10, 3)
    for row, t in zip(rows, texts, strict=True):
        text = ("\n" + " ".join(words(t)) + "\n").encode()
        for notice in search.notices:
            spans = [s for s in row["notices"] if s["notice"] == notice.text.decode()]
            edits = best_edits(notice.text, text)
            assert (min(s["edits"] for s in spans) == edits) if edits <= notice.edits else not spans, (t, notice.text)


def test_spans_are_places_in_the_text(docs_of):
    texts = ["é😀 (MIT  License) x", "ü\nGNU\n// genral public-License ü"]
    a, b = license_scan.find_notices(docs_of(texts), carry=["doc_id", "text"]).orderBy("doc_id").collect()
    assert [(s["label"], a["text"][s["begin"]:s["end"]], s["first_word"], s["edits"]) for s in a["notices"]] == [("mit", "MIT  License", 1, 0)]
    assert [(s["label"], b["text"][s["begin"]:s["end"]], s["edits"]) for s in b["notices"]] == [("gpl", "GNU\n// genral public-License", 1)]


def test_notices_are_checked_and_texts_may_be_none(docs_of):
    with pytest.raises(ValueError):
        license_scan.find_notices(docs_of([""]), [("MIT License", "mit")])
    assert license_scan.summary(license_scan.find_notices(docs_of(["a"]).limit(0))).count() == 0
    got = license_scan.find_notices(docs_of(["a b a b a b"]), [("a b a", "x")]).first()
    assert [(s["first_word"], s["edits"]) for s in got["notices"]] == [(0, 0), (2, 0)]


# ---- fill in the middle

def test_cutting_splits_descriptors():
    table = fim.PieceTable([b"hello world", b"<M>"], [fim.Piece(0, 0, 5), fim.Piece(1, 0, 3), fim.Piece(0, 5, 11)])
    assert table.bytes() == b"hello<M> world" and table.sha256() == hashlib.sha256(b"hello<M> world").hexdigest()
    for a in range(15):
        for z in range(a, 15):
            parts = table.cut([a, z])
            assert [fim.PieceTable(table.buffers, p).bytes() for p in parts] == [b"hello<M> world"[x:y] for x, y in ((0, a), (a, z), (z, 14))]


def in_middle(i, t, percent, spm, seed):
    h = hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in range(0, 32, 8))
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    a, z = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:z]), "".join(lines[z:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(lines), "plain", None, None, t
    if h4 % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("percent,spm", [(100, 50), (60, 0), (0, 50)])
def test_fill_in_middle_is_the_definition(docs_of, percent, spm):
    texts = HARD + ["a <P> b\nc", "x<S>", "<M>", "<\nP>\n<<\n", "\r\n\r\n"] + ["\n".join("line %d é" % k for k in range(n)) for n in range(40)]
    made = fim.fill_in_middle(docs_of(texts), seed=3, arranged_percent=percent, spm_percent=spm, restored=True)
    rows = fim.restore(made).orderBy("doc_id").collect()
    for i, (r, t) in enumerate(zip(rows, texts, strict=True), 1):
        assert (r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == in_middle(i, t or "", percent, spm, 3)
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() and r["restored"] == (t or "")


def test_units_of_code_points_and_other_sentinels(docs_of):
    texts = ["añb😀c" * k for k in range(20)]
    made = fim.fill_in_middle(docs_of(texts), unit="character", sentinels=("[PRE]", "[MID]", "[SUF]"), restored=True)
    for r, t in zip(fim.restore(made, sentinels=("[PRE]", "[MID]", "[SUF]")).orderBy("doc_id").collect(), texts, strict=True):
        assert r["n_units"] == len(t) and r["restored"] == t and (r["form"] == "plain") == (not t)
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs_of(texts), sentinels=("<P>", "<P>", "<S>"))


def test_fill_in_middle_of_null_ids_and_nothing(spark, docs_of):
    rows = spark.createDataFrame([(None, "a\nb"), (None, "a\nb"), (None, None)], "doc_id long, text string")
    a, b, c = sorted(fim.fill_in_middle(rows).collect(), key=lambda r: r["form"], reverse=True)
    assert a == b and a["form"] in ("psm", "spm") and (c["form"], c["output"], c["n_units"]) == ("plain", "", 0)
    assert fim.fill_in_middle(docs_of(["a"]).limit(0), restored=True).count() == 0
