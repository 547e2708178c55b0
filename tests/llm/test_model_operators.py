"""Classifiers, joins, the language model and the pipeline against brute force, and on awkward inputs."""
import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from faultline.llm import common, jaccard, language_model, quality, text, toxicity, vectors

from llm_fixtures import docs_of  # noqa: F401
from test_text_operators import words

SF = "/root/testdata/sf0.01"


def reach(n, pairs):
    low = list(range(n))

    def find(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# ---- n-gram Jaccard join

def gram_set(t, size=5):
    w = words(t)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_links(texts):
    sets = [gram_set(t) for t in texts]
    return [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]


@pytest.mark.parametrize("block_rows", [256, 7])
def test_jaccard_against_brute_force(spark, docs_of, block_rows):
    rng = random.Random(block_rows)
    texts = [None, "", "one two", "One, two", "!!", "a b c d e", "a b c d e f", "word " * 30000]
    for _ in range(12):
        base = prose(rng, rng.choice([30, 80, 200]))
        for _ in range(rng.choice([1, 2, 6, 30])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = "x" + str(rng.random())
            texts.append(" ".join(copy))
    shared = " ".join(prose(rng, 40))
    texts += [shared + " " + " ".join(prose(rng, 100)) for _ in range(20)]
    links = brute_links(texts)
    got = jaccard.near_duplicates(docs_of(texts, start=0), block_rows=block_rows).orderBy("id").collect()
    degree = collections.Counter(x for pair in links for x in pair)
    assert [r["n_links"] for r in got] == [degree[i] for i in range(len(texts))]
    assert [r["component"] for r in got] == reach(len(texts), links)


def test_jaccard_of_repeated_rows_and_nothing(spark, docs_of):
    twice = docs_of(["a b c d e f g", "q"]).unionByName(docs_of(["a b c d e f g", "q"])).unionByName(docs_of([None, "zz"], start=5))
    rows = sorted(jaccard.near_duplicates(twice).collect())
    assert [(r["id"], r["n_links"], r["component"]) for r in rows] == [(1, 1, 1), (1, 1, 1), (2, 1, 2), (2, 1, 2), (5, 0, 5), (6, 0, 6)]
    assert jaccard.near_duplicates(twice.limit(0)).count() == 0


def test_pruning_bounds():
    fewest = jaccard.fewest_matches(0.8, 1e-6)
    for n, m in fewest.items():
        tail = lambda k, n=n: sum(math.comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-6 and (m == 0 or tail(m - 1) < 1e-6)
    # a pair at the threshold survives all checks but for a chance of about the tolerance
    rng = np.random.default_rng(0)
    equal = rng.random((20000, 128)) < 0.8
    sig = np.where(equal, 1, 2).astype(np.uint16)
    sig[:, :4] = 1
    x, y = jaccard.likely_pairs(np.concatenate([np.ones((1, 128), np.uint16), sig]), np.array([0]), np.arange(1, 20001), 0, fewest)
    assert len(x) >= 19995


# ---- vectors

@pytest.mark.parametrize("block_rows", [1024, 16])
def test_vectors_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 16))
    near = np.concatenate([base, base[:60] + rng.normal(size=(60, 16)) * 0.2, base[:5].repeat(30, 0) + rng.normal(size=(150, 16)) * 0.15, base[:10], base[:8] * 3.5])
    x = near.astype(np.float32).astype(float)
    awkward = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0] + [0.0] * 14, [1e38] * 16]
    rows = [(i, [float(a) for a in v], 1) for i, v in enumerate(x)] + [(1000 + i, v, 1) for i, v in enumerate(awkward)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), block_rows=block_rows).orderBy("id").collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    cosine = unit @ unit.T
    links = [(a, b) for a in range(len(x)) for b in range(a) if cosine[a, b] >= 0.95]
    degree = collections.Counter(i for pair in links for i in pair)
    low = reach(len(x), links)
    assert [r["n_links"] for r in found[:len(x)]] == [degree[i] for i in range(len(x))]
    assert [r["component"] for r in found[:len(x)]] == low
    assert [(r["n_links"], r["component"]) for r in found[len(x):]] == [(0, 1000), (0, 1001), (0, 1002), (0, 1003), (0, 1004), (0, 1005), (1, 1006), (1, 1006), (0, 1008)]


def test_no_vectors(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(nothing).count() == 0
    only_null = spark.createDataFrame([(1, None), (1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vectors.near_duplicates(only_null).collect()] == [(1, 0, 1), (1, 0, 1)]


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(300, 360)]
    got = common.components(spark.range(400), spark.createDataFrame(pairs, "a long, b long")).orderBy("id").collect()
    assert [r["component"] for r in got] == reach(400, pairs)


# ---- classifiers

def test_forest_arrays_against_plain_traversal():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5)).astype(np.float32)
    x[:50] = x[50:100]                                         # ties
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = quality.grow(x, y, trees=30)
    for i in range(0, 800, 37):
        total = forest.start
        for feature, above, leaf in zip(forest.feature, forest.above, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[i, feature[node]] > above[node] else 1)
            total += leaf[node - len(feature)]
        assert forest.score(x[i:i + 1])[0] == pytest.approx(1 / (1 + math.exp(-total)))
    assert ((forest.score(x) >= 0.5) == (y == 1)).mean() > 0.97
    assert quality.grow(x[:0], y[:0]).score(x).tolist() == [0.5] * 800
    assert (quality.grow(x, np.ones(800)).score(x) > 0.9).all()


def test_statistics_against_plain_python():
    texts = ["Hello World, hello | x2!\nHello World, hello | x2!\n\nÉa b", "", "A", "aa aa aa bb"]
    data, offsets = text.utf8(pa.array(texts))
    got = quality.statistics(data, offsets)
    name = {n: k for k, n in enumerate(quality.STATISTICS)}
    for row, t in zip(got, texts, strict=True):
        w, b = re.split(r"[\x20\x09-\x0D]+", t.lower().replace("É", "é")) if t else [], t.encode()
        w = [x for x in w if x]
        pairs = list(zip(w[:-1], w[1:], strict=True))
        lines = [x for x in re.split(r"[\n\r\x0b\x0c]+", t.lower()) if x]
        assert row[name["log_words"]] == pytest.approx(math.log1p(len(w)), rel=1e-5)
        assert row[name["share_bar"]] == pytest.approx(b.count(b"|") / max(len(b), 1), rel=1e-5)
        assert row[name["distinct_words"]] == pytest.approx(len(set(w)) / max(len(w), 1), rel=1e-5)
        assert row[name["top_word"]] == pytest.approx(max(collections.Counter(w).values(), default=0) / max(len(w), 1), rel=1e-5)
        assert row[name["distinct_pairs"]] == pytest.approx(len(set(pairs)) / max(len(pairs), 1), rel=1e-5)
        assert row[name["repeated_lines"]] == pytest.approx(1 - len(set(lines)) / max(len(lines), 1) if lines else (1 if not t else 0), abs=1e-5) or not t


@pytest.mark.parametrize("name, label, recall, alarms", [("op4_quality_classifier", "quality", 0.97, 0.1), ("op8_toxicity", "toxic", 0.6, 0.02)])
def test_held_out_accuracy(spark, name, label, recall, alarms):
    sf = "/root/testdata/sf0.1"
    got = __spark_entry__.queries()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").groupBy(label).agg(F.avg("predicted").alias("yes")).collect()
    yes = {r[label]: r["yes"] for r in got}
    assert yes[1] >= recall and yes[0] <= alarms


def test_classifiers_on_awkward_input(spark, docs_of):
    docs = docs_of([None, "", "x" * 50000, "good words here. You idiot!", "good words here.", "good words here."])
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (5, 0, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    forest = quality.fit(docs, labels)
    rows = quality.score(docs, forest).orderBy("doc_id").collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows) and rows[0]["score"] == rows[1]["score"] and rows[4]["score"] == rows[5]["score"]
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).orderBy("doc_id").collect()
    assert len(rows) == 6 and rows[0]["score"] == 0 and rows[1]["score"] == 0 and rows[0]["offending"] == []
    assert quality.score(docs.limit(0), quality.fit(docs, labels.limit(0))).count() == 0
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels.limit(0))).count() == 0


def test_toxic_sentences_are_located(spark, docs_of):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        sentences = [" ".join(prose(rng, 8, 60)) for _ in range(6)]
        if i % 4 == 0:
            sentences[rng.randrange(6)] += " dratted " + rng.choice(["fool", "foolish", "foolery"])
        rows.append("Ö " + ". ".join(sentences) + ".")
        labels.append((i + 1, int(i % 4 == 0)))
    docs = docs_of(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = toxicity.score(docs, model).orderBy("doc_id").collect()
    for r, t, (_, y) in zip(found, rows, labels, strict=True):
        assert (r["score"] >= 0.7) == bool(y)
        assert [("fool" in t[s["begin"]:s["end"]]) for s in r["offending"]] == [True] * y
    assert (toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_bytes=1 << 30).weight == model.weight).all()      # the bound isn't reached
    none = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_bytes=1)
    assert toxicity.score(docs, none).where("score BETWEEN 0 AND 1").count() == 600
    p = np.array([0.1, 0.5, 0.2])
    assert toxicity.noisy_or(p, np.array([0, 0, 2]), 3) == pytest.approx([0.55, 0, 0.2])


# ---- language model

def test_forward_recursion_is_exact():
    rng = np.random.default_rng(1)
    m = language_model.Hmm(np.array([0.1, 0.2, 0.3, 0.4]), rng.dirichlet(np.ones(4), 4), rng.dirichlet(np.ones(1025), 4).T)
    length = np.array([1, 5, 300, 1024, 1025, 3000, 2, 2048, 3])
    seq, first = rng.integers(0, 1025, length.sum()).astype(np.uint16), np.cumsum(length) - length
    for got, f, n in zip(language_model.log_likelihoods(seq, first, length, m), first, length, strict=True):
        state, log = m.start * m.emit[seq[f]], 0.0
        for t in range(1, n):
            log += math.log10(state.sum())
            state = (state / state.sum() @ m.step) * m.emit[seq[f + t]]
        assert got == pytest.approx(log + math.log10(state.sum()), rel=1e-9)
    # expected counts against forward-backward on one short sequence
    s = seq[:20]
    start, step, emit = language_model.expected_counts(s, np.array([0]), np.array([20]), m)
    alpha = [m.start * m.emit[s[0]]]
    for t in range(1, 20):
        alpha.append((alpha[-1] @ m.step) * m.emit[s[t]])
    beta = [np.ones(4)]
    for t in range(18, -1, -1):
        beta.insert(0, m.step @ (m.emit[s[t + 1]] * beta[0]))
    total = alpha[-1].sum()
    assert start == pytest.approx(alpha[0] * beta[0] / total)
    assert step == pytest.approx(sum(np.outer(alpha[t], m.emit[s[t + 1]] * beta[t + 1]) * m.step for t in range(19)) / total)
    assert emit.sum() == pytest.approx(20) and emit[s[3]].sum() >= 1 - 1e-9


def brute_base(docs, modulus=7, out=2):
    tokens = {k: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")) if w] + ["\0end"] for k, (_, t) in enumerate(docs)}
    held = [zlib.crc32(str(i).encode()) % modulus == out for i, _ in docs]
    count = collections.Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(count.values()), len(count)
    return [(len(ws), sum(count[w] > 0 for w in ws), n, held[k], sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in ws)) for k, ws in tokens.items()]


@pytest.mark.parametrize("part_tokens, frequent", [(2_000_000, 65_536), (50, 65_536), (50, 20), (2_000_000, 20)])
def test_language_model_counts(spark, docs_of, part_tokens, frequent, monkeypatch):
    """Words are broadcast, or (with ``frequent`` 20 most of them) shuffled, in one part and slice or in many."""
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    rng = random.Random(6)
    texts = [" ".join(prose(rng, rng.choice([1, 5, 50, 400]), 3000)) for _ in range(80)] + [None, "", "É é É É A a\x0bb\x1cc", "zz " * 5000]
    docs = list(enumerate(texts, 1))
    frame = docs_of(texts).unionByName(docs_of([texts[0]]))
    docs.append((1, texts[0]))                                 # a repeated row
    got = language_model.score_texts(frame, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, part_tokens=part_tokens, rounds=1).collect()
    key = lambda r: (r[0], r[1])
    want = sorted(((i, *b[:4]) + (b[4],) for (i, _), b in zip(docs, brute_base(docs), strict=True)), key=key)
    got = sorted(((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"], r["base_score"], r["score"]) for r in got), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)
    assert language_model.score_texts(frame.limit(0), F.lit(False), rounds=1).count() == 0
    empty = language_model.score_texts(docs_of([None, "", ""]), F.lit(False), rounds=1).collect()          # no word in any text
    assert [(r["n_tokens"], r["n_known"]) for r in empty] == [(1, 1)] * 3
    alone = language_model.score_texts(frame.limit(3), F.lit(True), rounds=1).collect()      # nothing to learn from
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in alone)


def test_latent_states_help_on_held_out_texts(spark):
    rows = __spark_entry__.queries()["op7_hmm_language_model"](spark, SF).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


# ---- pipeline and entry

def test_pipeline_against_its_stages(spark):
    docs = common.table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    frames, at = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = common.stored(stage(spark, at, SF), "test-stage")
        assert at.dtypes == docs.dtypes
        frames.append({r["doc_id"]: (r["text"], r["n_chars"]) for r in at.collect()})
    good, single, clean, hidden = frames
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([(d in good) == (q == 1) for d, q in labels.items()]) > 0.97 and all(good[d][0] == texts[d] for d in good)
    ids = sorted(good)
    sets = {i: gram_set(texts[i]) for i in ids}
    shared = collections.defaultdict(list)
    for i in ids:
        for g in sets[i]:
            shared[g].append(i)
    common_grams = collections.Counter((a, b) for own in shared.values() for k, a in enumerate(own) for b in own[k + 1:])
    place = {d: k for k, d in enumerate(ids)}
    low = reach(len(ids), [(place[a], place[b]) for (a, b), n in common_grams.items() if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n)])
    assert sorted(single) == [d for d, x in zip(ids, low, strict=True) if place[d] == x]
    bench = {tuple(w[k:k + 10]) for r in common.table(spark, SF, "benchmark").collect() for w in [words(r["text"])] for k in range(max(1, len(w) - 9))}
    for d, (t, n) in single.items():
        w = words(t)
        dirty = any(tuple(w[k:k + 10]) in bench for k in range(len(w) - 9))
        assert (clean[d][0] != t) == dirty and (dirty or clean[d] == (t, n))
        if dirty:
            w = words(clean[d][0])
            assert not any(tuple(w[k:k + 10]) in bench for k in range(len(w) - 9)) and clean[d][1] == len(clean[d][0])
    assert sorted(hidden) == sorted(clean)
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) for t, _ in hidden.values())
    final = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert {r["doc_id"] for r in final.collect()} == set(hidden)


def test_pipeline_stages_on_awkward_rows(spark, docs_of, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("b", "one two three")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of([None, "", "a@b.cc One two, three!", "plain", "plain", "z" * 30000]).withColumn("removal", F.lit(1)).unionByName(docs_of([None, "q"], start=7).withColumns({"doc_id": F.lit(None).cast("long"), "removal": F.lit(2)}))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert 7 <= out.count() <= 8 and stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    hidden = corpus_pipeline.hide_personal_data(spark, docs, str(tmp_path)).where("doc_id = 3").first()
    assert hidden["text"] == "[EMAIL] One two, three!" and hidden["n_chars"] == len(hidden["text"]) and hidden["removal"] == 1
    assert corpus_pipeline.cut_benchmark(spark, docs, str(tmp_path)).where("doc_id = 3").first()["text"] == "a@b.cc  !"


def test_entry_lists_every_operator():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_expected_counts_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(8)
    m = language_model.Hmm(rng.dirichlet(np.ones(4)), rng.dirichlet(np.ones(4) * 0.5, 4), rng.dirichlet(np.ones(1025), 4).T)
    length = np.array([700, 1, 256, 0, 257, 1100, 30])
    seq, first = rng.integers(0, 1025, length.sum()).astype(np.uint16), np.cumsum(length) - length
    got = language_model.expected_counts(seq, first, length, m)
    monkeypatch.setattr(language_model, "PIECE", 2000)
    for a, b in zip(got, language_model.expected_counts(seq, first, length, m), strict=True):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-12)
    assert np.isclose(got[0].sum(), 6) and np.isclose(got[1].sum(), length.sum() - 6)


def test_large_sets_share_no_minhash_values_by_chance():
    rng = np.random.default_rng(3)
    sig = jaccard.signatures(rng.integers(0, 2**64, 600_000, dtype=np.uint64), np.array([0, 300_000]))
    assert (sig[0] == sig[1]).sum() <= 2


def test_jaccard_blocks_by_bytes(spark, docs_of, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 9999, 60)]
    texts = [" ".join(base + [f"end{k}"]) for k in range(12)]
    want = jaccard.near_duplicates(docs_of(texts)).orderBy("id").collect()
    assert all(r["n_links"] == 11 and r["component"] == 1 for r in want)
    assert jaccard.near_duplicates(docs_of(texts), block_bytes=1000).orderBy("id").collect() == want


def test_pipeline_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, b + " more"), (3, c), (1, None), (None, c), (4, a)]
    kept = corpus_pipeline.keep_one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(kept.collect(), key=str) == sorted(spark.createDataFrame([(1, a), (1, b), (3, c), (1, None), (None, c)], "doc_id long, text string").collect(), key=str)


def test_pipeline_keeps_the_same_one_of_repeated_rows(spark):
    rows = [(1, "x y z", "en", k % 4) for k in range(40)] + [(1, "x y z", None, 7), (2, "p q", None, None)]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, text_hash int").repartition(parts)
        assert sorted(corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()) == [(1, "x y z", "en", 0), (2, "p q", None, None)]


def test_jaccard_names_one_first_text_of_a_component(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b + " more"), (3, a + " more"), (4, None), (4, "")], "doc_id long, text string")
    found = jaccard.near_duplicates(docs, texts_apart=True).join(docs.withColumn("text_hash", F.xxhash64("text")).withColumnRenamed("doc_id", "id"), ["id", "text_hash"])
    assert sorted((r["id"], r["text"] or "") for r in found.where("first").collect()) == [(1, a), (1, b), (4, ""), (4, "")]
    assert sorted(r["n_links"] for r in found.collect()) == [0, 0, 1, 1, 2, 2, 2]


def test_vectors_longer_than_most_are_left_alone(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8)).tolist()
    rows = list(enumerate(base + base[:3])) + [(100, [1.0] * 500_000), (101, [1.0] * 500_000), (102, base[0] + [0.0])]
    found = {r["id"]: (r["n_links"], r["component"]) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [found[k] for k in (100, 101, 102)] == [(0, 100), (0, 101), (0, 102)]
    assert [found[k] for k in (0, 1, 2, 40, 41, 42, 9)] == [(1, 0), (1, 1), (1, 2), (1, 0), (1, 1), (1, 2), (0, 9)]


def test_probes_of_many_cells_find_the_neighbours():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(400, 32))
    x = np.repeat(centre, 20, 0) + rng.normal(size=(8000, 32)) * 0.16
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = vectors.fit_index(x[::2], 360, math.sqrt(0.1))
    own, probes, codes, error = vectors.place(x, index)
    assert len(index.centroids) == index.first[-1] and abs(len(index.centroids) - 360) < 40
    assert all(o in p and (np.diff(p) > 0).all() for o, p in zip(own, probes, strict=True))
    a, b = np.nonzero(np.triu(x @ x.T >= 0.95, 1))
    met = [own[j] in probes[i] or own[i] in probes[j] for i, j in zip(a, b, strict=True)]
    assert len(a) > 10_000 and np.mean(met) > 0.99
    assert np.mean([len(p) for p in probes]) < 60
