"""The registered queries of this subpackage: each applies one operator to its whole table."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, contamination, fill_in_middle, jaccard, language_model, license_scan, pii, quality, resampling, secret_scan, toxicity, url_rules, vectors
from .common import ORACLE, QUERIES, query, shared_folder, table  # noqa: F401

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The rules of the url query (host, path, verdict).
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query("op5_decontamination", rf"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
bwin AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bwin),
dwin AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item FROM dwin JOIN bwin USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op5_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.benchmark_spans(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op6_url_rules", rf"""
WITH p AS (SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")} AS host,
                  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(rh, rp, rv) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
best AS (SELECT p.page_id, p.host, p.path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
         FROM (SELECT DISTINCT * FROM p) p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM p LEFT JOIN best USING (page_id, host, path)""")
def op6_url_rules(spark, sf_dir):
    shared_folder(spark)
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(rule_host, path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op1_secret_scan")
def op1_secret_scan(spark, sf_dir):
    return secret_scan.summary(secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op2_personal_data")
def op2_personal_data(spark, sf_dir):
    return pii.summary(pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), carry_text=False))


def fold(modulus: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


@query("op4_quality_classifier")
def op4_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, sf_dir, "labels").where(fold(3) != 1))
    return quality.score(docs, forest, carry=["doc_id"]).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold(3) != 1))
    return toxicity.score(docs, model, carry=["doc_id"]).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "offending")


def bpe_digests(docs, vocabulary):
    """Encode and decode the texts; digests of the ids and of the decoded text."""
    both = bpe.encode(docs.select("doc_id", "text"), vocabulary, decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def bpe_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_bpe")
def op10_bpe(spark, sf_dir):
    return bpe_digests(table(spark, sf_dir, "documents"), bpe_vocabulary())


@query("op9_embedding_dedup")
def op9_embedding_dedup(spark, sf_dir):
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


@query("op3_ngram_jaccard", rf"""
WITH RECURSIVE dw AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
grams AS (SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
sets AS (SELECT rid, count(*) AS n, md5(string_agg(gram, ',' ORDER BY gram)) AS key FROM grams GROUP BY rid),
classes AS (SELECT key, min(rid) AS c, any_value(n) AS n, count(*) AS weight, min(doc_id) AS least FROM sets JOIN dw USING (rid) GROUP BY key),
of_class AS (SELECT c, n, gram FROM grams JOIN classes ON rid = c),
met AS (SELECT a.c AS a, b.c AS b, a.n + b.n AS n, count(*) AS common FROM of_class a JOIN of_class b ON a.gram = b.gram AND a.c < b.c GROUP BY ALL),
pairs AS (SELECT a, b FROM met WHERE 5 * common >= 4 * (n - common)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
low AS (SELECT reach.a AS c, min(least) AS least FROM reach JOIN classes ON classes.c = reach.b GROUP BY reach.a),
degree AS (SELECT links.a AS c, sum(weight) AS others FROM links JOIN classes ON classes.c = links.b GROUP BY links.a)
SELECT doc_id, CAST(coalesce(weight - 1 + coalesce(others, 0), 0) AS BIGINT) AS n_links, coalesce(low.least, doc_id) AS class_id, doc_id = coalesce(low.least, doc_id) AS kept
FROM dw LEFT JOIN sets USING (rid) LEFT JOIN classes USING (key) LEFT JOIN low USING (c) LEFT JOIN degree USING (c)""")
def op3_ngram_jaccard(spark, sf_dir):
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_links", F.col("component").alias("class_id"), (F.col("id") == F.col("component")).alias("kept"))


@query("op7_hmm_language_model")
def op7_hmm_language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.score_texts(docs, fold(7) == 2).withColumnRenamed("id", "doc_id")


# CRC-32 of a word in SQL: a step a bit over the bytes of its UTF-8 form.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, len(hex(encode(f))) // 2 + 1), lambda i: [CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)"""


@query("op11_importance_resampling", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
df AS (SELECT r, unnest(w) AS f FROM d), bf AS (SELECT unnest({_WORDS}) AS f FROM benchmark),
v AS (SELECT f, {_CRC} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf)),
s AS (SELECT bucket, count(*) AS s FROM df JOIN v USING (f) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bf JOIN v USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM df) + 10000) AS DOUBLE) / ((s + 1) * ((SELECT count(*) FROM bf) + 10000)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT r, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM df JOIN v USING (f) JOIN g USING (bucket) GROUP BY r),
x AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, len(w) >= 20 AS large,
             CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (r)),
y AS (SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY large ORDER BY score DESC, doc_id NULLS LAST) AS i, count(*) OVER (PARTITION BY large) AS n FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN large AND i <= 10 * n // 100 THEN i END AS rank FROM z""")
def op11_importance_resampling(spark, sf_dir):
    found = resampling.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_license_scan")
def op12_license_scan(spark, sf_dir):
    return license_scan.summary(license_scan.find_notices(table(spark, sf_dir, "documents"), carry=["doc_id"]))


@query("op13_fill_in_middle", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hx FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ls, CAST('0x' || substr(hx, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hx, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(hx, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hx, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a, greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS z,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:z], '') AS mid, array_to_string(ls[z + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""")
def op13_fill_in_middle(spark, sf_dir):
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), carry=["doc_id"], output=False, restored=True)
    return made.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
