"""A cleaning pipeline over ``documents``.

Five stages, each one operator of ``faultline.llm`` applied to all rows that the stage
before kept: the quality classifier drops what it rejects, of each group of near
duplicates the document with the smallest id stays, passages of the benchmark are
cut out, personal data is replaced by its kind, and the rest is encoded.

All stages but the last return the columns of ``documents``.  A row with a null
doc_id takes part in every stage except the grouping of near duplicates, which
lets it through.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import contamination, jaccard, pii, quality, queries
from faultline.llm.common import stored, table


def _plain(docs: DataFrame) -> DataFrame:
    """doc_id and text, and all else under names that no operator uses."""
    return docs.select("doc_id", "text", *[F.col(c).alias(f"other_column_{c}") for c in docs.columns if c not in ("doc_id", "text")])


def _restored(df: DataFrame, docs: DataFrame, changed: Column) -> DataFrame:
    """The columns of ``docs`` from those of _plain; n_chars follows a changed text."""
    columns = []
    for c in docs.columns:
        if c in ("doc_id", "text"):
            columns.append(F.col(c))
        elif c == "n_chars":
            columns.append(F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(f"other_column_{c}")).alias(c))
        else:
            columns.append(F.col(f"other_column_{c}").alias(c))
    return df.select(*columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives 0.5 or more; labels are learned as in the query of its own."""
    forest = quality.fit(docs, table(spark, sf_dir, "labels").where(queries.fold(3) != 1))
    return _restored(quality.score(_plain(docs), forest).where("score >= 0.5"), docs, F.lit(False))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Different texts under one doc_id are documents of their own: only copies and near duplicates are dropped.
    Of rows with the same doc_id and text the one whose other columns read least (as JSON) stays."""
    rows = _plain(docs.where("doc_id IS NOT NULL")).withColumn("text_hash", F.xxhash64("text"))
    found = jaccard.near_duplicates(rows, texts_apart=True)
    first = found.where("first").select(F.col("id").alias("doc_id"), "text_hash").distinct()
    kept = rows.join(first, ["doc_id", "text_hash"], "left_semi")
    others = [c for c in rows.columns if c.startswith("other_column_")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    one = kept.groupBy("doc_id", "text_hash").agg(F.min_by(F.struct("text", *others), order).alias("row")).select("doc_id", "row.*")
    return _restored(one, docs, F.lit(False)).unionByName(docs.where("doc_id IS NULL"))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages that occur in the benchmark."""
    found = contamination.benchmark_spans(_plain(docs), table(spark, sf_dir, "benchmark"))
    return _restored(contamination.remove_spans(found), docs, F.col("n_hit") > 0)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind in brackets."""
    found = pii.find_personal_data(_plain(docs)).withColumn("changed", F.size("base") + F.size("added") > 0)
    return _restored(pii.redact(found), docs, F.col("changed"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return queries.bpe_digests(docs, queries.bpe_vocabulary())


STAGES = [("quality", keep_good), ("near duplicates", keep_one_of_each_group), ("decontamination", cut_benchmark), ("personal data", hide_personal_data), ("encoding", encode)]

#: Boosted trees and merges by rank are beyond SQL; tests hold run() against the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
