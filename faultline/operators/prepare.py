"""Preparation: labels, keys, schema alignment, guards, splits and sampling.

Random choices use ``md5(key || '|' || seed)`` ordering: deterministic,
engine-independent and reproducible in SQL.  Per-group top-k and ranks use
salted two-level selection or the sort-based ordinal, so no group (a fault
class, a label) is ranked inside a single task.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import LEAKAGE_WORDS_BINARY, LEAKAGE_WORDS_MULTICLASS
from .blocked import global_prefix
from .selection import among_first


# --------------------------------------------------------------------------
# B1-B13 filters, keys, schema checks
# --------------------------------------------------------------------------
def trim_pre_injection(df: DataFrame, cutoff: int, fault: str = "faultNumber", pos: str = "sample") -> DataFrame:
    """B1: keep normal runs whole and faulty runs only after the injection sample."""
    return df.where((F.col(fault) == 0) | (F.col(pos) > cutoff))


def active_faults(df: DataFrame, only: Iterable[int] | None = None, fault: str = "faultNumber") -> DataFrame:
    """B2: rows of active faults, optionally restricted to a list."""
    out = df.where(F.col(fault) > 0)
    return out.where(F.col(fault).isin(list(only))) if only else out


def with_run_key(df: DataFrame, source: str | Column, fault: str = "faultNumber", run: str = "simulationRun",
                 out: str = "run_key") -> DataFrame:
    """``<source>_fault_<fault>_run_<run>``; raises when a key column is missing."""
    missing = [c for c in (fault, run) if c not in df.columns]
    if missing:
        raise ValueError(f"missing run key columns: {missing}")
    src = F.lit(source) if isinstance(source, str) else source
    return df.withColumn(out, F.concat(src, F.lit("_fault_"), F.col(fault).cast("string"), F.lit("_run_"),
                                       F.col(run).cast("string")))


def sensor_columns(df: DataFrame) -> list[str]:
    """Sensors discovered by prefix, in table order."""
    return [c for c in df.columns if c.startswith("xmeas_") or c.startswith("xmv_")]


def align_schema(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), dtype: str = "double") -> DataFrame:
    """Drop unknown columns, add missing ones as nulls, order as ``columns``."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(c).cast(dtype) if c in have else F.lit(None).cast(dtype)).alias(c)
                              for c in columns])


def feature_problems(schema: T.StructType, columns: Sequence[str], words: Sequence[str] = ()) -> dict[str, str]:
    """What is wrong with each requested feature: absent from the schema, of a type that is
    not a number, or named after the target (contains one of ``words``)."""
    kinds = {f.name: f.dataType for f in schema.fields}
    problems: dict[str, list[str]] = {}
    for name in columns:
        if name not in kinds:
            problems.setdefault(name, []).append("absent")
        elif not isinstance(kinds[name], T.NumericType):
            problems.setdefault(name, []).append(f"type {kinds[name].simpleString()}")
        named = [w for w in words if w in name.lower()]
        if named:
            problems.setdefault(name, []).append("named like the target: " + ", ".join(named))
    return {name: "; ".join(why) for name, why in problems.items()}


def _raise_for(problems: dict[str, str]) -> None:
    if problems:
        raise ValueError(f"{len(problems)} unusable features: " + ", ".join(f"{name} ({why})" for name, why in problems.items()))


def check_features(df: DataFrame, columns: Sequence[str]) -> None:
    """ValueError that lists every feature that is absent or no number."""
    _raise_for(feature_problems(df.schema, columns))


def check_no_leakage(columns: Sequence[str], words: Sequence[str] | None = None) -> None:
    """ValueError that lists every feature named after the target."""
    words = {*LEAKAGE_WORDS_BINARY, *LEAKAGE_WORDS_MULTICLASS} if words is None else words
    numbers = T.StructType([T.StructField(str(c), T.DoubleType()) for c in columns])
    _raise_for(feature_problems(numbers, [str(c) for c in columns], sorted(words)))


def every_kth(df: DataFrame, k: int, pos: str = "sample") -> DataFrame:
    """Every k-th row of a run by 0-based position (``pos`` is dense, 1-based)."""
    return df.where((F.col(pos) - 1) % k == 0)


def zoom(df: DataFrame, onset: int, before: int = 25, after: int = 80, pos: str = "sample") -> DataFrame:
    """Samples in [onset - before, onset + after]."""
    return df.where(F.col(pos).between(onset - before, onset + after))


# --------------------------------------------------------------------------
# hashing helpers
# --------------------------------------------------------------------------
def seeded_hash(*cols: str | Column, seed: int = 42) -> Column:
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Column, k: int, salts: int = 64) -> DataFrame:
    """The ``k`` rows with the smallest ``order`` per group (exact).

    Level 1 keeps the top k inside (group, salt) sub-groups; level 2 ranks the
    at most ``k * salts`` survivors of each group.  A hot group is thus ranked
    by ``salts`` tasks first.
    """
    group = list(group)
    d = df.withColumn("_o", order).withColumn("_salt", F.pmod(F.hash(F.col("_o")), F.lit(salts)))
    w1 = Window.partitionBy(*group, "_salt").orderBy("_o")
    lvl1 = d.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy("_o")
    return lvl1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k).drop("_o", "_salt", "_r1")


# --------------------------------------------------------------------------
# I1-I7 sampling and splits
# --------------------------------------------------------------------------
def distinct_runs(df: DataFrame, cols: Sequence[str] = ("run_key", "faultNumber", "simulationRun")) -> DataFrame:
    """One row per run."""
    return df.select(*cols).dropDuplicates([cols[0]])


def sample_runs_per_fault(runs: DataFrame, k: int, seed: int = 42, fault: str = "faultNumber",
                          key: str = "run_key") -> DataFrame:
    """K runs per fault by seeded hash order."""
    return top_k_per_group(runs, [fault], seeded_hash(key, seed=seed), k)


def stratified_run_split(runs: DataFrame, test_pct: int = 20, seed: int = 42, label: str = "faultNumber",
                         key: str = "run_key") -> DataFrame:
    """Run-level stratified split.  Per label, the first
    ``min(ceil(pct * n / 100), n - 1)`` runs in seeded hash order are ``test``,
    the rest ``train`` (exact integer arithmetic for the cut)."""
    # every class keeps at least one training run (a class of one run trains only)
    r = among_first(runs, F.col(label), seeded_hash(key, seed=seed), lambda _, n: [min(-(-n * test_pct // 100), n - 1)], ["_test"])
    return r.withColumn("fold", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def stratified_row_split(df: DataFrame, label: str, row_key: Sequence[str], pcts=(70, 15),
                         seed: int = 42) -> DataFrame:
    """I4: row-level stratified train/val/test (leaky for time series; kept as an option)."""
    a, b = pcts
    r = among_first(df, F.col(label), seeded_hash(*row_key, seed=seed), lambda _, n: [n * a // 100, n * (a + b) // 100], ["_train", "_val"])
    return r.withColumn("fold", F.when(F.col("_train"), "train").when(F.col("_val"), "val").otherwise("test")).drop("_train", "_val")


def exact_sample(df: DataFrame, n: int, row_key: Sequence[str], seed: int = 42, check: bool = True) -> DataFrame:
    """Exactly ``n`` rows in seeded hash order; error if fewer exist."""
    have = df.count() if check else n
    if have < n:
        raise ValueError(f"need {n} rows, have {have}")
    return among_first(df, F.lit("all"), seeded_hash(*row_key, seed=seed), lambda *_: [n], ["_in"]).where("_in").drop("_in")


def capped_composition(df: DataFrame, label: str, caps: dict[int, int], row_key: Sequence[str],
                       seed: int = 42) -> DataFrame:
    """At most ``caps[c]`` rows of each class c (shrink to what exists), by seeded hash.

    Rows of other classes (a null label too) are left out."""
    few = {str(c): n for c, n in caps.items()}
    return among_first(df.where(F.col(label).isin(list(caps))), F.col(label), seeded_hash(*row_key, seed=seed), lambda c, n: [min(few[c], n)], ["_in"]).where("_in").drop("_in")


def capped_compositions(df: DataFrame, label: str, fold: str, caps: dict[str, dict[tuple, int]], row_key: Sequence[str], seed: int = 42, out: str = "composition") -> DataFrame:
    """Several compositions at once: a row for each one (``out``) that takes the row.

    ``caps[name][fold, class]``: at most so many rows of that class and fold; a composition takes
    none of folds and classes that it doesn't name.  All cuts are found in the same passes."""
    names, group = list(caps), F.concat_ws("|", F.col(fold).cast("string"), F.col(label).cast("string"))
    few = [{f"{f}|{c}": n for (f, c), n in caps[name].items()} for name in names]
    some = df.where(group.isin(sorted({g for by in few for g in by})))
    flags = [f"_in_{i}" for i in range(len(names))]
    marked = among_first(some, group, seeded_hash(*row_key, seed=seed), lambda g, n: [min(by.get(g, 0), n) for by in few], flags)
    taken = F.filter(F.array(*[F.when(F.col(f), F.lit(name)) for f, name in zip(flags, names, strict=True)]), lambda x: x.isNotNull())
    return marked.withColumn(out, F.explode(taken)).drop(*flags)


def composition_class(fault: str = "faultNumber", label: str = "y_true") -> Column:
    """0 for every row of a fault-free run, 1 for the fault rows of a faulty run, else
    null: what a faulty run shows before its fault is neither."""
    return F.when(F.col(fault) == 0, 0).when(F.col(label) == 1, 1)


def complete_runs_until(runs: DataFrame, target: int, n_col: str = "n_rows", seed: int = 42,
                        key: str = "run_key") -> DataFrame:
    """Shuffle runs (seeded hash) and take whole runs until the row
    target is reached, including the run that crosses it."""
    h = runs.withColumn("_h", seeded_hash(key, seed=seed))
    # md5 is uniform, so its first hex digits make balanced, ordered ranges of a few thousand runs
    digits = 1
    runs_in_all = runs.count()
    while 16**digits * 4096 < runs_in_all:
        digits += 1
    cum = global_prefix(h, "_h", [n_col], bucket_expr=F.conv(F.substring("_h", 1, digits), 16, 10).cast("long"))
    return cum.where(F.col(n_col) - F.col(f"_d_{n_col}") < target).select(
        key, F.col(f"_d_{n_col}").alias(n_col), F.col(n_col).alias("cum_rows"), "_h")


# --------------------------------------------------------------------------
# C4/C5, D1/D2/D8/D10 fold and run audits
# --------------------------------------------------------------------------
def fold_overlap(df: DataFrame, key: str = "run_key", fold: str = "fold") -> DataFrame:
    """Run keys present in more than one fold (must be empty)."""
    return df.groupBy(key).agg(F.count_distinct(fold).alias("n_folds")).where(F.col("n_folds") > 1)


def assert_disjoint(df: DataFrame, key: str = "run_key", fold: str = "fold") -> None:
    if not fold_overlap(df, key, fold).isEmpty():
        raise AssertionError("run keys shared between folds")


def class_counts(df: DataFrame, label: str, folds: Sequence[str], fold: str = "fold") -> DataFrame:
    """Class counts per fold, outer-aligned, missing -> 0."""
    p = df.groupBy(label).pivot(fold, list(folds)).count().na.fill(0)
    return p.select(label, *[F.col(f).cast("long").alias(f) for f in folds])


def run_sizes(df: DataFrame, key: str = "run_key", label: str = "y_true") -> DataFrame:
    """Rows and fault rows per run."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(label)).cast("long").alias("n_fault_rows"))


def split_report(df: DataFrame, fold: str = "fold", label: str = "y_true", key: str = "run_key") -> DataFrame:
    """Shape, normal and fault counts, fault ratio, unique runs per fold."""
    return df.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label) == 0).alias("n_normal"),
        F.count_if(F.col(label) == 1).alias("n_fault"), F.avg(F.col(label).cast("double")).alias("fault_ratio"),
        F.count_distinct(key).alias("n_runs"))


def run_extent(df: DataFrame, cutoff: int, key: str = "run_key", label: str = "faultNumber",
               pos: str = "sample") -> DataFrame:
    """min/max sample and first label per run, of the faulty runs that begin by the cutoff."""
    e = df.groupBy(key).agg(F.min(pos).alias("min_sample"), F.max(pos).alias("max_sample"),
                            F.min_by(label, pos).alias("fault_label"))
    return e.where((F.col("fault_label") > 0) & (F.col("min_sample") <= cutoff)).withColumn(
        "n_samples", F.col("max_sample") - F.col("min_sample") + 1)


def longest_run(extents: DataFrame, key: str = "run_key") -> DataFrame:
    """The run that ends last, then begins first, then has the smallest key: one row."""
    return extents.orderBy(F.col("max_sample").desc(), "min_sample", key).limit(1)


def scan_runs(df: DataFrame, fault: int, runs: Sequence[int], fault_col: str = "faultNumber",
              run_col: str = "simulationRun") -> DataFrame:
    """A5: one fault's selected runs (filters push down to the scan); error when empty."""
    out = df.where((F.col(fault_col) == fault) & F.col(run_col).isin(list(runs)))
    if out.isEmpty():
        raise ValueError(f"no rows for fault {fault} runs {list(runs)}")
    return out
