"""Small helpers of the operators: reading tables, the registry, connected components."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; a session on one machine without one gets its own."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            import tempfile
            folder = tempfile.mkdtemp(prefix="faultline-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def keep(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the undirected edges (a, b).

    Alternating hooking: each round links every vertex's larger neighbours, then all
    its neighbours, to the smallest one in reach (large-star and small-star); the
    number of rounds grows with the logarithm of the longest path.  Every round is
    a grouped aggregate and a join on the vertex, and is checkpointed.  The driver
    sees one number a round, whether anything changed."""
    star = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        mark = star.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or not mark["n"]:
            break
        before = mark
        # large-star: larger neighbours of x go to the least of x and its neighbours.
        # The least is kept first: a join of two plain shuffles is one whose hot keys Spark can split.
        both = star.select("u", "v").union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = keep(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small-star: smaller neighbours of x, and x, go to the least of them
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        star = keep(small.where("u <> v").distinct())
    low = star.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.select("id").join(low.withColumnRenamed("u", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def grouped(batches, key: str):
    """The rows of each key, as tables, from batches of a partition that is sorted by ``key``.

    Only the rows of one key are held."""
    import numpy as np
    import pyarrow as pa
    held: list = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            if held and keys[a] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = keys[a]
            held.append(batch.slice(a, z - a))
    if held:
        yield current, pa.Table.from_batches(held)


def smallest_in_reach(n: int, a, b):
    """For the undirected edges (a, b) over 0..n-1, the smallest vertex reachable from each (inside one task)."""
    import numpy as np
    low = np.arange(n)
    while True:
        before = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (low == before).all():
            return low


def lean(batches):
    """The batches; at their end, memory that the process has freed but keeps goes back to the system.

    Python workers outlive their tasks, and idle ones sit beside the tasks of later stages."""
    import ctypes
    import pyarrow as pa
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
        if trim:
            trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write as a table of the shared checkpoint folder and read it back (compressed, unlike a checkpoint)."""
    import uuid
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
