"""URL rules by a sort-merge range join (DataFrame functions only).

A key is the host's labels reversed, each followed by a dot, then a separator and the path
(``a.example.org`` and ``/es/x`` -> ``org.example.a.`` | ``/es/x``), as bytes.  What starts with a key is
the interval from the key to the key followed by FF, a byte that UTF-8 never uses.  Intervals of keys are nested
or disjoint, so a sweep over sorted keys needs one stack: a beginning puts a rule on it, an end takes it off.
The stack is kept as pointers.  Each border names the rule on top from there on: a beginning itself,
an end the rule beneath (its parent), so a border is one row however deeply rules are nested.

The host part and the path part of a rule are prefixes of their own, so there are two sweeps.  The first finds for
each distinct host the innermost rule host around it; that one's ancestors are its chain.  The second sweeps each
distinct (host, path) once for every rule host of its chain, against the rules' whole keys.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _A_Z, _a_z), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")), "UTF-8")


def rule_key(host: Column, path: Column) -> Column:
    """Host and path in one; FE, which UTF-8 never uses either, comes between them."""
    return F.concat(host_key(host), F.lit(b"\xfe"), F.encode(path, "UTF-8"))


def with_parents(intervals: DataFrame, group: Column, part: Column) -> DataFrame:
    """(key, part, parent): ``intervals`` (distinct keys) with the key of the innermost interval around each, if any.

    ``part`` is the key's varying text within its ``group``.  Of a key only those prefixes are looked up that are as
    long as some other key of the group: one equi-join, linear in the rules times their nesting."""
    keys = intervals.select("key", group.alias("group"), part.alias("part")).withColumn("size", F.octet_length("part"))
    sizes = keys.groupBy("group").agg(F.collect_set("size").alias("sizes"))                  # at most as many as the longest key is long
    shorter = F.explode(F.filter("sizes", lambda n: n < F.col("size")))
    prefixes = keys.join(sizes, "group").select("key", "group", "part", shorter.alias("n")).select("key", "group", F.expr("substring(part, 1, n)").alias("part"))
    around = prefixes.join(keys.select(F.col("key").alias("outer"), "group", "part", "size"), ["group", "part"])
    return keys.select("key", "part").join(around.groupBy("key").agg(F.max_by("outer", "size").alias("parent")), "key", "left")


def borders(intervals: DataFrame) -> DataFrame:
    """(key, turn, top): which interval is on top of the stack from each border on (null: none).

    turn orders equal keys: a beginning (1) comes before a point (2); ends have keys of their own."""
    return intervals.select(F.inline(F.array(
        F.struct("key", F.lit(1).alias("turn"), F.col("key").alias("top")),
        F.struct(F.concat("key", F.lit(b"\xff")).alias("key"), F.lit(1).alias("turn"), F.col("parent").alias("top")))))


def sweep(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """``points`` (key, and others) with top: the key of the innermost of the nested intervals (key, parent) around it.

    One range shuffle sorts points and borders.  Each range keeps its own sweep, and
    starts from the last border of the ranges before it (one row a range).  Points with equal keys may lie in several ranges."""
    others = [c for c in points.columns if c != "key"]
    both = (points.withColumns({"turn": F.lit(2), "border": F.lit(None).cast("struct<top:binary>")})
            .unionByName(borders(intervals).select("key", "turn", F.struct("top").alias("border")), allowMissingColumns=True))
    ranged = both.repartitionByRange("key", "turn", *others)
    both = keep(ranged.withColumn("range", F.spark_partition_id()))
    last = both.where("turn = 1").groupBy("range").agg(F.max_by("border", "key").alias("left"))
    ranges = both.select("range").distinct().join(last, "range", "left")
    carried = ranges.select("range", F.last("left", ignorenulls=True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    inside = Window.partitionBy("range").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    return (both.withColumn("here", F.last("border", ignorenulls=True).over(inside)).where("turn = 2")
            .join(carried, "range", "left").select("key", *others, F.coalesce("here", "carried")["top"].alias("top")))


def rule_hosts_around(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rule_host): for distinct hosts the rule hosts that are the host itself or a domain above it."""
    labels = F.split("rule_host", r"\.", -1)
    nodes = keep(rules.select("rule_host").distinct().withColumn("key", host_key(F.col("rule_host"))))
    nested = keep(with_parents(nodes, F.element_at(labels, -1), F.col("key")))
    above = nodes.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("rule_host"))
    chain = above.join(nodes.select("rule_host"), "rule_host").select(F.col("key").alias("top"), "rule_host")
    tops = sweep(hosts.select("host", host_key(F.col("host")).alias("key")), nested).where("top IS NOT NULL")
    return tops.join(chain, "top").select("host", "rule_host")


def judge_urls(pages: DataFrame, rules: DataFrame, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    rules: (rule_host, path, verdict).  A rule fits its host and all subdomains if the
    url's path starts with the rule's.  The longest rule (host and path together) wins,
    then the one with the longer host, then the greater text, then the greater verdict.
    Where no rule fits, rule is null and the verdict is ``default``.

    A null url or one without ``://`` has an empty host and path.  Rules with a null
    field are left out and repeated rules count once; with no rules at all every
    verdict is the default.  Repeated pages are rows of their own.  Other columns
    pass through; an input column named like an added one is replaced.

    Borders are two rows a rule, whatever the nesting.  A url is swept once (all its pages together) for each
    rule host above it, of which there are no more than its host has labels.  A url with a third of all
    pages is one row in the sweep; AQE splits its rows in the join that brings the result back.
    """
    rules = keep(rules.select("rule_host", "path", "verdict").na.drop().where("rule_host <> ''").groupBy("rule_host", "path").agg(F.max("verdict").alias("verdict"))
                 .withColumn("key", rule_key(F.col("rule_host"), F.col("path"))))
    pages = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}).drop("rule", "verdict", "best")
    urls = pages.select("host", "path").distinct()
    around = rule_hosts_around(pages.select("host").distinct(), rules)
    points = urls.join(around, "host").select("host", "path", "rule_host", rule_key(F.col("rule_host"), F.col("path")).alias("key"))
    nested = keep(with_parents(rules, F.col("rule_host"), F.encode("path", "UTF-8")))
    found = sweep(points, nested).where("top IS NOT NULL").select("host", F.col("path").alias("url_path"), F.col("top").alias("key"))
    fits = found.join(rules, "key").groupBy("host", "url_path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("path")).alias("length"), F.length("rule_host").alias("host_length"),
        F.concat("rule_host", "path").alias("rule"), "verdict")).alias("best"))
    return (pages.join(fits.withColumnRenamed("url_path", "path"), ["host", "path"], "left")
            .withColumns({"rule": F.col("best")["rule"], "verdict": F.coalesce(F.col("best")["verdict"], F.lit(default))})
            .drop("best"))
