"""Selection by rank without a sort: which rows are among the k first of their group.

Rows are ordered by a hexadecimal hash.  Histograms of its leading digits narrow down, for every
wanted rank at once, the prefix in which the rank lies, until a prefix ends exactly there; then
one comparison a row decides.  A pass counts by (group, prefix) with map-side aggregation; no row
is sorted, ranked or shuffled, and a hot group costs no more than others.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .blocked import ordinal_within

DIGITS = 32                      # of an md5 hash
NO_GROUP = "\0null"


class Cut(NamedTuple):
    """The first ``rank`` rows of a group: all below ``prefix``, the ``inside`` first of those that begin with it."""
    rank: int
    prefix: str
    inside: int
    there: int

    @property
    def done(self) -> bool:
        return self.inside in (0, self.there) or len(self.prefix) == DIGITS

    @property
    def tied(self) -> bool:
        """Whether rows with one and the same hash fall on both sides."""
        return self.inside not in (0, self.there)


def _text(group: Column) -> Column:
    return F.coalesce(group.cast("string"), F.lit(NO_GROUP))


def _looked_up(values: dict[str, str], group: Column) -> Column:
    """values[group] (null without one); one entry a group, as many as the label has values."""
    if not values:
        return F.lit(None).cast("string")
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), _text(group))


def _histogram(df: DataFrame, group: Column, order: Column, length: int) -> dict[str, list[tuple[str, int]]]:
    """For each group its prefixes of this length in order, with their rows."""
    out: dict[str, list[tuple[str, int]]] = {}
    for r in df.groupBy(_text(group).alias("g"), F.substring(order, 1, length).alias("p")).count().collect():
        out.setdefault(r["g"], []).append((r["p"], r["count"]))
    return {g: sorted(rows) for g, rows in out.items()}


def _narrowed(cut: Cut, rows: list[tuple[str, int]]) -> Cut:
    """The cut in the prefix of ``rows`` (all within its own prefix) that holds its last row."""
    inside = cut.inside
    for prefix, n in rows:
        if inside <= n:
            return Cut(cut.rank, prefix, inside, n)
        inside -= n
    raise ValueError("the rows have changed between two passes")


def rank_cuts(df: DataFrame, group: Column, order: Column, ranks: Callable[[str, int], Sequence[int]], digits: int = 3) -> list[dict[str, Cut]]:
    """For each i a cut in every group after its ``ranks(group, rows)[i]`` first rows (at most all).

    The driver sees at most 16^digits numbers for each group and rank in a pass; groups are the values of a label."""
    first = _histogram(df, group, order, digits)
    cuts: list[dict[str, Cut]] = []
    for g, rows in first.items():
        n = sum(c for _, c in rows)
        for i, rank in enumerate(ranks(g, n)):
            while len(cuts) <= i:
                cuts.append({})
            rank = max(0, min(int(rank), n))
            cuts[i][g] = _narrowed(Cut(rank, "", rank, n), rows) if rank else Cut(0, "", 0, n)
    length = digits
    while any(not c.done for by in cuts for c in by.values()):
        length = min(DIGITS, length + digits)
        opened = [{g: c.prefix for g, c in by.items() if not c.done} for by in cuts]
        wanted = F.lit(False)
        for by in opened:
            wanted = wanted | F.coalesce(F.startswith(order, _looked_up(by, group)), F.lit(False))
        found = _histogram(df.where(wanted), group, order, length)
        for by, prefixes in zip(cuts, opened, strict=True):
            for g, prefix in prefixes.items():
                by[g] = _narrowed(by[g], [(p, n) for p, n in found.get(g, []) if p.startswith(prefix)])
    return cuts


def among_first(df: DataFrame, group: Column, order: Column, ranks: Callable[[str, int], Sequence[int]], out: Sequence[str], digits: int = 3) -> DataFrame:
    """df with a boolean column ``out[i]``: whether the row is among the ``ranks(group, rows)[i]`` first of its group.

    ``order``: an md5 hash in hexadecimal digits (``seeded_hash``).  A null group is a group.  Rows with one
    hash that fall on both sides of a cut (repeated rows) are told apart by their place, so that
    the numbers are exact; only these are numbered.  df is read once a pass, and must give the same rows each time."""
    cuts = rank_cuts(df, group, order, ranks, digits)
    while len(cuts) < len(out):
        cuts.append({})
    # up to and with a prefix if all of it is in ("g" comes after all digits), else before it
    bounds = [{g: "" if not c.rank else c.prefix + "g" if c.inside == c.there else c.prefix for g, c in by.items()} for by in cuts]
    plain = [F.coalesce(order < _looked_up(b, group), F.lit(False)) for b in bounds]
    ties = [{g: c for g, c in by.items() if c.tied} for by in cuts]
    rows = df.withColumns(dict(zip(out, plain, strict=False)))
    if not any(ties):
        return rows
    tied = F.lit(False)
    for by in ties:
        tied = tied | F.coalesce(order == _looked_up({g: c.prefix for g, c in by.items()}, group), F.lit(False))
    ensure_checkpoint_dir(df.sparkSession)
    same = rows.where(tied).withColumn("_t", F.concat_ws("|", _text(group), order)).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    numbered = ordinal_within(same, "_t", ["_at"], out="_n")
    for name, by in zip(out, ties, strict=False):
        if by:
            few = _looked_up({g: str(c.inside) for g, c in by.items()}, group).cast("long")
            here = F.coalesce(order == _looked_up({g: c.prefix for g, c in by.items()}, group), F.lit(False))
            numbered = numbered.withColumn(name, F.when(here, F.col("_n") <= few).otherwise(F.col(name)))
    return rows.where(~tied).unionByName(numbered.drop("_t", "_at", "_n"))
