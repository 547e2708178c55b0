"""Pattern matches with code point positions, as column expressions (no Python in the tasks)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64
HITS = "array<struct<begin:int,end:int,hit:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(numbers: Column) -> Column:
    """Exclusive running sums of a non-empty int array, by blocks, so that the work
    grows far slower than the square of the array's length."""
    zero = F.lit(0)
    block = lambda b: F.aggregate(F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK)), zero, lambda s, x: s + x)
    last = F.floor((F.size(numbers) - 1) / _BLOCK).cast("int")
    heads = F.aggregate(F.transform(F.sequence(zero, last), block), F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return let(heads, lambda h: F.transform(numbers, lambda _, i: F.get(h, F.floor(i / _BLOCK).cast("int")) + F.aggregate(
        F.slice(numbers, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK), zero, lambda s, x: s + x)))


def find_all(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as (begin, end, hit), in code points, end exclusive.

    Positions come from the lengths of the pieces between matches.  The pattern must not
    match the empty string.  A null or empty text has no matches."""
    def placed(hits: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        lengths = let(pieces, lambda p: F.zip_with(F.slice(p, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("size"))))
        return let(lengths, lambda ls: let(prefix_sums_of(ls), lambda heads: F.transform(hits, lambda hit, i: F.struct(
            (F.get(heads, i) + F.get(ls, i)["gap"]).alias("begin"), (F.get(heads, i) + F.get(ls, i)["gap"] + F.get(ls, i)["size"]).alias("end"), hit.alias("hit")))))

    def prefix_sums_of(ls: Column) -> Column:
        return let(F.transform(ls, lambda x: x["gap"] + x["size"]), prefix_sums)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(let(found, lambda hits: F.when(F.size(hits) > 0, placed(hits))), F.array().cast(HITS))


def tagged(hits: Column, kind: str, order: int) -> Column:
    """(begin, order, end, kind) of each hit."""
    return F.transform(hits, lambda h: F.struct(h["begin"].alias("begin"), F.lit(order).alias("order"), h["end"].alias("end"), F.lit(kind).alias("kind")))


def written(spans: Column) -> Column:
    """kind:begin:end by begin, then order of the kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


_CHUNK = 512


def chunks(text: Column) -> Column:
    """The text as an array of pieces of 512 code points (the last may be shorter), so that a place in it is reached at once."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))


def cut(pieces: Column, begin: Column, end: Column) -> Column:
    """Code points begin..end (exclusive) of the text of ``pieces``; what lies outside of it is left out."""
    first, last = F.floor(begin / _CHUNK).cast("int"), F.floor(F.greatest(end - 1, begin) / _CHUNK).cast("int")
    piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
    middle = F.when(last > first + 1, F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")).otherwise(F.lit(""))
    tail = F.when(last > first, F.substring(piece(last), F.lit(1), (end - last * _CHUNK).cast("int"))).otherwise(F.lit(""))
    return F.when(end > begin, F.concat(F.substring(piece(first), (begin - first * _CHUNK + 1).cast("int"), F.least(end - begin, F.lit(_CHUNK)).cast("int")), middle, tail)).otherwise(F.lit(""))


def running_max(numbers: Column) -> Column:
    """For each number of a non-empty int array the largest so far, itself included; by blocks."""
    def by_blocks(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / _BLOCK).cast("int")
        tops = F.transform(F.sequence(F.lit(0), last), lambda b: F.array_max(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))))
        heads = F.aggregate(tops, F.array(F.lit(-1)), lambda acc, x: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), x))))
        return let(heads, lambda h: F.transform(v, lambda _, i: F.greatest(F.get(h, F.floor(i / _BLOCK).cast("int")), F.array_max(
            F.slice(v, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK + 1)))))
    return let(numbers, by_blocks)


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others.

    The others are sorted; those that begin before a span's end are counted by halving, and the
    furthest end among them tells whether one reaches into the span."""
    def before(begins: Column, end: Column) -> Column:
        halved = F.aggregate(F.sequence(F.lit(1), F.lit(31)), F.struct(F.lit(0).alias("lo"), F.size(begins).alias("hi")), lambda s, _: let(
            F.floor((s["lo"] + s["hi"]) / 2).cast("int"), lambda m: F.when(s["lo"] >= s["hi"], s).when(F.get(begins, m) < end, F.struct((m + 1).alias("lo"), s["hi"].alias("hi")))
            .otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi")))))
        return halved["lo"]

    def free(v: Column) -> Column:
        begins, ends = F.transform(v["o"], lambda o: o["begin"]), F.transform(v["o"], lambda o: o["end"])
        kept = let(F.struct(begins.alias("b"), running_max(ends).alias("e")), lambda o: F.filter(v["s"], lambda s: let(
            before(o["b"], s["end"]), lambda n: (n == 0) | (F.get(o["e"], n - 1) <= s["begin"]))))
        return F.when((F.size(v["o"]) == 0) | (F.size(v["s"]) == 0), v["s"]).otherwise(kept)

    plain = F.array_sort(F.transform(others, lambda o: F.struct(o["begin"].alias("begin"), o["end"].alias("end"))))
    return let(F.struct(spans.alias("s"), plain.alias("o")), free)


def merged(spans: Column) -> Column:
    """Spans by place, overlapping ones joined to one of the first's kind."""
    def joined(v: Column) -> Column:
        spans, far = v["s"], v["far"]
        firsts = F.filter(F.transform(spans, lambda s, i: F.when((i == 0) | (F.get(far, i - 1) <= s["begin"]), i)), lambda i: i.isNotNull())
        return let(firsts, lambda f: F.transform(f, lambda i, k: F.struct(
            F.get(spans, i)["begin"].alias("begin"), F.get(far, F.coalesce(F.get(f, k + 1), F.size(spans)) - 1).alias("end"), F.get(spans, i)["kind"].alias("kind"))))

    none = F.array().cast("array<struct<begin:int,end:int,kind:string>>")
    return let(F.array_sort(spans), lambda o: F.when(F.size(o) > 0, let(F.struct(o.alias("s"), running_max(F.transform(o, lambda s: s["end"])).alias("far")), joined)).otherwise(none))
