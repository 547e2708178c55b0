"""Secrets by pattern, and by a battery of randomness tests (DataFrame functions only).

Long tokens are scored under the encoding they seem to use: a chi-squared test of
even use of its alphabet, a runs test of codes above and below the middle, and a
test of correlation between neighbouring codes, joined by Fisher's method into the
score p(random).  Tokens without digits are ordinary words as a rule: they serve
as controls of the same length, and a token's p-value is the share of controls
that look at least as random.  A Benjamini-Hochberg procedure weighted by length
bounds the share of false discoveries among the tokens that are reported.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep
from .spans import apart, find_all, let, tagged, written

# The base patterns. Minimum lengths that can't change a match are part of the pattern.
ASSIGN_KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_KEY + r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"

# Alphabets in code order, and the least lengths of the length classes.
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "letters": "abcdefghijklmnopqrstuvwxyz"}
LENGTHS = (16, 24, 32, 48, 64, 96)
LEVELS = 200
_SCORED = "array<struct<begin:int,end:int,bin:int,level:int,control:boolean>>"


def _upper(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by its logistic approximation (error under 2e-4)."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def encoding(token: Column) -> Column:
    """The alphabet that a token seems to use; null for plain numbers."""
    has = lambda p: token.rlike(p)
    return (F.when(~has("[A-Za-z]"), F.lit(None).cast("string"))
            .when(~has("[0-9]"), "letters")
            .when(has("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
            .when(has("^[A-Z2-7]+$"), "base32")
            .when(has("^([0-9a-z]+|[0-9A-Z]+)$"), "base36")
            .otherwise("base64"))


def _battery(codes: Column, size: Column) -> Column:
    """Joint p-value of the three tests for an array of codes 0..size-1."""
    n = F.size(codes).cast("double")

    def chi_squared(c: Column) -> Column:
        # every code between two commas: what is left without a code tells how often it occurs
        name = lambda x: F.concat(F.lit(","), x.cast("string"), F.lit(","))
        squares = let(F.array_join(F.transform(c, name), ""), lambda text: F.aggregate(F.array_distinct(c), F.lit(0.0), lambda s, x: s + F.pow(
            (F.length(text) - F.length(F.replace(text, name(x), F.lit("")))) / F.length(name(x)), F.lit(2.0))))
        df = size - 1.0
        x2 = size / n * squares - n
        return _upper((F.pow(x2 / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))

    def runs(c: Column) -> Column:
        high = F.aggregate(c, F.lit(0.0), lambda s, x: s + (x * 2 >= size).cast("double"))
        steps = F.aggregate(F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda x, y: ((x * 2 >= size) != (y * 2 >= size)).cast("double")), F.lit(1.0), lambda s, x: s + x)
        return let(F.struct(high.alias("h"), steps.alias("r")), lambda v: let(2 * v["h"] * (n - v["h"]) / n + 1, lambda m: F.when(
            m > 2, 2 * _upper(F.abs(v["r"] - m) / F.sqrt((m - 1) * (m - 2) / (n - 1)))).otherwise(F.lit(0.0))))

    def serial(c: Column) -> Column:
        mean = F.aggregate(c, F.lit(0.0), lambda s, x: s + x) / n
        return let(mean, lambda m: let(F.aggregate(c, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)), lambda var: F.when(var > 0, 2 * _upper(F.abs(F.aggregate(
            F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda x, y: (x - m) * (y - m)), F.lit(0.0), lambda s, x: s + x) / var + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))))

    logs = [F.log(F.greatest(F.lit(1e-12), p(codes))) for p in (chi_squared, runs, serial)]
    return let(-(logs[0] + logs[1] + logs[2]), lambda h: F.exp(-h) * (1 + h + h * h / 2))   # Fisher: chi-squared with 6 degrees of freedom


def scored_tokens(text: Column) -> Column:
    """(begin, end, bin, level, control) of the long tokens of a text."""
    def score(h: Column, name: Column) -> Column:
        plain = F.translate(F.regexp_replace(h["hit"], "=+$", ""), "-_", "+/")
        by_name = F.when(name == "letters", F.regexp_replace(F.lower(plain), "[+/]", "")).when((name == "hex") | (name == "base36"), F.lower(plain)).otherwise(plain)
        alphabet = F.lit(None).cast("string")
        for k, v in ALPHABETS.items():
            alphabet = F.when(name == k, F.lit(v)).otherwise(alphabet)
        return let(F.struct(by_name.alias("t"), alphabet.alias("a")), lambda s: let(_codes(s["t"], s["a"]), lambda c: F.struct(
            h["begin"].alias("begin"), h["end"].alias("end"), _bin(F.size(c)).alias("bin"),
            F.when(F.size(c) >= LENGTHS[0], F.least(F.lit(LEVELS - 1), F.floor(_battery(c, F.length(s["a"]).cast("double")) * LEVELS).cast("int"))).otherwise(0).alias("level"),
            (name == "letters").alias("control"))))

    return F.filter(F.transform(find_all(text, TOKEN), lambda h: let(encoding(h["hit"]), lambda e: F.when(e.isNotNull(), score(h, e)))), lambda x: x.isNotNull()).cast(_SCORED)


def _codes(token: Column, alphabet: Column) -> Column:
    """The place of each character in the alphabet, from one split of the token."""
    return F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c) - 1)


def _bin(n: Column) -> Column:
    return sum(((n >= low).cast("int") for low in LENGTHS[1:]), F.lit(0))


def discovery_levels(counts: list[tuple[int, int, bool, int]], rate: float, least_controls: int = 200) -> dict[int, int]:
    """For each length class the least score level to report.

    counts: (bin, level, control, number), at most bins x levels x 2 rows.  A class with
    fewer than ``least_controls`` controls borrows those of the next shorter classes
    (shorter words look more random, so this is cautious)."""
    n = {c: [[0] * LEVELS for _ in LENGTHS] for c in (True, False)}
    for b, level, control, number in counts:
        n[control][b][level] += number
    cells = []
    total = sum(map(sum, n[False]))
    mean = sum(sum(n[False][b]) * LENGTHS[b] for b in range(len(LENGTHS))) / total if total else 1.0
    for b in range(len(LENGTHS)):
        pool, c = list(n[True][b]), b
        while sum(pool) < least_controls and c > 0:
            c -= 1
            pool = [x + y for x, y in zip(pool, n[True][c], strict=True)]
        above, everything = 0, sum(pool)
        for level in range(LEVELS - 1, -1, -1):
            above += pool[level]
            cells.append(((1 + above) / (1 + everything) * mean / LENGTHS[b], b, level, n[False][b][level]))
    cells.sort()
    best, seen = -1.0, 0
    for k, (p, _, _, number) in enumerate(cells):
        seen += number
        if (k + 1 == len(cells) or cells[k + 1][0] > p) and seen and p <= rate * seen / total:
            best = p
    out: dict[int, int] = {}
    for p, b, level, _ in cells:
        if p <= best:
            out[b] = min(out.get(b, LEVELS), level)
    return out


def find_secrets(docs: DataFrame, *, text_col: str = "text", false_discovery_rate: float = 0.05) -> DataFrame:
    """``docs`` without the text, with base (array of begin, order, end, kind) and random (the same).

    base: assign, access and hex patterns over the whole text, leftmost non-overlapping
    per kind.  random: tokens that pass the randomness tests and overlap no base span.

    A null text has no spans; other columns but the text pass through, one named like an
    added one is replaced; repeated rows stay.  Without controls in the corpus nothing is added.  The text is scanned once: the spans and
    scores are kept in the checkpoint folder, and the driver sees only the histogram of
    scores (bins x levels x 2 numbers).  No shuffle of documents.
    """
    docs, text = docs.drop("base", "random", "scored"), F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(find_all(text, ASSIGN), lambda h: F.length(F.regexp_extract(h["hit"], "^" + ASSIGN_KEY + "(.*)$", 1)) >= 6)
    base = F.concat(tagged(assign, "assign", 0), tagged(find_all(text, ACCESS), "access", 1), tagged(find_all(text, HEX), "hex", 2))
    found = keep(docs.select(*[F.col(c) for c in docs.columns if c != text_col], base.alias("base"), scored_tokens(text).alias("scored")))
    one = found.select(F.explode("scored").alias("s")).groupBy("s.bin", "s.level", "s.control").count().collect()
    levels = discovery_levels([tuple(r) for r in one], false_discovery_rate)
    passes = lambda s: ~s["control"] & _any([(s["bin"] == b) & (s["level"] >= level) for b, level in levels.items()])
    random = F.transform(apart(F.filter("scored", passes), F.col("base")), lambda s: F.struct(
        s["begin"].alias("begin"), F.lit(3).alias("order"), s["end"].alias("end"), F.lit("random").alias("kind")))
    return found.withColumn("random", random).drop("scored")


def _any(terms: list[Column]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | t
    return out


def summary(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.concat("base", "random")).alias("spans"))
