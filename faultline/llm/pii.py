"""Personal data by weak supervision (DataFrame functions only).

Patterns propose spans.  Five labelers vote on each: the strict form of its kind
(check digit, number ranges), clean edges, a gazetteer (top-level domains, card
issuers, calling codes, ...), a cue word shortly before, and no counter-cue (such as
"version" or "isbn").  Expectation-maximisation over the counts of vote patterns
estimates each labeler's reliability without labels; its posteriors train the final
span classifier.  Spans of the base patterns always stay; the classifier decides on
the looser forms.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, stored
from .spans import apart, chunks, cut, find_all, let, merged, written

# Base patterns.  Possessive repeats and look-behind keep long runs linear and change no match.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"

# Looser forms that only the classifier can accept.
LOOSE = {
    "email_like": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++)++",
    "phone_like": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "id_like": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban_like": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
KINDS = ("email", "ip", "card", "phone", *LOOSE)

# Gazetteers, cue words and counter-cues.
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|mil|int|info|io|biz|de|fr|es|uk|it|nl|be|ch|at|pt|pl|eu|us|ca|au|jp|cn|in|br|mx|ru)$",
    "ip": r"^(?!(0|127|255)\.).*(?<!\.255)$",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|35|6011|65|62)",
    "phone": r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "email_like": r"(?i)(com|org|net|edu|gov|info|io|de|fr|es|uk|it|eu)$",
    "phone_like": r"^\(?[2-9]",
    "id_like": r"^(?!000|666|9)",
    "iban_like": r"^(AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LT|LU|LV|MT|NL|NO|PL|PT|RO|SE|SI|SK)",
}
STRICT = {
    "email": rf"^[A-Za-z0-9][{_LOCAL}]{{0,63}}@.*\.[A-Za-z]{{2,24}}$", "ip": OCTETS, "card": None, "phone": None,
    "email_like": r"(?i)(\.|dot ?[\])]) ?[a-z]{2,24}$", "phone_like": r"^(\([0-9]{3}\)|[0-9]{3})[ .-][2-9][0-9]{2}[ .-][0-9]{4}$",
    "id_like": r"^...-(?!00)..-(?!0000)", "iban_like": r"^[A-Z]{2}(0[2-9]|[1-8][0-9]|9[0-8])",
}
CUES = (r"(?i)(e-?mail|mail|contact|kontakt|correo|courriel|phone|tel\b|tel[eé]|fax|mobile|handy|m[oó]vil|call|card|karte|carte|tarjeta|visa|credit|"
        r"\bip\b|host|server|address|adresse|ssn|social|security|iban|account|konto|compte|cuenta)")
COUNTER = r"(?i)(version|\bv\.? ?$|isbn|issn|doi|order|invoice|figure|page|section|chapter|https?:|www\.|#\s*$|[$€£]\s*$)"
VOTES = ("strict", "edge", "gazetteer", "cue", "no_counter")

_CANDIDATE = "array<struct<begin:int,order:int,end:int,kind:string,base:boolean,votes:int>>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string's check sum is a multiple of ten."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + let(
        F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return total % 10 == 0


def _votes(pieces: Column, h: Column, kind: str, strict: Column) -> Column:
    before, after = cut(pieces, h["begin"] - 1, h["begin"]), cut(pieces, h["end"], h["end"] + 1)
    ahead = cut(pieces, F.greatest(h["begin"] - 40, F.lit(0)), h["begin"])
    one = [strict, ~F.when(h["begin"] > 0, before).otherwise(F.lit("")).rlike("[A-Za-z0-9]") & ~after.rlike("[A-Za-z0-9]"),
           (_digits(h["hit"]) if kind == "card" else h["hit"]).rlike(GAZETTEER[kind]), ahead.rlike(CUES), ~ahead.rlike(COUNTER)]
    return sum((F.when(v, F.lit(1 << k)).otherwise(0) for k, v in enumerate(one)), F.lit(0))


def candidates(text: Column) -> Column:
    """All proposed spans of a text with their votes as bits; base marks those of the base patterns."""
    return let(chunks(text), lambda pieces: _candidates(text, pieces))


def _candidates(text: Column, pieces: Column) -> Column:
    def of(kind: str, pattern: str, size=None, strict=None) -> Column:
        hits = find_all(text, pattern)
        if size:
            hits = F.filter(hits, lambda h: F.length(_digits(h["hit"])).between(*size))
        order = min(KINDS.index(kind), 4)
        strict = strict or (lambda h: h["hit"].rlike(STRICT[kind]) if STRICT[kind] else F.lit(True))
        is_base = {"ip": lambda s: s, "card": lambda s: s}.get(kind, lambda s: F.lit(kind in KINDS[:4]))
        return F.transform(hits, lambda h: let(strict(h), lambda s: F.struct(
            h["begin"].alias("begin"), F.lit(order).alias("order"), h["end"].alias("end"), F.lit(kind).alias("kind"), is_base(s).alias("base"), _votes(pieces, h, kind, s).alias("votes"))))

    loose = find_all(text, "|".join(LOOSE.values()))
    parts = [of("email", EMAIL), of("ip", IP), of("card", CARD, (12, 19), lambda h: luhn(_digits(h["hit"]))), of("phone", PHONE, (9, 15))]

    def loose_kind(h: Column) -> Column:
        strict, votes, kind = F.lit(False), F.lit(0), F.lit("")
        for k in reversed(list(LOOSE)):
            mine = F.regexp_replace(h["hit"], LOOSE[k], "") == ""
            kind = F.when(mine, F.lit(k)).otherwise(kind)
            votes = F.when(mine, _votes(pieces, h, k, h["hit"].rlike(STRICT[k]))).otherwise(votes)
        return F.struct(h["begin"].alias("begin"), F.lit(4).alias("order"), h["end"].alias("end"), kind.alias("kind"), strict.alias("base"), votes.alias("votes"))

    return F.concat(*[p.cast(_CANDIDATE) for p in parts], F.transform(loose, loose_kind).cast(_CANDIDATE))


def estimate(counts: dict[tuple[str, int], int], rounds: int = 60) -> tuple[dict[tuple[str, int], float], dict[str, list[tuple[float, float]]]]:
    """Expectation-maximisation over (kind, vote pattern) counts, at most kinds x 2^5 of them.

    Returns the posterior of each pattern, and the labelers' (sensitivity, specificity).
    Pseudo-counts keep the estimates inside (0, 1) and break the symmetry in favour of
    labelers that are right more often than not."""
    prior = dict.fromkeys(KINDS, 0.5)
    rates = [(0.8, 0.6)] * len(VOTES)
    post: dict[tuple[str, int], float] = {}
    for _ in range(rounds):
        for kind, votes in counts:
            log = math.log(prior[kind] / (1 - prior[kind]))
            for k, (hit, miss) in enumerate(rates):
                log += math.log(hit / (1 - miss)) if votes >> k & 1 else math.log((1 - hit) / miss)
            post[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        for kind in KINDS:
            own = [(n, post[x]) for x, n in counts.items() if x[0] == kind]
            prior[kind] = (sum(n * p for n, p in own) + 2) / (sum(n for n, _ in own) + 4)
        fresh = []
        for k in range(len(VOTES)):
            yes = sum(n * post[x] for x, n in counts.items())
            no = sum(n * (1 - post[x]) for x, n in counts.items())
            hit = sum(n * post[x] for x, n in counts.items() if x[1] >> k & 1)
            miss = sum(n * (1 - post[x]) for x, n in counts.items() if not x[1] >> k & 1)
            fresh.append(((hit + 8) / (yes + 10), (miss + 6) / (no + 10)))
        rates = fresh
    return post, {"labelers": rates}


def train_classifier(counts: dict[tuple[str, int], int], post: dict[tuple[str, int], float], rounds: int = 300) -> tuple[dict[str, float], list[float]]:
    """Logistic regression on the posteriors: a weight for each kind and each vote.

    Gradient ascent on the pattern table with a small ridge; counts enter by their
    logarithm, so that a frequent form does not outweigh all others."""
    by_kind, by_vote = dict.fromkeys(KINDS, 0.0), [0.0] * len(VOTES)
    rows = [(kind, votes, math.log1p(n), post[kind, votes]) for (kind, votes), n in counts.items()]
    total = sum(r[2] for r in rows) or 1.0
    for _ in range(rounds):
        d_kind, d_vote = {k: -0.01 * w for k, w in by_kind.items()}, [-0.01 * w for w in by_vote]
        for kind, votes, weight, p in rows:
            z = by_kind[kind] + sum(w for k, w in enumerate(by_vote) if votes >> k & 1)
            step = weight / total * (p - 1 / (1 + math.exp(-z)))
            d_kind[kind] += step
            for k in range(len(VOTES)):
                d_vote[k] += step * (votes >> k & 1)
        by_kind = {k: w + 2.0 * d_kind[k] for k, w in by_kind.items()}
        by_vote = [w + 2.0 * d for w, d in zip(by_vote, d_vote, strict=True)]
    return by_kind, by_vote


def find_personal_data(docs: DataFrame, *, text_col: str = "text", least: float = 0.9, carry_text: bool = True) -> DataFrame:
    """``docs`` (without the text unless ``carry_text``) with base and added (arrays of begin, order, end, kind).

    base: email, ip, card and phone patterns over the whole text, leftmost
    non-overlapping per kind, failing matches dropped.  added: looser forms that the
    classifier gives at least ``least`` and that overlap no base span.

    A null text has no spans; other columns pass through, one named like an added one is
    replaced; repeated rows stay.  The text
    is scanned once: spans and votes (and the text, if carried) are kept in the checkpoint folder, and the driver
    sees only the counts of vote patterns (kinds x 32).  No shuffle of documents.
    """
    docs, text = docs.drop("base", "added", "seen"), F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(*[F.col(c) for c in docs.columns if carry_text or c != text_col], candidates(text).alias("seen"))
    found = stored(found, "personal-data") if carry_text else keep(found)
    rows = found.select(F.explode("seen").alias("s")).groupBy("s.kind", "s.votes").count().collect()
    counts = {(r["kind"], r["votes"]): r["count"] for r in rows}
    post, _ = estimate(counts)
    by_kind, by_vote = train_classifier(counts, post)

    def accepted(s: Column) -> Column:
        z = F.lit(0.0)
        for k, w in by_kind.items():
            z = F.when(s["kind"] == k, F.lit(w)).otherwise(z)
        z = z + sum((F.when(s["votes"].bitwiseAND(1 << k) != 0, F.lit(w)).otherwise(0.0) for k, w in enumerate(by_vote)), F.lit(0.0))
        return 1 / (1 + F.exp(-z)) >= least

    plain = lambda s: F.struct(s["begin"].alias("begin"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))
    base = F.transform(F.filter("seen", lambda s: s["base"]), plain)
    loose = F.transform(F.filter("seen", lambda s: s["kind"].endswith("_like") & accepted(s)), plain)
    return found.withColumn("base", base).withColumn("added", apart(loose, F.col("base"))).drop("seen")


def summary(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in KINDS[:4]], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.concat("base", "added")).alias("spans"))


def redact(found: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets, as in ``[EMAIL]``; overlapping spans become one.

    Texts without spans stay as they are."""
    def done(v: Column) -> Column:
        m, pieces = v["m"], v["p"]
        name = lambda s: F.concat(F.lit("["), F.upper(F.regexp_replace(s["kind"], "_like$", "")), F.lit("]"))
        return F.concat(F.array_join(F.transform(m, lambda s, i: F.concat(cut(pieces, _from(m, i), s["begin"]), name(s))), ""),
                        cut(pieces, F.element_at(m, -1)["end"], F.size(pieces) * 512))

    text, spans = F.col(text_col), F.concat("base", "added")
    one = let(F.struct(merged(spans).alias("m"), chunks(text).alias("p")), done)
    return found.withColumn(text_col, F.when(F.size("base") + F.size("added") > 0, one).otherwise(text)).drop("base", "added")


def _from(spans: Column, i: Column) -> Column:
    return F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
