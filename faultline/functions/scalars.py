"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _map(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# H1 / H2 / H3 -------------------------------------------------------------
def severity_weight(severity: Column) -> Column:
    return F.coalesce(F.element_at(_map(K.RISK_SEVERITY_WEIGHT), severity), F.lit(K.UNKNOWN_SEVERITY_WEIGHT))


def risk_score(confidence: Column, severity: Column) -> Column:
    """H1: round(confidence x severity weight, 4)."""
    return F.round(confidence * severity_weight(severity), 4)


def risk_level(score: Column) -> Column:
    """H2: >= .75 HIGH, >= .50 MEDIUM, else LOW."""
    t = K.RISK_LEVEL_THRESHOLDS
    return F.when(score >= t["HIGH"], "HIGH").when(score >= t["MEDIUM"], "MEDIUM").otherwise("LOW")


def plant_status(severity: Column) -> Column:
    """H3: severity -> plant status (WARNING when unknown)."""
    return F.coalesce(F.element_at(_map(K.SEVERITY_TO_STATUS), severity), F.lit(K.UNKNOWN_FAULT_STATUS))


def severity_rank(severity: Column) -> Column:
    return F.element_at(_map(K.SEVERITY_RANK), severity)


# H4 / H5 / H6 / H7 / H8 ---------------------------------------------------
def health_score(p: Column) -> Column:
    return (F.lit(1.0) - p) * F.lit(100.0)


def is_fault(p: Column, threshold: float = K.BINARY_THRESHOLD) -> Column:
    return (p >= F.lit(threshold)).cast("int")


def binary_label(fault: Column, sample: Column, cutoff: int) -> Column:
    """1 when a fault run is past its injection sample."""
    return ((fault > 0) & (sample > cutoff)).cast("int")


def masked_target(fault: Column, sample: Column, cutoff: int) -> Column:
    """The fault label after injection, 0 before."""
    return F.when(sample > cutoff, fault).otherwise(F.lit(0)).cast("int")


def max_prob(probs: Column) -> Column:
    return F.array_max(probs)


def risk_proxy(probs: Column) -> Column:
    return F.lit(1.0) - F.array_max(probs)


def confidence_pct(confidence: Column) -> Column:
    """H6: '96.0%'."""
    return F.format_string("%.1f%%", confidence * 100.0)


def alert_timestamp(base_ts: Column, index: Column, minutes: int = K.SAMPLE_MINUTES) -> Column:
    """H7: base + index x 3 minutes."""
    return F.timestamp_add("MINUTE", index * F.lit(minutes), base_ts)


def sample_minutes(sample: Column) -> Column:
    return sample * F.lit(K.SAMPLE_MINUTES)


# H9 / H10 / H11 / H19 / H21 / H22 -------------------------------------------
def operational_risk(fault_id: Column, p: Column) -> Column:
    """H9: per-class risk; class 13 HIGH only above p .8; 16-20 and unknown LOW."""
    table = F.element_at(_map(K.OPERATIONAL_RISK), fault_id)
    return (F.when(fault_id == 13, F.when(p > K.CLASS13_HIGH_ABOVE, "HIGH").otherwise("MEDIUM"))
            .when(fault_id.between(16, 20), "LOW")
            .otherwise(F.coalesce(table, F.lit("LOW"))))


def snapshot_plant_state(fault: Column, risk: Column, p: Column) -> Column:
    """Not fault -> NORMAL; HIGH risk or p >= .92 -> CRITICAL; else WARNING."""
    return (F.when(~fault, "NORMAL").when((risk == "HIGH") | (p >= K.CRITICAL_P), "CRITICAL")
            .otherwise("WARNING"))


def snapshot_severity(plant: Column, fault: Column, risk: Column) -> Column:
    return (F.when(~fault, "NONE").when(plant == "CRITICAL", "CRITICAL").when(risk == "HIGH", "HIGH")
            .when(risk == "MEDIUM", "MEDIUM").otherwise("LOW"))


def maintenance_risk(risk: Column) -> Column:
    return F.when(risk == "HIGH", "SEVERE").when(risk == "MEDIUM", "MODERATE").otherwise("LOW")


def failure_window_snapshot(sample: Column) -> Column:
    """max(5, 480 - sample)."""
    return F.greatest(F.lit(5), F.lit(480) - F.round(sample).cast("int"))


def recommended_action(fault_id: Column) -> Column:
    """Per-class action; 16-20 unclassified; unknown fallback."""
    return (F.when(fault_id.between(16, 20), F.lit(K.ACTION_UNCLASSIFIED))
            .otherwise(F.coalesce(F.element_at(_map(K.RECOMMENDED_ACTIONS), fault_id), F.lit(K.ACTION_FALLBACK))))


def anomaly_level(score: Column) -> Column:
    """> .6 high, > .3 warn, else ok."""
    return F.when(score > 0.6, "high").when(score > 0.3, "warn").otherwise("ok")


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def confidence_pct_int(p: Column) -> Column:
    """Confidence percent clamped to 0..100 and rounded (half up)."""
    return clamp(F.floor(p * 100.0 + 0.5), 0, 100).cast("int")


# H12 / H13 / H14 / H15 / H17 / H20 / H23 ------------------------------------
def case_failure_window(delay: Column) -> Column:
    """max(3, 11 + 3*delay); 45 when delay is null or negative."""
    return F.when(delay.isNull() | (delay < 0), F.lit(45)).otherwise(F.greatest(F.lit(3), F.lit(11) + 3 * delay))


def urgency(severity: Column) -> Column:
    """CRITICAL P1, HIGH P2, MEDIUM P3, else P4."""
    return F.coalesce(F.element_at(_map(K.URGENCY_BY_SEVERITY), severity), F.lit("P4"))


def relative_time(hours_ago: Column) -> Column:
    """Null -> 'No recent alerts'; under a minute 'Just now'; under an hour
    'Nm ago'; else 'Nh ago' (half-up rounding)."""
    mins = F.floor(hours_ago * 60.0 + 0.5).cast("long")
    hrs = F.floor(hours_ago + 0.5).cast("long")
    return (F.when(hours_ago.isNull(), F.lit("No recent alerts"))
            .when(hours_ago < 1.0 / 60.0, F.lit("Just now"))
            .when(hours_ago < 1.0, F.concat(mins.cast("string"), F.lit("m ago")))
            .otherwise(F.concat(hrs.cast("string"), F.lit("h ago"))))


def recall_in_ten(recall: Column) -> Column:
    """Recall as 'n in 10' with n clamped to 1..10 (half-up rounding)."""
    n = clamp(F.floor(recall * 10.0 + 0.5), 1, 10).cast("int")
    return F.concat(n.cast("string"), F.lit(" in 10"))


def action_steps(detail: Column) -> Column:
    """Split an action detail on ' · ' into trimmed, non-empty steps."""
    parts = F.split(detail, " · ")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def parse_fault_id(raw: Column) -> Column:
    """Integer 0..20, else 1."""
    n = F.expr("try_cast(NULL AS double)") if raw is None else raw.try_cast("double")
    ok = n.isNotNull() & (n == F.floor(n)) & (n >= 0) & (n <= 20)
    return F.when(ok, n.cast("int")).otherwise(F.lit(1))


def plain_sensor_name(tag: Column) -> Column:
    """Operator-facing sensor name; unknown xmeas tags -> 'Plant sensor <n>'."""
    return F.coalesce(F.element_at(_map(K.SENSOR_PLAIN_NAMES), F.lower(tag)),
                      F.regexp_replace(tag, "(?i)^xmeas_", "Plant sensor "))


def z_score(x: Column, mean: Column, scale: Column) -> Column:
    """(imputed value - mean) / scale."""
    return (x - mean) / scale
