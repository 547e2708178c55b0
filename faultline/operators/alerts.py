"""Risk fusion, alerts, operator snapshots, incidents and maintenance items.

All columnar: catalogue lookups are broadcast joins against 21-row
dimension tables (size fixed by the fault vocabulary), per-row top drivers
use higher-order array functions, and edges use the run-blocked ``lag``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import scalars as S
from .blocked import DEFAULT_BLOCK, halo_select


# --------------------------------------------------------------------------
# A11 catalogues
# --------------------------------------------------------------------------
def fault_catalog(spark: SparkSession) -> DataFrame:
    """Backend catalogue: fault_id, name, description, type, severity, action."""
    schema = "fault_id int, name string, description string, type string, severity string, action string"
    return spark.createDataFrame(K.FAULT_CATALOG, schema)


def operator_catalog(spark: SparkSession) -> DataFrame:
    """Operator catalogue: label, description, fault type, affected systems, actions, base failure window."""
    schema = T.StructType([
        T.StructField("fault_id", T.IntegerType()), T.StructField("label", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("fault_type", T.StringType()),
        T.StructField("affected_systems", T.ArrayType(T.StringType())),
        T.StructField("recommended_action", T.StringType()), T.StructField("action_detail", T.StringType()),
        T.StructField("base_failure_minutes", T.IntegerType())])
    return spark.createDataFrame(K.OPERATOR_CATALOG, schema)


# --------------------------------------------------------------------------
# F6 / H5 argmax and probability summaries
# --------------------------------------------------------------------------
def argmax_class(probs: Column, classes: Column | None = None) -> Column:
    """class of the highest probability, ties -> first (lowest) class."""
    idx = F.array_position(probs, F.array_max(probs)).cast("int")
    return idx if classes is None else F.element_at(classes, idx)


def align_probabilities(prob_map: Column, labels: Sequence[int]) -> Column:
    """Probabilities for a target label list; absent labels -> 0."""
    return F.array(*[F.coalesce(F.element_at(prob_map, F.lit(lab)), F.lit(0.0)) for lab in labels])


# --------------------------------------------------------------------------
# C2 catalogue lookup with defaults
# --------------------------------------------------------------------------
def with_catalog(df: DataFrame, fault_col: str, spark: SparkSession | None = None) -> DataFrame:
    """Left broadcast join with the backend catalogue; unknown ids get the
    documented defaults (name 'Unknown (id)', MEDIUM, type Unknown)."""
    spark = spark or df.sparkSession
    cat = fault_catalog(spark).select(
        F.col("fault_id").alias("_cid"), F.col("name").alias("_name"), F.col("description").alias("_desc"),
        F.col("type").alias("_type"), F.col("severity").alias("_sev"), F.col("action").alias("_act"))
    j = df.join(F.broadcast(cat), F.col(fault_col) == F.col("_cid"), "left")
    return (j.withColumn("predicted_fault", F.coalesce("_name", F.concat(F.lit("Unknown ("),
                                                                          F.col(fault_col).cast("string"), F.lit(")"))))
             .withColumn("fault_type", F.coalesce("_type", F.lit(K.UNKNOWN_FAULT_TYPE)))
             .withColumn("severity", F.coalesce("_sev", F.lit(K.UNKNOWN_FAULT_SEVERITY)))
             .withColumn("recommended_action", F.coalesce("_act", F.lit(K.UNKNOWN_FAULT_ALERT_ACTION)))
             .withColumn("description", F.coalesce("_desc", F.lit(K.UNKNOWN_FAULT_DESCRIPTION)))
             .drop("_cid", "_name", "_desc", "_type", "_sev", "_act"))


# --------------------------------------------------------------------------
# F1 top drivers
# --------------------------------------------------------------------------
def top_drivers(features: Sequence[str], imputed: dict[str, Column], z: dict[str, Column],
                importance: dict[str, Column], k: int = 5) -> Column:
    """the k features with the largest |z x importance| (ties: later feature
    first), as array<struct<feature, value, z_score, contribution>>."""
    items = [F.struct((-F.abs(z[f] * importance[f])).alias("_key"), F.lit(-i).alias("_tie"),
                      F.lit(f).alias("feature"), imputed[f].alias("value"), z[f].alias("z_score"),
                      (z[f] * importance[f]).alias("contribution")) for i, f in enumerate(features)]
    ordered = F.sort_array(F.array(*items))
    return F.transform(F.slice(ordered, 1, k), lambda s: F.struct(
        s["feature"].alias("feature"), s["value"].alias("value"), s["z_score"].alias("z_score"),
        s["contribution"].alias("contribution")))


# --------------------------------------------------------------------------
# J16 / J17 alert construction
# --------------------------------------------------------------------------
def build_alerts(df: DataFrame, probs: str, base_ts: Column, features: Sequence[str] = (),
                 params: dict[str, tuple[float, float, float]] | None = None,
                 importance: dict[str, float] | None = None, index: Column | None = None) -> DataFrame:
    """One alert per row: argmax class, confidence, catalogue fields, risk
    fusion, timestamp and top drivers.  ``params`` are the train-fitted
    (median, mean, scale) per feature; ``importance`` the model's weights."""
    d = df.withColumn("predicted_fault_id", argmax_class(F.col(probs)))
    d = d.withColumn("_conf", F.array_max(F.col(probs)))
    d = with_catalog(d, "predicted_fault_id")
    idx = index if index is not None else (F.col("sample") - 1)
    d = (d.withColumn("timestamp", S.alert_timestamp(base_ts, idx))
          .withColumn("plant_status", S.plant_status(F.col("severity")))
          .withColumn("confidence", F.round("_conf", 4))
          .withColumn("confidence_pct", S.confidence_pct(F.col("_conf")))
          .withColumn("severity_rank", S.severity_rank(F.col("severity")))
          .withColumn("risk_score", S.risk_score(F.col("_conf"), F.col("severity")))
          .withColumn("risk_level", S.risk_level(F.col("risk_score"))))
    if features and params and importance:
        imputed = {f: F.coalesce(F.col(f).cast("double"), F.lit(params[f][0])) for f in features}
        z = {f: (imputed[f] - F.lit(params[f][1])) / F.lit(params[f][2]) for f in features}
        imp = {f: F.lit(importance[f]) for f in features}
        d = d.withColumn("top_features", top_drivers(features, imputed, z, imp))
    return d.drop("_conf")


# --------------------------------------------------------------------------
# E11 rising edges
# --------------------------------------------------------------------------
def rising_edges(df: DataFrame, flag: str = "is_fault", key: str = "run_key", pos: str = "sample",
                 block: int = DEFAULT_BLOCK, dense: bool = False) -> DataFrame:
    """Rows where the flag goes 0 -> 1 (never the run's first row)."""
    def build(w: Window) -> list[Column]:
        return [F.lag(F.col(flag), 1).over(w).alias("_prev")]
    e = halo_select(df, key, pos, build, before=1, block=block, dense=dense)
    return e.where((F.col("_prev") == 0) & (F.col(flag) == 1)).drop("_prev")


# --------------------------------------------------------------------------
# J19 operator snapshot
# --------------------------------------------------------------------------
def operator_snapshot(df: DataFrame, p: str = "p_fault", is_fault: str = "is_fault", cls: str = "fault_type_pred",
                      health: str = "health_score", pos: str = "sample", sensors: dict[str, str] | None = None) -> DataFrame:
    """Per scored sample: plant state, class, severity, maintenance risk,
    clamped scores, failure window, action and affected systems.

    sensors: the columns that the panel shows as reactor_temp, separator_pressure, flow_rate and
    vibration (a valve reading, scaled); a missing reading, and a panel without a column, shows its default."""
    spark = df.sparkSession
    fault = F.col(is_fault) == 1
    class_id = S.clamp(F.round(F.col(cls)), 1, 20).cast("int")
    d = df.withColumn("_cls", class_id).withColumn("_risk", S.operational_risk(F.col("_cls"), F.col(p)))
    d = d.withColumn("plant_status", S.snapshot_plant_state(fault, F.col("_risk"), F.col(p)))
    cat = operator_catalog(spark).select(F.col("fault_id").alias("_fid"), F.col("affected_systems").alias("_sys"),
                                         F.col("description").alias("_desc"))
    d = d.join(F.broadcast(cat), F.col("_cls") == F.col("_fid"), "left")
    desc = F.when(F.col("_cls") == 13, F.lit(K.CLASS13_DESCRIPTION)).otherwise(F.coalesce("_desc", F.lit("Unknown fault")))
    action = S.recommended_action(F.col("_cls"))
    reading = lambda name: F.coalesce(F.col(sensors[name]).cast("double") if sensors and name in sensors else F.lit(None).cast("double"), F.lit(float(K.SNAPSHOT_SENSOR_DEFAULTS[name])))
    return d.select(
        "*",
        F.when(fault, F.col("_cls")).alias("fault_id"),
        S.snapshot_severity(F.col("plant_status"), fault, F.col("_risk")).alias("severity"),
        F.when(fault, S.maintenance_risk(F.col("_risk"))).otherwise(F.lit("LOW")).alias("maintenance_risk"),
        S.confidence_pct_int(F.col(p)).alias("confidence_pct"),
        S.clamp(F.col(p), 0.0, 1.0).alias("risk_score"),
        F.when(fault, F.col("_risk")).otherwise(F.lit("LOW")).alias("risk_level"),
        F.when(fault, S.failure_window_snapshot(F.col(pos))).alias("failure_window_minutes"),
        F.when(fault, action).otherwise(F.lit(K.ACTION_NORMAL)).alias("recommended_action"),
        F.when(fault, F.concat(F.lit(K.TEXT_DETECTED[0]), F.col("_cls").cast("string"), F.lit(K.TEXT_DETECTED[1]), desc))
        .otherwise(F.lit("Plant running normally")).alias("detected_fault"),
        F.when(fault, F.coalesce("_sys", F.array(*[F.lit(s) for s in K.SNAPSHOT_FALLBACK_SYSTEMS])))
        .otherwise(F.array(F.lit("Plant-wide"))).alias("affected_systems"),
        S.clamp(F.col(health), 0.0, 100.0).alias("system_health_pct"),
        S.clamp(F.col(p), 0.0, 0.99).alias("anomaly_score"),
        F.when(fault, F.concat_ws(" ", action, F.lit(K.ACTION_DETAIL_FAULT))).otherwise(F.lit(K.ACTION_DETAIL_NORMAL)).alias("action_detail"),
        S.clamp(F.col(p), 0.0, 1.0).alias("anomaly_index"),
        *[(F.least(F.lit(0.99), F.lit(0.35) + reading(c) / 200) if c == "vibration" else reading(c)).alias(c) for c in K.SNAPSHOT_SENSOR_DEFAULTS],
    ).drop("_cls", "_risk", "_fid", "_sys", "_desc")


# --------------------------------------------------------------------------
# J20 / J21 maintenance items and live incidents from active faults
# --------------------------------------------------------------------------
def maintenance_items(active: DataFrame, fault_col: str = "fault_id", stage: str = "severity_stage",
                      emergency: str = "emergency", tick: str = "tick") -> DataFrame:
    """One maintenance recommendation per active fault.

    Severity: emergency or stage >= 5 CRITICAL, >= 3 HIGH, else MEDIUM;
    failure window ``max(3, base - floor(tick / 8))``; progress ``min(95, 22 + 12 * stage)``."""
    cat = operator_catalog(active.sparkSession)
    d = active.withColumnRenamed(fault_col, "fault_id").join(F.broadcast(cat), "fault_id", "left")
    sev = (F.when(F.col(emergency) | (F.col(stage) >= 5), "CRITICAL").when(F.col(stage) >= 3, "HIGH")
           .otherwise("MEDIUM"))
    d = d.withColumn("risk", sev)
    steps = F.concat(F.array(F.col("recommended_action")), F.split(F.col("action_detail"), " · "),
                     F.array(F.concat(F.lit(K.TEXT_CONFIRM_READINGS[0]), F.col(tick).cast("string"),
                                      F.lit(K.TEXT_CONFIRM_READINGS[1]))))
    return d.select(
        F.concat(F.lit("m-live-"), F.col("fault_id").cast("string")).alias("id"),
        F.coalesce(F.element_at("affected_systems", 1), F.lit("Critical asset")).alias("equipment"),
        F.concat(F.col("label"), F.lit(K.TEXT_FINDING)).alias("issue"),
        "risk",
        F.when(F.col("risk") == "CRITICAL", F.lit(K.MAINTENANCE_IMPACT_CRITICAL))
        .otherwise(F.lit(K.MAINTENANCE_IMPACT_OTHER)).alias("impact"),
        steps.alias("steps"),
        S.urgency(F.col("risk")).alias("urgency"),
        F.greatest(F.lit(3), F.col("base_failure_minutes") - F.floor(F.col(tick) / 8).cast("int")).alias(
            "failure_window_minutes"),
        F.least(F.lit(95), F.lit(22) + F.col(stage) * 12).alias("progress_pct"),
        F.col("fault_id"))


def maintenance_list(live: DataFrame, cases: DataFrame, active: DataFrame) -> DataFrame:
    """Live items (part 0), then the cases of active faults (1), then all other cases (2)."""
    faults = active.select("fault_id").distinct().withColumn("_active", F.lit(True))
    ordered = cases.join(faults, "fault_id", "left").withColumn("part", F.when(F.col("_active"), 1).otherwise(2)).drop("_active")
    return live.withColumn("part", F.lit(0)).unionByName(ordered, allowMissingColumns=True)


def live_incidents(active: DataFrame, ts: str = "ts", stage: str = "severity_stage",
                   emergency: str = "emergency") -> DataFrame:
    """Incident record for an active fault (emergency CRITICAL, stage >= 4 HIGH, else MEDIUM)."""
    cat = operator_catalog(active.sparkSession)
    d = active.join(F.broadcast(cat), "fault_id", "left")
    sev = F.when(F.col(emergency), "CRITICAL").when(F.col(stage) >= 4, "HIGH").otherwise("MEDIUM")
    return d.select(
        F.concat(F.lit("live-"), F.col("fault_id").cast("string")).alias("id"), F.col(ts).alias("ts"),
        sev.alias("severity"), F.element_at("affected_systems", 1).alias("subsystem"),
        F.concat(F.col("label"), F.lit(K.TEXT_LIVE_TITLE)).alias("title"),
        F.concat(F.lit(K.TEXT_LIVE_DIAGNOSIS[0]), F.array_join("affected_systems", ", "),
                 F.lit(K.TEXT_LIVE_DIAGNOSIS[1]), F.col(stage).cast("string")).alias("diagnosis"),
        F.col("recommended_action"), F.col("fault_id").alias("faultId"), F.lit(False).alias("acknowledged"))


# --------------------------------------------------------------------------
# D27-D31 incident and overview KPIs
# --------------------------------------------------------------------------
def incident_kpis(incidents: DataFrame, show_at_most: int | None = None) -> DataFrame:
    """Open unacknowledged, open HIGH/CRITICAL, notifications.  A display can ask
    for a greatest number of notifications (K.NOTIFICATION_CAP); by default all count."""
    shown = (lambda n: n) if show_at_most is None else (lambda n: F.least(n, F.lit(show_at_most)))
    open_ = ~F.col("acknowledged")
    return incidents.agg(
        F.count_if(open_).alias("open_unacknowledged"),
        F.count_if(open_ & F.col("severity").isin("HIGH", "CRITICAL")).alias("open_high_critical"),
        shown(F.count_if(open_)).alias("notifications"))


def checklist_backlog(incidents: DataFrame, checked: DataFrame) -> DataFrame:
    """Unchecked steps per unacknowledged incident.  Incidents without a
    checklist use the default list of four (two share the id 'dcs', so
    checking one checks both).  ``checked``: (incident_id, item_id)."""
    default = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(None).cast("string").alias("label")) for i in K.DEFAULT_CHECKLIST_IDS])
    items = incidents.select(F.col("id").alias("incident_id"), "acknowledged",
                             F.explode(F.when(F.size(F.coalesce("checklist", F.array())) > 0, F.col("checklist"))
                                       .otherwise(default)).alias("item"))
    items = items.select("incident_id", "acknowledged", F.col("item.id").alias("item_id"))
    left = items.join(checked.select("incident_id", "item_id").distinct(), ["incident_id", "item_id"], "left_anti")
    total = items.groupBy("incident_id", "acknowledged").agg(F.count(F.lit(1)).alias("total_steps"))
    rem = left.groupBy("incident_id").agg(F.count(F.lit(1)).alias("remaining_steps"))
    return (total.join(rem, "incident_id", "left")
            .withColumn("remaining_steps", F.coalesce("remaining_steps", F.lit(0)).cast("long"))
            .withColumn("done_steps", F.col("total_steps") - F.col("remaining_steps")))


def hardest_fault(per_class: DataFrame) -> DataFrame:
    """Lowest-recall class (first on ties) and 'caught in n of 10'."""
    w = per_class.agg(F.min_by(F.struct("label", "recall", "name"), F.struct("recall", "label")).alias("w"))
    n = S.clamp(F.floor(F.col("w.recall") * 10 + 0.5), 1, 10).cast("int")
    name = F.coalesce(F.col("w.name"), F.concat(F.lit("Fault type "), F.col("w.label").cast("string")))
    return w.select(F.col("w.label").alias("label"), F.col("w.recall").alias("recall"), name.alias("name"),
                    n.alias("caught_of_10"))


def recall_watch(per_class: DataFrame, show_at_most: int | None = None) -> DataFrame:
    """Incidents for classes with recall < .88 in label order (a display can ask
    for the first K.RECALL_WATCH_MAX; by default all): HIGH below .75, dated 2026-03-(1 + n) capped at day 28, the first two
    unacknowledged.  The class table is bounded by the label vocabulary."""
    w = Window.orderBy("label")
    d = per_class.where(F.col("recall") < K.RECALL_WATCH_BELOW).withColumn("n", F.row_number().over(w))
    if show_at_most is not None:
        d = d.where(F.col("n") <= show_at_most)
    day = F.least(F.lit(28), F.lit(1) + F.col("n"))
    actions = F.create_map(*[x for row in K.FAULT_CATALOG for x in (F.lit(row[0]), F.lit(row[5]))])
    action = F.coalesce(F.try_element_at(actions, F.col("label").cast("int")), F.lit(K.UNKNOWN_FAULT_ACTION))
    return d.select(
        F.concat(F.lit("nb-fault-"), F.col("label").cast("string"), F.lit("-"), F.col("n").cast("string")).alias("id"),
        F.make_timestamp_ntz(F.lit(2026), F.lit(3), day, F.lit(0), F.lit(0), F.lit(0)).alias("ts"),
        F.when(F.col("recall") < K.RECALL_WATCH_HIGH_BELOW, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.lit("DCS / Analytics").alias("subsystem"),
        F.concat(F.lit("Class "), F.col("label").cast("string"), F.lit(" recall "), F.format_string("%.1f", F.col("recall") * 100), F.lit("%")).alias("diagnosis"),
        action.alias("recommendedAction"),
        F.concat(F.lit(K.TEXT_RECALL_WATCH), F.col("label").cast("string")).alias("title"),
        F.col("label").alias("faultId"), (F.col("n") > 2).alias("acknowledged"))
