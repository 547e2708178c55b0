"""Alert, snapshot, incident and maintenance queries."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scalars as S
from ..operators import alerts as al
from ..operators import features as fe
from ..operators import metrics as me
from ..operators import prepare as pr
from ..operators import quality as qa
from ..sources.tables import EVENTS_INJECTION, incidents, sensor_matrix, telemetry, with_class_probabilities
from . import sql as Q
from .prepare_queries import _I5, split_rows
from .registry import register
from .telemetry_queries import scored

FEATS = ["xmeas_13", "xmeas_9", "xmv_10"]
BASE_TS = "2024-01-01 00:00:00"


def r6(c):
    return F.round(c, 6)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


CATALOG_CTE = "catalog(fault_id, name, description, type, severity, action) AS (VALUES " + ", ".join(
    f"({r[0]}, {_q(r[1])}, {_q(r[2])}, {_q(r[3])}, {_q(r[4])}, {_q(r[5])})" for r in K.FAULT_CATALOG) + ")"
OPCAT_CTE = "opcat(fault_id, label, description, systems, first_system, recommended_action, action_detail, base_min) AS (VALUES " + \
    ", ".join(f"({r[0]}, {_q(r[1])}, {_q(r[2])}, {_q(', '.join(r[4]))}, {_q(r[4][0])}, {_q(r[5])}, {_q(r[6])}, {r[7]})"
              for r in K.OPERATOR_CATALOG) + ")"
STATUS_SQL = "CASE {s} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SEVERITY_TO_STATUS.items()) + " ELSE 'WARNING' END"
RANK_SQL = "CASE {s} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in K.SEVERITY_RANK.items()) + " END"
WEIGHT_SQL = "CAST(CASE {s} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in K.RISK_SEVERITY_WEIGHT.items()) + \
    " ELSE 0.6 END AS DOUBLE)"
OPRISK_SQL = ("CASE WHEN {c} = 13 THEN CASE WHEN {p} > 0.8 THEN 'HIGH' ELSE 'MEDIUM' END "
              "WHEN {c} BETWEEN 16 AND 20 THEN 'LOW' " +
              " ".join(f"WHEN {{c}} = {k} THEN '{v}'" for k, v in K.OPERATIONAL_RISK.items()) + " ELSE 'LOW' END")
ACTION_SQL = ("CASE WHEN {c} BETWEEN 16 AND 20 THEN " + _q(K.ACTION_UNCLASSIFIED) + " " +
              " ".join(f"WHEN {{c}} = {k} THEN {_q(v)}" for k, v in K.RECOMMENDED_ACTIONS.items()) +
              " ELSE " + _q(K.ACTION_FALLBACK) + " END")


# --------------------------------------------------------------------------
# A11 / C2 catalogues
# --------------------------------------------------------------------------
@register("a11_fault_catalog", "A11 H3", "WITH " + Q.TELEMETRY + ", " + CATALOG_CTE + f""",
runs AS (SELECT faultNumber AS fault_id, count(DISTINCT run_key) AS n_runs FROM telemetry GROUP BY faultNumber)
SELECT fault_id, name, type, severity, {STATUS_SQL.format(s='severity')} AS plant_status,
       {RANK_SQL.format(s='severity')} AS severity_rank, {WEIGHT_SQL.format(s='severity')} AS severity_weight,
       coalesce(r.n_runs, 0) AS n_runs
FROM catalog LEFT JOIN runs r USING (fault_id)""")
def a11(spark, sf_dir):
    """The catalogue as a dimension, with the number of runs of each fault in the data."""
    runs = telemetry(spark, sf_dir).groupBy(F.col("faultNumber").alias("fault_id")).agg(
        F.count_distinct("run_key").alias("n_runs"))
    c = al.fault_catalog(spark).join(runs, "fault_id", "left")
    return c.select("fault_id", "name", "type", "severity", S.plant_status(F.col("severity")).alias("plant_status"),
                    S.severity_rank(F.col("severity")).alias("severity_rank"),
                    S.severity_weight(F.col("severity")).alias("severity_weight"),
                    F.coalesce("n_runs", F.lit(0)).alias("n_runs"))


@register("c2_catalog_lookup_defaults", "C2 Q7", "WITH " + Q.TELEMETRY + ", " + CATALOG_CTE + f""",
ids AS (SELECT DISTINCT CAST(simulationRun % 23 AS INTEGER) AS fault_id FROM telemetry)
SELECT i.fault_id, coalesce(c.name, 'Unknown (' || CAST(i.fault_id AS VARCHAR) || ')') AS predicted_fault,
       coalesce(c.type, 'Unknown') AS fault_type, coalesce(c.severity, 'MEDIUM') AS severity,
       coalesce(c.action, 'Investigate.') AS recommended_action,
       {STATUS_SQL.format(s="coalesce(c.severity, 'MEDIUM')")} AS plant_status,
       {WEIGHT_SQL.format(s="coalesce(c.severity, 'MEDIUM')")} AS severity_weight
FROM ids i LEFT JOIN catalog c USING (fault_id)""")
def c2(spark, sf_dir):
    ids = telemetry(spark, sf_dir).select((F.col("simulationRun") % 23).cast("int").alias("fault_id")).distinct()
    j = al.with_catalog(ids, "fault_id")
    return j.select("fault_id", "predicted_fault", "fault_type", "severity", "recommended_action",
                    S.plant_status(F.col("severity")).alias("plant_status"),
                    S.severity_weight(F.col("severity")).alias("severity_weight"))


PROBS_SQL = """,
pw AS (SELECT s.run_key, s.sample, CAST(r.cls AS INTEGER) AS cls,
              CAST(1 << CAST((s.event_id * (r.cls + 3)) % 11 AS INTEGER) AS DOUBLE) AS w
       FROM scored s, range(1, 21) AS r(cls)),
pw2 AS (SELECT *, max(w) OVER (PARTITION BY run_key, sample) AS wmax, sum(w) OVER (PARTITION BY run_key, sample) AS tot FROM pw),
pred AS (SELECT run_key, sample, CAST(min(CASE WHEN w = wmax THEN cls END) AS INTEGER) AS pred_class,
                max(wmax / tot) AS max_prob FROM pw2 GROUP BY run_key, sample)"""


@register("f6_argmax_max_prob", "F6 H5 C7", "WITH " + Q.SCORED + PROBS_SQL + """
SELECT run_key, sample, pred_class, round(max_prob, 6) AS max_prob, round(1.0 - max_prob, 6) AS risk_proxy FROM pred""")
def f6(spark, sf_dir):
    p = with_class_probabilities(scored(spark, sf_dir))
    return p.select("run_key", "sample", al.argmax_class(F.col("probs")).alias("pred_class"),
                    r6(S.max_prob(F.col("probs"))).alias("max_prob"), r6(S.risk_proxy(F.col("probs"))).alias("risk_proxy"))


# --------------------------------------------------------------------------
# J16 / J17 alerts
# --------------------------------------------------------------------------
_FITTED: dict[tuple, tuple] = {}


def _fit(spark, sf_dir):
    """Train-fold preprocessor (medians, means, scales) and importances: a fitted
    artefact, computed once per session and data set, then applied to every
    alert (bounded by the feature count)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = _fit_now(spark, sf_dir)
    return _FITTED[key]


def _fit_now(spark, sf_dir):
    rows = split_rows(spark, sf_dir)
    train = rows.where(F.col("fold") == "train")
    params = {r["sensor"]: (r["median"], r["mean"], r["scale"]) for r in qa.fit_preprocessor(train, FEATS).collect()}
    var = train.agg(*[F.var_samp(F.col(f).cast("double")).alias(f) for f in FEATS]).first()
    tot = sum(var[f] for f in FEATS)
    imp = {f: var[f] / tot for f in FEATS}
    return rows, params, imp


def alert_stream(spark, sf_dir, every: int = 1, faults=None):
    rows, params, imp = _fit(spark, sf_dir)
    stream = rows if faults is None else rows.where(F.col("faultNumber").isin(list(faults)))
    stream = with_class_probabilities(pr.every_kth(stream, every) if every > 1 else stream)
    base = F.to_timestamp_ntz(F.lit(BASE_TS))
    return al.build_alerts(stream, "probs", base, FEATS, params, imp)


_J16_SQL = _I5 + PROBS_SQL.replace("FROM scored s,", "FROM sf s,") + """,
tr AS (SELECT * FROM sf WHERE fold = 'train'),
params AS (
  SELECT 'xmeas_13' AS f, 0 AS idx, median(xmeas_13) AS med, avg(xmeas_13) AS mu, stddev_pop(xmeas_13) AS sd, var_samp(xmeas_13) AS v FROM tr
  UNION ALL SELECT 'xmeas_9', 1, median(xmeas_9), avg(xmeas_9), stddev_pop(xmeas_9), var_samp(xmeas_9) FROM tr
  UNION ALL SELECT 'xmv_10', 2, median(xmv_10), avg(xmv_10), stddev_pop(xmv_10), var_samp(xmv_10) FROM tr),
pp AS (SELECT *, CASE WHEN sd = 0 THEN 1.0 ELSE sd END AS scale, v / sum(v) OVER () AS imp FROM params),
st AS (SELECT * FROM sf),
al AS (
  SELECT s.run_key, s.sample AS sample_index, s.simulationRun AS simulation_run, s.faultNumber AS ground_truth_fault_id,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (s.sample - 1) MINUTE * 3, '%Y-%m-%dT%H:%M:%S') AS timestamp,
         p.pred_class AS predicted_fault_id, p.max_prob AS conf,
         coalesce(c.name, 'Unknown (' || CAST(p.pred_class AS VARCHAR) || ')') AS predicted_fault,
         coalesce(c.type, 'Unknown') AS fault_type, coalesce(c.severity, 'MEDIUM') AS severity,
         coalesce(c.action, 'Investigate.') AS recommended_action,
         coalesce(c.description, 'Unrecognised fault pattern.') AS description,
         s.xmeas_13, s.xmeas_9, s.xmv_10
  FROM st s JOIN pred p USING (run_key, sample) LEFT JOIN catalog c ON c.fault_id = p.pred_class),
drv AS (
  SELECT a.run_key, a.sample_index, pp.f, pp.idx,
         coalesce(CASE pp.f WHEN 'xmeas_13' THEN a.xmeas_13 WHEN 'xmeas_9' THEN a.xmeas_9 ELSE a.xmv_10 END, pp.med) AS value,
         (coalesce(CASE pp.f WHEN 'xmeas_13' THEN a.xmeas_13 WHEN 'xmeas_9' THEN a.xmeas_9 ELSE a.xmv_10 END, pp.med) - pp.mu) / pp.scale AS z,
         pp.imp
  FROM al a, pp),
drv2 AS (SELECT *, z * imp AS contribution,
                row_number() OVER (PARTITION BY run_key, sample_index ORDER BY abs(z * imp) DESC, idx DESC) AS rk FROM drv)"""


def _j16_sql() -> str:
    tops = ",\n".join(
        f"max(CASE WHEN d.rk = {k} THEN d.f END) AS top{k}_feature, round(max(CASE WHEN d.rk = {k} THEN d.value END), 6) AS top{k}_value, "
        f"round(max(CASE WHEN d.rk = {k} THEN d.z END), 6) AS top{k}_z_score, "
        f"round(max(CASE WHEN d.rk = {k} THEN d.contribution END), 6) AS top{k}_contribution" for k in (1, 2, 3))
    return "WITH " + CATALOG_CTE + ", " + _J16_SQL[len("WITH "):] + f"""
SELECT a.run_key, a.sample_index, a.simulation_run, a.ground_truth_fault_id, a.timestamp,
       {STATUS_SQL.format(s='a.severity')} AS plant_status, a.predicted_fault_id, a.predicted_fault, a.fault_type,
       round(a.conf, 4) AS confidence, printf('%.1f%%', a.conf * 100.0) AS confidence_pct, a.severity,
       {RANK_SQL.format(s='a.severity')} AS severity_rank,
       round(a.conf * {WEIGHT_SQL.format(s='a.severity')}, 4) AS risk_score,
       CASE WHEN round(a.conf * {WEIGHT_SQL.format(s='a.severity')}, 4) >= 0.75 THEN 'HIGH'
            WHEN round(a.conf * {WEIGHT_SQL.format(s='a.severity')}, 4) >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       a.recommended_action, a.description,
{tops}
FROM al a JOIN drv2 d ON d.run_key = a.run_key AND d.sample_index = a.sample_index
GROUP BY ALL"""


def flat_alerts(a):
    tops = []
    for k in (1, 2, 3):
        e = F.col("top_features")[k - 1]
        tops += [e["feature"].alias(f"top{k}_feature"), r6(e["value"]).alias(f"top{k}_value"),
                 r6(e["z_score"]).alias(f"top{k}_z_score"), r6(e["contribution"]).alias(f"top{k}_contribution")]
    return a.select(
        "run_key", F.col("sample").alias("sample_index"), F.col("simulationRun").alias("simulation_run"),
        F.col("faultNumber").alias("ground_truth_fault_id"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "plant_status", "predicted_fault_id", "predicted_fault", "fault_type", "confidence", "confidence_pct",
        "severity", "severity_rank", "risk_score", "risk_level", "recommended_action", "description", *tops)


@register("j16_alert_stream", "J16 F1 H1 H2 H3 H6 H7", _j16_sql())
def j16(spark, sf_dir):
    return flat_alerts(alert_stream(spark, sf_dir))


PANEL_FAULTS = (0, 1, 4, 6, 11, 14)


@register("j17_alert_panel", "J17", _j16_sql().replace("st AS (SELECT * FROM sf)", f"st AS (SELECT * FROM sf WHERE faultNumber IN {PANEL_FAULTS} AND (sample - 1) % 10 = 0)"))
def j17(spark, sf_dir):
    """The alerts of the panel's faults, every tenth sample of all their runs."""
    return flat_alerts(alert_stream(spark, sf_dir, every=10, faults=PANEL_FAULTS))


# --------------------------------------------------------------------------
# E11 rising edges, J19 snapshot
# --------------------------------------------------------------------------
@register("e11_rising_edge_alerts", "E11", "WITH " + Q.SCORED + f""",
l AS (SELECT *, lag(is_fault) OVER (PARTITION BY run_key ORDER BY sample) AS prev FROM scored)
SELECT run_key, sample, pred_fault,
       CASE WHEN {OPRISK_SQL.format(c='pred_fault', p='p_fault')} = 'HIGH' THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM l WHERE prev = 0 AND is_fault = 1""")
def e11(spark, sf_dir):
    e = al.rising_edges(scored(spark, sf_dir), dense=True)
    sev = F.when(S.operational_risk(F.col("pred_fault"), F.col("p_fault")) == "HIGH", "HIGH").otherwise("MEDIUM")
    return e.select("run_key", "sample", "pred_fault", sev.alias("severity"))


def _snapshot_sql() -> str:
    risk = OPRISK_SQL.format(c="cls", p="p_fault")
    return "WITH " + Q.SCORED + ", " + OPCAT_CTE + f""",
b AS (SELECT *, CAST(least(greatest(round(pred_fault), 1), 20) AS INTEGER) AS cls FROM scored),
r AS (SELECT *, {risk} AS risk FROM b),
ps AS (SELECT *, CASE WHEN is_fault <> 1 THEN 'NORMAL' WHEN risk = 'HIGH' OR p_fault >= 0.92 THEN 'CRITICAL' ELSE 'WARNING' END AS plant_status FROM r)
SELECT p.run_key, p.sample, p.plant_status,
       CASE WHEN p.is_fault = 1 THEN p.cls END AS fault_id,
       CASE WHEN p.is_fault <> 1 THEN 'NONE' WHEN p.plant_status = 'CRITICAL' THEN 'CRITICAL' WHEN p.risk = 'HIGH' THEN 'HIGH'
            WHEN p.risk = 'MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       CASE WHEN p.is_fault = 1 THEN CASE p.risk WHEN 'HIGH' THEN 'SEVERE' WHEN 'MEDIUM' THEN 'MODERATE' ELSE 'LOW' END ELSE 'LOW' END AS maintenance_risk,
       CAST(least(greatest(floor(p.p_fault * 100.0 + 0.5), 0), 100) AS INTEGER) AS confidence_pct,
       round(least(greatest(p.p_fault, 0.0), 1.0), 6) AS risk_score,
       CASE WHEN p.is_fault = 1 THEN p.risk ELSE 'LOW' END AS risk_level,
       CASE WHEN p.is_fault = 1 THEN greatest(5, 480 - p.sample) END AS failure_window_minutes,
       CASE WHEN p.is_fault = 1 THEN {ACTION_SQL.format(c='p.cls')} ELSE {_q(K.ACTION_NORMAL)} END AS recommended_action,
       CASE WHEN p.is_fault = 1 THEN '⚠ Fault IDV(' || CAST(p.cls AS VARCHAR) || ') detected — ' ||
            CASE WHEN p.cls = 13 THEN {_q(K.CLASS13_DESCRIPTION)} ELSE coalesce(o.description, 'Unknown fault') END
            ELSE 'Plant running normally' END AS detected_fault,
       CASE WHEN p.is_fault = 1 THEN coalesce(o.systems, 'R-101, Catalyst system') ELSE 'Plant-wide' END AS affected_systems,
       round(least(greatest(p.health_score, 0.0), 100.0), 6) AS system_health_pct,
       round(least(greatest(p.p_fault, 0.0), 0.99), 6) AS anomaly_score,
       CASE WHEN p.is_fault = 1 THEN {ACTION_SQL.format(c='p.cls')} || ' ' || {_q(K.ACTION_DETAIL_FAULT)} ELSE {_q(K.ACTION_DETAIL_NORMAL)} END AS action_detail,
       round(least(greatest(p.p_fault, 0.0), 1.0), 6) AS anomaly_index, round(coalesce(p.xmeas_9, 120), 6) AS reactor_temp,
       round(coalesce(p.xmeas_13, 77), 6) AS separator_pressure, round(coalesce(p.xmv_10, 41), 6) AS flow_rate,
       round(least(0.99, 0.35 + coalesce(minute(p.ts), 18) / 200), 6) AS vibration
FROM ps p LEFT JOIN opcat o ON o.fault_id = p.cls"""


@register("j19_operator_snapshot", "J19 H9 H10 H11 H19 H22", _snapshot_sql())
def j19(spark, sf_dir):
    s = scored(spark, sf_dir).withColumnRenamed("pred_fault", "fault_type_pred")
    s = s.withColumn("xmv_11", F.minute("ts"))
    o = al.operator_snapshot(s, sensors={"reactor_temp": "xmeas_9", "separator_pressure": "xmeas_13", "flow_rate": "xmv_10", "vibration": "xmv_11"})
    return o.select("run_key", "sample", "plant_status", "fault_id", "severity", "maintenance_risk", "confidence_pct",
                    r6("risk_score").alias("risk_score"), "risk_level", "failure_window_minutes", "recommended_action",
                    "detected_fault", F.array_join("affected_systems", ", ").alias("affected_systems"),
                    r6("system_health_pct").alias("system_health_pct"), r6("anomaly_score").alias("anomaly_score"), "action_detail",
                    *[r6(c).alias(c) for c in ("anomaly_index", "reactor_temp", "separator_pressure", "flow_rate", "vibration")])


# --------------------------------------------------------------------------
# Incidents: D27, D28, B14, F4
# --------------------------------------------------------------------------
INCIDENTS_SQL = CATALOG_CTE + """,
inc AS (
  SELECT 'INC-' || CAST(event_id AS VARCHAR) AS id, event_id, ts,
         CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 100 THEN 'HIGH' WHEN value >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
         CASE user_id % 5 WHEN 0 THEN 'Reactor' WHEN 1 THEN 'Separator' WHEN 2 THEN 'Compressor' WHEN 3 THEN 'Feed'
              ELSE 'DCS / Analytics' END AS subsystem,
         'Event ' || CAST(event_id AS VARCHAR) || ' on run ' || CAST(user_id AS VARCHAR) AS title,
         CAST(user_id % 21 AS INTEGER) AS faultId,
         event_id % 3 = 0 AS acknowledged, value, CAST(user_id AS INTEGER) AS simulationRun
  FROM events WHERE event_type = 'error'),
inc2 AS (SELECT i.*, 'Residual on fault class ' || CAST(i.faultId AS VARCHAR) || ' · ' || i.severity AS diagnosis,
                c.action AS recommendedAction FROM inc i LEFT JOIN catalog c ON c.fault_id = i.faultId)"""


@register("d27_incident_kpis", "D27", "WITH " + INCIDENTS_SQL + """
SELECT count(*) FILTER (WHERE NOT acknowledged) AS open_unacknowledged,
       count(*) FILTER (WHERE NOT acknowledged AND severity IN ('HIGH', 'CRITICAL')) AS open_high_critical,
       count(*) FILTER (WHERE NOT acknowledged) AS notifications
FROM inc2""")
def d27(spark, sf_dir):
    return al.incident_kpis(incidents(spark, sf_dir))


def _checked(inc):
    a = inc.where(F.col("event_id") % 5 == 0).select(F.col("id").alias("incident_id"), F.lit("dcs").alias("item_id"))
    b = inc.where(F.col("event_id") % 7 == 0).select(F.col("id").alias("incident_id"), F.lit("review").alias("item_id"))
    return a.unionByName(b)


@register("d28_checklist_backlog", "D28", "WITH " + INCIDENTS_SQL + """,
items AS (SELECT i.id AS incident_id, i.acknowledged, d.item_id FROM inc2 i,
          (VALUES ('review'), ('notes'), ('dcs'), ('dcs')) AS d(item_id)),
checked AS (SELECT id AS incident_id, 'dcs' AS item_id FROM inc2 WHERE event_id % 5 = 0
            UNION SELECT id, 'review' FROM inc2 WHERE event_id % 7 = 0),
agg AS (SELECT incident_id, acknowledged, count(*) AS total_steps,
               count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM checked c WHERE c.incident_id = items.incident_id
                                                  AND c.item_id = items.item_id)) AS remaining_steps
        FROM items GROUP BY incident_id, acknowledged)
SELECT incident_id, acknowledged, total_steps, remaining_steps, total_steps - remaining_steps AS done_steps FROM agg""")
def d28(spark, sf_dir):
    inc = incidents(spark, sf_dir)
    return al.checklist_backlog(inc, _checked(inc)).select("incident_id", "acknowledged", "total_steps",
                                                           "remaining_steps", "done_steps")


@register("b14_incident_search", "B14", "WITH " + INCIDENTS_SQL + """
SELECT id, severity, subsystem FROM inc2
WHERE severity IN ('HIGH', 'CRITICAL') AND subsystem = 'Reactor'
  AND strpos(lower(title || ' ' || diagnosis || ' ' || recommendedAction), 'cool') > 0""")
def b14(spark, sf_dir):
    inc = incidents(spark, sf_dir)
    text = F.lower(F.concat_ws(" ", "title", "diagnosis", "recommendedAction"))
    return inc.where(F.col("severity").isin("HIGH", "CRITICAL") & (F.col("subsystem") == "Reactor") &
                     text.contains("cool")).select("id", "severity", "subsystem")


@register("f4_incidents_newest_first", "F4", "WITH " + INCIDENTS_SQL + """
SELECT id, CAST(row_number() OVER (ORDER BY ts DESC, id) AS INTEGER) AS position,
       count(*) FILTER (WHERE NOT acknowledged) OVER () AS unacknowledged_in_view
FROM inc2 WHERE severity <> 'LOW'""")
def f4(spark, sf_dir):
    # the view is the filtered incident list (bounded by what an operator pages through)
    inc = incidents(spark, sf_dir).where(F.col("severity") != "LOW")
    # newest-first position over the whole view: sort-based ordinal, not a one-task window
    from ..operators.blocked import ordinal_within
    keyed = inc.withColumn("_all", F.lit(0)).withColumn("_newest", -F.unix_micros(F.col("ts").cast("timestamp")))
    ordered = ordinal_within(keyed, "_all", ["_newest", "id"], out="position")
    unacked = inc.agg(F.count_if(~F.col("acknowledged")).alias("n")).first()["n"]   # one number
    return ordered.select("id", "position", F.lit(unacked).cast("long").alias("unacknowledged_in_view"))


# --------------------------------------------------------------------------
# D31 overview, A12/F5 snapshot probabilities, B15, B16, H misc
# --------------------------------------------------------------------------
@register("d31_overview_kpis", "D31 H14", _I5 + """,
t AS (SELECT * FROM sf WHERE fold = 'test'),
k AS (SELECT count(*) FILTER (WHERE y_true = 1 AND is_fault = 1) AS tp, count(*) FILTER (WHERE y_true = 1) AS pos,
             count(*) FILTER (WHERE y_true = 0 AND is_fault = 1) AS fa, count(*) FILTER (WHERE y_true = 0) AS normal,
             max(ts) AS last_ts, max(ts) FILTER (WHERE is_fault = 1) AS last_alert, avg(health_score) AS health FROM t)
SELECT round(CAST(tp AS DOUBLE) / pos, 6) AS recall,
       round(fa / (normal * 3.0 / 60.0), 6) AS false_alarms_per_normal_hour,
       round(health, 6) AS plant_health_pct,
       round(epoch(last_ts - last_alert) / 3600.0, 6) AS last_alert_hours_ago,
       CASE WHEN last_alert IS NULL THEN 'No recent alerts'
            WHEN epoch(last_ts - last_alert) / 3600.0 < 1.0 / 60.0 THEN 'Just now'
            WHEN epoch(last_ts - last_alert) / 3600.0 < 1.0 THEN CAST(CAST(floor(epoch(last_ts - last_alert) / 60.0 + 0.5) AS BIGINT) AS VARCHAR) || 'm ago'
            ELSE CAST(CAST(floor(epoch(last_ts - last_alert) / 3600.0 + 0.5) AS BIGINT) AS VARCHAR) || 'h ago' END AS last_alert_text
FROM k""")
def d31(spark, sf_dir):
    t = split_rows(spark, sf_dir).where(F.col("fold") == "test")
    k = t.agg(F.count_if((F.col("y_true") == 1) & (F.col("is_fault") == 1)).alias("tp"),
              F.count_if(F.col("y_true") == 1).alias("pos"),
              F.count_if((F.col("y_true") == 0) & (F.col("is_fault") == 1)).alias("fa"),
              F.count_if(F.col("y_true") == 0).alias("normal"), F.max("ts").alias("last_ts"),
              F.max(F.when(F.col("is_fault") == 1, F.col("ts"))).alias("last_alert"), F.avg("health_score").alias("health"))
    hours = (F.unix_micros(F.col("last_ts").cast("timestamp")) - F.unix_micros(F.col("last_alert").cast("timestamp"))) / 3.6e9
    return k.select(r6(F.try_divide(F.col("tp"), F.col("pos"))).alias("recall"),
                    r6(F.try_divide(F.col("fa"), F.col("normal") * 3.0 / 60.0)).alias("false_alarms_per_normal_hour"),
                    r6("health").alias("plant_health_pct"), r6(hours).alias("last_alert_hours_ago"),
                    S.relative_time(hours).alias("last_alert_text"))


@register("a12_latest_probability_snapshot", "A12 F5", "WITH " + Q.SCORED + """,
last AS (SELECT run_key, max(sample) AS sample FROM scored GROUP BY run_key),
ls AS (SELECT s.* FROM scored s JOIN last USING (run_key, sample)),
pw AS (SELECT s.run_key, CAST(r.cls AS INTEGER) AS class_id,
              CAST(1 << CAST((s.event_id * (r.cls + 3)) % 11 AS INTEGER) AS DOUBLE) AS w
       FROM ls s, range(1, 21) AS r(cls)),
pp AS (SELECT run_key, class_id, w / sum(w) OVER (PARTITION BY run_key) AS p FROM pw),
c AS (SELECT run_key, class_id, floor(p * 10000 + 0.5) / 100 AS pct FROM pp
      UNION ALL SELECT run_key, 0, floor(greatest(0.0, 1.0 - sum(p)) * 10000 + 0.5) / 100 FROM pp GROUP BY run_key)
SELECT run_key, class_id, pct, CAST(row_number() OVER (PARTITION BY run_key ORDER BY pct DESC, class_id) AS INTEGER) AS rank
FROM c""")
def a12(spark, sf_dir):
    s = with_class_probabilities(scored(spark, sf_dir))
    last = s.groupBy("run_key").agg(F.max_by(F.col("probs"), F.col("sample")).alias("probs"))
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    cls = last.select("run_key", F.posexplode("probs").alias("i", "p")).select(
        "run_key", (F.col("i") + 1).cast("int").alias("class_id"), (F.floor(F.col("p") * 10000 + 0.5) / 100).alias("pct"))
    zero = last.select("run_key", F.lit(0).alias("class_id"),
                       (F.floor(F.greatest(F.lit(0.0), F.lit(1.0) - total) * 10000 + 0.5) / 100).alias("pct"))
    c = cls.unionByName(zero)
    w = Window.partitionBy("run_key").orderBy(F.col("pct").desc(), "class_id")   # 21 rows per run
    return c.withColumn("rank", F.row_number().over(w).cast("int"))


# the embedding-derived sensors lie around 0; the check's sensors are moved to the height of their nominal bands
_RANGE_SHIFT = {"xmeas_13": (500.0, 2620.0), "xmv_11": (40.0, 19.0), "xmeas_22": (20.0, 78.0)}
_RANGE_SQL = ",\n".join(f"CASE WHEN {s} * {_RANGE_SHIFT[s][0]} + {_RANGE_SHIFT[s][1]} NOT BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END AS o_{s}" for s, lo, hi in K.NORMAL_RANGES)


@register("b15_normal_range_check", "B15", "WITH " + Q.SENSOR_MATRIX + f""",
f AS (SELECT faultNumber, sample, {_RANGE_SQL} FROM sensor_matrix)
SELECT faultNumber, sample, """ + ",\n".join(
    f"max(o_{s}) OVER (PARTITION BY faultNumber ORDER BY sample ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS {s}_out" for s, _, _ in K.NORMAL_RANGES) + " FROM f")
def b15(spark, sf_dir):
    """Whether each of the three watched sensors left its nominal band within the last 48 samples of its run."""
    from ..operators.blocked import halo_select
    m = sensor_matrix(spark, sf_dir)
    flags = {s: (~(F.col(s) * _RANGE_SHIFT[s][0] + _RANGE_SHIFT[s][1]).between(lo, hi)).cast("int") for s, lo, hi in K.NORMAL_RANGES}
    m = m.select("faultNumber", "sample", *[f.alias(f"o_{s}") for s, f in flags.items()])
    out = halo_select(m, "faultNumber", "sample", lambda w: [F.max(f"o_{s}").over(w.rowsBetween(-47, 0)).alias(f"{s}_out") for s in flags], before=47)
    return out.select("faultNumber", "sample", *[f"{s}_out" for s in flags])


@register("b16_maintenance_visibility", "B16 H12", "WITH " + Q.SCORED + """,
d AS (SELECT simulationRun, min(CASE WHEN is_fault = 1 THEN sample END) - 21 AS delay FROM scored GROUP BY simulationRun),
cases AS (SELECT 'case-' || CAST(simulationRun AS VARCHAR) AS id, simulationRun, delay FROM d
          UNION ALL SELECT 'case-live', NULL, NULL)
SELECT id, simulationRun, CASE WHEN delay IS NULL OR delay < 0 THEN 45 ELSE greatest(3, 11 + 3 * delay) END AS failure_window_minutes
FROM cases WHERE simulationRun IS NULL OR simulationRun IN (78, 148)""")
def b16(spark, sf_dir):
    """One maintenance case per run (failure window from its detection delay)
    plus a live case without a run; the page shows cases without a run and the
    curated runs 78 and 148."""
    s = scored(spark, sf_dir)
    d = s.groupBy("simulationRun").agg((F.min(F.when(F.col("is_fault") == 1, F.col("sample"))) - 21).alias("delay"))
    cases = d.select(F.concat(F.lit("case-"), F.col("simulationRun").cast("string")).alias("id"), "simulationRun", "delay")
    live = s.sparkSession.createDataFrame([("case-live", None, None)], "id string, simulationRun int, delay int")
    allc = cases.unionByName(live)
    vis = allc.where(F.col("simulationRun").isNull() | F.col("simulationRun").isin(78, 148))
    return vis.select("id", "simulationRun", S.case_failure_window(F.col("delay")).alias("failure_window_minutes"))


@register("h_scalar_functions", "H13 H15 H17 H20 H21 H23", "WITH " + Q.SCORED + ", " + OPCAT_CTE + """
SELECT s.run_key, s.sample,
       CASE WHEN p_fault > 0.6 THEN 'high' WHEN p_fault > 0.3 THEN 'warn' ELSE 'ok' END AS anomaly_level,
       CASE CASE WHEN xmeas_13 >= 150 THEN 'CRITICAL' WHEN xmeas_13 >= 100 THEN 'HIGH' WHEN xmeas_13 >= 50 THEN 'MEDIUM' ELSE 'LOW' END
            WHEN 'CRITICAL' THEN 'P1' WHEN 'HIGH' THEN 'P2' WHEN 'MEDIUM' THEN 'P3' ELSE 'P4' END AS urgency,
       CAST(least(greatest(floor(p_fault * 10 + 0.5), 1), 10) AS INTEGER) || ' in 10' AS recall_in_ten,
       CASE WHEN CAST(faultNumber + 1 AS INTEGER) BETWEEN 0 AND 20 THEN CAST(faultNumber + 1 AS INTEGER) ELSE 1 END AS parsed_fault_id,
       CASE WHEN faultNumber = 0 THEN CAST(faultNumber AS VARCHAR) || ': ' || o.description || ' (' || o.fault_type || ')'
            ELSE CAST(faultNumber AS VARCHAR) || ': ' || o.description || ' · ' || o.fault_type END AS fault_label_text,
       array_to_string([trim(x) for x in string_split(o.action_detail, ' · ') if length(trim(x)) > 0], '|') AS action_steps
FROM scored s JOIN (SELECT fault_id, description, action_detail,
                           CASE fault_id """ + " ".join(f"WHEN {r[0]} THEN {_q(r[3])}" for r in K.OPERATOR_CATALOG) + """ END AS fault_type
                    FROM opcat) o ON o.fault_id = s.faultNumber""")
def hmisc(spark, sf_dir):
    s = scored(spark, sf_dir)
    cat = al.operator_catalog(spark).select(F.col("fault_id").alias("faultNumber"), "description", "fault_type",
                                            "action_detail")
    j = s.join(F.broadcast(cat), "faultNumber")
    sev = (F.when(F.col("xmeas_13") >= 150, "CRITICAL").when(F.col("xmeas_13") >= 100, "HIGH")
           .when(F.col("xmeas_13") >= 50, "MEDIUM").otherwise("LOW"))
    label = F.when(F.col("faultNumber") == 0, F.concat(F.col("faultNumber").cast("string"), F.lit(": "), F.col("description"),
                                                       F.lit(" ("), F.col("fault_type"), F.lit(")"))) \
        .otherwise(F.concat(F.col("faultNumber").cast("string"), F.lit(": "), F.col("description"), F.lit(" · "),
                            F.col("fault_type")))
    return j.select("run_key", "sample", S.anomaly_level(F.col("p_fault")).alias("anomaly_level"),
                    S.urgency(sev).alias("urgency"), S.recall_in_ten(F.col("p_fault")).alias("recall_in_ten"),
                    S.parse_fault_id((F.col("faultNumber") + 1).cast("string")).alias("parsed_fault_id"),
                    label.alias("fault_label_text"),
                    F.array_join(S.action_steps(F.col("action_detail")), "|").alias("action_steps"))


@register("h18_z_scores", "H18", "WITH " + Q.TELEMETRY + """,
p AS (SELECT avg(xmeas_13) AS m, stddev_pop(xmeas_13) AS s FROM telemetry WHERE faultNumber = 0)
SELECT run_key, sample, round((coalesce(xmeas_13, p.m) - p.m) / p.s, 6) AS z FROM telemetry, p""")
def h18(spark, sf_dir):
    """Every sample against the mean and spread of the fault-free runs (two numbers, fitted once)."""
    t = telemetry(spark, sf_dir)
    m, sd = t.where(F.col("faultNumber") == 0).agg(F.avg("xmeas_13"), F.stddev_pop("xmeas_13")).first()
    return t.select("run_key", "sample", r6(S.z_score(F.coalesce("xmeas_13", F.lit(m)), F.lit(m), F.lit(sd))).alias("z"))


# --------------------------------------------------------------------------
# J20 / J21 maintenance items and live incidents for active faults
# --------------------------------------------------------------------------
ACTIVE_SQL = "WITH " + Q.SCORED + ", " + OPCAT_CTE + """,
act AS (SELECT faultNumber AS fault_id, CAST(count(*) FILTER (WHERE is_fault = 1) % 6 AS INTEGER) AS stage,
               faultNumber IN (6, 14) AS emergency, CAST(min(CASE WHEN is_fault = 1 THEN sample END) AS INTEGER) AS tick,
               max(ts) AS ts
        FROM scored WHERE faultNumber > 0 GROUP BY faultNumber HAVING count(*) FILTER (WHERE is_fault = 1) > 0)"""


def active_faults(spark, sf_dir):
    s = scored(spark, sf_dir).where(F.col("faultNumber") > 0)
    return s.groupBy(F.col("faultNumber").alias("fault_id")).agg(
        (F.count_if(F.col("is_fault") == 1) % 6).cast("int").alias("severity_stage"),
        F.min(F.when(F.col("is_fault") == 1, F.col("sample"))).cast("int").alias("tick"),
        F.max("ts").alias("ts"), F.count_if(F.col("is_fault") == 1).alias("_n")
    ).where(F.col("_n") > 0).withColumn("emergency", F.col("fault_id").isin(6, 14)).drop("_n")


@register("j20_maintenance_items", "J20 H13 H17", ACTIVE_SQL + """,
live AS (
  SELECT 0 AS part, 'm-live-' || CAST(a.fault_id AS VARCHAR) AS id, o.first_system AS equipment,
         o.label || ' — model-driven finding' AS issue,
         CASE WHEN a.emergency OR a.stage >= 5 THEN 'CRITICAL' WHEN a.stage >= 3 THEN 'HIGH' ELSE 'MEDIUM' END AS risk,
         CASE WHEN a.emergency OR a.stage >= 5 THEN 'P1' WHEN a.stage >= 3 THEN 'P2' ELSE 'P3' END AS urgency,
         o.recommended_action || '|' || replace(o.action_detail, ' · ', '|') || '|Digital twin tick ' || CAST(a.tick AS VARCHAR) || ': confirm field readings' AS steps,
         greatest(3, o.base_min - CAST(floor(a.tick / 8) AS INTEGER)) AS failure_window_minutes,
         least(95, 22 + a.stage * 12) AS progress_pct, a.fault_id
  FROM act a LEFT JOIN opcat o USING (fault_id)),
cases AS (
  SELECT CASE WHEN faultNumber IN (SELECT fault_id FROM act) THEN 1 ELSE 2 END AS part, 'case-' || CAST(simulationRun AS VARCHAR) AS id, NULL, NULL, NULL, NULL, NULL,
         CASE WHEN d IS NULL OR d < 0 THEN 45 ELSE greatest(3, 11 + 3 * d) END, NULL, faultNumber
  FROM (SELECT simulationRun, faultNumber, min(CASE WHEN is_fault = 1 THEN sample END) - 21 AS d FROM scored GROUP BY simulationRun, faultNumber))
SELECT CAST(part AS INTEGER) AS part, id, equipment, issue, risk, urgency, steps, failure_window_minutes, progress_pct, fault_id FROM live UNION ALL SELECT * FROM cases""")
def j20(spark, sf_dir):
    """Live items first, then a case a run: those of active faults, then the others."""
    active = active_faults(spark, sf_dir).checkpoint()
    live = al.maintenance_items(active).withColumn("steps", F.array_join("steps", "|"))
    runs = scored(spark, sf_dir).groupBy("simulationRun", F.col("faultNumber").alias("fault_id")).agg((F.min(F.when(F.col("is_fault") == 1, F.col("sample"))) - 21).alias("delay"))
    cases = runs.select(F.concat(F.lit("case-"), F.col("simulationRun").cast("string")).alias("id"), S.case_failure_window(F.col("delay")).alias("failure_window_minutes"), "fault_id")
    return al.maintenance_list(live, cases, active).select(
        "part", "id", "equipment", "issue", "risk", "urgency", "steps", "failure_window_minutes", "progress_pct", "fault_id")


@register("j21_live_incidents", "J21", ACTIVE_SQL + ", " + INCIDENTS_SQL + """
SELECT 0 AS part, 'live-' || CAST(a.fault_id AS VARCHAR) AS id, strftime(a.ts, '%Y-%m-%dT%H:%M:%S') AS ts,
       CASE WHEN a.emergency THEN 'CRITICAL' WHEN a.stage >= 4 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       o.first_system AS subsystem, o.label || ' — simulation active' AS title,
       'AI twin: elevated residual on ' || o.systems || ' · severity stage ' || CAST(a.stage AS VARCHAR) AS diagnosis,
       o.recommended_action AS recommendedAction, a.fault_id AS faultId, false AS acknowledged
FROM act a LEFT JOIN opcat o USING (fault_id)
UNION ALL
SELECT 1, id, strftime(ts, '%Y-%m-%dT%H:%M:%S'), severity, subsystem, title, diagnosis, recommendedAction, faultId, acknowledged FROM inc2""")
def j21(spark, sf_dir):
    """Live incidents in front of the history."""
    live = al.live_incidents(active_faults(spark, sf_dir)).withColumnRenamed("recommended_action", "recommendedAction")
    cols = ["id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "severity", "subsystem", "title", "diagnosis", "recommendedAction", "faultId", "acknowledged"]
    return live.select(F.lit(0).alias("part"), *cols).unionByName(incidents(spark, sf_dir).select(F.lit(1).alias("part"), *cols))


# --------------------------------------------------------------------------
# A13 / D25 replay summary, A14 / A15 sensor loop export and ingest
# --------------------------------------------------------------------------
@register("a13_replay_rows", "A13", "WITH " + Q.SCORED + """
SELECT run_key, sample, round(p_fault, 6) AS p_fault, round(health_score, 6) AS health_score, is_fault,
       CASE WHEN is_fault = 1 THEN pred_fault ELSE 0 END AS fault_type, round(xmeas_13, 6) AS xmeas_13, round(xmeas_9, 6) AS xmeas_9, xmv_10,
       CAST(minute(ts) AS DOUBLE) AS xmv_11
FROM scored""")
def a13_rows(spark, sf_dir):
    """The replay's rows: every sample of every run with its scores and four sensors (the fourth is the minute of its time)."""
    s = scored(spark, sf_dir)
    return s.select("run_key", "sample", r6("p_fault").alias("p_fault"), r6("health_score").alias("health_score"), "is_fault",
                    F.when(F.col("is_fault") == 1, F.col("pred_fault")).otherwise(0).alias("fault_type"), r6("xmeas_13").alias("xmeas_13"), r6("xmeas_9").alias("xmeas_9"), "xmv_10",
                    F.minute("ts").cast("double").alias("xmv_11"))


@register("a13_replay_summary", "A13 D25", "WITH " + Q.SCORED + """
SELECT run_key, count(*) AS n_rows, min(CASE WHEN is_fault = 1 THEN sample END) AS first_alert_sample,
       round(max(p_fault), 6) AS max_p_fault, round(min(health_score), 6) AS min_health_score,
       round(sum(p_fault), 6) AS sum_p_fault
FROM scored GROUP BY run_key""")
def a13(spark, sf_dir):
    s = scored(spark, sf_dir)
    rep = s.groupBy("run_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.when(F.col("is_fault") == 1, F.col("sample"))).alias("first_alert_sample"),
        F.max("p_fault").alias("max_p_fault"), F.min("health_score").alias("min_health_score"),
        F.sum("p_fault").alias("sum_p_fault"))
    return rep.select("run_key", "n_rows", "first_alert_sample", r6("max_p_fault").alias("max_p_fault"),
                      r6("min_health_score").alias("min_health_score"), r6("sum_p_fault").alias("sum_p_fault"))


@register("a14_sensor_loop_export", "A14", "WITH " + Q.SCORED + """,
n AS (SELECT run_key, count(*) AS n FROM scored GROUP BY run_key)
SELECT s.run_key, s.sample - 1 AS tick, round(s.xmeas_13, 4) AS separator_pressure, round(s.xmeas_9, 6) AS condenser_cw_flow,
       round(s.xmv_10, 4) AS comp_cw_outlet_temp, round(s.p_fault, 4) AS anomaly_score,
       CAST(least(20, n.n - 1) AS INTEGER) AS fault_onset_tick
FROM scored s JOIN n USING (run_key) WHERE s.sample <= 240""")
def a14(spark, sf_dir):
    s = scored(spark, sf_dir)
    n = s.groupBy("run_key").agg(F.count(F.lit(1)).alias("_n"))
    loop = s.where(F.col("sample") <= 240).join(n, "run_key")
    return loop.select("run_key", (F.col("sample") - 1).alias("tick"), F.round("xmeas_13", 4).alias("separator_pressure"),
                       F.round("xmeas_9", 6).alias("condenser_cw_flow"), F.round("xmv_10", 4).alias("comp_cw_outlet_temp"),
                       F.round("p_fault", 4).alias("anomaly_score"),
                       F.least(F.lit(EVENTS_INJECTION), F.col("_n") - 1).cast("int").alias("fault_onset_tick"))


@register("a15_sensor_loop_ingest", "A15", "WITH " + Q.TELEMETRY + """
SELECT run_key, sample - 1 AS tick, xmeas_13 AS separator_pressure, xmeas_9 AS condenser_cw_flow FROM telemetry""")
def a15(spark, sf_dir):
    """Round trip: export each run's loop as parallel arrays, a document for every 1024
    samples of a run so that no document grows with the run, then ingest the arrays back."""
    t = telemetry(spark, sf_dir)
    packed = t.groupBy("run_key", F.floor((F.col("sample") - 1) / 1024).alias("part")).agg(F.array_sort(F.collect_list(F.struct("sample", "xmeas_13", "xmeas_9"))).alias("_s"))
    loop = packed.select("run_key", "part", F.col("_s.xmeas_13").alias("separator_pressure"),
                         F.col("_s.xmeas_9").alias("condenser_cw_flow"))
    rows = loop.select("run_key", "part", F.posexplode(F.arrays_zip("separator_pressure", "condenser_cw_flow")).alias("tick", "z"))
    return rows.select("run_key", (F.col("part") * 1024 + F.col("tick")).cast("int").alias("tick"), F.col("z.separator_pressure").alias("separator_pressure"),
                       F.col("z.condenser_cw_flow").alias("condenser_cw_flow"))
