"""Shared oracle SQL fragments (DuckDB dialect, ANSI subset).

These restate the views of ``faultline.sources.tables`` independently in SQL.
"""

TELEMETRY = """
telemetry AS (
  SELECT CAST(user_id % 21 AS INTEGER) AS faultNumber,
         CAST(user_id AS INTEGER) AS simulationRun,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS sample,
         'EVENTS_fault_' || CAST(user_id % 21 AS VARCHAR) || '_run_' || CAST(user_id AS VARCHAR) AS run_key,
         value AS xmeas_13,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS xmeas_9,
         CAST(hour(ts) AS DOUBLE) AS xmv_10,
         value / (value + 50.0) AS p_fault,
         CAST(1 + event_id % 20 AS INTEGER) AS pred_fault,
         event_id, ts, event_type
  FROM events)"""

# scored telemetry at the default binary threshold 0.35, injection cutoff 20
SCORED = TELEMETRY + """,
scored AS (
  SELECT *, CASE WHEN p_fault >= 0.35 THEN 1 ELSE 0 END AS is_fault,
         (1.0 - p_fault) * 100.0 AS health_score,
         CASE WHEN faultNumber > 0 AND sample > 20 THEN 1 ELSE 0 END AS y_true,
         CASE WHEN sample > 20 THEN faultNumber ELSE 0 END AS target_fault_label
  FROM telemetry)"""

SENSOR_MATRIX_COLS = ",\n".join(
    [f"CAST(embedding[{i + 1}] AS DOUBLE) AS xmeas_{i + 1}" for i in range(41)]
    + [f"CAST(embedding[{42 + j}] AS DOUBLE) AS xmv_{j + 1}" for j in range(11)])

SENSOR_MATRIX = f"""
sensor_matrix AS (
  SELECT CAST(label AS INTEGER) AS faultNumber, 1 AS simulationRun, CAST(vec_id AS INTEGER) AS sample,
  {SENSOR_MATRIX_COLS}
  FROM embeddings)"""

