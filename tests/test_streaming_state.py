"""Keyed stream state: restarts, windows that end, counted copies and late rows."""
import datetime
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import alarms as al
from faultline.streaming import alarms as st

TUNING = al.Tuning(alpha=0.5, sigma=1.0, pad=1.0, n_on=1, n_off=1, lockout=0, max_latch=None, hysteresis=0.5)


def publish(spark, folder, rows):
    """(run, sample, minute) as one file; files are read in the order of their times."""
    made = [(r, 0, 0, s, float(s % 7), 0.0, 0.0, 0.9 if s % 5 == 0 else 0.1, 1, s, datetime.datetime(2026, 1, 1) + datetime.timedelta(minutes=m)) for r, s, m in rows]
    spark.createDataFrame(made, st.TELEMETRY_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)


@pytest.fixture(scope="module")
def params(spark):
    return spark.createDataFrame([(r, 3.0, 1.0, 2.0, 20) for r in "abc"], "run_key string, mu_z double, sig_z double, roc_thr double, t_max int").checkpoint()


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path, params):
    parts = [[(r, s, s) for r in "abc" for s in range(a, a + 10)] for a in (1, 11, 21)]
    for name, stops in (("once", [3]), ("twice", [1, 2, 3])):
        done = 0
        for n in stops:
            for rows in parts[done:n]:
                publish(spark, f"{tmp_path}/{name}", rows)
            done = n
            s = st.telemetry_stream(st.stream_session(spark, 2), f"{tmp_path}/{name}")
            st.run_to_completion(st.stateful_alarms(s, params, TUNING, 3), f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-chk")
    once, twice = (spark.read.parquet(f"{tmp_path}/{n}-out") for n in ("once", "twice"))
    assert once.count() == 90 and once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert once.where("rising_edge = 1").count() == 18


def test_idle_runs_are_closed_and_forgotten(spark, tmp_path, params):
    publish(spark, f"{tmp_path}/in", [("a", 1, 1), ("a", 3, 3), ("b", 1, 1)])         # 3 waits for 2
    publish(spark, f"{tmp_path}/in", [("c", 1, 1000)])
    publish(spark, f"{tmp_path}/in", [("c", 2, 2000)])
    s = st.telemetry_stream(st.stream_session(spark, 2), f"{tmp_path}/in")
    told = st.run_to_completion(st.stateful_alarms(s, params, TUNING, 3, idle_ms=60_000), f"{tmp_path}/out", f"{tmp_path}/chk")
    got = {(r["run_key"], r["sample"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("a", 1), ("a", 3), ("b", 1), ("c", 1), ("c", 2)}
    assert max(told["state_rows"]) > told["state_rows"][-1]


def alerts(spark, folder, minutes):
    rows = [(f"i{k}", datetime.datetime(2026, 1, 1) + datetime.timedelta(minutes=m), s) for k, (m, s) in enumerate(minutes)]
    spark.createDataFrame(rows, "id string, ts timestamp_ntz, severity string").coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)


@pytest.mark.parametrize("kind", [{"size": "1 hour"}, {"size": "2 hours", "slide": "1 hour"}, {"session_gap": "20 minutes"}])
def test_windows_are_emitted_once_and_their_state_ends(spark, tmp_path, kind):
    alerts(spark, f"{tmp_path}/in", [(m, s) for m in range(0, 300, 7) for s in ("LOW", "HIGH")])
    alerts(spark, f"{tmp_path}/in", [(m, "LOW") for m in range(300, 600, 7)])
    alerts(spark, f"{tmp_path}/in", [(5, "LOW"), (100_000, "none")])                    # minute 5 is late
    s = st.stream_session(spark, 2).readStream.schema("id string, ts timestamp_ntz, severity string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    told = st.run_to_completion(st.windowed_counts(s, watermark="1 hour", **kind), f"{tmp_path}/out", f"{tmp_path}/chk")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.groupBy("window_start", "window_end", "severity").count().where("count > 1").isEmpty()
    times = 2 if "slide" in kind else 1
    assert out.agg(F.sum("n")).first()[0] == times * (2 * 43 + 43) and out.where("severity = 'none'").isEmpty()
    assert told["late"] >= 1
    assert max(told["state_rows"]) > told["state_rows"][-1] and told["state_rows"][-1] <= times


def test_copies_are_counted_and_what_comes_too_late_is_told(spark, tmp_path):
    rng = np.random.default_rng(8)
    first = [("a", s, s) for s in range(1, 60)] + [("b", 1030, 5)]
    publish(spark, f"{tmp_path}/in", first + [first[i] for i in rng.integers(0, 60, 25)])
    publish(spark, f"{tmp_path}/in", first[10:20] + [("a", 2000, 70)])                   # 10 copies, and a sample of another block
    publish(spark, f"{tmp_path}/in", [("z", 1, 100_000)])
    publish(spark, f"{tmp_path}/in", first[:4])                                          # behind the watermark
    publish(spark, f"{tmp_path}/in", [("z", 2, 200_000)])
    s = st.telemetry_stream(st.stream_session(spark, 2), f"{tmp_path}/in")
    told = st.run_to_completion(st.counted_dedup(s), f"{tmp_path}/out", f"{tmp_path}/chk")
    out = spark.read.parquet(f"{tmp_path}/out").where("run_key <> 'z'")
    assert sorted((r["run_key"], r["sample"]) for r in out.where("sample IS NOT NULL").collect()) == sorted([(r, s) for r, s, _ in first] + [("a", 2000)])
    assert out.agg(F.sum("copies")).first()[0] == 35
    assert told["late"] == 4 and max(told["state_rows"]) > told["state_rows"][-1]


def test_the_session_of_the_caller_is_not_changed(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = st.stream_session(spark, 3)
    assert s.conf.get("spark.sql.shuffle.partitions") == "3" and s.conf.get("spark.sql.streaming.stateStore.providerClass") == st.ROCKSDB
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and s.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_batches_stay_as_many_as_the_slices_however_many_files(spark, tmp_path):
    from faultline.plans import stream_queries as sq
    rows = [(f"r{k}", 0, 0, 1, 1.0, 0.0, 0.0, 0.1, 1, k, datetime.datetime(2026, 1, 1)) for k in range(60)]
    spark.createDataFrame(rows, st.TELEMETRY_STREAM_SCHEMA).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/in")
    assert sq.files_per_trigger(spark, f"{tmp_path}/in") == 60 // sq.SLICES
    assert sq.files_per_trigger(spark, sq.publish(spark, "/root/testdata/sf0.001", "few") + "/in") == sq.FILES_PER_TRIGGER


def test_what_a_block_has_seen_is_one_value(spark, tmp_path):
    """A row of state a block, its timers aside, not one a sample."""
    publish(spark, f"{tmp_path}/in", [("a", s, s) for s in range(1, 200)])
    s = st.telemetry_stream(st.stream_session(spark, 2), f"{tmp_path}/in")
    told = st.run_to_completion(st.counted_dedup(s, block=64), f"{tmp_path}/out", f"{tmp_path}/chk")
    assert spark.read.parquet(f"{tmp_path}/out").where("sample IS NOT NULL").count() == 199
    assert max(told["state_rows"]) <= 4 * 4
