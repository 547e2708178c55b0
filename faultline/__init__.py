"""faultline: process-telemetry fault analytics as Spark DataFrame jobs.

Layout
------
sources/    tables and views over the provided data, typed ingest, sinks
functions/  fixed values (catalogues, ladders) and scalar column expressions
operators/  DataFrame operators: prepare, quality, features, alarms, metrics,
            alerts, models, plus the run-blocked execution helpers
plans/      registered queries (DataFrame form and oracle SQL form)
streaming/  Structured Streaming versions of the alarm and alert operators
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers on any
    executor can run its pandas UDFs without the package being installed
    there (a cluster that installs it, or ships it with --py-files, loses
    nothing)."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:   # pragma: no cover - older pyspark without the helper
        pass


_ship_by_value()
