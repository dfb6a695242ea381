"""martwise: a Spark-native retail star-schema engine.

Raw gzip JSON exports (orders, payments, bank, web tracking) are read with
explicit schemas, unified into five dimensions and five facts with
deterministic keys, checked for quality, scored by RFM, and served as
DataFrame views and measures.  Every builder is a lazy
``DataFrame -> DataFrame`` function; actions happen only in sinks and jobs.
"""

from martwise.session import build_session


def __getattr__(name):
    """Lazy exports of the main entry points (they import pyspark plans)."""
    if name in ("RawJsonGold", "DriverGold"):
        from martwise.plans import gold
        return getattr(gold, name)
    if name in ("run_full_pipeline", "run_extract_only", "run_transform_only"):
        from martwise.plans import jobs
        return getattr(jobs, name)
    raise AttributeError(name)


__all__ = ["build_session", "RawJsonGold", "DriverGold", "run_full_pipeline",
           "run_extract_only", "run_transform_only"]
