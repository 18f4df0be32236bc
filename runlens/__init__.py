"""Job-lifecycle, capacity, configuration and benchmark analytics on PySpark."""

from runlens.session import get_spark, scratch, shared_dir, tune

__all__ = ["get_spark", "scratch", "shared_dir", "tune"]
