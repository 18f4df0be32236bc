"""Queries by name. Importing this package registers all of them."""

from runlens.plans import bench_queries, conf_queries, event_queries, layout_queries, stream_queries, workload  # noqa: F401
from runlens.plans.registry import ORACLES, QUERIES, query, runner

# runs the whole workload, which is registered by now
query("bench_suite_sink", bench_queries.suite_sql())(bench_queries.suite_run)

__all__ = ["ORACLES", "QUERIES", "query", "runner"]
