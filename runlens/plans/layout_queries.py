"""Workload queries over facts that are laid out by month."""

from __future__ import annotations

from runlens.plans import workload
from runlens.plans.registry import ORACLES, query
from runlens.session import scratch_path
from runlens.sources.layout import Layout, lay_out


def lines(t) -> Layout:
    """The lines as a user would write them once, for all queries that follow."""
    return lay_out(t["lineitem"], scratch_path(t.spark, "lines-by-month"), "l_shipdate", ["l_orderkey", "l_linenumber"])


@query("laid_out_star_top_groups", ORACLES["w01_star_top_groups"])
def star_top_groups(t):
    return workload.star_top_groups(t, lines(t).during("month = 11"))


@query("laid_out_partition_share", ORACLES["w12_partition_share"])
def partition_share(t):
    return workload.partition_share(t, lines(t).during("year = 1999"))


@query("laid_out_before_after", ORACLES["w15_before_after"])
def before_after(t):
    first, _, end = workload.around()
    return workload.before_after(lines(t).between(first, end))
