"""Checks over snapshots of pods: (snapshot, pod, pod_no, labels, node_selector)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions.text import FAILED_STATUS
from runlens.operators.layers import missing_entries
from runlens.operators.scans import dense_rank_ids
from runlens.session import written

# Label names of role and test, and texts of check results.
ROLE_LABEL, TEST_LABEL = "spark-role", "test-id"
TIMED_OUT = "Timed out waiting for assertion"
COMPLETED_FIRST = " (job completed before assertion could pass)"


def has_labels(labels: Column, selector: Column) -> Column:
    """The map holds every entry of the selector."""
    return F.size(missing_entries(selector, labels)) == 0


def label_select(pods: DataFrame, selector: dict[str, str]) -> DataFrame:
    """Pods with all given labels, as plain conditions."""
    for key, value in selector.items():
        pods = pods.filter(F.try_element_at("labels", F.lit(key)) == value)
    return pods


def label(name: str) -> Column:
    return F.try_element_at("labels", F.lit(name))


def select_per_test(pods: DataFrame, checks: DataFrame) -> DataFrame:
    """Pods that match the selector of their test: checks(test_id, selector), one row per test."""
    tagged = pods.withColumn("test_id", label(TEST_LABEL))
    return tagged.join(checks, "test_id").filter(has_labels(F.col("labels"), F.col("selector"))).drop("selector")


def pod_counts(pods: DataFrame) -> DataFrame:
    """Pods per (snapshot, test_id, role)."""
    return pods.groupBy("snapshot", label(TEST_LABEL).alias("test_id"), label(ROLE_LABEL).alias("role")).agg(
        F.count(F.lit(1)).alias("n_pods"))


def pod_count_check(pods: DataFrame, checks: DataFrame) -> DataFrame:
    """checks(snapshot, test_id, role, expected): pass flag and the message of a failure."""
    found = F.coalesce("n_pods", F.lit(0))
    selector = F.concat(F.lit(f"{ROLE_LABEL}="), "role", F.lit(f",{TEST_LABEL}="), "test_id")
    message = F.concat(F.lit("Expected "), F.col("expected").cast("string"), F.lit(" pods with selector '"), selector,
                       F.lit("', found "), found.cast("string"))
    passed = found == F.col("expected")
    return checks.join(pod_counts(pods), ["snapshot", "test_id", "role"], "left").select(
        *checks.columns, found.alias("found"), passed.alias("passed"),
        F.when(passed, "").otherwise(message).alias("message"))


def max_seen(pods: DataFrame, role: str, expected: Column, latest: int) -> DataFrame:
    """Largest number of pods of a role per test over all snapshots, against an expected minimum."""
    counts = pod_counts(pods).filter(F.col("role") == role)
    per_test = counts.groupBy("test_id").agg(
        F.max("n_pods").alias("max_seen"),
        F.coalesce(F.max(F.when(F.col("snapshot") == latest, F.col("n_pods"))), F.lit(0)).alias("current"))
    text = F.concat(expected.cast("string"), F.lit(" (max seen: "), F.col("max_seen").cast("string"),
                    F.lit(", current: "), F.col("current").cast("string"), F.lit(")"))
    passed = F.col("max_seen") >= expected
    return per_test.select("*", passed.alias("passed"), F.when(passed, "").otherwise(
        F.concat(F.lit("Executor count max never reached "), text)).alias("message"))


def first_verdicts(pods: DataFrame, predicate: Column) -> DataFrame:
    """Per pod the verdict of the first snapshot it was seen in."""
    return pods.groupBy(label(TEST_LABEL).alias("test_id"), "pod").agg(
        F.min_by(F.coalesce(predicate, F.lit(False)), "snapshot").alias("ok"))


def all_pass_min(pods: DataFrame, role: str, predicate: Column, what: str, least: int) -> DataFrame:
    """Every pod ever seen passed and at least `least` did; the message names the pods that failed, in order."""
    seen = first_verdicts(pods.filter(label(ROLE_LABEL) == role), predicate)
    counts = seen.groupBy("test_id").agg(F.count_if("ok").alias("n_valid"), F.count_if(~F.col("ok")).alias("n_failed"),
                                         F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("pod")))).alias("names"))
    failed, valid = F.col("n_failed"), F.col("n_valid")
    message = (
        F.when(failed > 0, F.concat(failed.cast("string"), F.lit(f" {role} pod(s) failed '{what}': "), F.array_join("names", ", ")))
        .when(valid < least, F.concat(F.lit("Only seen "), valid.cast("string"),
                                      F.lit(f" valid {role} pod(s) so far, need at least {least}")))
        .otherwise("")
    )
    return counts.select("test_id", "n_valid", "n_failed", ((failed == 0) & (valid >= least)).alias("passed"), message.alias("message"))


def map_text(entries: Column) -> Column:
    """`k=v, k=v` with the keys in order."""
    pairs = F.array_sort(F.map_entries(entries))
    return F.concat_ws(", ", F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])))


# What a message says is missing, by the column that was checked.
MISSING = {"node_selector": "missing node selectors", "annotations": "missing or incorrect annotations"}


def entry_failures(pods: DataFrame, expected: Column, column: str = "node_selector") -> DataFrame:
    """Pods whose map `column` lacks expected entries, one row and message each, whatever their number."""
    missing = missing_entries(expected, F.col(column))
    bad = pods.withColumn("missing", missing).filter(F.size("missing") > 0)
    return bad.select("snapshot", label(TEST_LABEL).alias("test_id"), "pod_no", F.concat(
        F.lit("Pod "), "pod", F.lit(f" {MISSING[column]}: "), map_text(F.col("missing"))).alias("message"))


def no_pods(checks: DataFrame, pods: DataFrame) -> DataFrame:
    """checks(snapshot, test_id, role) that no pod matches, with the message that says so."""
    selector = F.concat(F.lit(f"{ROLE_LABEL}="), "role", F.lit(f",{TEST_LABEL}="), "test_id")
    return checks.join(pod_counts(pods), ["snapshot", "test_id", "role"], "left_anti").select(
        "snapshot", "test_id", "role", F.concat(F.lit("No pods found with selector: "), selector).alias("message"))


def join_messages(failures: DataFrame, keys: list[str], order: str, size: int = 1000, width: int = 100_000) -> DataFrame:
    """A report step, apart from the check itself: messages joined by `; ` in `order`, always `size` to a row.

    (`keys`, `chunk`) names a row, so that no row holds an unbounded group; chunk 0 is there for every group.
    """
    numbered = dense_rank_ids(written(failures, "failures"), keys, order, "_place", width)
    chunk = F.expr(f"(_place - 1) div {size}")
    texts = F.array_sort(F.collect_list(F.struct("_place", "message")))
    return numbered.groupBy(*keys, chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.concat_ws("; ", F.transform(texts, lambda x: x["message"])).alias("messages"))


def check_results(polls: DataFrame) -> DataFrame:
    """Final result per check from polls(check_id, poll, passed, message, job_completed).

    A success ends the polling. A check that still fails keeps its last message, with a note when
    the job completed first; a check with no result at all has timed out.
    """
    has_result = F.col("passed").isNotNull()
    per = polls.groupBy("check_id").agg(
        F.coalesce(F.max("passed"), F.lit(False)).alias("passed"),
        F.max_by("message", F.when(has_result, F.col("poll"))).alias("last"),
        F.max("job_completed").alias("completed"))
    message = (
        F.when(F.col("passed"), "")
        .when(F.col("last").isNull(), TIMED_OUT)
        .when(F.col("completed"), F.concat("last", F.lit(COMPLETED_FIRST)))
        .otherwise(F.col("last"))
    )
    return per.select("check_id", "passed", message.alias("message"))


def failed_status_scan(lines: DataFrame) -> DataFrame:
    """First failed entry per scan of status lines (scan_id, line_no from 1, line); line 1 is the header."""
    return (lines.filter((F.col("line_no") > 1) & F.col("line").rlike(FAILED_STATUS))
            .groupBy("scan_id").agg(F.min_by("line", "line_no").alias("line"))
            .select("scan_id", F.get(F.split("line", "\\s+"), F.lit(0)).alias("name")))
