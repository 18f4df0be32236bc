"""Capacity and demand as column expressions over tick and application tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Allocation defaults.
BATCH_SIZE = 10
MAX_PENDING = 100

STATIC_CLUSTER, STATIC_CLIENT = "StaticCluster", "StaticClient"
DYNAMIC_CLUSTER, DYNAMIC_CLIENT = "DynamicCluster", "DynamicClient"


def gap(target: Column, current: Column, pending: Column) -> Column:
    return target - (current + pending)


def to_allocate(missing: Column, cardinality: Column, batch: int = BATCH_SIZE) -> Column:
    """Executors to ask for in one step; a non-positive cardinality sets no bound."""
    step = F.when(cardinality > 0, F.least(F.lit(batch).cast("long"), cardinality.cast("long"))).otherwise(
        F.lit(batch).cast("long"))
    return F.least(missing.cast("long"), step)


def may_allocate(missing: Column, current: Column, pending: Column, ready: Column,
                 max_pending: int = MAX_PENDING) -> Column:
    first = (current == 0) & (pending == 0)
    return (missing > 0) & (pending < max_pending) & (first | ready)


def mode(deploy_mode: Column, has_job_set_env: Column, dynamic: Column) -> Column:
    cluster = (F.lower(F.coalesce(deploy_mode, F.lit("cluster"))) == "cluster") | has_job_set_env
    dynamic = F.coalesce(dynamic, F.lit(False))
    return (
        F.when(cluster & dynamic, DYNAMIC_CLUSTER).when(cluster, STATIC_CLUSTER)
        .when(dynamic, DYNAMIC_CLIENT).otherwise(STATIC_CLIENT)
    )


def cardinality(mode_: Column, instances: Column, captured: Column) -> Column:
    """Size of the group scheduled together; the driver counts in cluster mode."""
    members = F.when(mode_.isin(STATIC_CLUSTER, DYNAMIC_CLUSTER), instances + 1).otherwise(instances)
    return F.when(mode_.isin(DYNAMIC_CLUSTER, DYNAMIC_CLIENT) & captured, 0).otherwise(members)


def ready(mode_: Column, captured: Column) -> Column:
    """Dynamic client mode waits for the first executor's attributes; the others are always ready."""
    return (mode_ != DYNAMIC_CLIENT) | captured


def mode_violations(mode_: Column, instances: Column, uniformity: Column, driver_host: Column) -> Column:
    """Array of (rule_no, message) of all violated rules, in the order they are checked."""
    dynamic = mode_.isin(DYNAMIC_CLUSTER, DYNAMIC_CLIENT)
    client = mode_.isin(STATIC_CLIENT, DYNAMIC_CLIENT)
    least = F.when(mode_ == DYNAMIC_CLIENT, 2).otherwise(1)
    rules = [
        (dynamic & (F.coalesce(uniformity, F.lit("")) == ""), F.lit("node uniformity label is not set")),
        (dynamic & (instances < least), F.concat(
            F.lit("initial executors must be >= "), least.cast("string"), F.lit(", got "), instances.cast("string"))),
        (~dynamic & (instances <= 0), F.concat(
            F.lit("executor count must be > 0, got "), instances.cast("string"))),
        (client & driver_host.isNull(), F.lit("driver host is not set")),
    ]
    return violations(rules)


def violations(rules: list[tuple[Column, Column]]) -> Column:
    """Array of (rule_no, message) for the conditions that hold."""
    found = F.array(*[
        F.when(condition, F.struct(F.lit(no).alias("rule_no"), message.alias("message")))
        for no, (condition, message) in enumerate(rules, 1)])
    return F.filter(found, lambda v: v.isNotNull())


def priority_class(is_driver: Column, cardinality_: Column, initial: Column, scale_up: Column) -> Column:
    return F.when(is_driver | (cardinality_ > 0), initial).otherwise(scale_up)


def job_set_id(mode_: Column, env: Column, conf: Column, app_id: Column) -> Column:
    """Job set of a running application: the environment in cluster mode, else the setting or the id."""
    cluster = mode_.isin(STATIC_CLUSTER, DYNAMIC_CLUSTER)
    return F.when(cluster, env).otherwise(F.coalesce(conf, app_id))


def submitted_job_set_id(cli: Column, template: Column, app_id: Column) -> Column:
    empty = F.lit("")
    return F.coalesce(F.nullif(cli, empty), F.nullif(template, empty), app_id)
