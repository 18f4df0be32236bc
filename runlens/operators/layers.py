"""Layered configuration: precedence, merging by key, rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions.capacity import violations
from runlens.functions.text import duration, entries_valid, key_valid, kv_entries, path_source, to_long

# Defaults, and values that count as unset in the final merge.
DEFAULT_NAMESPACE = "default"
DEFAULT_PRIORITY = 0.0
DEFAULT_USER = 185
DEFAULT_TIMEOUT_S = 300
DEFAULT_UI_PORT = 4040
DEFAULT_PROXY_PORT = 4180
DEFAULT_MEMORY = "1Gi"
DEFAULT_CORES = "1"


def merge_layers(entries: DataFrame, keys: list[str], layer: str = "layer", value: str = "value") -> DataFrame:
    """Long form: per `keys` the value of the highest layer that has the key. Combines map-side."""
    return entries.groupBy(*keys).agg(F.max_by(value, layer).alias(value))


def merge_maps(*maps: Column) -> Column:
    """Map form: later maps win, a missing map is empty. Needs the LAST_WIN policy of `tune`."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.map_concat(*[F.coalesce(m, empty) for m in maps])


def merge_by_name(items: DataFrame, owner: str = "app_id") -> DataFrame:
    """Items (owner, layer, pos, name, value) merged by name: the override layer wins, then the last."""
    return (items.filter(F.col("name").isNotNull())
            .groupBy(owner, "name").agg(F.max_by("value", F.struct("layer", "pos")).alias("value")))


def first_capture(attributes: DataFrame, owner: str = "app_id", order: str = "message_id",
                  configured: Column | None = None) -> DataFrame:
    """First (label, value) with both parts non-empty per owner.

    `configured` is the uniformity label set for the owner: where it is missing or empty, attributes are ignored.
    """
    wanted = (F.col("label") != "") & (F.col("value") != "")
    if configured is not None:
        wanted = wanted & (configured != "")
    return (attributes.filter(wanted)
            .groupBy(owner).agg(F.min_by(F.struct("label", "value"), order).alias("c")).select(owner, "c.*"))


def resolve_long(entries: DataFrame, owner: str = "app_id") -> DataFrame:
    """(owner, key): the value of the strongest layer that sets it, in the order cli, template, default."""
    strength = F.when(F.col("layer") == "cli", 3).when(F.col("layer") == "template", 2).otherwise(1)
    return entries.filter(F.col("value").isNotNull()).groupBy(owner, "key").agg(
        F.max_by(F.struct("value", "layer"), strength).alias("r")).select(owner, "key", "r.*")


def missing_entries(expected: Column, actual: Column) -> Column:
    """Entries of `expected` that `actual` lacks or has with another value."""
    have = F.coalesce(actual, F.from_json(F.lit("{}"), "map<string,string>"))
    return F.map_filter(expected, lambda k, v: ~F.try_element_at(have, k).eqNullSafe(v))


def extra_resources(resources: Column) -> Column:
    """Resources besides memory and cpu."""
    return F.map_filter(resources, lambda k, _: ~k.isin("memory", "cpu"))


def resolved_resources(resources: Column, cli_memory: Column, cli_cpu: Column) -> Column:
    """Memory and cpu by precedence, laid under the template's other resources."""
    memory = F.coalesce(cli_memory, F.try_element_at(resources, F.lit("memory")), F.lit(DEFAULT_MEMORY))
    cpu = F.coalesce(cli_cpu, F.try_element_at(resources, F.lit("cpu")), F.lit(DEFAULT_CORES))
    return merge_maps(F.create_map(F.lit("memory"), memory, F.lit("cpu"), cpu), extra_resources(resources))


def resolve_resources(apps: DataFrame, owner: str = "app_id") -> DataFrame:
    """One row per role with memory and cpu, limit and request, by precedence.

    Input columns are named `cli_<role>_<resource>_<bound>` and `tpl_...`; every application is
    resolved inside its own row.
    """
    defaults = {"memory": DEFAULT_MEMORY, "cpu": DEFAULT_CORES}

    def resolved(role: str) -> Column:
        return F.struct(F.lit(role).alias("role"), *[
            F.coalesce(f"cli_{role}_{r}_{b}", f"tpl_{role}_{r}_{b}", F.lit(default)).alias(f"{r}_{b}")
            for r, default in defaults.items() for b in ("limit", "request")])

    return apps.select(owner, F.explode(F.array(resolved("driver"), resolved("executor"))).alias("r")).select(owner, "r.*")


def _unless(value: Column, unset) -> Column:
    return F.when(value != F.lit(unset), value)


def resolve_namespace(cli: Column, template: Column, base: Column) -> Column:
    """`default` counts as unset: an explicit cli `default` loses to the template.

    An empty template namespace with no cli value stays empty.
    """
    first = F.coalesce(cli, template, F.lit(DEFAULT_NAMESPACE))
    return F.coalesce(_unless(first, DEFAULT_NAMESPACE), _unless(template, ""), _unless(base, ""),
                      F.lit(DEFAULT_NAMESPACE))


def resolve_priority(cli: Column, template: Column, base: Column) -> Column:
    """0.0 counts as unset."""
    first = F.coalesce(cli, template, F.lit(DEFAULT_PRIORITY))
    return F.coalesce(_unless(first, DEFAULT_PRIORITY), _unless(template, 0.0), base)


def resolve_job(apps: DataFrame) -> DataFrame:
    """Final namespace, priority, user, image and time-out of each application."""
    return apps.select(
        "app_id",
        resolve_namespace(F.col("cli_namespace"), F.col("tpl_namespace"), F.col("base_namespace")).alias("namespace"),
        resolve_priority(F.col("cli_priority"), F.col("tpl_priority"), F.col("base_priority")).alias("priority"),
        F.coalesce("cli_user", "tpl_user", F.lit(DEFAULT_USER).cast("long")).alias("run_as_user"),
        F.coalesce("cli_image", "driver_image").alias("image"),
        F.coalesce("cli_timeout_s", F.lit(DEFAULT_TIMEOUT_S).cast("long")).alias("timeout_s"),
    )


def ui_port(proxy_enabled: Column, proxy_port: Column, configured: Column) -> Column:
    """The proxy's port where there is a proxy, else that of the UI; each with its own default."""
    return F.when(proxy_enabled, F.coalesce(proxy_port, F.lit(DEFAULT_PROXY_PORT))).otherwise(
        F.coalesce(configured, F.lit(DEFAULT_UI_PORT)))


def resolve_ingress(apps: DataFrame) -> DataFrame:
    """Ingress of the applications that have one on the command line or in the template."""
    has_cli, has_tpl = F.col("cli_ingress"), F.col("tpl_ingress")
    return apps.filter(has_cli | has_tpl).select(
        "app_id",
        merge_maps(F.when(has_tpl, F.col("tpl_annotations")), F.when(has_cli, F.col("cli_annotations"))).alias("annotations"),
        F.coalesce(F.when(has_cli, F.col("cli_tls")), F.when(has_tpl, F.col("tpl_tls")), F.lit(False)).alias("tls"),
        F.coalesce(F.when(has_cli, F.col("cli_cert")), F.when(has_tpl, F.col("tpl_cert")), F.lit("")).alias("cert"),
        ui_port(F.col("proxy_enabled"), F.col("proxy_port"), F.col("ui_port")).alias("port"),
    )


def node_selector(cli: Column, template: Column, captured_label: Column, captured_value: Column) -> Column:
    """The command line's selector, or the template's if that is empty, plus the captured pair."""
    both = (captured_label != "") & (captured_value != "")
    pair = F.when(both, F.create_map(captured_label, captured_value))
    chosen = F.when(F.coalesce(F.size(cli), F.lit(0)) > 0, cli).otherwise(template)
    return merge_maps(chosen, pair)


def explode_violations(rows: DataFrame, found: Column, owner: str = "app_id") -> DataFrame:
    """All violations as rows; the smallest `rule_no` is the one that is met first."""
    return rows.select(owner, F.explode(found).alias("v")).select(owner, "v.rule_no", "v.message")


def required_rules(apps: DataFrame) -> DataFrame:
    image, driver, executor = F.col("cli_image"), F.col("driver_image"), F.col("executor_image")

    def filled(c: Column) -> Column:
        return F.coalesce(c != "", F.lit(False))

    rules = [
        (image == "", F.lit("container image is empty")),
        (image.isNull() & (driver.isNull() | executor.isNull()), F.concat(
            F.lit("container image must be set or be in both templates (driver: "),
            driver.isNotNull().cast("string"), F.lit(", executor: "), executor.isNotNull().cast("string"), F.lit(")"))),
        (F.col("executor_ingresses") > 0, F.lit("executor template must not have an ingress")),
        (F.col("driver_ingresses") > 1, F.lit("driver template can have one ingress only")),
        (~filled(F.col("cli_queue")) & ~filled(F.col("tpl_queue")), F.lit("queue is not set")),
        (F.col("cli_job_set") == "", F.lit("job set id is empty")),
    ]
    return explode_violations(apps, violations(rules))


def auth_rules(apps: DataFrame) -> DataFrame:
    """Rules of the authentication proxy, for the applications that enable it."""
    skip = F.col("skip_discovery")
    rules = [
        (F.col("client_id").isNull(), F.lit("clientId is not set")),
        (F.col("client_secret").isNull() & F.col("secret_ref").isNull(), F.lit("neither clientSecret nor its reference is set")),
        (~skip & F.col("issuer_url").isNull(), F.lit("issuerUrl is not set")),
    ] + [(skip & F.col(c).isNull(), F.lit(f"{name} is not set")) for c, name in (
        ("login_url", "loginUrl"), ("redeem_url", "redeemUrl"), ("validate_url", "validateUrl"), ("jwks_url", "jwksUrl"))]
    return explode_violations(apps.filter("auth_enabled"), violations(rules))


INT_MAX = 2**31 - 1


def _typed(kind: str, unit: str, text: Column) -> Column:
    """The number a text stands for, null where it does not have the form of its kind."""
    word = F.lower(F.trim(text))
    if kind == "time":
        return duration(text, F.lit(unit)).cast("double")
    if kind in ("integer", "long"):
        whole = to_long(F.trim(text))
        return (F.when(whole.between(-INT_MAX - 1, INT_MAX), whole) if kind == "integer" else whole).cast("double")
    if kind == "number":
        return F.when(text.rlike("[0-9]|NaN|Infinity"), text.try_cast("double"))
    if kind == "boolean":
        return F.when(word == "true", 1.0).when(word == "false", 0.0)
    return F.lit(None).cast("double")


def _checked(kind: str, check: str, text: Column, number: Column) -> Column:
    """Whether a given text passes the check of its setting."""
    if kind == "text":
        # built only for the check at hand
        return {
            "": lambda: F.lit(True), "http": lambda: text.startswith("http"), "nonempty": lambda: text != "",
            "path": lambda: path_source(text) != "invalid", "label_key": lambda: (text == "") | key_valid(text),
            "labels": lambda: entries_valid(kv_entries(text)), "annotations": lambda: entries_valid(kv_entries(text, "annotation")),
        }[check]()
    limits = {"": F.lit(True), "positive": number > 0, "non_negative": number >= 0}
    # NaN is larger than any number
    return F.coalesce(limits[check] & ~F.isnan(number), F.lit(False)) if check else number.isNotNull()


def typed_settings(entries: DataFrame, settings: list[tuple], owner: str = "app_id", order: str = "pos") -> DataFrame:
    """All settings of each owner: last text given or the default, its typed value and validity.

    `settings` lists (key, kind, unit, default, check): kinds are time, integer, long, number, boolean and text; checks
    positive and non_negative for numbers; http, nonempty, path, label_key, labels and annotations for texts.

    The last text per owner and setting is combined map-side. Each given text is evaluated once, on its own row, by the rules of its own
    setting; defaults are constants of the plan. An owner's rows then meet the defaults of the settings that it does not give.
    """
    rules = {key: (kind, unit, check) for key, kind, unit, _, check in settings}
    known = F.when(F.col("key").isin(list(rules)) & F.col("value").isNotNull(), F.col("key"))
    last = entries.groupBy(owner, known.alias("key")).agg(F.max_by("value", order).alias("text"))

    def by_rule(part: list[int], value) -> Column:
        """`value` of each distinct rule, looking only at `part` of (kind, unit, check), for the keys that have it."""
        keys: dict[tuple, list[str]] = {}
        for key, rule in rules.items():
            keys.setdefault(tuple(rule[i] for i in part), []).append(key)
        chain = F
        for rule, own in keys.items():
            chain = chain.when(F.col("key").isin(own), value(*rule))
        return chain

    typed = last.withColumn("number", by_rule([0, 1], lambda kind, unit: _typed(kind, unit, F.col("text"))))
    valid = by_rule([0, 2], lambda kind, check: _checked(kind, check, F.col("text"), F.col("number")))
    one = F.struct("key", F.lit(True).alias("given"), "text", "number", valid.alias("valid"))
    given = typed.groupBy(owner).agg(F.collect_list(F.when(F.col("key").isNotNull(), one)).alias("own"))

    def standard(key: str, kind: str, unit: str, default: str | None, check: str) -> Column:
        text = F.lit(default).cast("string")
        number = _typed(kind, unit, text)
        ok = F.lit(True) if default is None else _checked(kind, check, text, number)
        return F.struct(F.lit(key).alias("key"), F.lit(False).alias("given"), text.alias("text"), number.alias("number"), ok.alias("valid"))

    absent = F.filter(F.array(*[standard(*s) for s in settings]), lambda d: ~F.exists("own", lambda g: g["key"] == d["key"]))
    return given.select(owner, F.inline(F.concat("own", absent)))
