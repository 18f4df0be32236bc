import json

import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from runlens.functions import capacity as cap, text as tx
from runlens.operators import documents as docs, layers as ly, snapshots as sn
from runlens.plans.conf_queries import SETTINGS
from runlens.sources.conf import conf_dir_scan


def values(spark, items, fn, kind="string"):
    df = spark.createDataFrame(list(enumerate(items)), f"n int, x {kind}")
    return [r["y"] for r in df.select("n", fn(F.col("x")).alias("y")).orderBy("n").collect()]


CASES = {
    tx.key_valid: [("description", True), ("example.com/description", True), ("valid-prefix/name_1", True), ("foo.bar/baz", True),
                   ("invalid_prefix/name", False), ("invalid key", False), ("", False), ("/leadingSlash", False), ("trailingSlash/", False),
                   ("a" * 254 + "/foo", False), ("a" * 253 + "/foo", True), ("a" * 63, True), ("a" * 64, False), (None, False), ("abc\n", False), ("a/b/c", False)],
    tx.annotation_value_valid: [("", True), ("some:value", True), ("x" * 500, True), ("x" * 262145, False), ("x" * 262144, True), (None, False), ("é" * 131073, False)],
    tx.label_value_valid: [("", True), ("my-app", True), ("App1", True), ("-wrong", False), ("a" * 64, False), ("invalid/value", False), (None, False), ("abc\n", False)],
    tx.name_valid: [("my-pod-01", True), ("example.com", True), ("foo.bar-baz", True), ("a" * 63, True), ("a" * 64, True), ("Invalid", False), ("", False),
                    ("-start", False), ("end-", False), (".dotstart", False), ("dotend.", False), ("foo..bar", False), ("/foo", False), ("foo/", False), ("a" * 254, False), (None, False)],
    tx.name_prefix_valid: [("AZaz09-.", True), ("prefix-", True), ("prefix.", True), ("a" * 30, True), ("b" * 31, False), ("", False), ("invalid/prefix", False), ("with space", False), (None, False), ("under_score", False)],
    tx.path_source: [("/etc/spark/config.yaml", "local"), ("./template.yaml", "local"), ("template.yaml", "local"), ("FILE:///etc/x.yaml", "file_uri"),
                     ("HTTP://localhost:8080/t.yaml", "http"), ("https://h/x", "http"), ("", "invalid"), ("ftp://h/x", "invalid"), ("ssh://h", "invalid"),
                     ("hdfs://h/x", "invalid"), ("://invalid/uri", "invalid"), (None, "invalid")],
    tx.is_local_resource: [("/a/b.jar", True), ("b.jar", True), ("file:/a", True), ("LOCAL:///a", True), ("hdfs://n/a", False), ("s3a://b/k", False), ("a b", False),
                           ("http://h/x", False), ("1x:y", False), ("a%2Fb", True), ("a%2", False), ("file:", False), ("dir/a:b", True), (None, False)],
    tx.to_long: [("12", 12), ("-5", -5), ("+7", 7), ("", None), ("x", None), (" 1", None), ("99999999999999999999", None), ("9223372036854775807", 2**63 - 1)],
}


@pytest.mark.parametrize("fn", CASES, ids=lambda f: f.__name__)
def test_text_checks(spark, fn):
    items = CASES[fn]
    assert values(spark, [x for x, _ in items], fn) == [y for _, y in items]


def test_master_url(spark):
    items = [("queue://localhost:50051", ("localhost", 50051)), ("queue://malformed:url:ohno", None), ("queue://badurl", None), ("queue://localhost:badport", None),
             ("queue://h:1:", ("h", 1)), ("queue://:9", ("", 9)), ("queue://h: 12 ", None), ("queue://h:-1", None), ("queue://h:99999999999", None), ("other://h:1", None), (None, None), ("queue://h:+5", ("h", 5))]
    got = values(spark, [x for x, _ in items], lambda c: tx.master_url(c, "queue"))
    assert [tuple(g) if g else None for g in got] == [y for _, y in items]


KV = [("", {}), ("a=1", {"a": "1"}), ("a=1,,b=2,c=3", {"a": "1", "b": "2", "c": "3"}), (" a=1,b= 2, c = 3 ", {"a": "1", "b": "2", "c": "3"}),
      ("a=1, ,b=2", None), ("a=", {"a": ""}), ("a=1,a=2", {"a": "2"}), ("noequals", None), ("a=b=c", None), ("\ta=1\n,b=2", {"a": "1", "b": "2"})]


def test_label_lists(spark):
    assert values(spark, [x for x, _ in KV], lambda c: tx.entries_map(tx.kv_entries(c))) == [y for _, y in KV]


def test_annotation_lists(spark):
    items = [("nginx.ingress.kubernetes.io/rewrite-target=/", {"nginx.ingress.kubernetes.io/rewrite-target": "/"}),
             (" key1=value1 , key2 = value2 ", {"key1": "value1", "key2": "value2"}), ("k=a=b", {"k": "a=b"}), ("bad key=1", None)]
    assert values(spark, [x for x, _ in items], lambda c: tx.entries_map(tx.kv_entries(c, "annotation"))) == [y for _, y in items]


def test_bad_entries_are_all_named(spark):
    assert values(spark, ["x,a=1,-b=2"], lambda c: tx.entries_messages(tx.kv_entries(c))) == [
        ["Invalid label format: 'x' (expected key=value)", "Invalid label format: '-b=2' (expected key=value)"]]


def test_conf_tokens(spark):
    assert values(spark, ["--conf a=1 --conf b=x=y --flag=3 word", ""], tx.conf_tokens) == [{"a": "1", "b": "x=y"}, {}]


def test_durations(spark):
    items = ["300s", "5", "5min", "2h", "1d", "1500ms", "-1500ms", "10us", "junk", "", "5 s", "1w", None, " 7S "]
    assert values(spark, items, lambda c: tx.duration(c, F.lit("s"))) == [300, 5, 300, 7200, 86400, 1, -1, 0, None, None, None, None, None, 7]
    assert values(spark, ["5s", "10"], lambda c: tx.duration(c, F.lit("ms"))) == [5000, 10]


def test_error_lines(spark):
    text = "\n".join(["ok", "Some Exception", "an Error", "error", "Failed", "FAILED"] + [f"Error {n}" for n in range(20)])
    got = values(spark, [text], tx.error_lines)[0]
    assert got == ["Some Exception", "an Error", "Failed", "FAILED"] + [f"Error {n}" for n in range(6)]


def test_conf_folder(spark, tmp_path):
    folder = tmp_path / "app1"
    (folder / "sub").mkdir(parents=True)
    for name in ("spark-defaults.conf", "a", "bad name", "trailing-", "x~"):
        (folder / name).write_text(f"content of {name}\nline 2")
    (folder / "sub" / "nested").write_text("no")
    got = {(r["app"], r["key"]): r["content"] for r in conf_dir_scan(spark, str(folder), "conf").collect()}
    assert got == {("app1", "conf/spark-defaults.conf"): "content of spark-defaults.conf\nline 2", ("app1", "conf/a"): "content of a\nline 2"}


def test_allocation_rows(spark):
    golden = [(4, 1, 1), (4, 2, 2), (4, 10, 4), (4, 4, 4), (4, 0, 4), (4, -1, 4), (2, 4, 2), (1, 10, 1), (3, 5, 3), (0, 5, 0)]
    df = spark.createDataFrame(golden, "gap int, card int, want int")
    assert df.filter(cap.to_allocate(F.col("gap"), F.col("card"), batch=4) != F.col("want")).count() == 0


def test_allocation_gate(spark):
    df = spark.createDataFrame([(1, 0, 0, False, True), (1, 1, 0, False, False), (1, 1, 0, True, True), (0, 0, 0, True, False), (9, 1, 100, True, False), (9, 1, 99, True, True)],
                               "gap int, current int, pending int, ready boolean, want boolean")
    assert df.filter(cap.may_allocate(*[F.col(c) for c in ("gap", "current", "pending", "ready")]) != F.col("want")).count() == 0


def test_modes(spark):
    data = [("cluster", False, True, "DynamicCluster", 4, 0), ("CLUSTER", False, None, "StaticCluster", 4, 4), (None, False, False, "StaticCluster", 4, 4),
            ("client", True, False, "StaticCluster", 4, 4), ("client", False, True, "DynamicClient", 3, 0), ("client", False, False, "StaticClient", 3, 3)]
    df = spark.createDataFrame(data, "deploy string, env boolean, dynamic boolean, want string, before int, after int")
    got = df.withColumn("mode", cap.mode(F.col("deploy"), F.col("env"), F.col("dynamic")))
    three = F.lit(3)
    bad = got.filter((F.col("mode") != F.col("want")) | (cap.cardinality(F.col("mode"), three, F.lit(False)) != F.col("before"))
                     | (cap.cardinality(F.col("mode"), three, F.lit(True)) != F.col("after")))
    assert bad.count() == 0


def test_mode_violations(spark):
    data = [("DynamicCluster", 1, "zone", None, []), ("DynamicCluster", 0, "", None, [1, 2]), ("DynamicClient", 1, "zone", "h", [2]), ("DynamicClient", 2, "zone", None, [4]),
            ("StaticCluster", 0, None, None, [3]), ("StaticClient", 1, None, None, [4]), ("StaticClient", 1, None, "h", [])]
    df = spark.createDataFrame(data, "mode string, n int, label string, host string, want array<int>")
    got = df.withColumn("v", cap.mode_violations(F.col("mode"), F.col("n"), F.col("label"), F.col("host"))).collect()
    assert [[v["rule_no"] for v in r["v"]] for r in got] == [r["want"] for r in got]


def test_namespace_and_priority_sentinels(spark):
    data = [("cli", "tpl", "", "cli"), (None, "tpl", "", "tpl"), (None, None, "", "default"), ("default", "tpl", "", "tpl"), (None, "", "", ""),
            ("default", "", "base", "base"), ("default", None, "", "default"), (None, "default", "base", "default")]
    df = spark.createDataFrame(data, "c string, t string, b string, want string")
    assert rows(df.select(ly.resolve_namespace(F.col("c"), F.col("t"), F.col("b")).alias("x"), "want").filter("x <> want")) == []
    data = [(5.0, 1.0, 0.0, 5.0), (None, 1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 1.0), (0.0, 0.0, 2.0, 2.0), (None, None, 0.0, 0.0), (0.0, None, 3.0, 3.0)]
    df = spark.createDataFrame(data, "c double, t double, b double, want double")
    assert rows(df.select(ly.resolve_priority(F.col("c"), F.col("t"), F.col("b")).alias("x"), "want").filter("x <> want")) == []


def test_env_merge(spark):
    items = [(1, 0, 0, "VAR1", "a"), (1, 0, 1, "VAR2", "b"), (1, 0, 2, "COMMON", "first"), (1, 1, 0, "VAR3", "c"), (1, 1, 1, "COMMON", "second"), (1, 1, 2, None, "x"), (1, 0, 3, "VAR1", "a2")]
    df = spark.createDataFrame(items, "app_id int, layer int, pos int, name string, value string")
    assert {r["name"]: r["value"] for r in ly.merge_by_name(df).collect()} == {"VAR1": "a2", "VAR2": "b", "COMMON": "second", "VAR3": "c"}


def test_ingress(spark):
    schema = ("app_id int, cli_ingress boolean, tpl_ingress boolean, cli_tls boolean, tpl_tls boolean, cli_cert string, tpl_cert string, proxy_enabled boolean, "
              "proxy_port int, ui_port int, cli_annotations map<string,string>, tpl_annotations map<string,string>")
    data = [(1, True, True, False, True, None, "template-cert", False, 4180, None, {"bazz": "cli"}, {"foo": "template"}),
            (2, True, False, None, None, None, None, True, 4180, 4050, {}, None), (3, False, False, None, None, None, None, False, None, None, None, None)]
    got = {r["app_id"]: r for r in ly.resolve_ingress(spark.createDataFrame(data, schema)).collect()}
    assert set(got) == {1, 2}
    assert got[1]["annotations"] == {"foo": "template", "bazz": "cli"} and got[1]["tls"] is False and got[1]["cert"] == "template-cert" and got[1]["port"] == 4040
    assert (got[2]["annotations"], got[2]["tls"], got[2]["cert"], got[2]["port"]) == ({}, False, "", 4180)


def test_missing_entries_and_selectors(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"a": "9"},), (None,)], "labels map<string,string>")
    expected = F.expr("map('a', '1')")
    assert [r["m"] for r in df.select(ly.missing_entries(expected, F.col("labels")).alias("m")).collect()] == [{}, {"a": "1"}, {"a": "1"}]
    assert [r["m"] for r in df.select(sn.has_labels(F.col("labels"), expected).alias("m")).collect()] == [True, False, False]


def test_check_results(spark):
    polls = [("a", 1, False, "m1", False), ("a", 2, True, "", False), ("b", 1, False, "m1", False), ("b", 2, False, "m2", True), ("c", 1, None, None, False), ("d", 1, False, "m", False), ("d", 2, None, "lost", False)]
    df = spark.createDataFrame(polls, "check_id string, poll int, passed boolean, message string, job_completed boolean")
    got = {r["check_id"]: (r["passed"], r["message"]) for r in sn.check_results(df).collect()}
    assert got == {"a": (True, ""), "b": (False, "m2 (job completed before assertion could pass)"), "c": (False, "Timed out waiting for assertion"), "d": (False, "m")}


def test_joined_messages_are_whole(spark):
    df = spark.range(0, 2500).selectExpr("'t' as test_id", "id as pod_no", "concat('m', id) as message")
    got = sn.join_messages(df, ["test_id"], "pod_no", size=1000, width=64).orderBy("chunk").collect()
    assert [r["n_messages"] for r in got] == [1000, 1000, 500]
    assert "; ".join(r["messages"] for r in got).split("; ") == [f"m{n}" for n in range(2500)]


def test_status_scan(spark):
    lines = [(1, 1, "NAME Error"), (1, 2, "pod-a 1/1 Running"), (1, 3, "pod-b 0/1 OOMKilled"), (1, 4, "pod-c Evicted"), (2, 1, "NAME"), (2, 2, "pod-x Running")]
    df = spark.createDataFrame(lines, "scan_id int, line_no int, line string")
    assert rows(sn.failed_status_scan(df)) == [("pod-b", 1)]


# ---- documents ----

def merged(spark, pairs):
    df = spark.createDataFrame([(n, json.dumps(b), json.dumps(o)) for n, (b, o) in enumerate(pairs)], "n int, b string, o string")
    return [json.loads(r["m"]) for r in df.select("n", docs.merge_documents(F.col("b"), F.col("o")).alias("m")).orderBy("n").collect()]


def test_document_merge(spark):
    pairs = [({"a": 1}, None), (None, {"a": 1}), ({"a": {"x": 1}}, {"a": {"y": 2}}), ({"a": {"x": 1}}, {"a": 5}), ({"a": [1, 2]}, {"a": [3]}), ({"a": 1}, {"a": None, "b": None}),
             ({"spec": {"containers": [{"name": "m", "i": 1}, {"name": "s"}, 7]}}, {"spec": {"containers": [{"name": "m", "i": 2}]}}),
             ({"spec": {"x": {"containers": [{"name": "m"}]}}}, {"spec": {"x": {"containers": [{"name": "n"}]}}})]
    assert merged(spark, pairs) == [{"a": 1}, {"a": 1}, {"a": {"x": 1, "y": 2}}, {"a": 5}, {"a": [3]}, {"a": 1, "b": None},
                                    {"spec": {"containers": [{"name": "s"}, 7, {"name": "m", "i": 2}]}}, {"spec": {"x": {"containers": [{"name": "n"}]}}}]


LEAF = st.one_of(st.none(), st.integers(0, 3), st.text("ab", max_size=2))
ITEM = st.one_of(st.fixed_dictionaries({"name": st.sampled_from(["m", "n", "o"]), "v": st.integers(0, 2)}), st.integers(0, 2))
INNER = st.recursive(LEAF, lambda c: st.one_of(st.lists(LEAF, max_size=2), st.dictionaries(st.sampled_from("abc"), c, max_size=3)), max_leaves=6)
DOC = st.fixed_dictionaries({}, optional={"a": INNER, "b": INNER, "spec": st.one_of(
    LEAF, st.fixed_dictionaries({}, optional={"volumes": st.one_of(LEAF, st.lists(ITEM, max_size=3), st.just({})), "containers": st.lists(ITEM, max_size=3), "a": INNER}))})


def test_node_merge_equals_document_merge(spark):
    """Random documents: the join form and the text form give the same nodes."""
    @settings(max_examples=300, deadline=None, database=None)
    @given(st.lists(st.tuples(DOC, DOC), min_size=5, max_size=5))
    def collect(batch):
        pairs.extend(batch)

    pairs = []
    collect()
    df = spark.createDataFrame([(n, json.dumps(b), json.dumps(o)) for n, (b, o) in enumerate(pairs)], "doc_id long, b string, o string").cache()
    base, over = docs.flatten_documents(df, "b").cache(), docs.flatten_documents(df, "o").cache()

    def plain(nodes, order):
        """Node rows with the items of an array numbered in `order`."""
        found = {}
        for r in sorted(nodes.collect(), key=lambda r: tuple(r[c] if r[c] is not None else -1 for c in order)):
            key = (r["doc_id"], tuple(r["path"]), r["kind"] == "item")
            found.setdefault(key, []).append((r["kind"], r["value"]))
        return found

    joined = plain(docs.merge_nodes(base, over), ["layer", "pos"])
    text = df.select("doc_id", docs.merge_documents(F.col("b"), F.col("o")).alias("doc"))
    assert joined == plain(docs.flatten_documents(text), ["pos"])


@given(DOC, DOC, DOC)
@settings(max_examples=200, deadline=None, database=None)
def test_merge_properties(a, b, c):
    assert docs.merge_values(a, None) == a
    assert docs.merge_values(None, a) == a
    assert docs.merge_values(a, {}) == a


OBJECTS = st.recursive(st.integers(0, 3), lambda c: st.dictionaries(st.sampled_from("abc"), c, min_size=1, max_size=3), max_leaves=6).filter(lambda x: isinstance(x, dict))


def same_shape(a, b):
    return all(isinstance(a[k], dict) == isinstance(b[k], dict) and (not isinstance(a[k], dict) or same_shape(a[k], b[k])) for k in a.keys() & b.keys())


@given(OBJECTS, OBJECTS, OBJECTS)
@settings(max_examples=200, deadline=None, database=None)
def test_merge_is_associative_without_clashes(a, b, c):
    if same_shape(a, b) and same_shape(b, c) and same_shape(a, c):
        m = docs.merge_values
        assert m(m(a, b), c) == m(a, m(b, c))


def test_typed_settings(spark):
    rows_in = [(1, 1, "allocation.batchSize", "5"), (1, 2, "allocation.batchSize", " 7 "), (1, 3, "killGracePeriod", "2s"), (1, 4, "driver.watchEnabled", "False"),
               (2, 1, "allocation.batchSize", "0"), (2, 2, "killGracePeriod", "soon"), (2, 3, "dashboardUrl", "ftp://x"), (2, 4, "scheduling.priority", "-1"),
               (2, 5, "runAsUser", "me"), (2, 6, "driver.watchTimeout", "0"), (3, 1, "unrelated", "x")]
    df = spark.createDataFrame(rows_in, "app_id int, pos int, key string, value string")
    got = {(r["app_id"], r["key"]): (r["number"], r["valid"], r["given"]) for r in ly.typed_settings(df, SETTINGS).collect()}
    assert len(got) == 3 * len(SETTINGS)
    assert got[1, "allocation.batchSize"] == (7.0, True, True) and got[1, "killGracePeriod"] == (2000.0, True, True)
    assert got[1, "driver.watchEnabled"] == (0.0, True, True) and got[1, "scheduling.priority"] == (None, True, False)
    assert [got[2, k][1] for k in ("allocation.batchSize", "killGracePeriod", "dashboardUrl", "scheduling.priority", "runAsUser", "driver.watchTimeout")] == [
        False, False, False, False, False, True]
    assert got[3, "allocation.batchSize"] == (10.0, True, False) and got[3, "executor.connectionTimeout"] == (300.0, True, False)


def test_each_check_of_a_setting(spark):
    cases = [("scheduling.priority", "NaN", False), ("scheduling.priority", "0.0", True), ("allocation.batchSize", "3000000000", False),
             ("runAsUser", "3000000000", True), ("scheduling.initialPriorityClass", "", False), ("scheduling.initialPriorityClass", "http", True),
             ("scheduling.nodeUniformity", "", True), ("scheduling.nodeUniformity", "example.com/zone", True), ("scheduling.nodeUniformity", "-x", False),
             ("pod.labels", "a=b,c=d", True), ("pod.labels", "a=has blank", False), ("driver.ingress.annotations", "a=has blank", True),
             ("driver.ingress.annotations", "blank key=x", False), ("jobTemplate", "", False), ("jobTemplate", "FILE:///x", True), ("jobTemplate", "ftp://x", False),
             ("jobTemplate", "conf/x.yaml", True), ("oauth.proxy.port", "0", False), ("oauth.proxy.port", "8080", True), ("dashboardUrl", "https://h", True), ("dashboardUrl", "", False)]
    df = spark.createDataFrame([(n, 1, k, v) for n, (k, v, _) in enumerate(cases)], "app_id int, pos int, key string, value string")
    got = {(r["app_id"], r["key"]): r["valid"] for r in ly.typed_settings(df, SETTINGS).collect()}
    assert [(c, got[n, c[0]]) for n, c in enumerate(cases) if got[n, c[0]] != c[2]] == []
    assert got[0, "oauth.proxy.port"] is True


def test_settings_are_evaluated_on_their_own_rows(spark):
    """Each owner has every setting once; texts of equal form under other settings keep their own rule; nothing is parsed per owner and setting."""
    df = spark.createDataFrame([(1, n, k, v) for n, (k, v) in enumerate([("killGracePeriod", "5"), ("health.checkTimeout", "5"), ("runAsUser", "5"), ("other", "5"),
                               ("runAsUser", None)])] + [(2, 1, None, None), (None, 1, "runAsUser", "7")], "app_id int, pos int, key string, value string")
    out = ly.typed_settings(df, SETTINGS)
    got = {(r["app_id"], r["key"]): r for r in out.collect()}
    assert out.count() == len(got) == 3 * len(SETTINGS)
    assert [got[1, k]["number"] for k in ("killGracePeriod", "health.checkTimeout", "runAsUser")] == [5.0, 5.0, 5.0]
    assert not any(r["given"] for (app, _), r in got.items() if app == 2) and got[2, "killGracePeriod"]["number"] == 5000.0
    assert got[None, "runAsUser"]["number"] == 7.0 and out.columns == ["app_id", "key", "given", "text", "number", "valid"]
    assert ly.typed_settings(df.limit(0), SETTINGS).count() == 0


def test_proxy_port_has_its_own_default(spark):
    df = spark.createDataFrame([(True, None, None), (True, 4280, 4050), (True, None, 4050), (False, 4280, None), (None, 4280, 4050)], "e boolean, p int, u int")
    assert [r["x"] for r in df.select(ly.ui_port(F.col("e"), F.col("p"), F.col("u")).alias("x")).collect()] == [4180, 4280, 4180, 4040, 4050]


def test_capture_needs_a_configured_label(spark):
    df = spark.createDataFrame([(1, 1, "zone", "a", "zone"), (2, 1, "zone", "a", ""), (3, 1, "zone", "a", None)], "app_id int, message_id int, label string, value string, u string")
    assert [r["app_id"] for r in ly.first_capture(df, configured=F.col("u")).collect()] == [1]
    assert ly.first_capture(df).count() == 3


def test_resolved_resources(spark):
    schema = "app_id int, " + ", ".join(f"{layer}_{role}_{r}_{b} string" for layer in ("cli", "tpl") for role in ("driver", "executor") for r in ("memory", "cpu") for b in ("limit", "request"))
    data = [(1, "4Gi", None, None, "2", *[None] * 4, "1Mi", "2Mi", None, None, *["t"] * 4)]
    got = {r["role"]: r for r in ly.resolve_resources(spark.createDataFrame(data, schema)).collect()}
    assert [got["driver"][c] for c in ("memory_limit", "memory_request", "cpu_limit", "cpu_request")] == ["4Gi", "2Mi", "1", "2"]
    assert [got["executor"][c] for c in ("memory_limit", "cpu_request")] == ["t", "t"]
    maps = spark.createDataFrame([({"memory": "2Gi", "gpu": "1"},), (None,)], "m map<string,string>")
    out = [r["r"] for r in maps.select(ly.resolved_resources(F.col("m"), F.lit(None).cast("string"), F.lit("3")).alias("r")).collect()]
    assert out == [{"memory": "2Gi", "cpu": "3", "gpu": "1"}, {"memory": "1Gi", "cpu": "3"}]


def test_rules_list_every_violation(spark):
    data = [(1, "", None, None, 1, 2, "", None, ""), (2, None, "d", None, 0, 1, "q", None, None), (3, "i", None, None, 0, 0, None, "q", "j")]
    df = spark.createDataFrame(data, "app_id int, cli_image string, driver_image string, executor_image string, executor_ingresses int, driver_ingresses int, cli_queue string, tpl_queue string, cli_job_set string")
    got = {}
    for r in ly.required_rules(df).collect():
        got.setdefault(r["app_id"], []).append(r["rule_no"])
    assert {k: sorted(v) for k, v in got.items()} == {1: [1, 3, 4, 5, 6], 2: [2]}
