"""Documents by VARIANT against the text forms."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from runlens.operators import documents as docs
from runlens.operators import variants as va
from runlens.plans import QUERIES
from runlens.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def value(rng, depth):
    kind = rng.randrange(6 if depth else 3)
    if kind == 0:
        return rng.choice([None, True, 7, -12345678901234567890, 0.25, "", "é \"q\" \\ \n", "12"])
    if kind == 1:
        return rng.randrange(4)
    if kind == 2:
        return [rng.choice([1, None, "x", {"name": "n"}, []]) for _ in range(rng.randrange(3))]
    return {rng.choice(["a", "b", "name", "é \"k\"", "x.y"]): value(rng, depth - 1) for _ in range(rng.randrange(4))}


def document(rng):
    item = lambda: rng.choice([{"name": rng.choice(["m", "n", 3, None, True, {"q": 1}, [1]]), "v": rng.randrange(3)}, 5, None, "s", {"w": 1}])
    spec = {k: [item() for _ in range(rng.randrange(4))] for k in ("volumes", "containers", "initContainers") if rng.random() < 0.5}
    return rng.choice([value(rng, 4), {"spec": {**spec, "a": value(rng, 3)}, "b": value(rng, 2)}, {"spec": value(rng, 3)}])


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(11)
    data = [(n, json.dumps(document(rng)), json.dumps(document(rng))) for n in range(250)] + [(900, None, "{}"), (901, "{}", None)]
    return spark.createDataFrame(data, "doc_id long, b string, o string"), data


def test_flatten_gives_the_same_nodes(pairs):
    df, _ = pairs
    assert rows(va.flatten(df, "b")) == rows(docs.flatten_documents(df, "b")) != []


@pytest.mark.parametrize("levels", [1, 2, 9])
def test_levels_of_a_pass_do_not_matter(pairs, levels):
    df, _ = pairs
    assert rows(va.flatten(df, "o", levels=levels)) == rows(docs.flatten_documents(df, "o"))


def test_rebuild_gives_the_documents(pairs):
    df, data = pairs
    got = {r["doc_id"]: r["doc"] for r in va.rebuild(va.flatten(df, "b")).collect()}
    assert got == {n: docs.compact(json.loads(b)) for n, b, _ in data if b is not None}


def test_merged_and_rebuilt_equals_the_text_merge(pairs):
    df, data = pairs
    merged = docs.merge_nodes(va.flatten(df, "b"), va.flatten(df, "o"))
    got = {r["doc_id"]: r["doc"] for r in va.rebuild(merged).collect()}
    assert got == {n: docs.compact(docs.merge_values(None if b is None else json.loads(b), None if o is None else json.loads(o))) for n, b, o in data}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, doc string")
    assert va.flatten(none).collect() == [] and va.rebuild(va.flatten(none)).collect() == []


def test_the_registered_merge_runs_no_python(spark):
    plan = entry.queries()["deep_merge"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_merge_and_flatten_in_one_pass(spark):
    """The same nodes as those of the merged texts, with one Python step in the plan instead of two."""
    texts = [(1, '{"a":{"b":[1,{"z":1,"y":2}]},"spec":{"volumes":[{"name":"v"},{"name":"w"}]}}', '{"a":null,"spec":{"volumes":[{"name":"v","k":1}]}}'),
             (2, None, '{"a":"\u00e9"}'), (3, '[1]', None), (4, None, None), (5, '{"a":{"b":1}}', '{"a":[]}')]
    pairs = spark.createDataFrame(texts, "doc_id int, base string, over string")
    one = docs.merged_nodes(pairs, F.col("base"), F.col("over"))
    two = docs.flatten_documents(pairs.select("doc_id", docs.merge_documents(F.col("base"), F.col("over")).alias("doc")))
    assert rows(one) == rows(two) != []
    steps = str(QUERIES["deep_merge_documents"](Tables(spark, SF))._jdf.queryExecution().optimizedPlan())
    assert steps.count("MapInArrow") == 1 and "ArrowEvalPython" not in steps


def test_rebuild_writes_several_levels_at_once(spark, monkeypatch):
    """One table of node texts and one per `LEVELS` levels, instead of two and one per level."""
    names, real = [], va.written
    monkeypatch.setattr(va, "written", lambda df, name, path=None: names.append(name) or real(df, name, path))
    deep = '{"x":' * 8 + '{"a":[1],"b":{}}' + "}" * 8
    texts = [(1, '{"metadata":{"labels":{"a":null}},"spec":{"containers":[{"name":"m"}],"volumes":[]}}'), (2, deep), (3, "{}"), (4, "7")]
    nodes = docs.flatten_documents(spark.createDataFrame(texts, "doc_id int, doc string"))
    assert rows(va.rebuild(nodes)) == sorted(((t, i) for i, t in texts), key=repr)
    assert names == ["node-texts", "texts-of-level"]


@pytest.mark.parametrize("name", ["deep_merge", "deep_merge_rebuilt"])
def test_no_join_of_nodes_builds_a_hash_table(spark, monkeypatch, name):
    """Files of nodes are a hundredth of their rows: joins planned by that size sent gigabytes through the driver."""
    plans, real = [], va.written

    def planned(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *rest)

    monkeypatch.setattr(va, "written", planned)
    monkeypatch.setattr(docs, "written", planned)
    planned(QUERIES[name](Tables(spark, SF)), "result")
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4
    assert not [p for p in plans if "Broadcast" in p or "ShuffledHashJoin" in p]


def test_objects_come_once_from_their_first_leaf(spark):
    """Also empty ones, and where a pass ends between an object and its members."""
    texts = [(1, '{"b":{"c":{"d":{}},"a":[],"n":null},"a":{"x":{"y":1},"z":{}}}'), (2, "{}"), (3, "null"), (4, "[{}]"),
             (5, '{"spec":{"containers":[],"volumes":[{"name":"v"},null,1]}}'), (6, '{"spec":{"volumes":{"spec":{"volumes":[1]}}}}')]
    df = spark.createDataFrame(texts, "doc_id int, doc string")
    for levels in (1, 2, 3, 4):
        assert rows(va.flatten(df, levels=levels)) == rows(docs.flatten_documents(df)) != []
