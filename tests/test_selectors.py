"""Selectors against label maps, by brute force."""

import random

import pytest

from runlens.operators import selectors as sl


def brute(rows, selectors):
    return sorted((r[0], s[0]) for r in rows for s in selectors
                  if all(v is not None and (r[1] or {}).get(k) == v for k, v in (s[1] or {}).items()))


@pytest.mark.parametrize(("part_rows", "hot_rows"), [(100_000, 1_000_000), (7, 20)])
def test_select_many_equals_brute_force(spark, part_rows, hot_rows):
    rng = random.Random(part_rows)
    keys = ["role", "app", "zone", "a=b", ""]

    def some(n):
        return {k: rng.choice(["x", "y", "z", "", "1:q"]) for k in rng.sample(keys, n)}

    rows = [(n, {**some(rng.randint(0, 4)), "hot": "yes"} if n % 3 else None if n % 7 == 0 else some(2)) for n in range(200)]
    rows += [(500, {"role": None, "app": "x"}), (500, {"role": None, "app": "x"}), (501, {})]
    selectors = [(f"s{n}", some(rng.randint(0, 3))) for n in range(120)] + [("hot", {"hot": "yes"}), ("none", None), ("empty", {}), ("null", {"role": None}),
                                                                              ("absent", {"role": "x", "never": "there"}), ("hot2", {"hot": "yes", "role": "x"})]
    out = sl.select_many(spark.createDataFrame(rows, "n long, labels map<string,string>"), spark.createDataFrame(selectors, "selector_id string, selector map<string,string>"),
                         part_rows=part_rows, hot_rows=hot_rows)
    assert sorted((r["n"], r["selector_id"]) for r in out.collect()) == brute(rows, selectors)


def test_no_selectors_or_rows(spark):
    rows, selectors = spark.createDataFrame([(1, {"a": "b"})], "n long, labels map<string,string>"), spark.createDataFrame([("s", {"a": "b"})], "selector_id string, selector map<string,string>")
    assert sl.select_many(rows, selectors.limit(0)).collect() == [] and sl.select_many(rows.limit(0), selectors).collect() == []


def test_hundred_thousand_selectors(spark):
    """Candidates stay near the results: each selector meets the rows of its rarest entry only."""
    from pyspark.sql import functions as F

    rows = spark.range(5000).select("id", F.create_map(F.lit("app"), (F.col("id") % 2500).cast("string"), F.lit("role"), F.lit("executor")).alias("labels"))
    many = spark.range(100_000).select(F.col("id").cast("string").alias("selector_id"),
                                       F.create_map(F.lit("role"), F.lit("executor"), F.lit("app"), (F.col("id") % 5000).cast("string")).alias("selector"))
    found = sl.select_many(rows, many, part_rows=1000, hot_rows=1000)
    assert found.count() == 100_000  # half of the selectors name an app that exists, two rows each


ROWS, SELECTORS = "n long, labels map<string,string>", "selector_id string, selector map<string,string>"


# as for a larger table: most selectors look up an entry that is not common, and those are not few
LIMITS = {"common_entries": 40, "sent_rows": 500}


def some_rows():
    return [(n, {"role": "xy"[n % 2], "app": str(n % 40), "zone": None if n % 5 else "z"}) for n in range(200)]


@pytest.mark.parametrize(("common_entries", "sent_rows"), [(1000, 10_000), (1000, 0), (2, 10_000), (2, 0), (0, 0)])
def test_selectors_that_share_an_id(spark, common_entries, sent_rows):
    """Each finds its own rows, whichever way its entry is looked up."""
    selectors = [("one", {"app": "7"}), ("one", {"app": "8", "role": "x"}), ("one", {"role": "y"}), ("one", {"zone": "z", "role": "x"}), ("one", {"zone": "z", "never": "there"}),
                 ("two", {"app": "9", "zone": None}), ("two", {}), ("two", None)]
    out = sl.select_many(spark.createDataFrame(some_rows(), ROWS), spark.createDataFrame(selectors, SELECTORS), part_rows=30, hot_rows=1000, common_entries=common_entries, sent_rows=sent_rows)
    assert sorted((r["n"], r["selector_id"]) for r in out.collect()) == brute(some_rows(), selectors)


@pytest.mark.parametrize("sent_rows", [10_000, 0])
def test_entries_that_share_a_hash(spark, monkeypatch, sent_rows):
    """The hash of an entry only chooses rows to compare."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(sl, "_entries", lambda labels, of_null: F.transform(
        F.map_entries(labels), lambda e: F.when(e["value"].isNull(), of_null).otherwise(F.length(e["key"]).cast("long"))))
    selectors = [("a", {"app": "7"}), ("b", {"role": "x", "zone": "z"}), ("c", {"role": "x", "app": "8"}), ("d", {}), ("e", {"disk": "x"})]
    out = sl.select_many(spark.createDataFrame(some_rows(), ROWS), spark.createDataFrame(selectors, SELECTORS), common_entries=1, sent_rows=sent_rows)
    assert sorted((r["n"], r["selector_id"]) for r in out.collect()) == brute(some_rows(), selectors)


def test_only_what_is_asked_for_is_moved(spark, monkeypatch):
    """Columns nobody reads stay out of the join, and no side of unknown size is sent."""
    from functools import partial

    from conftest import SF
    from runlens.plans import runner

    monkeypatch.setattr(sl, "select_many", partial(sl.select_many, **LIMITS))
    plan = runner("label_select_many")(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "zone-" not in plan
    assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") == 1  # the selectors of nations and regions


def test_one_entry_left_asks_for_no_count(spark, monkeypatch):
    """Selectors of one entry besides common ones are not taken apart."""
    kept = {}
    write = sl.written
    monkeypatch.setattr(sl, "written", lambda df, name: kept.setdefault(name, write(df, name)))
    rows = [(n, {"role": "x", "app": str(n)}) for n in range(100)]
    selectors = [(f"s{n}", {"role": "x", "app": str(n)}) for n in range(100)] + [("two", {"app": "1", "none": "2"})]
    out = sl.select_many(spark.createDataFrame(rows, ROWS), spark.createDataFrame(selectors, SELECTORS), common_entries=2)
    assert out.count() == 100
    assert kept["selectors"].filter("_n > 1").count() == 1 and kept["settled-selectors"].count() == 0
