"""Decision-support workload over the star schema, one query per published query shape.

Returned lines have `l_returnflag = 'R'`; the channel of a line follows from the priority of its
order; the date of a line is its ship date. Shapes that are written as self joins, set operations
or crossed one-row subqueries in SQL are expressed as one grouped pass wherever that is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlens.plans.registry import query
from runlens.session import written

RETURNED = "l_returnflag = 'R'"

CHANNEL_SQL = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'store'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'catalog' ELSE 'web' END"""

_SALES = f"""sales AS (
  SELECT l.*, o.*, {CHANNEL_SQL} AS channel, year(l_shipdate) AS y, month(l_shipdate) AS m
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey)"""


def channel() -> Column:
    p = F.col("o_orderpriority")
    return F.when(p.isin("1-URGENT", "2-HIGH"), "store").when(p == "3-MEDIUM", "catalog").otherwise("web")


def years(column: str, first: int, last: int | None = None) -> Column:
    """Whole years as a range on the raw column, so that the filter reaches the scan."""
    c = F.col(column)
    return (c >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (
        c < F.lit(f"{(last or first) + 1}-01-01").cast("timestamp_ntz"))


def amount(column: Column) -> Column:
    """Exact sum of finite amounts of at most six digits after the point: it does not depend on the order in which rows and partial sums meet."""
    return F.sum(column.cast("decimal(28,6)"))


def money(column: Column, digits: int = 2) -> Column:
    return F.round(amount(column), digits).cast("double")


def sales(t, lines: DataFrame | None = None, line_cols: list[str] | None = None) -> DataFrame:
    """Lines with channel and customer of their order."""
    lines = t["lineitem"] if lines is None else lines
    if line_cols:
        lines = lines.select("l_orderkey", *line_cols)
    heads = t["orders"].select("o_orderkey", "o_custkey", channel().alias("channel"), "o_orderdate")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))


TASK_BYTES = 16 << 20


def task_count(table: DataFrame) -> int:
    """Tasks for a table, one per core at least and per `TASK_BYTES` of its files. Its size is the planner's estimate, no job."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def year() -> Column:
    return F.year("l_shipdate").cast("long")


def month() -> Column:
    return F.month("l_shipdate").cast("long")


def count() -> Column:
    return F.count(F.lit(1))


@query("w01_star_top_groups", """
SELECT year(l_shipdate) AS year, p_brand, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type = 'PROMO' AND month(l_shipdate) = 11
GROUP BY ALL ORDER BY year, revenue DESC, p_brand LIMIT 100""")
def w01(t):
    return star_top_groups(t, t["lineitem"].filter(F.month("l_shipdate") == 11))


def star_top_groups(t, lines: DataFrame) -> DataFrame:
    part = t["part"].filter("p_type = 'PROMO'").select("p_partkey", "p_brand")
    return (lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(year().alias("year"), "p_brand")
            .agg(money(F.col("l_extendedprice")).alias("revenue"), count().alias("n_lines"))
            .orderBy("year", F.desc("revenue"), "p_brand").limit(100))


@query("w02_above_group_average", f"""WITH {_SALES},
returned AS (SELECT o_custkey, round(sum(l_extendedprice), 2) AS total FROM sales
  WHERE l_returnflag = 'R' AND y = 1998 GROUP BY o_custkey),
named AS (SELECT * FROM returned JOIN customer ON c_custkey = o_custkey)
SELECT a.c_custkey, a.c_nationkey, a.total FROM named a
WHERE a.total > 1.2 * (SELECT round(sum(b.total), 2) / count(*) FROM named b WHERE b.c_nationkey = a.c_nationkey)""")
def w02(t):
    lines = t["lineitem"].filter(F.expr(RETURNED) & years("l_shipdate", 1998))
    totals = sales(t, lines, ["l_extendedprice"]).groupBy("o_custkey").agg(
        money(F.col("l_extendedprice")).alias("total"))
    # read for the averages and for the customers above them
    named = written(totals.join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")), "totals")
    average = named.groupBy("c_nationkey").agg((money(F.col("total")) / count()).alias("average"))
    return (named.join(average, "c_nationkey").filter(F.col("total") > 1.2 * F.col("average"))
            .select("c_custkey", "c_nationkey", "total"))


@query("w03_year_over_year", f"""WITH {_SALES},
yearly AS (SELECT o_custkey, channel, y, round(sum(l_extendedprice), 2) AS total FROM sales
  WHERE y IN (1997, 1998) AND channel IN ('store', 'web') GROUP BY ALL)
SELECT s1.o_custkey, s1.total AS store_first, s2.total AS store_second, w1.total AS web_first, w2.total AS web_second
FROM yearly s1 JOIN yearly s2 USING (o_custkey) JOIN yearly w1 USING (o_custkey) JOIN yearly w2 USING (o_custkey)
WHERE s1.channel = 'store' AND s1.y = 1997 AND s2.channel = 'store' AND s2.y = 1998
  AND w1.channel = 'web' AND w1.y = 1997 AND w2.channel = 'web' AND w2.y = 1998
  AND w2.total / w1.total > s2.total / s1.total""")
def w03(t):
    lines = t["lineitem"].filter(years("l_shipdate", 1997, 1998))
    cells = {"store_first": ("store", 1997), "store_second": ("store", 1998),
             "web_first": ("web", 1997), "web_second": ("web", 1998)}
    per_customer = sales(t, lines, ["l_extendedprice", "l_shipdate"]).filter("channel <> 'catalog'").groupBy(
        "o_custkey").agg(*[
            money(F.when((F.col("channel") == c) & (year() == y), F.col("l_extendedprice"))).alias(name)
            for name, (c, y) in cells.items()])
    grown = F.col("web_second") / F.col("web_first") > F.col("store_second") / F.col("store_first")
    return per_customer.dropna(subset=list(cells)).filter(grown)


@query("w04_channel_rollup", f"""WITH {_SALES},
rows AS (SELECT channel, n_name, l_extendedprice AS sold, 0 AS returned FROM sales
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_returnflag <> 'R'
  UNION ALL SELECT channel, n_name, 0, l_extendedprice FROM sales
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_returnflag = 'R')
SELECT coalesce(channel, 'ALL') AS channel, coalesce(n_name, 'ALL') AS nation,
  round(sum(sold), 2) AS sold, round(sum(returned), 2) AS returned
FROM rows GROUP BY ROLLUP (channel, n_name)""")
def w04(t):
    s = sales(t, line_cols=["l_suppkey", "l_extendedprice", "l_returnflag"])
    returned = F.expr(RETURNED)
    supplier = t["supplier"].select("s_suppkey", "s_nationkey")
    # totals per cell first; names are joined to, and the rollup expands, a few rows instead of every line
    cells = s.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("channel", "s_nationkey").agg(
        amount(F.when(~returned, F.col("l_extendedprice")).otherwise(0.0)).alias("sold"),
        amount(F.when(returned, F.col("l_extendedprice")).otherwise(0.0)).alias("returned"))
    named = cells.join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    return named.rollup("channel", "n_name").agg(
        money(F.col("sold")).alias("sold"), money(F.col("returned")).alias("returned")).select(
        F.coalesce("channel", F.lit("ALL")).alias("channel"), F.coalesce("n_name", F.lit("ALL")).alias("nation"),
        "sold", "returned")


def _channels_of_customers(t, first: int, last: int | None = None) -> DataFrame:
    """One row per customer with a flag per channel: set operations between channels become filters.

    Orders and channels do not need the lines, except for their dates; the lines are reduced to
    one row per order on the map side before anything is joined.
    """
    shipped = t["lineitem"].filter(years("l_shipdate", first, last)).select("l_orderkey").distinct()
    heads = t["orders"].select("o_orderkey", "o_custkey", channel().alias("channel"))
    bought = heads.join(shipped, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return bought.groupBy("o_custkey").agg(*[
        F.max(F.col("channel") == c).alias(c) for c in ("store", "catalog", "web")])


@query("w05_channel_intersect", f"""WITH {_SALES}, buyers AS (
  SELECT o_custkey FROM sales WHERE channel = 'store' AND y = 1999
  INTERSECT SELECT o_custkey FROM sales WHERE channel = 'catalog' AND y = 1999
  INTERSECT SELECT o_custkey FROM sales WHERE channel = 'web' AND y = 1999)
SELECT c_nationkey, count(*) AS n_customers FROM buyers JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey""")
def w05(t):
    buyers = _channels_of_customers(t, 1999).filter("store and catalog and web")
    return (t["customer"].join(buyers, F.col("c_custkey") == F.col("o_custkey"))
            .groupBy("c_nationkey").agg(count().alias("n_customers")))


@query("w06_channel_except", f"""WITH {_SALES}
SELECT count(*) AS n_customers FROM (
  SELECT o_custkey FROM sales WHERE channel = 'store' AND y = 2000
  EXCEPT SELECT o_custkey FROM sales WHERE channel = 'catalog' AND y = 2000
  EXCEPT SELECT o_custkey FROM sales WHERE channel = 'web' AND y = 2000)""")
def w06(t):
    return _channels_of_customers(t, 2000).filter("store and not catalog and not web").agg(
        count().alias("n_customers"))


_QTY_BUCKETS = [(1, 10), (11, 20), (21, 30), (31, 40), (41, 50)]


@query("w07_case_buckets", "SELECT " + ", ".join(f"""
  CASE WHEN (SELECT count(*) FROM lineitem WHERE l_quantity BETWEEN {lo} AND {hi}) > 12000
    THEN (SELECT round(sum(l_extendedprice), 2) / count(*) FROM lineitem WHERE l_quantity BETWEEN {lo} AND {hi})
    ELSE (SELECT round(sum(l_tax), 2) / count(*) FROM lineitem WHERE l_quantity BETWEEN {lo} AND {hi}) END AS bucket_{i}"""
                                                for i, (lo, hi) in enumerate(_QTY_BUCKETS, 1)))
def w07(t):
    aggs = []
    for i, (lo, hi) in enumerate(_QTY_BUCKETS, 1):
        inside = F.col("l_quantity").between(lo, hi)
        n = F.count_if(inside)
        price, tax = (money(F.when(inside, F.col(c))) for c in ("l_extendedprice", "l_tax"))
        aggs.append(F.when(n > 12000, price / n).otherwise(tax / n).alias(f"bucket_{i}"))
    return t["lineitem"].agg(*aggs)


@query("w08_bucket_statistics", "SELECT " + ", ".join(f"""
  max(CASE WHEN b = {i} THEN mean END) AS mean_{i}, max(CASE WHEN b = {i} THEN n END) AS n_{i},
  max(CASE WHEN b = {i} THEN nd END) AS distinct_{i}""" for i in range(5)) + """
FROM (SELECT CAST(l_quantity - 1 AS INTEGER) // 10 AS b, round(sum(l_extendedprice), 2) / count(*) AS mean, count(*) AS n,
  count(DISTINCT l_partkey) AS nd FROM lineitem WHERE l_discount >= 0.05 GROUP BY 1)""")
def w08(t):
    bucket = F.expr("cast(l_quantity - 1 as int) div 10")
    stats = t["lineitem"].filter("l_discount >= 0.05").groupBy(bucket.alias("b")).agg(
        (money(F.col("l_extendedprice")) / count()).alias("mean"), count().alias("n"),
        F.countDistinct("l_partkey").alias("distinct"))
    return stats.agg(*[F.max(F.when(F.col("b") == i, F.col(c))).alias(f"{c}_{i}")
                       for i in range(5) for c in ("mean", "n", "distinct")])


@query("w09_exists_or", f"""WITH {_SALES}
SELECT c_mktsegment, c_nationkey, count(*) AS n_customers FROM customer c
WHERE EXISTS (SELECT 1 FROM sales WHERE o_custkey = c_custkey AND channel = 'store' AND y = 1998)
  AND (EXISTS (SELECT 1 FROM sales WHERE o_custkey = c_custkey AND channel = 'web' AND y = 1998)
    OR EXISTS (SELECT 1 FROM sales WHERE o_custkey = c_custkey AND channel = 'catalog' AND y = 1998))
GROUP BY ALL""")
def w09(t):
    buyers = _channels_of_customers(t, 1998).filter("store and (web or catalog)")
    return (t["customer"].join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
            .groupBy("c_mktsegment", "c_nationkey").agg(count().alias("n_customers")))


@query("w10_exists_not_exists", """
SELECT count(DISTINCT l_orderkey) AS n_orders, round(sum(l_extendedprice), 2) AS total FROM lineitem a
WHERE EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_suppkey <> a.l_suppkey)
  AND NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_orderkey = a.l_orderkey AND r.l_returnflag = 'R')""")
def w10(t):
    per_order = t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"),
        F.coalesce(F.max(F.expr(RETURNED)), F.lit(False)).alias("returned"), amount(F.col("l_extendedprice")).alias("total"))
    return per_order.filter("lo <> hi and not returned").agg(
        count().alias("n_orders"), money(F.col("total")).alias("total"))


@query("w11_in_subquery_union", f"""WITH {_SALES},
brands AS (SELECT p_brand FROM part WHERE p_type = 'ECONOMY' AND p_size > 48),
per_channel AS (SELECT channel, p_brand, sum(l_extendedprice) AS total FROM sales JOIN part ON p_partkey = l_partkey
  WHERE p_brand IN (SELECT p_brand FROM brands) AND y = 1997 GROUP BY ALL)
SELECT p_brand, round(sum(total), 2) AS total, count(*) AS n_channels FROM per_channel GROUP BY p_brand""")
def w11(t):
    part = t["part"].select("p_partkey", "p_brand")
    brands = t["part"].filter("p_type = 'ECONOMY' and p_size > 48").select("p_brand")
    wanted = part.join(brands, "p_brand", "left_semi")
    s = sales(t, t["lineitem"].filter(years("l_shipdate", 1997)), ["l_partkey", "l_extendedprice"])
    per_channel = s.join(wanted, F.col("l_partkey") == F.col("p_partkey")).groupBy("channel", "p_brand").agg(
        amount(F.col("l_extendedprice")).alias("total"))
    return per_channel.groupBy("p_brand").agg(money(F.col("total")).alias("total"), count().alias("n_channels"))


@query("w12_partition_share", """
SELECT p_type, p_brand, revenue, revenue * 100 / round(sum(revenue) OVER (PARTITION BY p_type), 2) AS share
FROM (SELECT p_type, p_brand, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE year(l_shipdate) = 1999 GROUP BY ALL)""")
def w12(t):
    return partition_share(t, t["lineitem"].filter(years("l_shipdate", 1999)))


def partition_share(t, lines: DataFrame) -> DataFrame:
    # one row per part reaches the join
    parts = lines.groupBy("l_partkey").agg(amount(F.col("l_extendedprice")).alias("price"))
    cells = parts.join(t["part"], F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type", "p_brand").agg(
        money(F.col("price")).alias("revenue"))
    whole = F.round(amount(F.col("revenue")).over(Window.partitionBy("p_type")), 2).cast("double")
    return cells.withColumn("share", F.col("revenue") * 100 / whole)


@query("w13_or_of_and_groups", """
SELECT count(*) AS n_lines, round(sum(l_quantity), 0) AS quantity, round(sum(l_extendedprice), 2) / count(*) AS mean_price
FROM lineitem, part WHERE l_partkey = p_partkey AND (
  (p_brand = 'Brand#12' AND p_size BETWEEN 1 AND 15 AND l_quantity BETWEEN 1 AND 11)
  OR (p_brand = 'Brand#23' AND p_size BETWEEN 1 AND 30 AND l_quantity BETWEEN 10 AND 30)
  OR (p_type = 'LARGE' AND p_size > 40 AND l_quantity > 45))""")
def w13(t):
    condition = """
      (p_brand = 'Brand#12' and p_size between 1 and 15 and l_quantity between 1 and 11)
      or (p_brand = 'Brand#23' and p_size between 1 and 30 and l_quantity between 10 and 30)
      or (p_type = 'LARGE' and p_size > 40 and l_quantity > 45)"""
    joined = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).filter(condition)
    return joined.agg(count().alias("n_lines"), money(F.col("l_quantity"), 0).alias("quantity"),
                      (money(F.col("l_extendedprice")) / count()).alias("mean_price"))


@query("w14_adjacent_months", """
WITH monthly AS (SELECT l_suppkey, month(l_shipdate) AS m, count(*) AS n, sum(l_quantity) / count(*) AS mean,
    round(stddev_samp(l_quantity), 4) AS deviation FROM lineitem WHERE year(l_shipdate) = 1999 GROUP BY ALL HAVING count(*) > 1)
SELECT a.l_suppkey, a.m AS month, a.mean, a.deviation, b.mean AS next_mean, b.deviation AS next_deviation
FROM monthly a JOIN monthly b ON a.l_suppkey = b.l_suppkey AND b.m = a.m + 1
WHERE a.deviation / a.mean > 0.5 AND b.deviation / b.mean > 0.5""")
def w14(t):
    monthly = t["lineitem"].filter(years("l_shipdate", 1999)).groupBy("l_suppkey", month().alias("month")).agg(
        count().alias("n"), (F.sum("l_quantity") / count()).alias("mean"),
        F.round(F.stddev_samp("l_quantity"), 4).alias("deviation")).filter("n > 1")
    # at most twelve rows per supplier: the next month is the next row
    w = Window.partitionBy("l_suppkey").orderBy("month")
    pairs = monthly.select(
        "l_suppkey", "month", "mean", "deviation", F.lead("month").over(w).alias("next_month"),
        F.lead("mean").over(w).alias("next_mean"), F.lead("deviation").over(w).alias("next_deviation"))
    return pairs.filter(
        (F.col("next_month") == F.col("month") + 1) & (F.col("deviation") / F.col("mean") > 0.5)
        & (F.col("next_deviation") / F.col("next_mean") > 0.5)).drop("next_month")


# first day, day of the change, day after the last
AROUND = ("1998-03-01", "1998-06-01", "1998-09-01")


@query("w15_before_after", """
SELECT * FROM (SELECT l_suppkey,
    round(sum(CASE WHEN l_shipdate < DATE '1998-06-01' THEN l_extendedprice ELSE 0 END), 2) AS before,
    round(sum(CASE WHEN l_shipdate >= DATE '1998-06-01' THEN l_extendedprice ELSE 0 END), 2) AS after
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
  WHERE l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-09-01' GROUP BY l_suppkey)
WHERE before > 0 AND after / before BETWEEN 2.0 / 3 AND 3.0 / 2""")
def w15(t):
    lo, _, hi = around()
    return before_after(t["lineitem"].filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi)))


def around() -> list[Column]:
    return [F.lit(day).cast("timestamp_ntz") for day in AROUND]


def before_after(lines: DataFrame) -> DataFrame:
    d, mid = F.col("l_shipdate"), around()[1]
    sums = lines.groupBy("l_suppkey").agg(
        money(F.when(d < mid, F.col("l_extendedprice")).otherwise(0.0)).alias("before"),
        money(F.when(d >= mid, F.col("l_extendedprice")).otherwise(0.0)).alias("after"))
    return sums.filter((F.col("before") > 0) & (F.col("after") / F.col("before")).between(2.0 / 3, 3.0 / 2))


@query("w16_rollup_averages", """
SELECT coalesce(r_name, 'ALL') AS region, coalesce(n_name, 'ALL') AS nation, coalesce(c_mktsegment, 'ALL') AS segment,
  sum(l_quantity) / count(*) AS mean_quantity, round(sum(l_extendedprice), 2) / count(*) AS mean_price, count(*) AS n_lines
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""")
def w16(t):
    heads = t["orders"].select("o_orderkey", "o_custkey").join(
        t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    lines = t["lineitem"].select("l_orderkey", "l_quantity", "l_extendedprice")
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    keys = ["r_name", "n_name", "c_mktsegment"]
    cells = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("c_nationkey", "c_mktsegment").agg(
        F.sum("l_quantity").alias("q"), amount(F.col("l_extendedprice")).alias("p"), count().alias("n")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey"))
    return cells.rollup(*keys).agg(
        (F.sum("q") / F.sum("n")).alias("mean_quantity"), (money(F.col("p")) / F.sum("n")).alias("mean_price"),
        F.sum("n").alias("n_lines")).select(
        *[F.coalesce(k, F.lit("ALL")).alias(a) for k, a in zip(keys, ("region", "nation", "segment"))],
        "mean_quantity", "mean_price", "n_lines")


@query("w17_rollup_rank", """
SELECT coalesce(p_type, 'ALL') AS p_type, coalesce(p_brand, 'ALL') AS p_brand, level, share,
  rank() OVER (PARTITION BY level, CASE WHEN level = 0 THEN p_type END ORDER BY share) AS place
FROM (SELECT p_type, p_brand, grouping(p_type) + grouping(p_brand) AS level,
  round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) / round(sum(l_extendedprice), 2) AS share
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ROLLUP (p_type, p_brand))""")
def w17(t):
    part = t["part"].select("p_partkey", "p_type", "p_brand")
    # one row per part reaches the join
    parts = t["lineitem"].groupBy("l_partkey").agg(
        amount(F.col("l_extendedprice")).alias("whole"),
        amount(F.when(F.expr(RETURNED), F.col("l_extendedprice")).otherwise(0.0)).alias("back"))
    cells = parts.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type", "p_brand").agg(
        F.sum("whole").alias("whole"), F.sum("back").alias("back"))
    shares = cells.rollup("p_type", "p_brand").agg(
        (F.grouping("p_type").cast("long") + F.grouping("p_brand").cast("long")).alias("level"),
        (money(F.col("back")) / money(F.col("whole"))).alias("share"))
    parent = F.when(F.col("level") == 0, F.col("p_type"))
    return shares.select(
        F.coalesce("p_type", F.lit("ALL")).alias("p_type"), F.coalesce("p_brand", F.lit("ALL")).alias("p_brand"),
        "level", "share",
        F.rank().over(Window.partitionBy("level", parent).orderBy("share")).cast("long").alias("place"))


@query("w18_rollup_top_ranks", """
SELECT * FROM (SELECT coalesce(p_type, 'ALL') AS p_type, coalesce(p_brand, 'ALL') AS p_brand, coalesce(l_partkey, -1) AS partkey, total,
    rank() OVER (PARTITION BY p_type ORDER BY total DESC) AS place
  FROM (SELECT p_type, p_brand, l_partkey, round(sum(l_extendedprice), 2) AS total
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ROLLUP (p_type, p_brand, l_partkey)))
WHERE place <= 100""")
def w18(t):
    part = t["part"].select("p_partkey", "p_type", "p_brand")
    per_part = t["lineitem"].groupBy("l_partkey").agg(amount(F.col("l_extendedprice")).alias("total"))
    cells = per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    totals = cells.rollup("p_type", "p_brand", "l_partkey").agg(money(F.col("total")).alias("total"))
    # the rank filter is applied per task before the shuffle (window group limit)
    place = F.rank().over(Window.partitionBy("p_type").orderBy(F.desc("total")))
    return totals.withColumn("place", place).filter("place <= 100").select(
        F.coalesce("p_type", F.lit("ALL")).alias("p_type"), F.coalesce("p_brand", F.lit("ALL")).alias("p_brand"),
        F.coalesce("l_partkey", F.lit(-1)).alias("partkey"), "total", F.col("place").cast("long").alias("place"))


@query("w19_having_join_back", """
SELECT o_orderkey, c_name, n_lines FROM (
  SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey HAVING count(*) BETWEEN 8 AND 12)
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""")
def w19(t):
    tickets = t["lineitem"].groupBy("l_orderkey").agg(count().alias("n_lines")).filter("n_lines between 8 and 12")
    return (tickets.join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t["customer"].select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_name", "n_lines"))


@query("w20_best_and_worst", """
WITH means AS (SELECT l_partkey, round(sum(l_extendedprice), 2) / count(*) AS mean FROM lineitem GROUP BY l_partkey)
SELECT b.place, b.l_partkey AS best, w.l_partkey AS worst
FROM (SELECT *, row_number() OVER (ORDER BY mean DESC, l_partkey) AS place FROM means) b
JOIN (SELECT *, row_number() OVER (ORDER BY mean, l_partkey) AS place FROM means) w ON b.place = w.place
WHERE b.place <= 10""")
def w20(t):
    means = t["lineitem"].groupBy("l_partkey").agg((money(F.col("l_extendedprice")) / count()).alias("mean"))

    def ranked(direction, name: str) -> DataFrame:
        # ten rows are left when the window runs
        top = means.orderBy(direction("mean"), "l_partkey").limit(10)
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(direction("mean"), "l_partkey"))
        return top.select(place.cast("long").alias("place"), F.col("l_partkey").alias(name))

    return ranked(F.desc, "best").join(ranked(F.asc, "worst"), "place")


@query("w21_deviation_and_neighbours", """
WITH monthly AS (SELECT p_brand, year(l_shipdate) AS year, month(l_shipdate) AS month, round(sum(l_extendedprice), 2) AS total
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
framed AS (SELECT *, round(sum(total) OVER (PARTITION BY p_brand, year), 2) / count(*) OVER (PARTITION BY p_brand, year) AS mean,
  coalesce(lag(total) OVER (PARTITION BY p_brand ORDER BY year, month), 0) AS previous,
  coalesce(lead(total) OVER (PARTITION BY p_brand ORDER BY year, month), 0) AS next FROM monthly)
SELECT * FROM framed WHERE year = 1999 AND abs(total - mean) / mean > 0.1""")
def w21(t):
    part = t["part"].select("p_partkey", "p_brand")
    # all years: the row before or after a month may lie any number of years away
    lines = t["lineitem"].select("l_partkey", "l_shipdate", "l_extendedprice")
    monthly = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        "p_brand", year().alias("year"), month().alias("month")).agg(money(F.col("l_extendedprice")).alias("total"))
    whole = Window.partitionBy("p_brand", "year")
    ordered = Window.partitionBy("p_brand").orderBy("year", "month")
    framed = monthly.select(
        "*", (F.round(amount(F.col("total")).over(whole), 2).cast("double") / count().over(whole)).alias("mean"),
        F.coalesce(F.lag("total").over(ordered), F.lit(0.0)).alias("previous"),
        F.coalesce(F.lead("total").over(ordered), F.lit(0.0)).alias("next"))
    return framed.filter((F.col("year") == 1999) & (F.abs(F.col("total") - F.col("mean")) / F.col("mean") > 0.1))


@query("w22_ranked_ratios_union", f"""WITH {_SALES},
ratios AS (SELECT channel, l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) AS ratio
  FROM sales GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY channel ORDER BY ratio) AS place FROM ratios WHERE ratio > 0)
SELECT channel, l_partkey, ratio FROM ranked WHERE channel = 'store' AND place <= 10
UNION SELECT channel, l_partkey, ratio FROM ranked WHERE channel = 'catalog' AND place <= 10
UNION SELECT channel, l_partkey, ratio FROM ranked WHERE channel = 'web' AND place <= 10""")
def w22(t):
    s = sales(t, line_cols=["l_partkey", "l_quantity", "l_returnflag"])
    ratios = s.groupBy("channel", "l_partkey").agg(
        (F.sum(F.when(F.expr(RETURNED), F.col("l_quantity")).otherwise(0.0)) / F.sum("l_quantity")).alias("ratio"))
    place = F.rank().over(Window.partitionBy("channel").orderBy("ratio"))
    ranked = ratios.filter("ratio > 0").withColumn("place", place).filter("place <= 10")
    return ranked.select("channel", "l_partkey", "ratio").distinct()


@query("w23_cumulative_outer", f"""WITH {_SALES},
web AS (SELECT l_partkey, y * 12 + m AS mon, sum(l_extendedprice) AS v FROM sales WHERE channel = 'web' GROUP BY ALL),
store AS (SELECT l_partkey, y * 12 + m AS mon, sum(l_extendedprice) AS v FROM sales WHERE channel = 'store' GROUP BY ALL),
webc AS (SELECT l_partkey, mon, sum(v) OVER (PARTITION BY l_partkey ORDER BY mon ROWS UNBOUNDED PRECEDING) AS c FROM web),
storec AS (SELECT l_partkey, mon, sum(v) OVER (PARTITION BY l_partkey ORDER BY mon ROWS UNBOUNDED PRECEDING) AS c FROM store),
both_ AS (SELECT coalesce(webc.l_partkey, storec.l_partkey) AS l_partkey, coalesce(webc.mon, storec.mon) AS mon, webc.c AS w, storec.c AS s
  FROM webc FULL OUTER JOIN storec ON webc.l_partkey = storec.l_partkey AND webc.mon = storec.mon),
run AS (SELECT l_partkey, mon, max(w) OVER p AS w, max(s) OVER p AS s FROM both_
  WINDOW p AS (PARTITION BY l_partkey ORDER BY mon ROWS UNBOUNDED PRECEDING))
SELECT l_partkey, mon AS month_no, round(w, 2) AS web_total, round(s, 2) AS store_total FROM run WHERE round(w, 2) > round(s, 2)""")
def w23(t):
    s = sales(t, line_cols=["l_partkey", "l_shipdate", "l_extendedprice"]).filter("channel <> 'catalog'")
    price = F.col("l_extendedprice")
    monthly = s.groupBy("l_partkey", (year() * 12 + month()).alias("month_no")).agg(*[
        a for c in ("web", "store") for a in (F.sum(F.when(F.col("channel") == c, price)).alias(c),
                                              F.max(F.col("channel") == c).alias(f"has_{c}"))])
    # a series has at most one row per calendar month; a channel's sum shows in the months it sold in
    w = Window.partitionBy("l_partkey").orderBy("month_no").rowsBetween(Window.unboundedPreceding, 0)
    sums = monthly.select("l_partkey", "month_no", *[
        F.when(F.col(f"has_{c}"), F.sum(c).over(w)).alias(c) for c in ("web", "store")])
    run = sums.select("l_partkey", "month_no", F.round(F.max("web").over(w), 2).alias("web_total"),
                      F.round(F.max("store").over(w), 2).alias("store_total"))
    return run.filter("web_total > store_total")


@query("w24_lag_day_pivot", f"""WITH {_SALES}
SELECT channel, n_name, count(*) FILTER (lag_days <= 30) AS d30, count(*) FILTER (lag_days > 30 AND lag_days <= 60) AS d60,
  count(*) FILTER (lag_days > 60 AND lag_days <= 90) AS d90, count(*) FILTER (lag_days > 90) AS d90_up
FROM (SELECT channel, n_name, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag_days FROM sales
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) GROUP BY ALL""")
def w24(t):
    supplier = t["supplier"].select("s_suppkey", "s_nationkey")
    lag = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    s = sales(t, line_cols=["l_suppkey", "l_shipdate"]).withColumn("lag", lag)
    cells = s.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("channel", "s_nationkey").agg(
        F.count_if(F.col("lag") <= 30).alias("d30"),
        F.count_if((F.col("lag") > 30) & (F.col("lag") <= 60)).alias("d60"),
        F.count_if((F.col("lag") > 60) & (F.col("lag") <= 90)).alias("d90"),
        F.count_if(F.col("lag") > 90).alias("d90_up"))
    return cells.join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select(
        "channel", "n_name", "d30", "d60", "d90", "d90_up")


@query("w24_weekday_pivot", """
SELECT year(l_shipdate) AS year, """ + ", ".join(
    f"coalesce(round(sum(l_extendedprice) FILTER (dayofweek(l_shipdate) = {d}), 2), 0) AS day_{d + 1}" for d in range(7)) + """
FROM lineitem GROUP BY 1""")
def w24_weekday(t):
    days = t["lineitem"].select(year().alias("year"), F.dayofweek("l_shipdate").alias("day"), "l_extendedprice")
    totals = days.groupBy("year").pivot("day", list(range(1, 8))).agg(money(F.col("l_extendedprice")))
    return totals.select("year", *[F.coalesce(F.col(f"`{d}`"), F.lit(0.0)).alias(f"day_{d}") for d in range(1, 8)])


@query("w25_ratio_of_aggregates", """
SELECT promo, whole, promo * 100 / whole AS share, early, late, early / CAST(late AS DOUBLE) AS early_late
FROM (SELECT round(sum(l_extendedprice), 2) AS promo FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'PROMO'),
  (SELECT round(sum(l_extendedprice), 2) AS whole FROM lineitem JOIN part ON p_partkey = l_partkey),
  (SELECT count(*) AS early FROM lineitem JOIN part ON p_partkey = l_partkey WHERE month(l_shipdate) <= 6),
  (SELECT count(*) AS late FROM lineitem JOIN part ON p_partkey = l_partkey WHERE month(l_shipdate) > 6)""")
def w25(t):
    # one row per part reaches the join
    parts = t["lineitem"].groupBy("l_partkey").agg(
        amount(F.col("l_extendedprice")).alias("price"),
        F.count_if(F.month("l_shipdate") <= 6).alias("early"), F.count_if(F.month("l_shipdate") > 6).alias("late"))
    joined = parts.join(t["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    one = joined.agg(
        money(F.when(F.col("p_type") == "PROMO", F.col("price"))).alias("promo"), money(F.col("price")).alias("whole"),
        F.coalesce(F.sum("early"), F.lit(0)).alias("early"), F.coalesce(F.sum("late"), F.lit(0)).alias("late"))
    return one.select("*", F.try_divide(F.col("promo") * 100, F.col("whole")).alias("share"),
                      F.try_divide(F.col("early").cast("double"), F.col("late").cast("double")).alias("early_late"))


@query("w26_range_condition_join", """
SELECT p_brand, count(*) FILTER (x.p_partkey IS NULL) AS no_promo, count(*) FILTER (x.p_partkey IS NOT NULL) AS promo, count(*) AS n_lines
FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY
JOIN part p ON p.p_partkey = l_partkey
LEFT JOIN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') x ON x.p_partkey = l_partkey
WHERE l_quantity < 25 GROUP BY p_brand""")
def w26(t):
    lines = t["lineitem"].filter("l_quantity < 25").select("l_orderkey", "l_partkey", "l_shipdate")
    heads = t["orders"].select("o_orderkey", "o_orderdate")
    late = F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 60 days")
    part = t["part"].select("p_partkey", "p_brand", F.coalesce(F.col("p_type") == "PROMO", F.lit(False)).alias("promo"))
    joined = lines.join(heads, (F.col("l_orderkey") == F.col("o_orderkey")) & late)
    return joined.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(
        F.count_if(~F.col("promo")).alias("no_promo"), F.count_if("promo").alias("promo"), count().alias("n_lines"))


@query("w27_left_join_adjusted", """
WITH back AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
sold AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
SELECT o_custkey, sum(greatest(sold.q - coalesce(back.q, 0), 0)) AS kept, count(*) FILTER (back.q IS NULL) AS never_returned
FROM sold LEFT JOIN back ON back.l_orderkey = sold.l_orderkey AND back.l_partkey = sold.l_partkey
JOIN orders ON o_orderkey = sold.l_orderkey GROUP BY o_custkey""")
def w27(t):
    returned, q = F.expr(RETURNED), F.col("l_quantity")
    # dealt by order once: that serves both aggregates and the join; the number follows the table, as the hash tables of a task take many times its bytes
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag").repartition(task_count(t["lineitem"]), "l_orderkey")
    pairs = lines.groupBy("l_orderkey", "l_partkey").agg(
        F.sum(F.when(~returned, q)).alias("sold"), F.sum(F.when(returned, q)).alias("back")).filter("sold is not null")
    kept = F.greatest(F.col("sold") - F.coalesce("back", F.lit(0.0)), F.lit(0.0))
    per_order = pairs.groupBy("l_orderkey").agg(F.sum(kept).alias("kept"), F.count_if(F.col("back").isNull()).alias("n"))
    return per_order.join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "o_custkey").agg(F.sum("kept").alias("kept"), F.sum("n").alias("never_returned"))


@query("w28_overlap_counts", f"""WITH {_SALES},
a AS (SELECT DISTINCT o_custkey, l_partkey FROM sales WHERE channel = 'store'),
b AS (SELECT DISTINCT o_custkey, l_partkey FROM sales WHERE channel = 'web')
SELECT count(*) FILTER (b.o_custkey IS NULL) AS store_only, count(*) FILTER (a.o_custkey IS NULL) AS web_only,
  count(*) FILTER (a.o_custkey IS NOT NULL AND b.o_custkey IS NOT NULL) AS both_channels
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey AND a.l_partkey = b.l_partkey""")
def w28(t):
    s = sales(t, line_cols=["l_partkey"]).filter("channel <> 'catalog'")
    flags = s.groupBy("o_custkey", "l_partkey").agg(
        F.max(F.col("channel") == "store").alias("a"), F.max(F.col("channel") == "web").alias("b"))
    return flags.agg(F.count_if(F.expr("a and not b")).alias("store_only"), F.count_if(F.expr("b and not a")).alias("web_only"),
                     F.count_if(F.expr("a and b")).alias("both_channels"))


@query("w29_far_below_average", """
WITH items AS (SELECT l_suppkey, l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY ALL),
means AS (SELECT l_suppkey, round(sum(revenue), 2) / count(*) AS mean FROM items GROUP BY l_suppkey)
SELECT l_suppkey, l_partkey, revenue, mean FROM items JOIN means USING (l_suppkey) WHERE revenue <= 0.1 * mean""")
def w29(t):
    items = t["lineitem"].groupBy("l_suppkey", "l_partkey").agg(money(F.col("l_extendedprice")).alias("revenue"))
    means = items.groupBy("l_suppkey").agg((money(F.col("revenue")) / count()).alias("mean"))
    return items.join(means, "l_suppkey").filter(F.col("revenue") <= 0.1 * F.col("mean")).select(
        "l_suppkey", "l_partkey", "revenue", "mean")


@query("w29_channels_within_share", f"""WITH {_SALES},
per AS (SELECT p_brand, channel, round(sum(l_extendedprice), 2) AS v FROM sales JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT s.p_brand, s.v AS store, c.v AS catalog, w.v AS web FROM per s JOIN per c USING (p_brand) JOIN per w USING (p_brand)
WHERE s.channel = 'store' AND c.channel = 'catalog' AND w.channel = 'web'
  AND s.v BETWEEN 0.7 * w.v AND 1.3 * w.v AND c.v BETWEEN 0.4 * w.v AND 0.6 * w.v""")
def w29_channels(t):
    s = sales(t, line_cols=["l_partkey", "l_extendedprice"]).join(
        t["part"].select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    per = s.groupBy("p_brand").agg(*[
        money(F.when(F.col("channel") == c, F.col("l_extendedprice"))).alias(c) for c in ("store", "catalog", "web")])
    web = F.col("web")
    return per.filter(F.col("store").between(0.7 * web, 1.3 * web) & F.col("catalog").between(0.4 * web, 0.6 * web))


@query("w30_frequent_and_best", f"""WITH {_SALES},
frequent AS (SELECT DISTINCT l_partkey FROM (SELECT l_partkey FROM lineitem
  GROUP BY l_partkey, year(l_shipdate), month(l_shipdate) HAVING count(*) >= 3)),
spent AS (SELECT o_custkey, round(sum(l_extendedprice), 2) AS total FROM sales GROUP BY o_custkey),
best AS (SELECT o_custkey FROM spent WHERE total > 0.6 * (SELECT max(total) FROM spent))
SELECT y AS year, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n_lines FROM sales
WHERE l_partkey IN (SELECT l_partkey FROM frequent) AND o_custkey IN (SELECT o_custkey FROM best) GROUP BY y""")
def w30(t):
    s = sales(t, line_cols=["l_partkey", "l_shipdate", "l_extendedprice"])
    frequent = t["lineitem"].groupBy("l_partkey", year().alias("y"), month().alias("m")).agg(
        count().alias("n")).filter("n >= 3").select("l_partkey").distinct()
    # read for its maximum and for the customers near it
    spent = written(s.groupBy("o_custkey").agg(money(F.col("l_extendedprice")).alias("total")), "spent")
    best = spent.filter(F.col("total") > 0.6 * spent.agg(F.max("total")).scalar())
    return (s.join(frequent, "l_partkey", "left_semi").join(best, "o_custkey", "left_semi")
            .groupBy(year().alias("year")).agg(money(F.col("l_extendedprice")).alias("revenue"), count().alias("n_lines")))


@query("w31_null_key_union", f"""WITH {_SALES},
keyed AS (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS supp, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_partkey END AS prt FROM sales)
SELECT channel, missing, y AS year, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS total FROM (
  SELECT channel, 'supplier' AS missing, y, l_extendedprice FROM keyed WHERE supp IS NULL AND channel = 'store'
  UNION ALL SELECT channel, 'part', y, l_extendedprice FROM keyed WHERE prt IS NULL AND channel = 'web'
  UNION ALL SELECT channel, 'part', y, l_extendedprice FROM keyed WHERE prt IS NULL AND channel = 'catalog') GROUP BY ALL""")
def w31(t):
    n = F.col("l_linenumber")
    lines = t["lineitem"].select(
        "l_orderkey", "l_shipdate", "l_extendedprice",
        F.when(n != 7, F.col("l_suppkey")).alias("supp"), F.when(n != 1, F.col("l_partkey")).alias("part"))
    missing = F.when(F.col("supp").isNull() & (F.col("channel") == "store"), "supplier").when(
        F.col("part").isNull() & (F.col("channel") != "store"), "part")
    s = sales(t, lines.filter("supp is null or part is null")).withColumn("missing", missing).filter("missing is not null")
    return s.groupBy("channel", "missing", year().alias("year")).agg(
        count().alias("n_lines"), money(F.col("l_extendedprice")).alias("total"))


@query("w31_time_of_day_union", """
SELECT event_type, part_of_day, count(*) AS n_events, round(sum(value), 2) AS total FROM (
  SELECT event_type, 'morning' AS part_of_day, value FROM events WHERE hour(ts) BETWEEN 8 AND 9
  UNION ALL SELECT event_type, 'evening', value FROM events WHERE hour(ts) BETWEEN 17 AND 18) GROUP BY ALL""")
def w31_time(t):
    h = F.hour("ts")
    part = F.when(h.between(8, 9), "morning").when(h.between(17, 18), "evening")
    return t["events"].withColumn("part_of_day", part).filter("part_of_day is not null").groupBy(
        "event_type", "part_of_day").agg(count().alias("n_events"), money(F.col("value")).alias("total"))


@query("w32_fact_chain", f"""WITH {_SALES}
SELECT p_brand, count(*) AS n_pairs, round(sum(r.l_extendedprice), 2) AS returned, round(sum(b.l_extendedprice), 2) AS bought_again
FROM sales r JOIN sales b ON b.o_custkey = r.o_custkey AND b.l_partkey = r.l_partkey
  AND (b.y * 12 + b.m) - (r.y * 12 + r.m) BETWEEN 0 AND 6
JOIN part ON p_partkey = r.l_partkey
WHERE r.channel = 'store' AND r.l_returnflag = 'R' AND b.channel <> 'store' AND b.l_returnflag <> 'R' GROUP BY p_brand""")
def w32(t):
    s = sales(t, line_cols=["l_partkey", "l_shipdate", "l_extendedprice", "l_returnflag"])
    returned = F.expr(RETURNED)
    store = F.col("channel") == "store"
    # months instead of lines: a customer and part have a bounded number of them, and sums over
    # pairs of lines follow from sums and counts per month
    back, again, price = store & returned, ~store & ~returned, F.col("l_extendedprice")
    monthly = s.filter(back | again).groupBy("o_custkey", "l_partkey", (year() * 12 + month()).alias("mon")).agg(
        amount(F.when(back, price)).alias("rv"), F.count_if(back).alias("rn"),
        amount(F.when(again, price)).alias("bv"), F.count_if(again).alias("bn"))
    later = Window.partitionBy("o_custkey", "l_partkey").orderBy("mon").rangeBetween(0, 6)
    pairs = monthly.select("l_partkey", "rv", "rn", F.sum("bv").over(later).alias("bv"), F.sum("bn").over(later).alias("bn")).filter(
        "rn > 0 and bn > 0")
    return pairs.join(t["part"].select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).groupBy(
        "p_brand").agg(F.sum(F.col("rn") * F.col("bn")).alias("n_pairs"),
                       money(F.col("rv") * F.col("bn")).alias("returned"), money(F.col("bv") * F.col("rn")).alias("bought_again"))


@query("w33_dimension_in_range_facts", """
SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size BETWEEN 10 AND 20
  AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity BETWEEN 45 AND 50
    AND l_shipdate >= DATE '1999-01-01' AND l_shipdate < DATE '2000-01-01')""")
def w33(t):
    sold = t["lineitem"].filter(years("l_shipdate", 1999) & F.col("l_quantity").between(45, 50)).select("l_partkey").distinct()
    return t["part"].filter("p_size between 10 and 20").join(
        sold, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_name", "p_retailprice")


@query("w33_correlated_count", """
SELECT DISTINCT p_name FROM part a WHERE p_size BETWEEN 20 AND 24
  AND (SELECT count(*) FROM part b WHERE b.p_type = a.p_type AND b.p_brand = a.p_brand AND b.p_size > 49) > 0""")
def w33_correlated(t):
    part = t["part"]
    large = part.filter("p_size > 49").select("p_type", "p_brand").distinct()
    return part.filter("p_size between 20 and 24").join(large, ["p_type", "p_brand"], "left_semi").select("p_name").distinct()


@query("w34_segment_histogram", f"""WITH {_SALES}
SELECT segment, count(*) AS n_customers, segment * 50000 AS segment_base FROM (
  SELECT CAST(floor(round(sum(l_extendedprice), 2) / 50000) AS BIGINT) AS segment FROM sales WHERE channel = 'web' GROUP BY o_custkey) GROUP BY segment""")
def w34(t):
    s = sales(t, line_cols=["l_extendedprice"]).filter("channel = 'web'")
    per = s.groupBy("o_custkey").agg(F.floor(money(F.col("l_extendedprice")) / 50000).alias("segment"))
    return per.groupBy("segment").agg(count().alias("n_customers")).withColumn("segment_base", F.col("segment") * 50000)


@query("w35_string_assembly", """
SELECT c_custkey, coalesce(c_name, '') || ', ' || coalesce(n_name, '') || ' (' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') || ')' AS label
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal BETWEEN 1000 AND 5000""")
def w35(t):
    joined = t["customer"].filter("c_acctbal between 1000 and 5000").join(
        t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left")
    empty = F.lit("")
    segment = F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("none"))
    return joined.select("c_custkey", F.concat(
        F.coalesce("c_name", empty), F.lit(", "), F.coalesce("n_name", empty), F.lit(" ("), segment, F.lit(")")).alias("label"))


_FACT_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"]
_FACT_FLAGS = ["l_returnflag", "l_linestatus"]


@query("w36_max_every_column", "SELECT count(*) AS n_rows, " + ", ".join(
    f"count({c}) AS n_{c}, max({c}) AS max_{c}" for c in _FACT_NUMBERS + _FACT_FLAGS) + " FROM lineitem")
def w36(t):
    # the few flags group the lines, so that the large pass keeps numbers only in its buffers
    per_flags = t["lineitem"].groupBy(*_FACT_FLAGS).agg(count().alias("n_rows"), *[
        a for c in _FACT_NUMBERS for a in (F.count(c).alias(f"n_{c}"), F.max(c).alias(f"max_{c}"))])
    return per_flags.agg(
        F.sum("n_rows").alias("n_rows"),
        *[a for c in _FACT_NUMBERS for a in (F.sum(f"n_{c}").alias(f"n_{c}"), F.max(f"max_{c}").alias(f"max_{c}"))],
        *[a for c in _FACT_FLAGS for a in (
            F.sum(F.when(F.col(c).isNotNull(), F.col("n_rows"))).alias(f"n_{c}"), F.max(c).alias(f"max_{c}"))])
