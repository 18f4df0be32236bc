"""Running counts and dense ids of new events, carried forward from totals: no batch reads an event, a count or an id of another.

After each batch a table of tails holds one row per job set (and one for all sets): how many jobs were recorded, and how many are
registered, pending and active. The next batch numbers and sums its own changes, cut into buckets like the one-pass
operators, and adds the tails. Changes come from keyed state (`reduced.changes`), which knows what each job did before.

Batches count in the order of arrival. If they arrive in the order of the ids, counts and ids are those of the one-pass operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.operators.scans import WIDTH, running_totals
from runlens.operators.skew import HOT_ROWS, lookup_join
from runlens.session import written

SUMS = {"recorded": "d_recorded", "registered": "d_registered", "pending": "d_pending", "active": "d_active"}
COUNTS = "job_set string, message_id long, registered long, pending long, active long"
IDS = "job_id string, job_set string, record_id long, executor_id long, set_executor_id long"
TAILS = "job_set string, recorded long, registered long, pending long, active long"


class Carried:
    """Call it on every micro-batch of `reduced.changes`. Below `path` grow `counts` and `ids`; `tails` has a snapshot per batch.

    A batch writes its own `batch=n` folders with overwrite and reads only the tails of the batch before: a repeated batch changes nothing.
    The folder belongs to one checkpoint; a batch older than what lies there is refused, except the last one.
    """

    def __init__(self, path: str, width: int = WIDTH, hot_rows: int = HOT_ROWS):
        self.path, self.width, self.hot_rows = path, width, hot_rows

    def _batches(self, spark: SparkSession) -> list[int]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/tails")
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch="))

    def _tails(self, spark: SparkSession, batch_id: int) -> DataFrame:
        there = self._batches(spark)
        if there and there[-1] > batch_id:
            raise ValueError(f"{self.path} holds batch {there[-1]}: it belongs to another checkpoint than batch {batch_id}")
        before = [b for b in there if b < batch_id]
        if not before:
            return spark.createDataFrame([], TAILS)
        return spark.read.schema(TAILS).parquet(f"{self.path}/tails/batch={before[-1]}")

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        tails = written(self._tails(spark, batch_id), "tails", f"{self.path}/tails-before")
        rows = written(changes, "changes", f"{self.path}/changes")
        sums = [F.sum(d).alias(n) for n, d in SUMS.items()]
        per_set = rows.groupBy("job_set").agg(*sums, F.count(F.lit(1)).alias("n_changes"))

        # counts after each event
        merged = written(rows.groupBy("job_set", "message_id").agg(*[F.sum(d).alias(d) for d in SUMS.values()]), "merged", f"{self.path}/merged")
        totals = running_totals(merged, ["job_set"], "message_id", {n: F.col(d) for n, d in SUMS.items()}, self.width)
        old = tails.select(F.col("job_set").alias("_set"), *[F.col(n).alias(f"_{n}") for n in SUMS])
        known = per_set.join(old, F.col("job_set") == F.col("_set"), "left").select("job_set", "n_changes", *[F.coalesce(f"_{n}", F.lit(0)).alias(f"_{n}") for n in SUMS])
        carried = lookup_join(totals, known, "job_set", [f"_{n}" for n in SUMS], "n_changes", hot_rows=self.hot_rows, path=f"{self.path}/per-set")
        after = [(F.col(n) + F.col(f"_{n}")).alias(n) for n in ("registered", "pending", "active")]
        carried.select("job_set", "message_id", *after).write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch_id}")

        # ids of the jobs recorded in this batch: among all, and in their set
        recorded = rows.filter("d_recorded = 1").select("job_id", "job_set", F.col("message_id").alias("record_id"))
        ones = {"n": F.lit(1).cast("long")}
        in_all = written(running_totals(recorded, [], "record_id", {"_all": F.lit(1).cast("long")}, self.width), "in-all", f"{self.path}/in-all")
        in_set = running_totals(in_all, ["job_set"], "record_id", ones, self.width)
        numbered = lookup_join(in_set, known, "job_set", ["_recorded"], "n_changes", hot_rows=self.hot_rows, path=f"{self.path}/per-set-again")
        so_far = tails.filter("job_set is null").agg(F.coalesce(F.max("recorded"), F.lit(0))).first()[0]
        numbered.select("job_id", "job_set", "record_id", (F.col("_all") + so_far).alias("executor_id"), (F.col("n") + F.col("_recorded")).alias("set_executor_id")
                        ).write.mode("overwrite").parquet(f"{self.path}/ids/batch={batch_id}")

        # tails: every set, and all of them together under a null
        every = per_set.select("job_set", *SUMS).unionByName(rows.agg(*sums).select(F.lit(None).cast("string").alias("job_set"), *SUMS)).unionByName(tails)
        every.groupBy("job_set").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in SUMS]).write.mode("overwrite").parquet(f"{self.path}/tails/batch={batch_id}")

    def _read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/{name}").drop("batch")

    def counts(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "counts", COUNTS)

    def ids(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "ids", IDS)
