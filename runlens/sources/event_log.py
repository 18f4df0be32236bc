"""An event log as a streaming source that is read by message id.

The log is a folder of parquet segments, `segment=n` holding the ids from n * width on. The offsets of the stream are message ids, so a
query can start after any id, with or without a checkpoint; a batch is cut into one id range per segment, and executors read those.

A log is only appended to, in the order of the ids: what arrives below an id that was read already is not seen again. Segments are read
through pyarrow, so the folder must be on a file system that it knows (local or shared folders, HDFS, S3), by a path or URI.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from runlens.operators.lifecycle import resume_from

LOG_SCHEMA = ("message_id long, ts timestamp_ntz, job_set string, job_id string, kind string, reason string, cause string, exit_codes array<int>")
SEGMENT_IDS = 1_000_000


def write_log(events: DataFrame, path: str, width: int = SEGMENT_IDS) -> None:
    """Append events to a log; `width` ids share a segment."""
    columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    (events.select(*columns, F.expr(f"message_id div {width}").alias("segment")).repartitionByRange("segment", "message_id")
     .write.mode("append").partitionBy("segment").parquet(path))


@dataclass
class IdRange(InputPartition):
    segment: int
    low: int
    high: int


def _folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, after: int):
        self.path, self.after = path, after

    def _segments(self) -> dict[int, list[str]]:
        """Files of every segment."""
        from pyarrow import fs

        system, root = _folder(self.path)
        found: dict[int, list[str]] = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            parent, _, name = info.path.rpartition("/")
            if info.is_file and name.endswith(".parquet") and "/segment=" in parent and "/_" not in parent[len(root):]:
                found.setdefault(int(parent.rpartition("=")[2]), []).append(info.path)
        return found

    def initialOffset(self) -> dict:
        return {"id": self.after}

    def latestOffset(self) -> dict:
        import pyarrow.parquet as pq

        segments = self._segments()
        if not segments:
            return self.initialOffset()
        system, _ = _folder(self.path)
        latest = self.after
        for file in segments[max(segments)]:
            footer = pq.ParquetFile(file, filesystem=system).metadata
            at = footer.schema.names.index("message_id")
            latest = max([latest, *(footer.row_group(g).column(at).statistics.max for g in range(footer.num_row_groups))])
        return {"id": latest}

    def partitions(self, start: dict, end: dict) -> list[IdRange]:
        return [IdRange(segment, start["id"], end["id"]) for segment in sorted(self._segments())] if end["id"] > start["id"] else []

    def read(self, partition: IdRange) -> Iterator:
        import pyarrow.dataset as ds

        system, _ = _folder(self.path)
        wanted = (ds.field("message_id") > partition.low) & (ds.field("message_id") <= partition.high)
        columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
        # files without such ids are skipped by their statistics
        files = ds.dataset(self._segments().get(partition.segment, []), format="parquet", filesystem=system)
        yield from (b for b in files.to_batches(columns=columns, filter=wanted) if b.num_rows)

    def commit(self, end: dict) -> None:
        pass


class EventLog(DataSource):
    """`spark.readStream.format("event_log").option("after", id).load(path)`."""

    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return LOG_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogReader(self.options["path"], int(self.options.get("after", -1)))


def read_log(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """Stream of the events with ids above `after`."""
    spark.dataSource.register(EventLog)
    return spark.readStream.format("event_log").option("after", str(after)).load(path)


def read_log_from(spark: SparkSession, path: str, points: DataFrame) -> DataFrame:
    """Stream that goes on after the last id of every job set in `points` (job_set, last_id, n_events); other sets are read from the start.

    Only ids above the least of those points are read if every set of the log has one, which the caller says by leaving no set out.
    """
    least = points.agg(F.min("last_id")).first()[0]
    return resume_from(read_log(spark, path, -1 if least is None else least), points)
