"""Replay of an archive of events by their own clock.

An archive is events in order of time, in files with the span that each covers in an
index. The stream's offset is event time: as far as the clock has come since the replay
began, so it needs no state and is the same after a restart. A trigger opens the files
that cover its span, and of these the row groups that do: what it reads follows what
happened in its seconds, not the archive.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a row group, the least that a trigger reads of a file.
GROUP_BYTES = 1 << 20


def write_archive(events: DataFrame, path: str, time_col: str = "time_ms") -> None:
    """Events with a time as an archive under path, which must be new; rows without time are left out."""
    known = events.where(F.col(time_col).isNotNull())
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known.repartitionByRange(n, time_col).sortWithinPartitions(time_col).write.option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/events")
    written = events.sparkSession.read.parquet(f"{path}/events")
    spans = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(time_col).alias("first"), F.max(time_col).alias("last"))
    spans.coalesce(1).write.parquet(f"{path}/index")


@dataclass
class Span(InputPartition):
    """The rows of a file later than since, up to until."""

    file: str
    since: int
    until: int


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.time, self.began, self.speed = options["time"], int(options["began"]), float(options["speed"])
        self.files = self._index(options["path"])
        self.first, self.last = (min(f[1] for f in self.files), max(f[2] for f in self.files)) if self.files else (0, -1)
        self.columns = json.loads(options["columns"])

    @staticmethod
    def _index(path: str) -> list:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(f"{path}/index")
        return sorted((tuple(r.values()) for r in pq.read_table(root, filesystem=store, columns=["file", "first", "last"]).to_pylist()), key=lambda f: f[1])

    def initialOffset(self) -> dict:
        return {"time": self.first - 1}

    def latestOffset(self) -> dict:
        gone = max(0, int((time.time() * 1000 - self.began) * self.speed))
        return {"time": min(self.last, self.first - 1 + gone)}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        since, until = start["time"], end["time"]
        return [Span(f, since, until) for f, first, last in self.files if first <= until and last > since and since < until]

    def groups(self, span: Span, file) -> list[int]:
        """The row groups of an opened file that may have rows of the span."""
        meta = file.metadata
        at = [meta.schema.column(i).path for i in range(len(meta.schema))].index(self.time)
        out = []
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            if s is None or not s.has_min_max or (s.min <= span.until and s.max > span.since):
                out.append(g)
        return out

    def read(self, span: Span):
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(span.file)
        with store.open_input_file(name) as f:
            file = pq.ParquetFile(f)
            for batch in file.iter_batches(batch_size=10_000, row_groups=self.groups(span, file), columns=self.columns):
                t = batch.column(batch.schema.get_field_index(self.time))
                kept = batch.filter(pc.and_(pc.greater(t, span.since), pc.less_equal(t, span.until)))
                if kept.num_rows:
                    yield kept.select(self.columns)


class ArchiveSource(DataSource):
    """Format `wayfold-archive`; see replay."""

    @classmethod
    def name(cls) -> str:
        return "wayfold-archive"

    def schema(self):
        from pyspark.sql.types import StructType

        return StructType.fromJson(json.loads(self.options["schema"]))

    def streamReader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def replay(spark: SparkSession, path: str, speed: float = 1.0, began_ms: int | None = None, time_col: str = "time_ms") -> DataFrame:
    """The archive's events as a stream in their own cadence, speed times as fast, in order of triggers.

    The replay begins at began_ms of the clock, now if none is given. A query that is to
    go on from its checkpoint must be given the began_ms that it began with.
    """
    spark.dataSource.register(ArchiveSource)
    schema = spark.read.parquet(f"{path}/events").schema
    began = int(time.time() * 1000) if began_ms is None else began_ms
    options = {"path": path, "time": time_col, "began": str(began), "speed": str(speed), "schema": schema.json(), "columns": json.dumps(schema.names)}
    return spark.readStream.format(ArchiveSource.name()).options(**options).load()
