"""Length-delimited message files as a Spark data source.

Reading: an index of splits comes first, offsets at which a message starts, about
SPLIT_BYTES apart. Only files larger than that are looked through for it, each by one
task that reads lengths and skips messages, in constant memory; it is a table in the
shared folder. Then each partition reads its splits alone, small files packed together.
So a file may be of any size, and no value holds more than a batch. Tasks don't grow in
number with the bytes where splits are small.

Writing: each task writes one file under a folder of the job's own; the job's commit
moves them to their place, its abort takes the folder away. A failed attempt leaves nothing.

Paths are what pyarrow's file systems open (local, hdfs, s3, gs); Spark lists them, so
globs and folders are what they are elsewhere in Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from wayfold.schema import EVENT, ROAD
from wayfold.shared import new_path
from wayfold.sinks import wire

SPLIT_BYTES = 64 << 20
#: Small splits are read several in a task, so that they are about so many tasks.
TASKS = 200
#: Bytes read at once, and rows of a batch.
BUFFER, BATCH = 4 << 20, 10_000
#: Kinds of messages and the rows they are.
KINDS = {"event": EVENT, "geometry": f"{ROAD}, tile string"}


def _open(path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _walk(file, start: int, end: int, payloads: bool) -> Iterator[tuple[int, bytes | None]]:
    """(where the next message starts, this message or None) of the messages from start to end."""
    at, base, data = start, start, b""
    while at < end:
        if at - base + 10 > len(data) and base + len(data) < end:
            file.seek(at)
            data, base = file.read(min(BUFFER, end - at)), at
        try:
            size, head = wire._varint_at(data, at - base)
        except IndexError:
            raise ValueError("the last message is cut short") from None
        then = base + head + size
        if then > end:
            raise ValueError("the last message is cut short")
        if not payloads:
            yield then, None
        elif head + size <= len(data):
            yield then, data[head : head + size]
        else:
            file.seek(base + head)
            yield then, file.read(size)
        at = then


def splits(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, glob: str | None = None) -> str:
    """Writes the table (path, start, end) of the splits of the files at path; returns where it is."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for file, size in zip(*(c.to_pylist() for c in batch.columns)):
                begun = 0
                if size > split_bytes:
                    with _open(file) as f:
                        for then, _ in _walk(f, 0, size, False):
                            if then - begun >= split_bytes and then < size:
                                rows.append((file, begun, then))
                                begun = then
                if size > begun:
                    rows.append((file, begun, size))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "start", "end"])

    files = spark.read.format("binaryFile")
    if glob:
        files = files.option("pathGlobFilter", glob)
    listed = files.load(path).select("path", "length")  # contents stay where they are
    index = new_path(spark, "splits")
    # a file a task: looking through a large one is the work
    listed.repartition(max(1, min(listed.count(), 10_000))).mapInArrow(work, "path string, start long, end long").write.parquet(index)
    return index


@dataclass
class Splits(InputPartition):
    files: list[tuple[str, int, int]]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.kind, self.index, self.most = options["kind"], options["index"], int(options["splitbytes"])

    def partitions(self) -> list[Splits]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.index)
        rows = sorted(tuple(r.values()) for r in pq.read_table(root, filesystem=store, columns=["path", "start", "end"]).to_pylist())
        most = max(self.most, min(SPLIT_BYTES, sum(r[2] - r[1] for r in rows) // TASKS))
        packed, size = [], 0
        for row in rows:
            if not packed or size + row[2] - row[1] > most:
                packed.append([])
                size = 0
            packed[-1].append(row)
            size += row[2] - row[1]
        return [Splits(p) for p in packed] or [Splits([])]

    def read(self, partition: Splits):
        rows = []
        for path, start, end in partition.files:
            tile = (path.rsplit("/", 1)[-1].split(".")[0],) if self.kind == "geometry" else ()
            decode = wire.decode_geometry if tile else wire.decode_event
            with _open(path) as f:
                for _, message in _walk(f, start, end, True):
                    rows.append((*decode(message), *tile))
                    if len(rows) >= BATCH:
                        yield self._batch(rows)
                        rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]):
        import pyarrow as pa

        point = pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())]))
        if self.kind == "event":
            kinds = [pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.map_(pa.string(), pa.float64())]
            names = ["vehicle_id", "time_ms", "lat", "lon", "event_data"]
        else:
            kinds = [*[pa.string()] * 5, pa.int32(), point, pa.string()]
            names = ["geom_id", "from_node", "to_node", "fwd_ref", "back_ref", "road_class", "geometry", "tile"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.kind, self.path, self.overwrite = options["kind"], options["path"], overwrite
        self.job = f"_writing-{uuid.uuid4().hex}"

    def _at(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, batches) -> Written:
        from pyspark import TaskContext

        store, root = self._at()
        task = TaskContext.get()
        name = f"part-{task.partitionId():05}-{self.job[-8:]}-{task.taskAttemptId()}.pbf"
        store.create_dir(f"{root}/{self.job}", recursive=True)
        encode, n, columns = (wire.encode_event, 0, ("vehicle_id", "time_ms", "lat", "lon", "event_data")) if self.kind == "event" else (wire.encode_geometry, 0, ("geom_id", "from_node", "to_node", "fwd_ref", "back_ref", "road_class", "geometry"))
        with store.open_output_stream(f"{root}/{self.job}/{name}") as f:
            for batch in batches:
                for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)):
                    if self.kind == "event":
                        row = (row[0], row[1] or 0, row[2] or 0.0, row[3] or 0.0, dict(row[4] or {}))
                    else:
                        row = (*row[:5], row[5] or 0, [(p["lon"], p["lat"]) for p in row[6] or []])
                    f.write(wire.delimited(encode(*row)))
                    n += 1
        return Written(name, n)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, root = self._at()
        if self.overwrite:
            for file in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if file.base_name.startswith("part-"):
                    store.delete_file(file.path)
        for m in messages:
            if m is not None and m.rows:
                store.move(f"{root}/{self.job}/{m.name}", f"{root}/{m.name}")
        self.abort(messages)  # what second attempts left

    def abort(self, messages) -> None:
        from pyarrow import fs

        store, root = self._at()
        if store.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.job}")


class DelimitedSource(DataSource):
    """Format `wayfold-delimited`; options kind (event or geometry), and index and splitbytes to read, or path to write."""

    @classmethod
    def name(cls) -> str:
        return "wayfold-delimited"

    def schema(self) -> str:
        return KINDS[self.options["kind"]]

    def reader(self, schema) -> _Reader:
        return _Reader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)


def read(spark: SparkSession, path: str, kind: str, split_bytes: int = SPLIT_BYTES, glob: str | None = None) -> DataFrame:
    """The messages of a kind of all files at path."""
    spark.dataSource.register(DelimitedSource)
    index = splits(spark, path, split_bytes, glob)
    return spark.read.format(DelimitedSource.name()).options(kind=kind, index=index, splitbytes=str(split_bytes)).load()


def write(rows: DataFrame, path: str, kind: str, overwrite: bool = False) -> None:
    """Rows as files of delimited messages, one for each partition that has any. Without overwrite, path must be new.

    Null numbers are written as 0, null texts as empty ones. A geometry's tile is not in its message.
    """
    from pyarrow import fs

    spark = rows.sparkSession
    spark.dataSource.register(DelimitedSource)
    store, root = fs.FileSystem.from_uri(path)
    if not overwrite and store.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    columns = [c for c in ("geom_id", "from_node", "to_node", "fwd_ref", "back_ref", "road_class", "geometry")] if kind == "geometry" else ["vehicle_id", "time_ms", "lat", "lon", "event_data"]
    rows.select(*columns).write.format(DelimitedSource.name()).options(kind=kind, path=path).mode("overwrite" if overwrite else "append").save()
