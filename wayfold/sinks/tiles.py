"""Tiled output: Parquet by week, type and tile; the wire formats by tile; lists of tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions import tile
from wayfold.shared import materialize
from wayfold.sinks import wire

#: Bytes of traces from which on a dust message is closed, and another of its start begun.
DUST_BYTES = 1 << 20
#: Bytes of messages, about, that a file of a tile holds before the tile has several.
PART_BYTES = 64 << 20
#: Failures, about, that a batch of decoded messages holds.
DECODED_ROWS = 10_000


def with_tiles(records: DataFrame, edges: DataFrame, ref: str = "ref_id", zoom: int = tile.DATA_ZOOM, last: bool = True) -> DataFrame:
    """records, once for each tile of their road's ends (or its start alone)."""
    places = edges.select(F.col("ref_id").alias(ref), F.explode(tile.record_tiles(F.col("geometry"), zoom, last)).alias("tile"))
    return records.join(places, ref)


def write_events(events: DataFrame, path: str) -> None:
    """Events as Parquet; refuses a path that exists."""
    events.write.mode("errorifexists").parquet(path)


def write_delimited(events: DataFrame, path: str, overwrite: bool = False) -> None:
    """Events as length-delimited messages, as sources.events.read_delimited reads them; all files of a job or none."""
    from wayfold.sources import delimited

    delimited.write(events, path, "event", overwrite)


def write_parquet(records: DataFrame, path: str, kind: str, week: str | None = "week") -> None:
    """One folder for each week, type and tile; overwrites what it writes again.

    Rows are dealt by tile first, so that a tile's files come from few tasks; AQE
    may split a tile that is too large.
    """
    if week is None:
        records = records.withColumn("week", F.lit(None).cast("date"))
    out = records.withColumn("type", F.lit(kind)).hint("rebalance", "week", "tile")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week", "type", "tile").parquet(path)


def encoded_speeds(cycle: DataFrame, ref: str = "ref_id") -> DataFrame:
    """(ref, week, message): weekly speed histograms as delimited messages."""
    bins = F.map_from_entries(F.collect_list(F.struct("speed_bin", "n")))
    periods = cycle.groupBy(ref, "week", "period").agg(bins.alias("bins"))
    nested = periods.groupBy(ref, "week").agg(F.map_from_entries(F.collect_list(F.struct("period", "bins"))).alias("periods"))

    def encode(ref_id, periods):
        return wire.delimited(wire.encode_speeds(ref_id, {p: dict(h) for p, h in dict(periods).items()}))

    return _encoded(nested.select(ref, "week", "periods"), encode, ref)


def encoded_binned(binned: DataFrame, ref: str = "ref_id") -> DataFrame:
    """(ref, week, message): weekly binned events as delimited messages, which have 0 for the sum of nulls alone."""
    entry = F.struct("bin", "period", "event_type", "count", F.coalesce("value", F.lit(0.0)).alias("value"))
    nested = binned.groupBy(ref, "week", "length_cm", "n_bins").agg(F.collect_list(entry).alias("entries"))

    def encode(ref_id, length_cm, n_bins, *entries):
        bins: dict = {}
        for at, period, kind, count, value in zip(*entries):
            bins.setdefault(at, {}).setdefault(period, []).append((kind or "", count, value))
        return wire.delimited(wire.encode_binned(ref_id, length_cm, n_bins, bins))

    told = [F.col("entries")[c].alias(f"_{c}") for c in ("bin", "period", "event_type", "count", "value")]
    return _encoded(nested.select(ref, "week", "length_cm", "n_bins", *told), encode, ref)


def encoded_dust(failures: DataFrame) -> DataFrame:
    """(start_ref, message): failure runs, or clusters of them, as delimited messages.

    Traces are encoded where they are, and only their bytes are brought together by
    start. A start has one message, or several where its traces are more than
    DUST_BYTES or AQE dealt them to several tasks, as in a file that was appended to.
    """
    import pyarrow as pa

    if "failures" in failures.columns:
        failures = failures.select("start_ref", F.inline("failures"))
    order = ["start_ref", *(c for c in ("end_ref", "vehicle_id", "run") if c in failures.columns)]
    runs = failures.select(*order, F.struct("end_ref", "start_fraction", "end_fraction", "lonlats").alias("trace"))

    def encode(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.column(len(order)).flatten()]
            traces = pa.array([wire.encode_trace(*row) for row in zip(*columns)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(order)], traces], names=[*order, "trace"])

    def pack(batches):
        start, traces, size = None, [], 0
        done = []

        def close():
            if traces:
                done.append((start, wire.delimited(wire.dust(start, traces))))

        def told():
            rows = [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.binary())]
            done.clear()
            return pa.RecordBatch.from_arrays(rows, names=["start_ref", "message"])

        for batch in batches:
            for ref, trace in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ref != start or size >= DUST_BYTES:
                    close()
                    start, traces, size = ref, [], 0
                traces.append(trace)
                size += len(trace)
            yield told()
        close()
        yield told()

    encoded = runs.mapInArrow(encode, runs.withColumn("trace", F.lit(b"")).schema)
    dealt = encoded.hint("rebalance", "start_ref").sortWithinPartitions(*order)
    return dealt.select("start_ref", "trace").mapInArrow(pack, "start_ref string, message binary")


def decoded_dust(messages: DataFrame) -> DataFrame:
    """(start_ref, end_ref, start_fraction, end_fraction, lonlats) of dust messages, one row for each failure."""

    def work(batches):
        import pyarrow as pa

        names = ["start_ref", "end_ref", "start_fraction", "end_fraction", "lonlats"]
        kinds = [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.float64())]

        def told(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        rows = []
        for batch in batches:
            for data in batch.column(0):
                for m in wire.frames(data.as_py()):
                    start, failures = wire.decode_dust(m)
                    rows.extend((start, *f) for f in failures)
                    if len(rows) >= DECODED_ROWS:
                        yield told(rows)
                        rows = []
        yield told(rows)

    return messages.select("message").mapInArrow(work, "start_ref string, end_ref string, start_fraction double, end_fraction double, lonlats array<double>")


def _decoded(messages: DataFrame, decode, schema: str) -> DataFrame:
    """(week, ...) of messages with their week, in batches of about DECODED_ROWS."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "date": pa.date32()}
    fields = [f.split() for f in schema.split(", ")]

    def told(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])

    def work(batches):
        rows = []
        for batch in batches:
            for week, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                for m in wire.frames(data.as_py()):
                    rows.extend((week, *r) for r in decode(m))
                    if len(rows) >= DECODED_ROWS:
                        yield told(rows)
                        rows = []
        yield told(rows)

    return messages.select("week", "message").mapInArrow(work, schema)


def decoded_speeds(messages: DataFrame) -> DataFrame:
    """(week, ref_id, period, speed_bin, n) of weekly speed messages."""

    def rows(m):
        ref, entries = wire.decode_speeds(m)
        return [(ref, *e) for e in entries]

    return _decoded(messages, rows, "week date, ref_id string, period int, speed_bin int, n long")


def decoded_binned(messages: DataFrame) -> DataFrame:
    """(week, ref_id, length_cm, n_bins, bin, period, event_type, count, value) of weekly messages of binned events."""

    def rows(m):
        ref, length_cm, n_bins, entries = wire.decode_binned(m)
        return [(ref, length_cm, n_bins, *e) for e in entries]

    return _decoded(messages, rows, "week date, ref_id string, length_cm long, n_bins int, bin int, period int, event_type string, count long, value double")


def ranked(placed: DataFrame) -> DataFrame:
    """Tiles (z, x, y) with their place from 1 in the total order of tiles.

    Columns of tiles are counted first; what is summed in one task are these counts,
    at most 2^z of them, and the places within a column are found column by column.
    """
    from pyspark.sql import Window as W

    counts = placed.groupBy("z", "x").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy(F.col("z"), F.col("x").desc()).rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("z", "x", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy("z", "x").orderBy(F.col("y").desc()))
    return placed.withColumn("_k", within).join(offsets, ["z", "x"]).select("z", "x", "y", (F.col("_before") + F.col("_k")).alias("place"))


def _encoded(nested: DataFrame, encode, ref: str) -> DataFrame:
    keys = [c for c in nested.columns if c in (ref, "week")]
    inputs = [c for c in nested.columns if c != "week"]
    schema = nested.select(*keys, F.lit(b"").alias("message")).schema

    def listed(column):
        """to_pylist() of a column; arrays are taken together, in a fraction of the time that they take one by one."""
        import pyarrow as pa

        if not pa.types.is_list(column.type) or column.null_count:
            return column.to_pylist()
        flat, ends = column.flatten(), (column.offsets.to_numpy() - column.offsets[0].as_py()).tolist()
        number = pa.types.is_integer(flat.type) or pa.types.is_floating(flat.type)
        flat = flat.to_numpy().tolist() if number and not flat.null_count else flat.to_pylist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            columns = [listed(batch.column(c)) for c in inputs]
            messages = [encode(*row) for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(messages, pa.binary())], names=[*keys, "message"])

    return nested.mapInArrow(work, schema)


def write_pbf(messages: DataFrame, folder: str, kind: str) -> DataFrame:
    """One file for each week and tile, <week>/<kind>/<tile>.<kind>.pbf; returns (path, records).

    A tile of more than PART_BYTES is several files, <tile>.<part>.<kind>.pbf, each of
    about so many bytes and written by a task of its own. messages needs tile, message and may have week. folder is a URI that all
    executors reach. A file is replaced, not appended to, when written again; it gets
    its name when it is whole, so that second attempts leave no torn files.
    """
    week = F.col("week").cast("string") if "week" in messages.columns else F.lit("")
    rows = messages.select(F.coalesce(week, F.lit("")).alias("week"), "tile", "message")
    rows = materialize(rows, "messages")
    parts = rows.groupBy("week", "tile").agg(F.ceil(F.sum(F.length("message")) / PART_BYTES).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("message"), F.col("parts"))  # by content, so that a task that runs again deals alike
    rows = rows.join(parts, ["week", "tile"], "left").select("week", F.when(F.col("parts") > 1, F.concat_ws(".", "tile", part)).otherwise(F.col("tile")).alias("tile"), "message")
    rows = rows.repartition("week", "tile").sortWithinPartitions("week", "tile", "message")

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        import uuid

        store, root = fs.FileSystem.from_uri(folder)
        current, stream, done, part = None, None, [], f".{uuid.uuid4().hex}.part"

        def close():
            if stream:
                stream.close()
                store.move(done[-1][0] + part, done[-1][0])

        for batch in batches:
            for key_week, tile_name, message in zip(*(c.to_pylist() for c in batch.columns)):
                if (key_week, tile_name) != current:
                    close()
                    current = (key_week, tile_name)
                    at = "/".join(x for x in (root, key_week, kind) if x)
                    store.create_dir(at, recursive=True)
                    out = f"{at}/{tile_name}.{kind}.pbf"
                    stream = store.open_output_stream(out + part)
                    done.append([out, 0])
                stream.write(message)
                done[-1][1] += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    return rows.mapInArrow(write, "path string, records long")


def tile_urls(points: DataFrame, base: str, zoom: int = tile.DATA_ZOOM) -> DataFrame:
    """The distinct tiles of points as addresses."""
    return points.select(F.concat(F.lit(base), tile.tile_id(F.col("lon"), F.col("lat"), zoom), F.lit(".geometry.6.pbf")).alias("url")).distinct()
