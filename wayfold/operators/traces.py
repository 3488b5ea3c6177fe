"""Order-dependent operators on traces: thinning, sampling, speeds, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions import geo, roads


def _per(key: str, time: str, *ties: str):
    return W.partitionBy(key).orderBy(time, *ties)


def thin(points: DataFrame, min_distance_m: float, min_interval_ms: int, key: str = "vehicle_id", time: str = "time_ms", either: bool = False) -> DataFrame:
    """Points whose distance and time from the last point kept are large enough.

    Rows with event data are always kept. either keeps a point if one of the two is
    large enough, and then event data makes no difference. Each point is judged
    against the last one kept, so a trace is folded over by one task, in order of time.
    """
    has = F.coalesce(F.size("event_data") > 0, F.lit(False)) if "event_data" in points.columns and not either else F.lit(False)
    rows = points.where(F.col(time).isNotNull())
    schema = rows.schema
    narrow = rows.select(F.struct(*rows.columns).alias("_row"), F.col(key).alias("_key"), F.col(time).alias("_t"), F.col("lon").cast("double").alias("_x"), F.col("lat").cast("double").alias("_y"), has.alias("_has"))

    def fold(group):
        import pyarrow as pa
        import pyarrow.compute as pc

        from wayfold.operators.kernel import chord_m

        order = pc.sort_indices(group, sort_keys=[("_t", "ascending"), ("_x", "ascending"), ("_y", "ascending")])
        t, x, y, has = (group.column(c).take(order).to_pylist() for c in ("_t", "_x", "_y", "_has"))
        kept, last = [], None
        for i in range(len(t)):
            if last is not None and not has[i]:
                known = None not in (x[i], y[i], x[last], y[last])
                far = chord_m(x[last], y[last], x[i], y[i]) >= max(0.0, min_distance_m) if known else None
                late = t[i] - t[last] >= max(0, min_interval_ms)
                if (far is False and late is False) if either else (far is False or late is False):
                    continue
            kept.append(i)
            last = i
        column = group.column("_row").combine_chunks().take(order.take(pa.array(kept, pa.int64())))
        return pa.Table.from_arrays([column.field(i) for i in range(column.type.num_fields)], names=[f.name for f in column.type])

    return narrow.groupBy("_key").applyInArrow(fold, schema)


def subsample(points: DataFrame, interval_s: int, key: str = "vehicle_id", time: str = "time_ms") -> DataFrame:
    """The first and last point of each trace, and those at whole multiples of the interval after the first."""
    w = W.partitionBy(key)
    first, last = F.min(time).over(w), F.max(time).over(w)
    since = F.floor((F.col(time) - first) / 1000)
    return points.where(F.col(time).isNotNull()).withColumn("_keep", (F.col(time) == first) | (F.col(time) == last) | (since % interval_s == 0)).where("_keep").drop("_keep")


def speed_pairs(points: DataFrame, key: str = "vehicle_id", time: str = "time_ms", whole_seconds: bool = False) -> DataFrame:
    """Each point but a trace's first with metres, milliseconds and speed since the one before."""
    w = _per(key, time)
    before = lambda c: F.lag(c).over(w)
    out = points.withColumns({"_lon": before("lon"), "_lat": before("lat"), "_t": before(time)}).where("_t IS NOT NULL")
    out = out.withColumns({"metres": geo.distance(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat")), "dt_ms": F.col(time) - F.col("_t")}).drop("_lon", "_lat", "_t")
    return out.withColumn("speed_mps", roads.segment_speed(F.col("metres"), F.col("dt_ms"), whole_seconds))


def probability_steps(rows: DataFrame, least: float, key: str = "vehicle_id", time: str = "time_ms", value: str = "seqprob") -> DataFrame:
    """delta of the log probability since the row before, which counts as 0 where it is less; good above least."""
    last = F.lag(value).over(_per(key, time))
    base = F.when(last.isNull() | (last < F.col(value)), 0.0).otherwise(last)
    return rows.withColumn("delta", F.col(value) - base).withColumn("good", F.col("delta") > least)


def failure_runs(rows: DataFrame, key: str = "vehicle_id", time: str = "time_ms", good: str = "good", ref: str = "ref_id", fraction: str | None = None) -> DataFrame:
    """Runs of failed points between two good rows: (key, run, start_ref, end_ref, start_fraction, end_fraction, n_points, lonlats).

    The fractions are those of the good rows, null without such a column. Runs at a trace's start or end are not closed on both sides and don't count.

    Each run but the first begins with its good row, so a run ends at the place of the
    next run: one shuffle, and no frame that is read to its end for each row.
    """
    marked = rows.withColumn("run", F.sum(F.col(good).cast("int")).over(_per(key, time).rowsBetween(W.unboundedPreceding, 0)))
    place = F.when(F.col(good), F.struct(F.col(ref).alias("ref"), (F.col(fraction) if fraction else F.lit(None)).cast("double").alias("at")))
    failed = F.when(~F.col(good), F.struct(F.col(time).alias("t"), F.col("lon").alias("lon"), F.col("lat").alias("lat")))
    runs = marked.groupBy(key, "run").agg(F.first(place, True).alias("_from"), F.count(failed).alias("n_points"), F.array_sort(F.collect_list(failed)).alias("p"))
    runs = runs.withColumn("_to", F.lead("_from").over(W.partitionBy(key).orderBy("run")))
    out = runs.where(F.col("n_points") > 0).select(key, "run", F.col("_from.ref").alias("start_ref"), F.col("_to.ref").alias("end_ref"), F.col("_from.at").alias("start_fraction"), F.col("_to.at").alias("end_fraction"), "n_points", "p")
    return out.where("start_ref IS NOT NULL AND end_ref IS NOT NULL").withColumn("lonlats", F.flatten(F.transform("p", lambda x: F.array(x["lon"], x["lat"])))).drop("p")


def consecutive_candidates(candidates: DataFrame, key: str = "vehicle_id", seq: str = "seq") -> DataFrame:
    """Each candidate with each candidate of the sample before: (key, seq, from_ref, from_fraction, ref_id, fraction)."""
    before = candidates.select(key, (F.col(seq) + 1).alias(seq), F.col("ref_id").alias("from_ref"), F.col("fraction").alias("from_fraction"))
    return candidates.select(key, seq, "ref_id", "fraction").join(before, [key, seq])


def split_traces(points: DataFrame, gap_ms: int, key: str = "vehicle_id", time: str = "time_ms") -> DataFrame:
    """points with trip: the trace's number of gaps before; long traces so become several groups."""
    w = _per(key, time)
    gap = F.coalesce(F.col(time) - F.lag(time).over(w) > gap_ms, F.lit(False)).cast("int")
    return points.withColumn("_gap", gap).withColumn("trip", F.sum("_gap").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_gap")


def with_event_data(snapped: DataFrame, events: DataFrame, key: str = "vehicle_id", time: str = "time_ms") -> DataFrame:
    """One row for each event of a matched vehicle and time: event type and value, on the place of the first matched point there.

    Several samples of a vehicle at one time have their events put on one place, each
    event once: the place smallest in ref_id, then in the other columns.
    """
    told = [c for c in snapped.columns if c not in (key, time)]
    order = sorted(told, key=lambda c: c != "ref_id")
    places = snapped.groupBy(key, time).agg(F.min(F.struct(*order)).alias("_place")).select(key, time, *(F.col("_place")[c].alias(c) for c in told))
    data = events.select(key, time, F.explode_outer("event_data").alias("event_type", "event_value")).where("event_type IS NOT NULL")
    return places.join(data, [key, time])
