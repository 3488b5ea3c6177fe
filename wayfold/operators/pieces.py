"""Traces as pieces of time, so that one trace is work for many tasks.

A piece is what a trace has in a span of piece_ms. Both operators below are folds over a
trace, in which each step needs the one before; here every piece is a task of its own.

thin() guesses that each piece starts anew, by keeping its first sample, and so gets a
sample that it may end with. From each such end it is then looked up, in the next piece
that keeps any sample after it (boxes of pieces tell which may), where the walk runs into
that piece's guess; from there on both keep the same. New ends are looked up in turn, until
there are none. The true walk then follows these links from the trace's first sample.

match_long() matches as kernel.match_trace does without max_inputs. First the candidates
of all samples and the routes between them: each piece starts as if no sample came before,
and is put right by the last candidates of the piece before, as far as that changes
anything (rounds go on until nothing changes). Then Viterbi as a scan: of each piece a
(max, +) matrix from its first candidates to its last, products of which give the log
probabilities that each piece starts with. Then backwards: which candidate a piece starts
from, by which one it ends with, as matrices of the same kind. At last each piece tells
its rows, and windows over pieces join what spans several.

What a task holds is a piece, or FAN matrices of pieces. Rows of pieces are few: one for
each span in which a trace has samples.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.operators import graphstore, kernel, match
from wayfold.schema import MATCHED
from wayfold.shared import materialize

PIECE_MS = 3_600_000
#: Matrices of pieces that are multiplied in one task.
FAN = 1000
_NONE = -math.inf


def _piece(time: str, piece_ms: int) -> Column:
    return F.floor(F.col(time) / piece_ms).cast("long")


def _trace(key: str) -> Column:
    """A trace's key as text, null too."""
    return F.to_json(F.struct(F.col(key).alias("k")))


# Groups


def _listed(values) -> list:
    """An Arrow array as Python values, structs as tuples; numbers go through numpy, in a tenth of the time that they take one by one."""
    import pyarrow as pa

    kind = values.type
    if pa.types.is_list(kind):
        at = values.offsets.to_numpy().tolist()
        inner = _listed(values.values[at[0] : at[-1]])
        out = [inner[a - at[0] : b - at[0]] for a, b in zip(at, at[1:])]
    elif pa.types.is_struct(kind):
        out = list(zip(*(_listed(values.field(i)) for i in range(kind.num_fields))))
    elif (pa.types.is_integer(kind) or pa.types.is_floating(kind)) and not values.null_count:
        return values.to_numpy().tolist()
    else:
        return values.to_pylist()
    return [v if known else None for v, known in zip(out, values.is_valid().to_pylist())] if values.null_count else out


def grouped(rows: DataFrame, run, ddl: str, *beside: DataFrame, keys: tuple = ("trace", "piece")) -> DataFrame:
    """What run tells of each group by keys, as tuples of ddl: run(rows), and the group's rows of each frame beside.

    Rows are dicts. Groups that lack rows of any frame are left out. All frames are shuffled
    once, together, and a task walks through its sorted groups: there are millions of small
    ones, each of which would be some Arrow batches of its own by applyInArrow.
    """
    frames = [rows, *beside]
    names = [[c for c in df.columns if c not in keys] for df in frames]
    told = [df.select(*keys, F.lit(i).alias("_side"), F.struct(*c).alias(f"_{i}")) for i, (df, c) in enumerate(zip(frames, names))]
    every = told[0]
    for more in told[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = every.repartition(n, *keys).sortWithinPartitions(*keys)

    def work(batches):
        import pyarrow.compute as pc

        at, held, out = None, None, []
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                sides = part.column("_side")
                of = [iter(zip(*map(_listed, part.column(f"_{k}").filter(pc.equal(sides, k)).flatten()))) for k in range(len(names))]
                for key, side in zip(zip(*(_listed(part.column(k)) for k in keys)), _listed(sides)):
                    if key != at:
                        if held and all(held):
                            out.extend(run(*held))
                        at, held = key, [[] for _ in names]
                        if len(out) >= 1000:
                            yield from _table(out, ddl).to_batches()
                            out = []
                    row = dict(zip(keys, key))
                    row.update(zip(names[side], next(of[side])))
                    held[side].append(row)
        if held and all(held):
            out.extend(run(*held))
        if out:
            yield from _table(out, ddl).to_batches()

    return every.mapInArrow(work, ddl)


# Thinning


def _far(min_m: float, min_ms: int, either: bool, metres):
    """Whether a sample is kept after another one; samples are (t, x, y, has)."""

    def keeps(last, new) -> bool:
        if new[3]:
            return True
        known = None not in (last[1], last[2], new[1], new[2])
        far = metres(last[1], last[2], new[1], new[2]) >= max(0.0, min_m) if known else None
        late = new[0] - last[0] >= max(0, min_ms)
        return not ((far is False and late is False) if either else (far is False or late is False))

    return keeps


_STATE = "id long, t long, x double, y double"


def kept(rows: DataFrame, min_m: float, min_ms: int, either: bool = False, metres=kernel.chord_m) -> DataFrame:
    """(trace, piece, id) of the samples that thinning keeps; rows has these and t, x, y, has. An id comes once."""
    keeps = _far(min_m, min_ms, either, metres)
    rows = materialize(rows.select("trace", "piece", "id", "t", "x", "y", "has"), "samples")

    def walk(group, entry=None, guess=frozenset()):
        """ids kept after entry until one is in guess, that one, and the last sample kept (id, t, x, y)."""
        samples = sorted(((r["t"], r["x"], r["y"], r["id"], r["has"]) for r in group), key=lambda s: (s[0], s[1] is not None, s[1], s[2] is not None, s[2], s[3]))
        ids, last = [], entry
        for t, x, y, name, has in samples:
            if last is None or keeps(last[1:], (t, x, y, has)):
                if name in guess:
                    return ids, name, None
                ids.append(name)
                last = (name, t, x, y)
        return ids, None, last

    def guessed(group):
        ids, _, last = walk(group)
        xs, ys = ([r[c] for r in group if r[c] is not None] for c in "xy")
        box = [min(xs, default=None), max(xs, default=None), min(ys, default=None), max(ys, default=None)]
        always = any(r["has"] or r["x"] is None or r["y"] is None for r in group)
        return [(group[0]["trace"], group[0]["piece"], ids, *last, *box, max(r["t"] for r in group), always)]

    columns = f"trace string, piece long, ids array<long>, {_STATE}, x0 double, x1 double, y0 double, y1 double, t1 long, always boolean"
    guesses = materialize(grouped(rows, guessed, columns), "guesses")
    order = W.partitionBy("trace").orderBy("piece")
    boxes = materialize(guesses.select("trace", "piece", F.lead("piece").over(order).alias("onward"), "x0", "x1", "y0", "y1", "t1", "always"), "boxes")
    # more than a degree has anywhere, by both axes: no sample of the box is farther
    most = (F.greatest(F.abs(F.col("x") - F.col("x0")), F.abs(F.col("x") - F.col("x1"))) + F.greatest(F.abs(F.col("y") - F.col("y0")), F.abs(F.col("y") - F.col("y1")))) * 112_000.0
    far, late = F.coalesce(most >= min_m, F.lit(True)), F.col("t1") - F.col("t") >= min_ms
    may = F.col("always") | (far | late if either else far & late)
    ends = materialize(guesses.select("trace", "piece", "id", "t", "x", "y"), "ends")
    seen, links = ends, []

    def follow(group, ends, guess):
        met_at, out = frozenset(guess[0]["ids"]), []
        for e in ends:
            ids, met, last = walk(group, (e["e_id"], e["e_t"], e["e_x"], e["e_y"]), met_at)
            out.append((e["trace"], e["from_piece"], e["e_id"], e["piece"], ids, met, *(last or (None,) * 4)))
        return out

    linked = f"trace string, from_piece long, from_id long, piece long, prefix array<long>, met long, {_STATE}"
    while not ends.isEmpty():
        after = ends.withColumnRenamed("piece", "from_piece").join(boxes.select("trace", F.col("piece").alias("from_piece"), F.col("onward").alias("piece")), ["trace", "from_piece"]).where("piece IS NOT NULL")
        after = materialize(after.join(boxes, ["trace", "piece"]).withColumn("_may", may).select("trace", "from_piece", "id", "t", "x", "y", "piece", "_may"), "onward")
        beyond = after.where("NOT _may").drop("piece", "_may").join(boxes, "trace").where(F.col("piece") > F.col("from_piece")).where(may)  # a stop longer than a piece
        beyond = beyond.groupBy("trace", "from_piece", "id", "t", "x", "y").agg(F.min("piece").alias("piece"))
        targets = after.where("_may").drop("_may").unionByName(beyond).select("trace", "piece", "from_piece", *(F.col(c).alias(f"e_{c}") for c in ("id", "t", "x", "y")))
        found = materialize(grouped(rows, follow, linked, targets, guesses.select("trace", "piece", "ids")), "links")
        links.append(found)
        # a piece that keeps nothing passes the end on; one that met its guess ends as that does
        fresh = found.where("met IS NULL").select("trace", "piece", "id", "t", "x", "y").distinct()
        ends = materialize(fresh.join(seen, ["trace", "piece", "id"], "left_anti"), "ends")
        seen = seen.unionByName(ends)
    if not links:
        return guesses.select("trace", "piece", F.explode("ids").alias("id"))
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)

    def path(group, others):
        """The pieces that keep samples, and the link by which each is reached."""
        last = {r["piece"]: r["id"] for r in group}
        onward = {(r["from_piece"], r["from_id"]): (r["piece"], r["met"], r["id"]) for r in others if r["from_piece"] is not None}
        piece = min(last)
        out, at = [(piece, None, None)], (piece, last[piece])
        while at in onward:
            n, met, to = onward[at]
            out.append((n, *at))
            at = (n, last[n] if met is not None else to)
        return [(group[0]["trace"], *one) for one in out]

    led = every.select("trace", "from_piece", "from_id", "piece", "met", "id")
    led = led.unionByName(guesses.select("trace").distinct(), allowMissingColumns=True)  # traces of one piece have no links
    walked = grouped(guesses.select("trace", "piece", "id"), path, "trace string, piece long, from_piece long, from_id long", led, keys=("trace",))
    walked = materialize(walked, "walk")
    by_link = walked.where("from_id IS NOT NULL").join(every.select("trace", "piece", "from_piece", "from_id", "prefix", "met"), ["trace", "piece", "from_piece", "from_id"]).join(guesses.select("trace", "piece", "ids"), ["trace", "piece"])
    rest = F.when(F.col("met").isNull(), F.array().cast("array<long>")).otherwise(F.slice("ids", F.greatest(F.lit(1), F.array_position("ids", F.col("met")).cast("int")), F.greatest(F.lit(1), F.size("ids"))))
    first = walked.where("from_id IS NULL").join(guesses.select("trace", "piece", "ids"), ["trace", "piece"])
    return by_link.select("trace", "piece", F.explode(F.concat("prefix", rest)).alias("id")).unionByName(first.select("trace", "piece", F.explode("ids").alias("id")))


def thin(points: DataFrame, min_distance_m: float, min_interval_ms: int, key: str = "vehicle_id", time: str = "time_ms", either: bool = False, piece_ms: int = PIECE_MS) -> DataFrame:
    """traces.thin by pieces: the same rows, with a trace of any length over many tasks."""
    has = F.coalesce(F.size("event_data") > 0, F.lit(False)) if "event_data" in points.columns and not either else F.lit(False)
    rows = materialize(points.where(F.col(time).isNotNull()).withColumn("_wf_id", F.monotonically_increasing_id()), "points")
    narrow = rows.select(_trace(key).alias("trace"), _piece(time, piece_ms).alias("piece"), F.col("_wf_id").alias("id"), F.col(time).alias("t"), F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"), has.alias("has"))
    ids = kept(narrow, min_distance_m, min_interval_ms, either).select(F.col("id").alias("_wf_id"))
    return rows.join(ids, "_wf_id", "left_semi").drop("_wf_id")


# Matching

_FOUND = "array<struct<edge:string,fraction:double,metres:double,x:double,y:double>>"
#: Links come as arrays of their parts, by candidate, then by the one before.
_LINKS = "from array<int>, to array<int>, probs array<double>, metres array<double>, refs array<array<string>>"
#: A sample with its candidates as they are after the sample before, and the routes from those of that one.
_STEP = f"trace string, piece long, id long, t long, lon double, lat double, has boolean, round int, edges array<string>, fractions array<double>, xs array<double>, ys array<double>, logs array<double>, {_LINKS}, broke boolean"
_TRANSFER = "trace string, rank long, constant boolean, width int, cells array<double>"


def _arrow(kind: str):
    """The Arrow type of a DDL type, for tasks: Spark's own parser lives on the driver."""
    import pyarrow as pa

    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    if kind.startswith("struct<"):
        parts, depth, start, inner = [], 0, 0, kind[7:-1] + ","
        for i, c in enumerate(inner):
            depth += (c == "<") - (c == ">")
            if c == "," and depth == 0:
                parts.append(inner[start:i].split(":", 1))
                start = i + 1
        return pa.struct([(name, _arrow(t)) for name, t in parts])
    return {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind]


def _table(rows: list[tuple], ddl: str):
    import pyarrow as pa

    fields = [f.split() for f in ddl.split(", ")]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], _arrow(kind)) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _records(group: list[dict]) -> list[dict]:
    """A group's rows in order of time, of several rounds the last."""
    latest: dict[int, dict] = {}
    for r in group:
        if r["id"] not in latest or r.get("round", 0) >= latest[r["id"]]["round"]:
            latest[r["id"]] = r
    return sorted(latest.values(), key=lambda r: (r["t"], r["lon"], r["lat"], r["id"]))


class _Roads:
    """What _steps asks of a stored graph: a sample's candidates and the routes to them."""

    def __init__(self, path: str, config: MatchConfig):
        self.graph, self.config = graphstore.opened(path, config.connect), config
        self.find, self.name, self.ref = self.graph.find, self.graph.name, self.graph.ref

    def prepared(self, before: list, last, s: dict):
        found = [(self.find(edge), *rest) for edge, *rest in s["found"]]
        return kernel.prepared(self.graph, self.config, before, last, s["t"], s["lon"], s["lat"], found)


def _steps(graph, samples: list[dict], last, before: list, known: dict, turn: int):
    """Rows of _STEP for samples after a vector before; stops where what follows is known already."""
    for s in samples:
        now, transition = graph.prepared(before, last, s)
        links, reached = [], set()
        for a, p in enumerate(before):
            for k, (prob, (_, metres, path)) in transition(p).items():
                if prob > 0 and now[k][1] > 0:
                    reached.add(k)
                    links.append((a, k, math.log10(prob), metres, [graph.ref(e) for e in path]))
        alive = [k for k in range(len(now)) if (k in reached if reached else now[k][1] > 0)]
        place = {k: i for i, k in enumerate(alive)}
        before, last = [now[k][0] for k in alive], (s["t"], s["lon"], s["lat"])
        edges, fractions = [graph.name(c.edge) for c in before], [c.fraction for c in before]
        told = list(zip(*((a, place[k], *rest) for a, k, *rest in sorted(links, key=lambda x: (x[1], x[0]))))) or [()] * 5
        yield (s["trace"], s["piece"], s["id"], *last, s["has"], turn, edges, fractions, [c.lon for c in before], [c.lat for c in before], [math.log10(now[k][1]) for k in alive], *told, not reached)
        old = known.get(s["id"])
        if old is not None and old["edges"] == edges and old["fractions"] == fractions:
            return


def _linked(samples: DataFrame, opened) -> DataFrame:
    """Rows of _STEP of all samples; some come for several rounds, of which the last counts. Tasks call opened()."""

    def started(group):
        return _steps(opened(), _records(group), None, [], {}, 0)

    def restarted(group, todo, old):
        rows, graph = _records(group), opened()
        (t, lon, lat, *vector), turn = todo[0]["entry"], todo[0]["turn"]
        before = [kernel.Candidate(graph.find(n), f, x, y) for n, f, x, y in zip(*vector)]
        return _steps(graph, rows, (t, lon, lat), before, {r["id"]: r for r in _records(old)}, turn)

    done = materialize(grouped(samples, started, _STEP), "steps")
    state = F.struct("t", "lon", "lat", "edges", "fractions", "xs", "ys")
    ends = materialize(done.groupBy("trace", "piece").agg(F.max_by(state, F.struct("t", "lon", "lat", "id")).alias("entry"), F.max(F.struct("t", "lon", "lat", "id")).alias("at")), "piece-ends")
    onward = ends.select("trace", "piece", F.lead("piece").over(W.partitionBy("trace").orderBy("piece")).alias("next"), "at").where("next IS NOT NULL")
    onward, turn = materialize(onward, "onward"), 1
    changed = ends.select("trace", "piece", "entry")
    while True:
        todo = onward.join(changed, ["trace", "piece"]).select("trace", F.col("next").alias("piece"), "entry")
        old = done.select("trace", "piece", "id", "t", "lon", "lat", "round", "edges", "fractions")
        if turn > 1:  # of the first round all but first pieces are asked
            asked = [df.join(todo.select("trace", "piece"), ["trace", "piece"], "left_semi") for df in (samples, old)]
        else:
            asked = [samples, old]
        more = materialize(grouped(asked[0], restarted, _STEP, todo.withColumn("turn", F.lit(turn)), asked[1]), "steps")
        done = done.unionByName(more)
        # a piece has another end only where its last sample was put right, to other candidates than before
        other = more.join(ends.select("trace", "piece", "at", "entry"), ["trace", "piece"]).where((F.col("id") == F.col("at.id")) & ((F.col("edges") != F.col("entry.edges")) | (F.col("fractions") != F.col("entry.fractions"))))
        changed = materialize(other.select("trace", "piece", state.alias("entry")), "changed")
        if changed.isEmpty():
            return done if turn < 8 else materialize(done, "linked")  # many rounds would be read each time
        ends = materialize(ends.select("trace", "piece", "at", F.col("entry").alias("_old")).join(changed, ["trace", "piece"], "left").select("trace", "piece", "at", F.coalesce("entry", "_old").alias("entry")), "piece-ends")
        turn += 1


def _times(left, right, sums: bool = False):
    """(max, +) product of two transfers (constant, matrix), or that of sums scaled to 1: first left, then right."""
    if right[0]:
        return right
    if sums:
        m = left[1] @ right[1]
        return left[0], m / (m.max() or 1.0)
    return left[0], (left[1][:, :, None] + right[1][None]).max(1)


def _transfers(rows: list[dict]) -> list:
    import numpy as np

    return [(r["constant"], np.array(r["cells"], float).reshape(-1, r["width"])) for r in rows]


def entering(transfers: DataFrame, sums: bool = False) -> DataFrame:
    """(trace, rank, v): the vector with which each transfer of a trace is entered, null for the first; of sums up to a factor.

    Products of FAN transfers, then of these products, then back down: a tree of three
    levels. The first transfer of a trace is a constant.
    """
    blocks = transfers.withColumn("block", F.floor(F.col("rank") / FAN).cast("long"))

    def product(group):
        rows = sorted(group, key=lambda r: r["rank"])
        all_, whole = _transfers(rows), None
        for m in all_:
            whole = m if whole is None else _times(whole, m, sums)
        return [(rows[0]["trace"], rows[0]["block"], whole[0], whole[1].shape[1], whole[1].ravel().tolist())]

    def prefixes(rows, v):
        """The vector before each transfer."""
        out = []
        for m in _transfers(rows):
            out.append(v)
            v = (m[1] if m[0] or v is None else _times((True, v[None]), m, sums)[1])[0]
        return out

    def of_blocks(group):
        rows = sorted(group, key=lambda r: r["rank"])
        return [(r["trace"], r["rank"], None if v is None else v.tolist()) for r, v in zip(rows, prefixes(rows, None))]

    def of_transfers(group, *starts):
        import numpy as np

        rows = sorted(group, key=lambda r: r["rank"])
        v = starts[0][0]["v"] if starts else None
        return [(r["trace"], r["rank"], None if x is None else x.tolist()) for r, x in zip(rows, prefixes(rows, None if v is None else np.array(v)))]

    told, by_block = "trace string, rank long, v array<double>", ("trace", "block")
    if blocks.where("block > 0").isEmpty():
        return materialize(grouped(blocks, of_transfers, told, keys=by_block), "entering")
    products = materialize(grouped(blocks, product, _TRANSFER, keys=by_block), "products")
    starts = grouped(products, of_blocks, "trace string, block long, v array<double>", keys=("trace",))
    return materialize(grouped(blocks, of_transfers, told, starts, keys=by_block), "entering")


def _viterbi(rows: list[dict], v: list | None):
    """Of each row its candidates' log probabilities, and the place of the link by which each was reached (None: it starts anew)."""
    for r in rows:
        logs = r["logs"]
        if r["broke"]:
            seq, by = list(logs), [None] * len(logs)
        else:
            seq, by = [_NONE] * len(logs), [None] * len(logs)
            for i, (a, b, prob) in enumerate(zip(r["from"], r["to"], r["probs"])):  # ties go to the smaller
                q = v[a] + prob + logs[b]
                if q > seq[b] + kernel.TIE:
                    seq[b], by[b] = q, i
        v = seq
        yield seq, by


def _chain(rows: list[dict], told: list, v: list | None, end: int):
    """Each row's candidate on the way to candidate `end` of the last row: (candidate, its log probability, link); and the candidate before the first.

    told is what _viterbi tells of the rows.
    """
    out, c = [], end
    for i in range(len(rows) - 1, -1, -1):
        seq, by = told[i]
        link = by[c]
        out.append((c, seq[c], link))
        before = told[i - 1][0] if i else v
        c = rows[i]["from"][link] if link is not None else None if before is None else kernel.leader(before)
    return out[::-1], c


def _matrix(rows: list[dict], n_before: int, sums: bool = False):
    """Whether a piece starts anew within, and its transfer from the candidates before it to its last."""
    import numpy as np

    of = (lambda x: 10.0 ** np.array(x, float)) if sums else (lambda x: np.array(x, float))
    constant, m = False, None
    for i, r in enumerate(rows):
        if r["broke"]:
            constant, m = True, of(r["logs"])[None]
        else:
            one = np.full((n_before if i == 0 else m.shape[1], len(r["logs"])), 0.0 if sums else _NONE)
            to = np.array(r["to"], int)
            one[np.array(r["from"], int), to] = of(np.array(r["probs"]) + np.array(r["logs"])[to])
            m = one if m is None else _times((constant, m), (False, one), sums)[1]
        if sums:
            m = m / (m.max() or 1.0)
    return constant, m


def _pieces(steps: DataFrame) -> DataFrame:
    """A row for each piece: its rank in the trace, the samples before it, what the piece before ends with."""
    order, final = W.partitionBy("trace").orderBy("piece"), F.struct("round", "edges", "fractions", "t")
    by_sample = steps.groupBy("trace", "piece", "id").agg(F.max(F.struct("t", "lon", "lat", "id")).alias("at"), F.max_by(final, "round").alias("s"))
    pieces = by_sample.groupBy("trace", "piece").agg(F.count("*").alias("n"), F.max_by("s", "at").alias("s")).select(
        "trace", "piece", (F.row_number().over(order) - 1).cast("long").alias("rank"), F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.coalesce(F.size(F.lag("s.edges").over(order)), F.lit(0)).alias("n_before"), F.lag("s.edges").over(order).alias("edges_before"), F.lag("s.fractions").over(order).alias("fractions_before"), F.lag("s.t").over(order).alias("t_before"), F.lead("piece").over(order).isNull().alias("is_last"))
    return materialize(pieces, "pieces")


#: What a scan reads of steps.
_SCANNED = ["trace", "piece", "id", "t", "lon", "lat", "round", "logs", "from", "to", "probs", "broke"]


def _entered(steps: DataFrame, pieces: DataFrame, sums: bool = False) -> DataFrame:
    """pieces with v: the log probabilities, or the probabilities, with which each is entered."""

    def transfer(group, piece):
        constant, m = _matrix(_records(group), piece[0]["n_before"], sums)
        return [(piece[0]["trace"], piece[0]["rank"], constant, m.shape[1], m.ravel().tolist())]

    known = grouped(steps.select(*_SCANNED), transfer, _TRANSFER, pieces.select("trace", "piece", "rank", "n_before"))
    vectors = entering(materialize(known, "matrices"), sums)
    return materialize(pieces.join(vectors, ["trace", "rank"]), "entered")


def _scanned(steps: DataFrame, pieces: DataFrame) -> DataFrame:
    """A row for each piece with v, the log probabilities that it is entered with, and end: 0 for the candidate that it ends with."""
    entered = _entered(steps, pieces)

    def back(group, piece):
        """From which candidate of the piece before each of the last candidates comes, as a transfer; of the last piece the likeliest too."""
        rows, out = _records(group), []
        trace, v, rank = piece[0]["trace"], piece[0]["v"], piece[0]["rank"]
        told = list(_viterbi(rows, v))
        ends = told[-1][0]
        if piece[0]["is_last"]:
            out.append((trace, -rank - 1, True, len(ends), [0.0 if k == kernel.leader(ends) else _NONE for k in range(len(ends))]))
        if v is not None:
            ways = [_chain(rows, told, v, k)[1] for k in range(len(ends))]
            out.append((trace, -rank, False, len(v), [0.0 if k == way else _NONE for way in ways for k in range(len(v))]))
        else:
            out.append((trace, -rank, True, 1, [0.0]))  # nothing comes before, but something is to be entered
        return out

    transfers = materialize(grouped(steps.select(*_SCANNED), back, _TRANSFER, entered.select("trace", "piece", "v", "rank", "is_last")), "back")
    # ranks from 0 up, from the last piece to the first
    backward = _after(materialize(transfers.withColumn("rank", F.col("rank") - F.min("rank").over(W.partitionBy("trace"))), "backward"))
    return entered.join(entered.groupBy("trace").agg(F.max("rank").alias("top")), "trace").withColumn("up", F.col("top") - F.col("rank")).join(backward.select("trace", F.col("rank").alias("up"), F.col("v").alias("end")), ["trace", "up"])


def match_long(points: DataFrame, roads: DataFrame, config: MatchConfig = MatchConfig(), key: str = "vehicle_id", piece_ms: int = PIECE_MS, graph: str | None = None) -> DataFrame:
    """Rows of schema MATCHED as match gives them with max_inputs off, but of kind `filtered`; a trace is spread over its pieces.

    Log probabilities are added in another order than along a whole trace: they agree
    but for rounding. Ties are told as along a trace, but for those at the edge of kernel.TIE.
    """
    path = graph or graphstore.write(roads)
    rows = match._samples(points, roads, config, key).where("geom_id IS NOT NULL")
    rows = rows.select(_trace(key).alias("trace"), _piece("time_ms", piece_ms).alias("piece"), *(c for c in rows.columns if c != key))

    def gathered(group):
        opened, out = graphstore.opened(path, config.connect), []
        listed = ((*(r[c] for c in ("time_ms", "lon", "lat", "has_event", "_n", "geom_id", "fwd_ref", "back_ref")), r["place"] and dict(zip("di", r["place"])), r["along"], r["road_lon"], r["road_lat"]) for r in group)
        for t, lon, lat, has, found, n in match.trace_of(listed, opened, config.radius_m, numbered=True):
            left = kernel.minset(opened, sorted(found)) if found else []
            if left:
                out.append((group[0]["trace"], group[0]["piece"], n, t, lon, lat, has, [dict(zip(("edge", "fraction", "metres", "x", "y"), (opened.name(e), *rest))) for e, *rest in left]))
        return out

    sample = f"trace string, piece long, id long, t long, lon double, lat double, has boolean, found {_FOUND}"
    samples = materialize(grouped(rows, gathered, sample), "samples")
    if config.min_distance_m > 0 or config.min_interval_ms > 0:
        ids = kept(samples.select("trace", "piece", "id", "t", F.col("lon").alias("x"), F.col("lat").alias("y"), "has"), config.min_distance_m, config.min_interval_ms, metres=kernel.planar_m)
        samples = materialize(samples.join(ids, ["trace", "piece", "id"], "left_semi"), "kept-samples")
    steps = _linked(samples, lambda: _Roads(path, config))

    ends = _scanned(steps, _pieces(steps))
    out_ddl = f"{MATCHED.removeprefix('vehicle_id string, ')}, trace string, piece long, open_start boolean, open_end boolean, n_routes int"
    names = [f.split()[0] for f in out_ddl.split(", ")]

    def told(group, piece):
        rows, head = _records(group), piece[0]
        chain, c = _chain(rows, list(_viterbi(rows, head["v"])), head["v"], head["end"].index(0.0))
        before = None if c is None else (head["v"][c], head["fractions_before"][c], head["t_before"])
        out, seq, good, first, waiting = [], 0, None, None, []

        def row(kind, **told):
            out.append({"kind": kind, "trace": head["trace"], "piece": head["piece"], **told})

        def close(end_ref, end_fraction, at_seq):
            for t, lon, lat in waiting:
                row("failure", seq=at_seq, time_ms=t, lon=lon, lat=lat, start_ref=good and good[0], start_fraction=good and good[1], end_ref=end_ref, end_fraction=end_fraction, open_start=good is None, open_end=end_ref is None)
            waiting.clear()

        for i, (r, (c, p, link)) in enumerate(zip(rows, chain)):
            fraction = r["fractions"][c]
            if link is not None:
                seconds = (r["t"] - before[2]) / 1000
                speed = r["metres"][link] / seconds if seconds > 0 else None
                last = 0.0 if head["offset"] + i == 1 or before[0] < p else before[0]
                delta, ref = p - last, r["edges"][c].split(":", 1)[1]
                seq += 1
                same = {"seq": seq, "time_ms": r["t"], "lon": r["lon"], "lat": r["lat"]}
                row("estimate", **same, seqprob_delta=delta, speed_mps=speed, ref_id=ref, end_fraction=fraction)
                if r["has"]:
                    row("snapped", **same, seqprob_delta=delta, speed_mps=speed, ref_id=ref, end_fraction=fraction)
                if delta > config.seqprob_delta_min:
                    for k, e in enumerate(r["refs"][link]):
                        start, end = before[1] if k == 0 else 0.0, fraction if k == len(r["refs"][link]) - 1 else 1.0
                        row("speed", seq=seq, time_ms=r["t"], ref_id=e, start_fraction=start, end_fraction=end, speed_mps=speed)
                        if k == 0:
                            first = first or (e, start, seq)
                            close(e, start, seq)
                        good = (e, end)
                else:
                    waiting.append((r["t"], r["lon"], r["lat"]))
                    row("failed_point", **same)
            before = (p, fraction, r["t"])
        close(None, None, None)
        row("_piece", n_routes=seq, end_ref=first and first[0], end_fraction=first and first[1], seq=first and first[2], start_ref=good and good[0], start_fraction=good and good[1])
        return [tuple(map(r.get, names)) for r in out]

    pieced = materialize(grouped(steps.drop("xs", "ys"), told, out_ddl, ends.select("trace", "piece", "v", "end", "offset", "fractions_before", "t_before")), "told")
    order = W.partitionBy("trace").orderBy("piece")
    own = pieced.where("kind = '_piece'")
    up, down = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy("trace").orderBy(F.desc("piece")).rowsBetween(W.unboundedPreceding, -1)
    own = own.withColumn("earlier", F.coalesce(F.sum("n_routes").over(up), F.lit(0)).cast("int"))
    known = lambda kind: F.when(F.col(f"{kind}_ref").isNotNull(), F.struct(F.col(f"{kind}_ref").alias("ref"), F.col(f"{kind}_fraction").alias("at"), (F.col("seq") + F.col("earlier")).alias("seq")))
    own = own.select("trace", "piece", "earlier", F.last(known("start"), True).over(up).alias("since"), F.last(known("end"), True).over(down).alias("until"))
    spans = pieced.where("kind <> '_piece'").join(own, ["trace", "piece"])
    opened, closed = F.coalesce("open_start", F.lit(False)), F.coalesce("open_end", F.lit(False))
    filled = {"seq": F.when(closed, F.col("until.seq")).otherwise(F.col("seq") + F.col("earlier")), "start_ref": F.when(opened, F.col("since.ref")).otherwise(F.col("start_ref")), "start_fraction": F.when(opened, F.col("since.at")).otherwise(F.col("start_fraction")), "end_ref": F.when(closed, F.col("until.ref")).otherwise(F.col("end_ref")), "end_fraction": F.when(closed, F.col("until.at")).otherwise(F.col("end_fraction"))}
    whole = spans.withColumns(filled).where("kind <> 'failure' OR (start_ref IS NOT NULL AND end_ref IS NOT NULL)")
    named = F.from_json("trace", f"k {points.schema[key].dataType.simpleString()}")["k"]
    return whole.select(named.alias(key), *(F.col(c) for c in names[: names.index("trace")]))


def _after(transfers: DataFrame) -> DataFrame:
    """(trace, rank, v): the vector after each transfer but the last, which is the one that the next is entered with."""
    return entering(transfers).where("v IS NOT NULL").withColumn("rank", F.col("rank") - 1)
