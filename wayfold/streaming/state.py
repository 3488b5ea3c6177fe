"""The state of matching on streams, as Spark's list and map state with a timer."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wayfold.config import MatchConfig

STEPS = "n long, time_ms long, lon double, lat double"
#: A step's candidates as kernel.told gives them.
VECTOR = "vector array<struct<ref string, fraction double, lon double, lat double, seqprob double, filtprob double, before int, cost double, metres double, refs array<string>>>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def on_rocksdb(spark: SparkSession) -> None:
    """Sets RocksDB as the session's state store, which lists and maps need, where Spark's default is set.

    Queries that restart keep the store that their checkpoint names.
    """
    if spark.conf.get(_PROVIDER).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Matcher(StatefulProcessor):
    """kernel.Online for each vehicle of a stream, see replay.matched.

    Steps are a list, the candidates of each a map's value by the step's number. A batch
    writes the candidates of its own samples and removes those that k and tau_ms let go;
    what stays is not written again. One timer a vehicle clears both.
    """

    def __init__(self, path: str, config: MatchConfig, k: int, tau_ms: int, max_age_ms: int, columns: list[str], late: bool, monitor: bool):
        self.path, self.config, self.k, self.tau_ms, self.max_age_ms = path, config, k, tau_ms, max_age_ms
        self.columns, self.late, self.monitor = columns, late, monitor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.steps = handle.getListState("steps", STEPS)
        self.candidates = handle.getMapState("candidates", "n long", VECTOR)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        from wayfold.operators import graphstore, kernel, match

        graph = graphstore.opened(self.path, self.config.connect)
        online, held = kernel.Online(graph, self.config, self.k, self.tau_ms), [tuple(s) for s in self.steps.get()]
        vectors = {n: vector for (n,), (vector,) in self.candidates.iterator()} if held else {}
        for n, t, lon, lat in held:
            online.steps.append(((t, lon, lat), kernel.recalled(graph, vectors[n], online.steps[-1][1] if online.steps else [])))
        upto = held[-1][0] + 1 if held else 0

        listed: list[tuple] = []
        for frame in rows:
            told = zip(frame.time_ms, frame.lon, frame.lat, frame.geom_id, frame.fwd_ref, frame.back_ref, frame.d, frame.i, frame.along, frame.road_lon, frame.road_lat)
            listed += [(int(t), x, y, False, 0, None if pd.isna(g) else g, f, None if pd.isna(b) else b, {"d": d, "i": i}, a, rx, ry) for t, x, y, g, f, b, d, i, a, rx, ry in told]
        out, new = [], []
        for t, lon, lat, _, found in match.trace_of(listed, graph, self.config.radius_m):
            if online.steps and t < online.steps[-1][0][0]:
                if self.late:
                    out.append((key[0], t, lon, lat, None, None, None, True, *([None] if self.monitor else [])))
                continue
            before = online.steps[-1][1] if online.steps else []
            c = online.add(t, lon, lat, found)
            if c is not None:
                new.append(((upto + len(new), t, lon, lat), kernel.told(graph, online.steps[-1][1], before)))
                out.append((key[0], t, lon, lat, graph.ref(c.edge), c.fraction, c.filt, *([False] if self.late else []), *([online.monitor()] if self.monitor else [])))
        if new:
            self._write(held, new, len(online.steps))
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(max(new[-1][0][1], timerValues.getCurrentWatermarkInMs()) + self.max_age_ms)
        yield pd.DataFrame(out, columns=self.columns)

    def _write(self, held: list[tuple], new: list[tuple], n_kept: int) -> None:
        """Adds new steps and lets go of all but the last n_kept of both."""
        gone, skipped = max(0, len(held) + len(new) - n_kept), max(0, len(new) - n_kept)
        steps = [s for s, _ in new[skipped:]]
        if gone:
            self.steps.put(held[gone:] + steps)
        else:
            self.steps.appendList(steps)
        for n, *_ in held[:gone]:
            self.candidates.removeKey((n,))
        for (n, *_), vector in new[skipped:]:
            self.candidates.updateValue((n,), (vector,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        self.steps.clear()
        self.candidates.clear()
        return iter([])
