"""The network as a table of edges by tile, opened by the tasks that need it.

write() puts each directed edge into the tile of its own first vertex, once, as Parquet
under the shared folder. A task that routes opens tiles as its search reaches them: an
edge names the tile in which it ends, and there are the edges that leave its node. So
neither the driver nor a task ever holds the network, and no edge is shuffled to a trace.

Where roads tell of one node in several tiles, each of these has a note of the others.
Candidates know their road's geometry, so they find their edge by its first vertex.

A tile is written and read as a whole: ACROSS is such that the densest cities have some
ten thousand edges in one. Tiles are squares of degrees, not of a projection, which would
put all that lies beyond its last latitude into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import roads as rd
from wayfold.operators import kernel, network
from wayfold.shared import new_path

#: Tiles of a turn of longitude, which are as many degrees of latitude high.
ACROSS = 1 << 13
#: Edges that a worker keeps from one trace to the next.
MOST_EDGES = 400_000


def tile_number(place: Column) -> Column:
    """The number of the tile of a struct(lon, lat)."""
    cell = lambda x: F.floor(x * (ACROSS / 360.0)).cast("long")
    return cell(place["lon"] + 180) * (1 << 20) + cell(place["lat"] + 90)


def named_roads(roads: DataFrame) -> DataFrame:
    """roads whose references begin with the tile in which their edge is found, as TileGraph.find takes them."""
    ends = {"fwd_ref": F.element_at("geometry", 1), "back_ref": F.element_at("geometry", -1)}
    back = F.nullif(F.trim("back_ref"), F.lit(""))
    refs = {"fwd_ref": F.col("fwd_ref"), "back_ref": back}
    return roads.withColumns({c: F.when(refs[c].isNotNull(), F.concat(tile_number(p).cast("string"), F.lit(":"), refs[c])) for c, p in ends.items()})


def write(roads: DataFrame, path: str | None = None) -> str:
    """Writes the graph of roads under a path that executors share, a new one if none is given; returns it."""
    return write_edges(network.edges(roads.where(F.size("geometry") > 0)), rd.cost_time_priority(F.col("length_m"), F.col("max_speed"), F.col("priority")), path)


def write_edges(edges: DataFrame, cost: Column, path: str | None = None) -> str:
    """write() of rows as network.edges gives them; they need no speeds if cost needs none."""
    path = path or new_path(edges.sparkSession, "graph")
    first, last = tile_number(F.element_at("geometry", 1)), tile_number(F.element_at("geometry", -1))
    none = F.lit(None).cast("array<long>").alias("others")
    own = edges.select(first.alias("tile"), "ref_id", "src", "dst", last.alias("next_tile"), "length_m", cost.alias("cost"), none)
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("node"), first.alias("t")), F.struct(F.col("dst").alias("node"), last.alias("t")))).alias("e"))
    apart = ends.groupBy("e.node").agg(F.sort_array(F.collect_set("e.t")).alias("others")).where(F.size("others") > 1)
    notes = apart.select(F.explode("others").alias("tile"), F.col("node").alias("src"), "others")
    rows = own.unionByName(notes, allowMissingColumns=True)
    rows.repartition("tile").sortWithinPartitions("tile", "ref_id").write.partitionBy("tile").parquet(path)
    return path


class _Successors(dict):
    def __init__(self, graph):
        super().__init__()
        self.graph = graph

    def __missing__(self, ref):
        graph = self.graph
        self[ref] = found = graph.leaving(*graph.to[ref]) if graph.connect else []
        return found


class TileGraph:
    """A stored graph, loaded tile by tile; edges are known by their reference. Stands in for kernel.Graph."""

    def __init__(self, path: str, connect: bool = True):
        from pyarrow import fs

        self.connect = connect
        self.store, self.root = fs.FileSystem.from_uri(path)
        self.clear()

    def clear(self) -> None:
        self.length, self.cost, self.to, self.tile_of, self.out = {}, {}, {}, {}, {}
        self.notes: dict[str, list[int]] = {}
        self.loaded: set[int] = set()
        self.least: int | None = None
        self.next = _Successors(self)
        self.searches = kernel.Searches()

    def make_room(self) -> None:
        """To be called after each search: forgets all tiles where they hold many edges, unless the first search since then loaded half of them."""
        if self.least is None:
            self.least = len(self.length)
        if len(self.length) > max(MOST_EDGES, 2 * self.least):
            self.clear()

    def load(self, tile: int) -> None:
        if tile in self.loaded:
            return
        import pyarrow.parquet as pq
        from pyarrow import fs

        self.loaded.add(tile)
        listed = self.store.get_file_info(fs.FileSelector(f"{self.root}/tile={tile}", allow_not_found=True))
        for file in sorted(f.path for f in listed if f.base_name.endswith(".parquet")):
            with self.store.open_input_file(file) as f:
                columns = pq.ParquetFile(f).read(columns=["ref_id", "src", "dst", "next_tile", "length_m", "cost", "others"])
            for ref, src, dst, onward, metres, cost, others in zip(*(c.to_pylist() for c in columns.columns)):
                if ref is None:
                    self.notes[src] = others
                    continue
                self.length[ref], self.cost[ref], self.to[ref], self.tile_of[ref] = metres, cost, (dst, onward), tile
                self.out.setdefault(src, []).append(ref)

    def leaving(self, node, tile: int) -> list[str]:
        """The edges that leave a node, known to be in a tile, in order."""
        self.load(tile)
        for other in self.notes.get(node, ()):
            self.load(other)
        return sorted(self.out.get(node, []))

    def find(self, name: str):
        """The edge of a name `tile:reference`; None if there is none."""
        tile, ref = name.split(":", 1)
        self.load(int(tile))
        return ref if ref in self.length else None

    def name(self, ref: str) -> str:
        return f"{self.tile_of[ref]}:{ref}"

    def ref(self, edge: str) -> str:
        return edge


_OPEN: dict[tuple[str, bool], TileGraph] = {}


def opened(path: str, connect: bool = True) -> TileGraph:
    """The worker's view of a stored graph, kept from trace to trace while it is small."""
    graph = _OPEN.get((path, connect))
    if graph is None:
        _OPEN.clear()  # of one graph at a time
        graph = _OPEN[path, connect] = TileGraph(path, connect)
    elif len(graph.length) > MOST_EDGES:
        graph.clear()
    return graph
