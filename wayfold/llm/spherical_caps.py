"""Embedding near-duplicates by spherical-cap filters from random product codes.

Vectors are rotated at random and cut into blocks, each with a random code on its
sphere. A filter is one codeword of every block: a direction. A vector is listed
with the TOP filters nearest to it, found by list decoding: block by block, keeping
the best so far. Several codes are used, each with its own cut and codewords: as many
as let RECALL of random pairs at the least cosine share a filter. That chance depends
on nothing but count, length and cosine, and is measured before the tables are read;
if MOST_CODES don't reach it, filters become fewer and wider, but never fewer than
LEAST_FILTERS: the decoder runs at every count. Vectors that share a filter are compared
in double precision.

Within a filter all pairs are compared, but none is emitted: a task gives each
vector's number of links and a root to reach. A pair that shares several filters
counts in the smallest only. Filters with more than CHUNK vectors are dealt out as
pairs of chunks. Equal vectors (of one 128-bit hash) form one class with a weight first.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different lengths don't link; repeated
rows and null ids take part row by row; empty tables give empty results; numbers may
be as large or small as doubles are; only the id and the vector are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from wayfold.llm.common import ROW, mapped, materialize, partitions
from wayfold.operators.network import connected_components

#: Filters of a code that list a vector, and vectors that a filter lists on average.
TOP, FILL = 4, 16
#: Share of pairs at the least cosine that must share a filter, of so many planted ones.
RECALL, PLANTED = 0.995, 2000
#: Codes at most, before filters are made wider.
MOST_CODES = 8
#: Filters of a code at least: with these, MOST_CODES let more than RECALL of any linked pairs meet.
LEAST_FILTERS = 16
#: Most codewords of a block, and vectors that one task compares with as many others.
CODEWORDS, CHUNK = 2048, 1500


def decoder(dim: int, blocks: int, words: int, codes: int):
    """A function from unit vectors (rows) to an iterator with an array of each code: row by row, the filters that list it."""
    import numpy as np

    rng = np.random.default_rng(dim * 1000 + blocks)
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    edges = np.linspace(0, dim, blocks + 1).astype(int)
    made = []
    for _ in range(codes):
        order, parts = rng.permutation(dim), []
        for a, b in zip(edges, edges[1:]):
            code = rng.standard_normal((b - a, words))
            parts.append((order[a:b], code / np.linalg.norm(code, axis=0) * np.sqrt((b - a) / dim)))
        made.append(parts)

    def best(sums, names):
        k = min(TOP, sums.shape[1])
        at = np.argpartition(-sums, k - 1, axis=1)[:, :k]
        return np.take_along_axis(sums, at, 1), np.take_along_axis(names, at, 1)

    def of(x):
        x = x @ turn
        for parts in made:
            totals, names = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
            for columns, code in parts:
                scores, at = best(x[:, columns] @ code, np.broadcast_to(np.arange(words), (len(x), words)))
                totals, names = best((totals[:, :, None] + scores[:, None, :]).reshape(len(x), -1), (names[:, :, None] * words + at[:, None, :]).reshape(len(x), -1))
            yield names

    return of


def planted(n: int, dim: int, cosine: float, seed: int = 7):
    """n random pairs of unit vectors at this cosine."""
    import numpy as np

    a, b = np.random.default_rng(seed).standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)  # one number has no other direction
    if dim == 1:
        return a, a
    return a, cosine * a + max(0.0, 1 - cosine**2) ** 0.5 * b


def unit(x):
    """Rows of length 1; scaled by their largest number first, so that no square overflows or vanishes."""
    import numpy as np

    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sized(count: int, dim: int, cosine: float) -> tuple[int, int, int]:
    """Blocks, codewords and codes for so many vectors."""
    import numpy as np

    filters = max(LEAST_FILTERS, count * TOP // FILL)
    a, b = planted(PLANTED, dim, cosine)
    while True:
        blocks = 2 if dim >= 8 else 1
        while CODEWORDS**blocks < filters and blocks < dim // 4:
            blocks += 1
        words = min(CODEWORDS, int(np.ceil(filters ** (1 / blocks))))
        of, met = decoder(dim, blocks, words, MOST_CODES), np.zeros(len(a), bool)
        for codes, (x, y) in enumerate(zip(of(a), of(b)), 1):
            met |= (x[:, :, None] == y[:, None, :]).any((1, 2))
            if met.mean() >= RECALL:
                return blocks, words, codes
        if filters == LEAST_FILTERS:
            return blocks, words, MOST_CODES
        filters = max(LEAST_FILTERS, min(filters, words**blocks) // 4)


def _listed(classes: DataFrame, sizes: dict[int, tuple[int, int, int]]) -> DataFrame:
    """classes with the sorted filters that list each vector, and its numbers as bytes: floats where they are exact, else doubles."""

    def work(batches):
        import numpy as np

        decode: dict[int, object] = {}
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            lists, packed = [None] * len(vectors), [None] * len(vectors)
            by_dim: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_dim.setdefault(len(v), []).append(i)
            for dim, at in by_dim.items():
                x = np.array([vectors[i] for i in at], float)
                with np.errstate(over="ignore"):
                    short = x.astype(np.float32)
                for i, v, s, exact in zip(at, x, short, (short == x).all(1)):
                    packed[i] = (s if exact else v).tobytes()
                x = unit(x)
                if dim not in decode:
                    decode[dim] = decoder(dim, *sizes[dim])
                names = [n + (k << 40) for k, n in enumerate(decode[dim](x))]
                for i, own in zip(at, np.sort(np.concatenate(names, axis=1), axis=1) + (dim << 44)):
                    lists[i] = own
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=["class", "weight", "packed", "filters"])

    return mapped(classes.select("class", "weight", "v"), work, "class long, weight long, packed binary, filters array<long>")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vectors' ids with n_links long, component_id (type of the id) and kept boolean.

    n_links counts the other rows linked directly; component_id is the smallest id
    that links reach; kept says that the row has that id.
    """
    spark = vectors.sparkSession
    raw = F.col(vector_col)
    of_floats = vectors.select(raw.alias("v")).schema["v"].dataType == ArrayType(FloatType())
    rows = vectors.select(F.monotonically_increasing_id().alias(ROW), F.col(id_col).alias("id"), (raw if of_floats else raw.cast("array<double>")).alias("v"))
    fine = F.coalesce(F.size("v") > 0, F.lit(False)) & ~F.exists("v", lambda c: F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True))) & F.exists("v", lambda c: c != 0)
    # equal vectors are told by 128 bits, so that the vectors themselves are shuffled once
    hashes = {f"h{i}": F.when(fine, F.xxhash64(F.lit(i), F.size("v"), "v")) for i in (1, 2)}
    rows = materialize(rows.withColumns(hashes).withColumn("v", F.when(F.col("h1").isNotNull(), F.col("v"))), "vectors")
    classes = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min(ROW).alias("class"), F.count("*").alias("weight"), F.min("id").alias("first_id"), F.min_by("v", ROW).alias("v"))
    classes = materialize(classes, "vector-classes")
    counts = {r[0]: r[1] for r in classes.groupBy(F.size("v")).count().collect()}  # a row for each length
    index = materialize(_listed(classes, {dim: sized(n, dim, cosine) for dim, n in counts.items()}), "filters")
    entries = index.select("*", F.posexplode("filters").alias("at", "filter")).withColumn("smaller", F.slice("filters", F.lit(1), F.col("at"))).drop("filters", "at")
    large = entries.groupBy("filter").count().where(F.col("count") > CHUNK).select("filter", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    large = materialize(large, "large-filters")  # of known size: entries aren't shuffled to meet few of them
    entries = entries.join(large, "filter", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    # a chunk meets itself and each other chunk once
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    entries = entries.select("filter", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "own", "class", "weight", "packed", "smaller")
    dealt = entries.repartition(partitions(spark), "filter", "c1", "c2").sortWithinPartitions("filter", "c1", "c2", "class")

    def compare(batches):
        import numpy as np

        def links(key, group):
            """(class, root, links) of the linked vectors of one pair of chunks."""
            name, c1, c2 = key
            ids, weights = np.array([g[1] for g in group]), np.array([g[2] for g in group], float)
            dim = name >> 44
            x = np.array([np.frombuffer(g[3], np.float32 if len(g[3]) == 4 * dim else float) for g in group], float)
            x = unit(x)
            linked = x @ x.T >= cosine
            np.fill_diagonal(linked, False)
            if c1 != c2:
                own = np.array([g[0] for g in group])
                linked &= own[:, None] != own[None, :]
            some = np.flatnonzero(linked.any(1))
            if not len(some):
                return
            linked, ids, weights = linked[np.ix_(some, some)], ids[some], weights[some]
            # pairs that also share a smaller filter count there
            smaller = [group[i][4] for i in some]
            columns, counts = np.unique(np.concatenate([np.array(s, np.int64) for s in smaller]), return_counts=True)
            columns = columns[counts > 1]
            counted = linked.copy()
            for a in range(0, len(columns), 512):
                part = columns[a : a + 512]
                has = np.zeros((len(some), len(part)), np.float32)
                for i, s in enumerate(smaller):
                    s = np.array(s, np.int64)
                    at = np.searchsorted(part, s)
                    ok = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == s)
                    has[i, at[ok]] = 1
                counted &= has @ has.T == 0
            n = counted @ weights
            root = np.arange(len(some))
            while True:  # each takes the smallest root among its links
                least = np.minimum(root, np.where(linked, root[None, :], len(root)).min(1))
                least = np.minimum(least, least[least])
                if (least == root).all():
                    break
                root = least
            yield from zip(ids.tolist(), ids[root].tolist(), n.astype(np.int64).tolist())

        def rows_of():
            current, group = None, []
            for batch in batches:
                for f, c1, c2, own, cls, weight, packed, smaller in zip(*(c.to_pylist() for c in batch.columns)):
                    if (f, c1, c2) != current:
                        if len(group) > 1:
                            yield from links(current, group)
                        current, group = (f, c1, c2), []
                    group.append((own, cls, weight, packed, smaller))
            if len(group) > 1:
                yield from links(current, group)

        out = []
        for row in rows_of():
            out.append(row)
            if len(out) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["class", "root", "n"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["class", "root", "n"])

    found = materialize(mapped(dealt, compare, "class long, root long, n long"), "vector-links")
    n_links = found.groupBy("class").agg(F.sum("n").alias("n"))
    labels = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    placed = classes.drop("v").join(n_links, "class", "left").join(labels, "class", "left").withColumn("root", F.coalesce("root", "class"))
    tops = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    placed = placed.join(tops, "root").select("h1", "h2", "weight", "n", "component_id")
    out = rows.select("id", "h1", "h2").join(placed, ["h1", "h2"], "left")
    alone = F.col("h1").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.when(alone, 0).otherwise(F.coalesce("n", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


LINKS_SQL = r"""
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95
), reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), components AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN degrees d USING (vec_id) LEFT JOIN components c USING (vec_id)
"""
