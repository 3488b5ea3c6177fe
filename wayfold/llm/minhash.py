"""Near-duplicates by one-permutation hashing, banded buckets and star-shaped links.

A document's set of word shingles is hashed once. The hash range is cut into BINS
bins, each keeping its smallest hash; empty bins are filled by optimal
densification, that is from a bin that a hash of (bin, attempt) names. Bins are
banded into buckets. Documents with equal sets form one class first, so exact
copies cost one row. In a bucket only the links of a star are candidates, from its
hub to each other class; all candidates are confirmed on full sets.

A star may miss a link between two classes of which its hub links only one. So
buckets that still hold more than one component are taken up again, and there all
pairs across components are judged where they are, without being emitted: no link
between documents that share a bucket is lost.

Edge cases: null texts and texts without words have an empty set and link with
nothing; fewer words than a shingle make one shingle; repeated rows are copies;
rows with a null id take part, and components take the smallest id that is not
null; empty tables give empty results. What near_duplicates adds replaces columns of
docs with these names (a prefix gives it others); names that begin with _wf_ are
reserved.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import ROW, mapped, materialize, partitions
from wayfold.operators.network import connected_components

#: A link at similarity 0.8 shares no bucket with a chance of (1 - 0.8^5)^25 = 5e-5.
BANDS, BAND_ROWS = 25, 5
BINS = BANDS * BAND_ROWS
#: Classes that a task compares with as many others.
CHUNK = 2000
_SET, _TEXT, _SIZE = "_wf_set", "_wf_text", "_wf_size"


def _mix(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingler(ngram: int):
    """A function from text to the sorted distinct hashes of its word shingles.

    Words are runs of other than blanks and U+0009 to U+000D; A-Z are lower-cased.
    """
    import numpy as np
    import xxhash

    class Words(dict):
        def __missing__(self, word):
            self[word] = h = xxhash.xxh64_intdigest(word)
            return h

    memo = Words()

    def of(text: str | None):
        words = text.encode().lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(memo) > 150_000:
            memo.clear()
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        n = min(ngram, len(h))
        size = len(h) - n + 1
        out = np.full(size, n, np.uint64)
        for i in range(n):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + size])
        return np.unique(out)

    return of


def signer():
    """A function from a set of hashes to the keys of its BANDS buckets and a byte of each bin."""
    import numpy as np

    edges = np.array([(i << 64) // BINS + (i > 0) for i in range(BINS)], np.uint64)
    rng = np.random.default_rng(11)
    turns = rng.integers(0, BINS, (64, BINS))
    band = np.arange(BANDS, dtype=np.uint64)

    def of(hashes):
        at = np.searchsorted(hashes, edges)
        ends = np.append(at[1:], len(hashes))
        full = at < ends
        bins = np.zeros(BINS, np.uint64)
        bins[full] = hashes[at[full]]
        empty = np.flatnonzero(~full)
        turn = 0
        while len(empty):
            if turn == len(turns) - 1:  # hardly ever: the next full bin to the right
                sources = np.flatnonzero(full)
                bins[empty] = bins[sources[np.searchsorted(sources, empty) % len(sources)]]
                break
            source = turns[turn][empty]
            ok = full[source]
            bins[empty[ok]] = bins[source[ok]]
            empty, turn = empty[~ok], turn + 1
        keys = band
        for column in bins.reshape(BANDS, BAND_ROWS).T:
            keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
        return keys.astype(np.int64), bins.astype(np.uint8).tobytes()

    return of


def _sketch(docs: DataFrame, text_col: str, ngram: int) -> DataFrame:
    """docs with the text compressed, its set's size, fingerprint and bucket keys."""
    rows = docs.withColumn(ROW, F.monotonically_increasing_id())
    others = [c for c in rows.columns if c != text_col]
    schema = rows.select(*others, F.lit(b"").alias(_TEXT), F.lit(0).cast("long").alias(_SIZE), F.lit(b"").alias(_SET), F.array(F.lit(0).cast("long")).alias("_wf_keys"), F.lit(b"").alias("_wf_bins")).schema
    for field in schema.fields:
        field.nullable = True

    def sketch(batches):
        import hashlib

        import zstandard

        shingles, sign, pack = shingler(ngram), signer(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts, sizes, sets, keys, bins = [], [], [], [], []
            for text in batch.column(len(others)).to_pylist():
                hashes = shingles(text)
                texts.append(None if text is None else pack(text.encode()))
                sizes.append(len(hashes))
                sets.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                signed = sign(hashes) if len(hashes) else (None, None)
                keys.append(signed[0])
                bins.append(signed[1])
            added = [pa.array(texts, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bins, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *added], names=[*others, _TEXT, _SIZE, _SET, "_wf_keys", "_wf_bins"])

    return mapped(rows.select(*others, text_col), sketch, schema)


def _confirm(pairs: DataFrame, texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""

    def confirm(batches):
        import numpy as np
        import zstandard

        shingles, unpack = shingler(ngram), zstandard.ZstdDecompressor().decompress
        held: dict[int, np.ndarray] = {}

        def set_of(number, text):
            if number not in held:
                if len(held) >= 4000:
                    held.clear()
                held[number] = shingles(unpack(text.as_py()).decode())
            return held[number]

        for batch in batches:
            a, b = [], []
            for x, y, left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                one, two = set_of(x, left), set_of(y, right)
                common = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
                if 100 * common >= percent * (len(one) + len(two) - common):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    left = texts.select(F.col("class").alias("a"), F.col(_TEXT).alias("left"))
    right = texts.select(F.col("class").alias("b"), F.col(_TEXT).alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return mapped(both, confirm, "a long, b long")


def near_duplicates(docs: DataFrame, ngram: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with n_shingles long, component_id (type of the id), kept and keeper boolean.

    component_id is the smallest id that links reach, the row's own included; kept
    says that the row has that id. keeper is true for exactly one row of each
    component, one with the smallest id: repeated ids are told apart. The text comes
    compressed (with_text gives it back). prefix goes before the names of all four.
    """
    sketched = materialize(_sketch(docs, text_col, ngram), "sketches")
    filled = sketched.where(F.col(_SET).isNotNull())
    # What a class needs: its first row, one row's sketch, its smallest id, the row that stays.
    smallest = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(ROW)))
    classes = filled.groupBy(_SET).agg(F.min(ROW).alias("class"), F.first(_SIZE).alias("n"), F.first("_wf_keys").alias("keys"), F.first("_wf_bins").alias("bins"), F.min(id_col).alias("first_id"), smallest.alias("keeper_row"))
    classes = materialize(classes, "classes")
    members = classes.select("class", "n", F.explode("keys").alias("key"))
    hubs = members.groupBy("key").agg(F.min(F.struct("class", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1").select("key", "hub")
    members = materialize(members.join(hubs, "key"), "members")  # of buckets with company
    wanted = members.select("class")
    texts = filled.select(F.col(ROW).alias("class"), _TEXT).join(wanted, "class", "left_semi")
    profiles = materialize(texts.join(classes.select("class", "n", "keys", "bins"), "class"), "profiles")
    stars = members.where("class <> hub.class").select(F.col("class").alias("a"), F.col("hub.class").alias("b"), "n", F.col("hub.n").alias("nb"))
    fits = F.least("n", "nb") * 100 >= F.greatest("n", "nb") * percent
    stars = stars.where(fits).select("a", "b").distinct()
    labels = _labels(materialize(_confirm(stars, profiles, ngram, percent), "confirmed"))
    labelled = members.select("class", "key").join(labels, "class", "left").withColumn("root", F.coalesce("root", "class"))
    labels = _joined(labels, materialize(_across(labelled, profiles, ngram, percent), "across"))
    # Most classes are alone in their component; only the others meet.
    linked = classes.select("class", "first_id", "keeper_row").join(labels, "class")
    tops = linked.groupBy("root").agg(F.min("first_id").alias("top_id"), F.min("keeper_row").alias("top_row"))
    moved = linked.select("class", "root").join(tops, "root").select("class", "top_id", "top_row")
    placed = classes.select(_SET, "class", "first_id", "keeper_row").join(moved, "class", "left")
    placed = placed.select(_SET, F.when(F.col("top_row").isNull(), F.col("first_id")).otherwise(F.col("top_id")).alias("component_id"), F.coalesce("top_row", "keeper_row")[ROW].alias("_wf_keeper"))
    placed = placed.withColumnRenamed("component_id", "_wf_component")
    out = sketched.drop("_wf_keys", "_wf_bins").join(placed, _SET, "left")
    alone = F.col(_SET).isNull()
    component = F.when(alone, F.col(id_col)).otherwise(F.col("_wf_component"))
    told = {"n_shingles": F.col(_SIZE), "component_id": component, "kept": F.col(id_col).eqNullSafe(component), "keeper": alone | (F.col("_wf_keeper") == F.col(ROW))}
    told = {prefix + name: c for name, c in told.items()}
    return out.select(*(c for c in docs.columns if c != text_col and c not in told), *(c.alias(name) for name, c in told.items()), _TEXT)


def _labels(links: DataFrame) -> DataFrame:
    """(class, root) of the classes that links name."""
    return materialize(connected_components(links), "labels").withColumnRenamed("node", "class")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after more links."""
    if links.isEmpty():
        return labels
    ends = (labels.select(F.col("class").alias(x), F.col("root").alias(f"r{x}")) for x in ("a", "b"))
    moved = links.join(next(ends), "a", "left").join(next(ends), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    onward = _labels(moved).select(F.col("class").alias("old"), F.col("root").alias("new"))
    known = labels.join(onward, F.col("root") == F.col("old"), "left").select("class", F.coalesce("new", "root").alias("root"))
    fresh = onward.join(labels, F.col("old") == F.col("class"), "left_anti").select(F.col("old").alias("class"), F.col("new").alias("root"))
    return materialize(known.union(fresh), "labels")


def _across(labelled: DataFrame, profiles: DataFrame, ngram: int, percent: int) -> DataFrame:
    """Links (a, b) that join components which share buckets; all of them as components.

    labelled has key, class and root of all members. Only buckets with several roots
    are dealt out. Within a task all pairs across components are judged, but what is
    emitted are the links that joined something, fewer than the task has rows. A pair
    that shares several buckets is judged in the first. A bucket of more than CHUNK
    classes is cut: those of its commonest root meet all others, chunk by chunk, but
    not each other; the others meet each other.
    """
    by_root = labelled.groupBy("key", "root").agg(F.count("*").alias("size"))
    open_keys = by_root.groupBy("key").agg(F.count("*").alias("roots"), F.sum("size").alias("total"), F.max(F.struct("size", "root")).alias("top")).where("roots > 1")
    chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    large = F.col("total") > CHUNK
    open_keys = open_keys.select("key", large.alias("large"), F.col("top.root").alias("top"), chunks(F.col("top.size")).alias("m"), chunks(F.col("total") - F.col("top.size")).alias("k"))
    rows = labelled.join(open_keys, "key").withColumn("major", F.col("large") & (F.col("root") == F.col("top")))
    own = F.pmod(F.xxhash64("class"), F.when(F.col("major"), F.col("m")).otherwise(F.col("k"))).cast("int")
    rows = rows.withColumn("own", F.when(F.col("large"), own).otherwise(0))

    def places(n: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), make)

    def place(kind: int, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.alias("c1"), j.alias("c2"))

    meets_minor = places("k", lambda j: place(0, F.col("own"), j))
    meets_all = F.concat(places("m", lambda i: place(0, i, F.col("own"))), places("k", lambda j: place(1, F.least(F.col("own"), j), F.greatest(F.col("own"), j))))
    dealt = F.when(~F.col("large"), F.array(place(2, F.col("own"), F.col("own")))).when(F.col("major"), meets_minor).otherwise(meets_all)
    rows = rows.select("key", "class", "root", "major", "own", F.explode(dealt).alias("p")).join(profiles, "class")
    order = ["key", "kind", "c1", "c2"]
    rows = rows.select("key", "p.*", "class", "root", "major", "own", "n", "keys", "bins", _TEXT)
    rows = rows.repartition(partitions(rows.sparkSession), *order).sortWithinPartitions(*order, "class")
    least = BINS * (percent - 20) // 100

    def compare(batches):
        import numpy as np
        import zstandard

        shingles, unpack = shingler(ngram), zstandard.ZstdDecompressor().decompress

        def links(place, group):
            key, kind, c1, c2 = place
            names, roots, major, own, n, keys, bins, texts = zip(*group)
            label, n, major, own = np.array(roots), np.array(n), np.array(major), np.array(own)
            keys, bins = np.array(keys), np.frombuffer(b"".join(bins), np.uint8).reshape(len(group), BINS)
            band = int(np.argmax(keys[0] == key))
            sets = {}

            def set_of(i):
                if i not in sets:
                    sets[i] = shingles(unpack(texts[i]).decode())
                return sets[i]

            for i in range(len(group) - 1):
                j = np.arange(i + 1, len(group))
                ok = label[j] != label[i]
                if kind == 0:
                    ok &= major[j] != major[i]
                elif c1 != c2:
                    ok &= own[j] != own[i]
                ok &= np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * percent
                j = j[ok]
                if not len(j):
                    continue
                j = j[np.argmax(keys[j] == keys[i], 1) == band]
                # Of BINS bins, pairs at the threshold have that share in common, give or take
                # sqrt(0.16 / BINS) = 0.036. What is less by 0.2 (over five deviations) goes. Sets
                # with few shingles fill bins from each other; they are not judged this way.
                same = (bins[j] == bins[i]).sum(1)
                ok = (same >= least) | (np.minimum(n[j], n[i]) < BINS)
                for x in j[ok][np.argsort(-same[ok], kind="stable")].tolist():
                    if label[x] == label[i]:
                        continue
                    one, two = set_of(i), set_of(x)
                    common = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
                    if 100 * common >= percent * (len(one) + len(two) - common):
                        yield names[i], names[x]
                        label[label == label[x]] = label[i]

        def rows_of():
            current, group = None, []
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if row[:4] != current:
                        if len(group) > 1:
                            yield from links(current, group)
                        current, group = row[:4], []
                    group.append(row[4:])
            if len(group) > 1:
                yield from links(current, group)

        found = list(rows_of())  # fewer than the rows that came
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return mapped(rows, compare, "a long, b long")


def with_text(rows: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """What near_duplicates gives, with the text as it was, in the order of docs' columns."""
    columns = [c for c in docs.columns]
    others = [c for c in rows.columns if c != _TEXT]
    schema = rows.select(*others, F.lit("").alias(text_col)).schema
    for field in schema.fields:
        field.nullable = True

    def unpack(batches):
        import zstandard

        unpacked = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [None if t is None else unpacked(t).decode() for t in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string())], names=[*others, text_col])

    out = mapped(rows.select(*others, _TEXT), unpack, schema)
    return out.select(*columns, *[c for c in others if c not in columns])


COMPONENTS_SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), components AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN components c USING (doc_id)
"""
