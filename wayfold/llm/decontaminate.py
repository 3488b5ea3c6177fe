"""Benchmark decontamination by a hash set of normalised n-grams.

Native: DataFrame expressions only, and one method at every size. Texts and
benchmark items become words; each window of WINDOW item words (or a shorter item
as a whole) is an n-gram of the set. The set travels as bits: two hash slots of
each window, in one array of longs that Spark hands to all tasks as the result of a
scalar subquery. Its size follows the benchmark, BITS for each window, MOST_BITS in
all; fewer bits only mean more false alarms. Documents are scanned where they are:
each window's hash is looked up in the bits, and only what passes is compared with
the windows themselves, as text, by a join.

Hits belong to texts, so they are keyed by a fingerprint of the text (64 and 32 bits
of hash, and the length), not by numbers of rows: a plan that runs twice, or after
executors were lost, gives the same keys, and copies of a text have their hits found
in one group.

Edge cases: null texts have no words and no hits; items without words are
skipped; those with a null id are hit and removed as others, but have no place in
n_items and items_sha256; repeated rows are judged row by row; empty tables give no
hits; texts are taken whole. Names that begin with _wf_ are reserved. What find adds
replaces columns of docs with these names; the other functions keep all columns of docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import materialize

WINDOW = 10
#: Bits of the set for each window, and at least and at most in all (2^28 are 32 MB).
BITS, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 28
#: Texts with hits up to which their keys are broadcast, so that no document is shuffled.
BROADCAST_TEXTS = 1_000_000
#: What stands between words, which are runs of 0-9, a-z and all beyond ASCII, after A-Z were lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["_wf_k1", "_wf_k2", "_wf_k3"]
_HIT = "array<struct<at:int,len:int,window:string>>"


def words(text: Column) -> Column:
    """The words of a text; splitting costs a fifth of extracting them by a pattern."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN), "")


def _hash(array: str, at: str, size: int) -> str:
    """SQL for the hash of so many words of an array from a position on; nulls beyond its end count for nothing."""
    return "xxhash64(" + ", ".join(f"get({array}, {at} + {k})" for k in range(size)) + ")"


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(len int, window string, items array<string>): each distinct window and the items that have it, without null ids."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    items = items.withColumn("len", F.least(F.size("w"), F.lit(window)))
    starts = items.select("item", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))).alias("window"))
    return starts.groupBy("len", "window").agg(F.collect_set("item").alias("items"))


def _bits(windows: DataFrame, size: int, window: int) -> DataFrame:
    """One row: the set as an array of longs, two slots of each window's hash."""
    hashed = windows.select(F.split("window", " ").alias("w")).select(F.expr(_hash("w", "0", window)).alias("h"))
    slots = hashed.select(F.explode(F.array(F.expr(f"h & {size - 1}L"), F.expr(f"shiftrightunsigned(h, 32) & {size - 1}L"))).alias("s"))
    filled = slots.groupBy(F.expr("shiftright(s, 6)").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 AS int))")).alias("b"))
    whole = windows.sparkSession.range(size // 64).join(filled, "id", "left")
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("long")).alias("b")))), lambda x: x["b"]).alias("bits"))


def _keys(text: Column) -> list[Column]:
    known = F.coalesce(text, F.lit(""))
    return [c.alias(k) for k, c in zip(_KEY, (F.xxhash64(known), F.hash(known), F.length(known)))]


def found(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Each distinct text with hits: its key, hits array<struct<at int, len int, window string>> and items array<string>."""
    windows = materialize(benchmark_windows(benchmark, text_col="text", window=window), "windows")
    sizes = {r[0]: r[1] for r in windows.groupBy("len").count().collect()}  # one for each length, 10 at most
    total = max(1, sum(sizes.values()))
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS * total - 1).bit_length()))
    # explode of one item computes its content once; the optimizer would else move it to wherever it is used
    texts = docs.select(F.explode(F.array(F.struct(words(F.col(text_col)).alias("w"), *_keys(F.col(text_col))))).alias("t")).select("t.*").withColumn("n", F.size("w")).where("n > 0")
    places = texts.withColumn("at", F.explode(F.expr("sequence(0, n - 1)")))
    tried = ", ".join(f"struct({n} AS len, {_hash('w', 'at', n)} AS h)" for n in sorted(sizes) or [window])
    places = places.withColumn("c", F.explode(F.expr(f"array({tried})")))
    bits, h = _bits(windows, size, window).scalar(), F.col("c.h")
    slots = (h.bitwiseAND(size - 1), F.shiftrightunsigned(h, 32).bitwiseAND(size - 1))
    set_ = [F.getbit(F.get(bits, F.shiftright(s, 6).cast("int")), s.bitwiseAND(63).cast("int")) == 1 for s in slots]
    passed = places.where((F.col("at") <= F.col("n") - F.col("c.len")) & set_[0] & set_[1])
    passed = passed.select(*_KEY, "at", "c.len", F.array_join(F.slice("w", F.col("at") + 1, F.col("c.len")), " ").alias("window")).distinct()
    hits = passed.join(windows, ["len", "window"])
    told = hits.groupBy(*_KEY).agg(F.collect_list(F.struct("at", "len", "window")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # written, so that Spark knows its size: it is broadcast where small, and else hot texts of the other side can be split
    return materialize(told, "hits")


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words int and hits array<struct<at int, len int, window string>>, at from 0."""
    rows = _with_hits(docs, found(docs, benchmark, text_col, window), text_col)
    return rows.withColumns({"n_words": F.size(words(F.col(text_col))), "hits": F.col("_wf_hits")}).select(*(c for c in docs.columns if c not in ("n_words", "hits")), "n_words", "hits")


def _with_hits(docs: DataFrame, hits: DataFrame, text_col: str) -> DataFrame:
    """docs with _wf_hits and _wf_items, by the texts' keys."""
    told = hits.select(*_KEY, F.col("hits").alias("_wf_hits"), F.col("items").alias("_wf_items"))
    out = docs.select("*", *_keys(F.col(text_col))).join(told, _KEY, "left").drop(*_KEY)
    return out.withColumns({"_wf_hits": F.coalesce("_wf_hits", F.array().cast(_HIT)), "_wf_items": F.coalesce("_wf_items", F.array().cast("array<string>"))})


def covered_words(hits: Column) -> Column:
    """How many words lie inside any of the hits."""
    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(h["at"].alias("at"), (h["at"] + h["len"]).alias("end"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc, h):
        return F.struct(F.greatest(acc["end"], h["end"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(acc["end"], h["at"]))).alias("n"))

    return F.aggregate(ordered, start, add, lambda acc: acc["n"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs without the rows that hold any benchmark window.

    The keys of texts with hits, 20 bytes each, go to the documents where they are at
    most BROADCAST_TEXTS; else documents and keys are joined as Spark chooses.
    """
    hits = found(docs, benchmark, text_col, window).select(*_KEY)
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_TEXTS else hits
    return docs.select("*", *_keys(F.col(text_col))).join(hits, _KEY, "left_anti").select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with the hit words cut from their texts; rows without hits stay as they are.

    Each run of hit words, with what stands between them, becomes one line break.
    """
    rows = _with_hits(docs, found(docs, benchmark, text_col, window), text_col).withColumn("_wf_words", F.when(F.size("_wf_hits") > 0, words(F.col(text_col))))
    ordered = F.array_sort(F.transform("_wf_hits", lambda h: F.struct(h["at"].alias("at"), (h["at"] + h["len"]).alias("end"))))

    def merge(runs, h):
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.struct(last["at"].alias("at"), F.greatest(last["end"], h["end"]).alias("end"))
        apart = F.coalesce(last["end"] < h["at"], F.lit(True))
        return F.when(apart, F.concat(runs, F.array(h))).otherwise(F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(longer)))

    runs = F.aggregate(ordered, F.array().cast("array<struct<at:int,end:int>>"), merge)
    between, edge = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

    def pattern(run) -> Column:
        """Words have no characters that mean something in a pattern."""
        return F.concat(F.lit(f"(?i)(?<!{edge})"), F.array_join(F.slice(F.col("_wf_words"), run["at"] + 1, run["end"] - run["at"]), between + "+"), F.lit(f"(?!{edge})"))

    text = F.aggregate(runs, F.col(text_col), lambda t, run: F.regexp_replace(t, pattern(run), F.lit("\n")))
    return rows.withColumn(text_col, F.when(F.size("_wf_hits") > 0, text).otherwise(F.col(text_col))).select(*docs.columns)


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = found(docs, benchmark).select(*_KEY, covered_words(F.col("hits")).alias("n_hit"), "items")
    rows = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), *_keys(F.col("text"))).join(hits, _KEY, "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


DIGEST_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)
), hits AS (SELECT d.doc_id, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON d.win = t.win AND d.n = t.n
), hit_words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
