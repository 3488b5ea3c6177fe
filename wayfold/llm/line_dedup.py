"""Lines that many documents have are dropped from all of them.

Each text is split into lines, a line's key is hashed to 128 bits, and the lines are
exploded: a hash found in at least min_docs documents is frequent. Places of frequent
lines come back by a join on the hash, are gathered for their document, and the other
lines are joined in order of position.

A document's distinct hashes are told before the explode, so counting needs no
distinct over rows: it is a sum with partial sums on the map side. In the join back a
hash that holds 1/HEAVY or more of all frequent places would be a hot key; there are at
most HEAVY of these, so they are broadcast, whatever the size of the data. Any other
key holds less than that share. Texts are shuffled once, to meet their dropped positions.

Edge cases: a null or empty text is one empty line; keys shorter than min_chars are
never dropped; a document that loses all lines has the empty text; a line repeated
within one document counts once for it and is dropped at every place; each row is a
document of its own, repeated rows and null ids too; empty tables give empty results;
texts are taken whole. Columns of docs pass through, but for those named as the outputs.
Names that begin with _wf_ are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import ROW, added, materialize

#: The blanks that a key is stripped of, and the letters that it has in lower case.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A hash with this share (1/HEAVY) of the places of frequent lines is broadcast; there can't be more of them than HEAVY.
HEAVY = 4096
_HASHES, _DROPS = "_wf_hashes", "_wf_drops"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashed(line: Column, min_chars: int) -> Column:
    """128 bits of a line's key; null for keys too short to drop."""
    key = F.btrim(line, F.lit(BLANKS))
    return F.when(F.length(key) >= min_chars, F.struct(F.xxhash64(F.lit(1), key).alias("a"), F.xxhash64(F.lit(2), key).alias("b")))


def frequent(rows: DataFrame, min_docs: int) -> DataFrame:
    """(a, b, n): the hashes that at least min_docs rows have, and how many do."""
    own = rows.select(F.explode(F.array_distinct(_HASHES)).alias("h")).where("h IS NOT NULL").select("h.a", "h.b")
    return own.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)


def _dropped(rows: DataFrame, common: DataFrame) -> DataFrame:
    """(row, positions): where a row's frequent lines are; rows without any are left out."""
    total = common.agg(F.sum("n")).first()[0] or 0
    places = rows.select(ROW, F.posexplode(_HASHES).alias("at", "h")).where("h IS NOT NULL").select(ROW, "at", "h.a", "h.b")
    is_heavy = F.col("n") * HEAVY >= total
    heavy = F.broadcast(common.where(is_heavy).select("a", "b"))
    rest = common.where(~is_heavy).select("a", "b")
    hit = places.join(heavy, ["a", "b"], "left_semi").select(ROW, "at").union(places.join(heavy, ["a", "b"], "left_anti").join(rest, ["a", "b"], "left_semi").select(ROW, "at"))
    return hit.groupBy(ROW).agg(F.collect_list("at").alias(_DROPS))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", n_lines_out: str = "n_lines", n_dropped_out: str = "n_dropped") -> DataFrame:
    """docs with the lines that at least min_docs of them have taken out of their texts, the number of lines before, and of those dropped."""
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER)
    rows = materialize(docs.select(F.monotonically_increasing_id().alias(ROW), *docs.columns, F.transform(lines(lowered), lambda x: _hashed(x, min_chars)).alias(_HASHES)), "lines")
    common = materialize(frequent(rows, min_docs), "frequent-lines")
    joined = rows.withColumn(n_lines_out + "_wf", F.size(_HASHES)).drop(_HASHES).join(_dropped(rows, common), ROW, "left")
    # explode of one item binds the lines once; inside the lambda they would be split again for each line
    bound = joined.withColumn("_wf_lines", F.explode(F.array(F.when(F.col(_DROPS).isNotNull(), lines(F.col(text_col))))))
    left = F.array_except(F.sequence(F.lit(0), F.size("_wf_lines") - 1), F.col(_DROPS))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("_wf_lines"), i)), "\n")
    out = bound.withColumns({"_wf_text": F.when(F.col(_DROPS).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept), "_wf_n": F.col(n_lines_out + "_wf").cast("long"), "_wf_d": F.coalesce(F.size(_DROPS), F.lit(0)).cast("long")})
    return added(out, {"_wf_text": text_col, "_wf_n": n_lines_out, "_wf_d": n_dropped_out}, (ROW, _DROPS, "_wf_lines", n_lines_out + "_wf"))


KEPT_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents
), keyed AS (SELECT *, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (SELECT key AS hit FROM keyed WHERE length(key) >= 1 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10
), judged AS (SELECT keyed.*, hit FROM keyed LEFT JOIN common ON key = hit)
SELECT doc_id, count(*) AS n_lines, count(hit) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE hit IS NULL), '')) AS kept_sha256
FROM judged GROUP BY 1
"""
