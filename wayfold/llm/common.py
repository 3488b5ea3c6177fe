"""What several operators share: the shared folder, written tables, buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.shared import materialize, new_path, shared_dir  # noqa: F401

#: A row's own number; doc_id may be null or repeated, so operators that must
#: tell rows apart use this one.
ROW = "_wf_row"


#: Rows that a task's Python holds at once, unless the session says otherwise. Spark
#: bounds the bytes of a batch too (spark.sql.execution.arrow.maxBytesPerBatch).
BATCH_ROWS = 1000
_ROWS_KEY, _ROWS_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def mapped(df: DataFrame, work, schema) -> DataFrame:
    """df.mapInArrow(work, schema) with small batches, and memory given back at a task's end.

    Python workers live on and serve other tasks; what their allocators keep would
    add up over the stages of a long application.
    """
    if df.sparkSession.conf.get(_ROWS_KEY) == _ROWS_DEFAULT:
        df.sparkSession.conf.set(_ROWS_KEY, str(BATCH_ROWS))

    def run(batches):
        import ctypes
        import gc

        import pyarrow

        try:
            yield from work(batches)
        finally:
            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return df.mapInArrow(run, schema)


def added(df: DataFrame, columns: dict[str, str], without: tuple[str, ...] = ()) -> DataFrame:
    """df with columns renamed to what they are called outside; they replace others of these names."""
    kept = [c for c in df.columns if c not in columns.values() and c not in columns and c not in without]
    return df.select(*kept, *(F.col(c).alias(name) for c, name in columns.items()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_remainder(id_col: str, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


#: A widely used pattern that splits text before merges, and the same for texts of
#: Latin letters in the syntax of the faster standard library.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT_LATIN = r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
#: Characters that the two libraries class differently, and all beyond Latin.
_NOT_LATIN = r"[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]"


def splitter(pattern: str):
    """A function from text to the list of its pre-tokens by this pattern."""
    import re

    import regex

    full = regex.compile(pattern).findall
    if pattern != SPLIT:
        return full
    other, latin = re.compile(_NOT_LATIN).search, re.compile(_SPLIT_LATIN).findall
    return lambda text: full(text) if other(text) else latin(text)
