"""Periodic runs of words, found by Karp, Miller and Rosenberg's naming.

The words of a document get numbers; a window of 2^(k+1) words is named by the names
of its two halves of 2^k, level by level, until no window of a level occurs twice. The
common extension of two places, forward or backward, is read off by descending levels:
where the names agree, both places move on by that window.

A run of period p and at least `repeats` times p words agrees with itself, p words on,
at (repeats - 1) p places, so whatever the run's start one multiple of (repeats - 2) p is
followed by p more of them. So such multiples i are the candidates: those whose window
of the largest power of two up to p is named as that of i + p are extended both ways.
A stretch found by several periods has the smallest; all others are multiples of it.

Documents are packed, PACK words at least if there are as many, since numpy works on
whole arrays; words of different documents never get one number, so nothing reaches
across. A task holds a pack, or one document if that is longer, and SLAB candidates.

Edge cases: null, empty and blank texts have no words, no runs and an empty text; ties
for the greatest exponent go to the smallest start, then to the smallest period; each
row is judged on its own, repeated rows and null ids too; empty tables give empty
results; texts are taken whole. Columns pass through, but for those named as the outputs.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfold.llm.common import mapped

#: Words of a pack, and candidates that are extended at once.
PACK, SLAB = 1 << 18, 1 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = "n_words long, runs array<struct<start:long,length:long,period:long>>, strongest struct<start:long,length:long,period:long>, collapsed string"


def levels(names) -> list:
    """Names of the windows of 1, 2, 4, ... items by their start, as long as some window of that size occurs twice."""
    import numpy as np

    out, repeated = [names.astype(np.int64)], np.bincount(names, minlength=1)[names] > 1
    while repeated.any():
        half = 1 << (len(out) - 1)
        last, m = out[-1], len(out[-1]) - half
        if m <= 0:
            break
        # only a window both of whose halves occur twice can itself
        some = np.flatnonzero(repeated[:m] & repeated[half : half + m])
        pairs = last[some] * (int(last.max()) + 1) + last[some + half]
        _, inverse, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        fresh, repeated = np.arange(m) + len(counts), np.zeros(m, bool)
        fresh[some], repeated[some] = inverse, counts[inverse] > 1
        if repeated.any():
            out.append(fresh)
    return out


def _extended(named: list, i, j, back: bool):
    """How many items agree from places i and j on (back: before them); i < j."""
    import numpy as np

    i, j, far = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(named) - 1, -1, -1):
        size, names = 1 << k, named[k]
        at, other = (i - size, j - size) if back else (i, j)
        fits = np.flatnonzero(at >= 0 if back else other < len(names))
        same = fits[names[at[fits]] == names[other[fits]]]
        step = -size if back else size
        i[same] += step
        j[same] += step
        far[same] += size
    return far


def find(names, longest: int, words: int = 6, repeats: int = 4):
    """(start, end, period) of all runs in an array of numbers; none is longer than longest."""
    import numpy as np

    if repeats < 3:
        raise ValueError("a run must repeat at least three times")
    found = [np.empty((0, 3), np.int64)]
    n = len(names)
    named = levels(names) if n else []

    def take(i, p):
        back, on = _extended(named, i, i + p, True), _extended(named, i, i + p, False)
        start, end = i - back, i + p + on
        fits = end - start >= np.maximum(words, repeats * p)
        found.append(np.unique(np.column_stack([start, end, p])[fits], axis=0))

    for k, level in enumerate(named):
        periods = np.arange(1 << k, min(2 << k, longest // repeats + 1))
        counts = np.maximum(0, (len(level) - 1 - periods) // ((repeats - 2) * periods) + 1)
        waiting, total = [], 0
        first = 0
        while first < len(periods):  # a slab of periods
            ends = np.cumsum(counts[first:])
            last = first + max(1, int(np.searchsorted(ends, SLAB, "right")))
            p = np.repeat(periods[first:last], counts[first:last])
            nth = np.arange(len(p)) - np.repeat(ends[: last - first] - counts[first:last], counts[first:last])
            i = nth * (repeats - 2) * p
            same = level[i] == level[i + p]
            waiting.append((i[same], p[same]))
            total += int(same.sum())
            first = last
            if total >= SLAB or first == len(periods):
                i, p = (np.concatenate(c) for c in zip(*waiting))
                for at in range(0, len(i), SLAB):
                    take(i[at : at + SLAB], p[at : at + SLAB])
                waiting, total = [], 0
    every = np.unique(np.concatenate(found), axis=0)  # in order of start, end, period
    fresh = np.ones(len(every), bool)
    fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    return every[fresh]


def _told(texts: list, words: int, repeats: int):
    """A pack's columns: words, runs, strongest run and collapsed text of each document."""
    import numpy as np

    each = [t.split() for t in texts]  # bytes are split at ASCII blanks alone
    sizes = np.array([len(w) for w in each])
    ends = np.cumsum(sizes)
    starts, flat = ends - sizes, [w for ws in each for w in ws]
    codes = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if flat else np.empty(0, np.int64)
    own = np.repeat(np.arange(len(each)), sizes) * (int(codes.max(initial=0)) + 1) + codes
    runs = find(np.unique(own, return_inverse=True)[1], int(sizes.max(initial=0)), words, repeats)
    gone = np.zeros(len(flat) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    kept = np.cumsum(gone)[:-1] == 0
    doc = np.searchsorted(ends, runs[:, 0], "right")
    listed: list[list[tuple]] = [[] for _ in each]
    for d, (start, end, period) in zip(doc.tolist(), runs.tolist()):
        listed[d].append((start - int(starts[d]), end - start, period))
    for d in listed:
        d.sort(key=lambda r: (r[0], r[2]))
    strongest, collapsed = [], []
    for d, ws in enumerate(each):
        best = None
        for r in listed[d]:  # earlier ones win ties
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        strongest.append(best)
        collapsed.append(b" ".join(w for w, k in zip(ws, kept[starts[d] : ends[d]].tolist()) if k) if listed[d] else b" ".join(ws))
    names = ("start", "length", "period")
    return [pa.array(sizes, pa.int64()), pa.array([[dict(zip(names, r)) for r in d] for d in listed], pa.list_(_RUN)), pa.array([b and dict(zip(names, b)) for b in strongest], _RUN), pa.array(collapsed, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, text_col: str = "text", words: int = 6, repeats: int = 4) -> DataFrame:
    """docs with n_words, runs (by start, then period), the strongest run (greatest length / period, null without runs) and the collapsed text.

    A run is a maximal stretch with smallest period q and at least max(words, repeats * q)
    words; collapsed keeps its first q words. start counts words from 0.
    """
    added = StructType.fromDDL(OUT)
    inner = docs.select(F.col(text_col).alias("_wf_text"), *(c for c in docs.columns if c not in added.names))

    def work(batches):
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(0).to_pylist()]
            first, size = 0, 0
            for at, text in enumerate(texts):
                size += len(text)
                if size >= 6 * PACK or at == len(texts) - 1:
                    part = batch.slice(first, at + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns[1:], *_told(texts[first : at + 1], words, repeats)], names=[*part.schema.names[1:], *added.names])
                    first, size = at + 1, 0

    return mapped(inner, work, StructType([*inner.schema.fields[1:], *added.fields]))


def planted(id_col: str = "doc_id", text_col: str = "text", words_col: str = "_wf_words") -> Column:
    """The text in which each tenth document (by crc32 of its id) repeats a stretch of its words_col to the end."""
    h, n = F.crc32(F.col(id_col).cast("string")), F.size(words_col)
    g = F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    turned = F.transform(words_col, lambda w, i: F.when(i < a, w).otherwise(F.get(F.col(words_col), (a + (i - a) % p).cast("int"))))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(turned, " ")).otherwise(F.col(text_col))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
