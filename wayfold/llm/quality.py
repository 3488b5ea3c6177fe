"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. It is learned from
preference pairs (a document marked good over one marked bad) by logistic loss on
feature differences: from all pairs of all labelled documents. A pair's weight depends
on its two strengths alone, so each round of Newton's method takes sums over documents
by class and narrow bin of strength (BIN), added up on the executors, and the driver
pairs bins, each at its mean strength. The threshold is a quantile of the learned
strengths: the share of bad documents among those learned from. Scores are strengths on
a logistic scale that puts this quantile at THRESHOLD.

Edge cases: a null text counts as empty; empty texts have features, hence scores;
texts are taken whole; null labels and labels of unknown documents are not
learned from; with labels of one kind only, or none, there are no pairs, and every
score is the share of good labels (0.5 without labels); repeated rows and null ids
keep their rows; columns of any name pass through, but those beginning with _wf_.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped, materialize

#: Width of the bins of strength; documents of a bin are paired at the bin's mean.
BIN = 0.125
#: Numbers of a model are rounded to these digits: sums in any order give the same model.
DIGITS = 9
#: The score of a document at the quantile.
THRESHOLD = 0.3
FEATURES_COL = "_wf_features"
FEATURES = ["log_chars", "log_words", "word_length", "long_words", "distinct_words", "repeats", "distinct_lines", "line_words", "upper", "digits", "marks", "sentence_marks", "bars", "other_bytes", "blanks", "titled"]


def text_features(text: str) -> list[float]:
    import math
    from operator import eq

    import numpy as np

    data = text.encode()
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = text.split(), text.split("\n")
    n, w = max(1, len(data)), max(1, len(words))
    upper, lower = int(bytes_of[65:91].sum()), int(bytes_of[97:123].sum())
    ends = int(bytes_of[[33, 44, 46, 63]].sum())
    marks = int(bytes_of[33:48].sum() + bytes_of[58:65].sum() + bytes_of[91:97].sum() + bytes_of[123:127].sum())
    sizes = [len(x) for x in words]
    return [
        math.log1p(n),
        math.log1p(len(words)),
        sum(sizes) / w,
        sum(s > 15 for s in sizes) / w,
        len(set(words)) / w,
        sum(map(eq, words, words[1:])) / w,
        len(set(lines)) / len(lines),
        math.log1p(len(words) / len(lines)),
        upper / max(1, upper + lower),
        int(bytes_of[48:58].sum()) / n,
        (marks - ends) / n,
        ends / w,
        int(bytes_of[124]) / w,
        int(bytes_of[128:].sum()) / n,
        int(bytes_of[32]) / n,
        min(1.0, upper / w),
    ]


def features(docs: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """These columns of docs and _wf_features array<double> of whole texts; one map over the scan."""
    columns = list(columns)
    schema = docs.select(*columns, F.array(F.lit(0.0)).alias(FEATURES_COL)).schema

    def measure(batches):
        for batch in batches:
            rows = [text_features(text or "") for text in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return mapped(docs.select(*(F.col(c) for c in columns), F.col(text_col).alias("_wf_text")), measure, schema)


def _expand(x, mean, scale):
    """Standardised features, clipped, and their squares: a strength may have its best in the middle."""
    import numpy as np

    z = np.clip((x - mean) / scale, -4, 4)
    return np.concatenate([z, z * z], axis=-1)


def _sums(known: DataFrame, work) -> dict[int, list[float]]:
    """Sums by key over all rows; work turns an array of features and one of marks into {key: flat array of sums}.

    Each task sums its own rows, then tasks share the keys: the driver gets one row a key.
    """
    schema = "k long, v array<double>"

    def rows(sums):
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["k", "v"])

    def own(batches):
        import numpy as np

        sums: dict = {}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, len(FEATURES))
            for k, v in work(x, np.asarray(batch.column(1))).items():
                sums[k] = sums[k] + v if k in sums else v
        yield rows(sums)

    def shared(batches):
        sums: dict = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy()
                sums[k] = sums[k] + v if k in sums else v
        yield rows(sums)

    return {r.k: r.v for r in mapped(mapped(known, own, schema).repartition("k"), shared, schema).collect()}


def _moments(mean, scale, w):
    """For _sums: by bin of strength and mark, the products of features with each other and, in the last row, with 1."""
    import numpy as np

    def work(x, y):
        z = np.concatenate([_expand(x, mean, scale), np.ones((len(x), 1))], axis=1)
        key = 2 * np.clip(np.rint(z[:, :-1] @ w / BIN), -1000, 1000).astype(np.int64) + y
        order = np.argsort(key, kind="stable")
        keys, starts = np.unique(key[order], return_index=True)
        return {int(k): (part.T @ part).ravel() for k, part in zip(keys, np.split(z[order], starts[1:]))}

    return work


def _newton_step(sums: dict, w):
    """Of Newton's method on the mean logistic loss of all pairs with a small ridge."""
    import numpy as np

    m = len(w)

    def side(mark):
        a = np.array([v for k, v in sorted(sums.items()) if k & 1 == mark]).reshape(-1, m + 1, m + 1)
        return a[:, m, m], a[:, m, :m], a[:, :m, :m]  # counts, sums and products by bin

    (n1, z1, s1), (n0, z0, s0) = side(1), side(0)
    pairs = n1.sum() * n0.sum()
    margin = (z1 @ w / n1)[:, None] - (z0 @ w / n0)[None, :]
    p = 1 / (1 + np.exp(np.clip(margin, -30, 30)))  # chance that a pair is the wrong way round
    v = p * (1 - p)
    cross = z1.T @ v @ z0
    slope = (z1.T @ (p @ n0) - z0.T @ (n1 @ p)) / pairs
    bend = (np.tensordot(v @ n0, s1, 1) + np.tensordot(n1 @ v, s0, 1) - cross - cross.T) / pairs
    return np.linalg.solve(bend + 1e-3 * np.eye(m), slope - 1e-3 * w)


def _ranked(strengths: DataFrame, rank: int) -> float:
    """The strength at this place (from 0) in ascending order, to 2^-40 of their range: counts by bin, then within a bin."""
    lo, hi = strengths.agg(F.min("s"), F.max("s")).first()
    unit = (hi - lo) / (1 << 40)
    if unit == 0:
        return lo
    rows, at = strengths.select(F.floor((F.col("s") - lo) / unit).alias("k")), 0
    for shift in (30, 20, 10, 0):
        part = F.shiftright("k", shift)
        counts = rows.where(F.shiftright("k", shift + 10) == at).groupBy(part.alias("part")).count() if shift < 30 else rows.groupBy(part.alias("part")).count()
        for at, n in sorted(map(tuple, counts.collect())):
            if rank < n:
                break
            rank -= n
    return lo + (at + 0.5) * unit


def learn(measured: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", label_col: str = "quality") -> dict:
    """Strengths from all measured rows whose label is known and for which learn_from holds.

    The driver gets sums by bin of strength, whatever the input.
    """
    import numpy as np

    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn_from).groupBy(id_col).agg((F.max(label_col) > 0).cast("int").alias("_wf_good"))
    known = materialize(measured.select(id_col, FEATURES_COL).join(marked, id_col).select(FEATURES_COL, "_wf_good"), "quality-labelled")
    each = [f(F.col(FEATURES_COL)[i]) for f in (F.avg, F.stddev_pop) for i in range(len(FEATURES))]
    n, good, *spread = known.agg(F.count("*"), F.sum("_wf_good"), *each).first()
    if not n or good in (0, n):
        return {"weights": None, "share": good / n if n else 0.5}
    mean, scale = np.round(spread[: len(FEATURES)], DIGITS), np.round(spread[len(FEATURES) :], DIGITS) + 1e-9
    w = np.zeros(2 * len(FEATURES))
    for _ in range(25):
        step = _newton_step(_sums(known, _moments(mean, scale, w)), w)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    w = np.round(w, DIGITS)
    model = {"weights": w.tolist(), "mean": mean.tolist(), "scale": scale.tolist(), "at": 0.0}
    at = round(_ranked(known.select(_strength(model).alias("s")), int((n - 1) * (1 - good / n))), DIGITS)
    # a logistic scale of one parameter, fitted with its zero at the quantile
    slopes, base = np.geomspace(0.02, 20, 61), np.log(THRESHOLD / (1 - THRESHOLD))

    def losses(x, y):
        margin, sign = _expand(x, mean, scale) @ w - at, np.where(y > 0, -1, 1)
        return {0: np.array([np.logaddexp(0, sign * (s * margin + base)).sum() for s in slopes])}

    slope = slopes[int(np.argmin(_sums(known, losses)[0]))]
    return model | {"at": at, "slope": float(slope)}


def _strength(model: dict) -> Column:
    total = F.lit(-model["at"])
    for i, (m, s) in enumerate(zip(model["mean"], model["scale"])):
        z = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (F.col(FEATURES_COL)[i] - m) / s))
        total = total + z * model["weights"][i] + z * z * model["weights"][i + len(FEATURES)]
    return total


def score(measured: DataFrame, model: dict, out_col: str = "score") -> DataFrame:
    """measured without its features, with the score, which replaces a column of its name; Column expressions only."""
    if model["weights"] is None:
        return measured.drop(FEATURES_COL).withColumn(out_col, F.lit(model["share"]))
    total = _strength(model)
    odds = (1 - THRESHOLD) / THRESHOLD
    return measured.withColumn(out_col, 1 / (1 + odds * F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), total * model["slope"]))))).drop(FEATURES_COL)
