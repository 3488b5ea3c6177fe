"""Toxicity by compression distance.

Two zstandard dictionaries: one trained on ordinary text, and one of toxic
passages laid before the same ordinary content, so that ordinary text compresses
alike with either. Texts are cut into windows of WINDOW words; each is compressed
with both, and what the toxic dictionary saves is the window's evidence. A
document's largest, mean and counted savings give its score by a logistic
calibration on the learned rows.

Toxic documents are mostly ordinary text. What the toxic dictionary is trained on
are therefore the parts of words that letter sequences cover which are far more
frequent in toxic than in ordinary documents.

Edge cases: a null text counts as empty; an empty text has no window and gets the
score of no savings; texts are taken whole; null labels are not learned from;
with labels of one kind only, or none, every score is the share of toxic labels
(0 without labels); repeated rows and null ids keep their rows; only the id and the
text are read, so names of other columns can't clash.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped

#: Labelled documents of each class, about, from which dictionaries are trained and
#: scores calibrated, chosen by a hash of the id; longer texts are not learned from.
LEARN_ROWS, LEARN_CHARS = 3000, 50_000
WINDOW = 8
#: Bytes of the ordinary dictionary and of the passages at most, letters of a sequence.
ORDINARY_BYTES, PASSAGE_BYTES, SEQUENCE = 32_768, 16_384, 5
#: Windows that the ordinary dictionary is trained on at most, evenly spread over those of the learned texts.
TRAIN_WINDOWS = 100_000
LEVEL = 4


def _words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _windows(text: str) -> list[bytes]:
    words = _words(text)
    return [b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]


def _train(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    from collections import Counter

    import zstandard

    def sequences(words):
        return {w[i : i + SEQUENCE] for w in words for i in range(len(w) - SEQUENCE + 1)}

    seen, passages = (Counter(), Counter()), Counter()
    for count, texts in zip(seen, (toxic, ordinary)):
        for text in texts:
            count.update(sequences({b" " + w for w in _words(text)}))
    least, rate = max(2, 0.01 * len(toxic)), 10 * len(toxic) / max(1, len(ordinary))
    telling = {s for s, n in seen[0].items() if n >= least and n > rate * (seen[1][s] + 1)}
    for text in toxic:
        passages.update({run for word in {b" " + w for w in _words(text)} for run in _covered(word, telling)})
    kept: list[bytes] = []
    room = PASSAGE_BYTES
    for passage, n in sorted(passages.items(), key=lambda x: (-x[1], x[0])):
        if n >= least and len(passage) <= room and not any(passage in other or other in passage for other in kept):
            kept.append(passage)
            room -= len(passage) + 2
    samples = [w for text in ordinary for w in _windows(text)]
    samples = samples[:: -(-len(samples) // TRAIN_WINDOWS) or 1]
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        base = b" ".join(samples)[-ORDINARY_BYTES:] or b" " * 8
    # The compressor indexes every third position of a dictionary. Padded to that,
    # each passage is found by its start, and what follows is indexed as without them.
    return b"".join(p + b" " * (-len(p) % 3) for p in reversed(kept)) + base, base


def _covered(word: bytes, telling: set[bytes]) -> list[bytes]:
    """The runs of a word that telling sequences cover."""
    runs, end = [], -1
    for i in range(len(word) - SEQUENCE + 1):
        if word[i : i + SEQUENCE] in telling:
            if i > end:
                runs.append([i, i + SEQUENCE])
            end = runs[-1][1] = i + SEQUENCE
    return [word[a:b] for a, b in runs]


def _savings(toxic: bytes, ordinary: bytes):
    """A function from text to its evidence: six numbers, zeros without windows."""
    import numpy as np
    import zstandard

    one, two = (zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False).compress for d in (toxic, ordinary))

    def of(text: str) -> list[float]:
        windows = _windows(text)
        if not windows:
            return [0.0] * 6
        saved = np.array([len(two(w)) - len(one(w)) for w in windows], float)
        top = np.sort(saved)[-3:]
        return [saved.max(), top.mean(), saved.mean(), float((saved >= 2).mean()), float((saved >= 4).mean()), float(np.log1p((saved >= 3).sum()))]

    return of


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Dictionaries and calibration from labelled rows for which learn_from holds.

    One half of the sampled rows, by hash, trains the dictionaries; the other half
    calibrates, since texts that a dictionary was trained on compress too well.
    """
    import numpy as np

    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn_from).groupBy(id_col).agg(F.max(label_col).alias("_wf_label")).select(id_col, (F.col("_wf_label") > 0).alias("_wf_label"))
    totals = {r[0]: r[1] for r in marked.groupBy("_wf_label").count().collect()}
    if len(totals) < 2:
        return {"dictionaries": None, "share": 1.0 if totals.get(True) else 0.0}
    chosen = marked.where((F.col("_wf_label") & _sampled(id_col, totals[True])) | (~F.col("_wf_label") & _sampled(id_col, totals[False])))
    # The chosen rows are few: they are matched where the texts are, so that no text is shuffled.
    texts = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("t")).where(F.length("t") <= LEARN_CHARS)
    rows = texts.join(F.broadcast(chosen), id_col).select(F.xxhash64(id_col).alias("h"), "t", F.col("_wf_label").alias("label")).collect()
    rows.sort(key=lambda r: (r.h, r.t))
    half = [[r for r in rows if (r.h >> 21 & 1) == k] for k in (0, 1)]
    if any(len({r.label for r in h}) < 2 for h in half):
        half = [rows, rows]
    toxic, ordinary = _train([r.t for r in half[0] if r.label], [r.t for r in half[0] if not r.label])
    of = _savings(toxic, ordinary)
    x, y = np.array([of(r.t) for r in half[1]]), np.array([r.label for r in half[1]], float)
    share = totals[True] / (totals[True] + totals[False])
    weight = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z / len(z) + 1e-3 * np.eye(len(w))
        w += 0.7 * np.linalg.solve(hess, z.T @ (weight * (y - p)) / len(z) - 1e-3 * w)
    p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
    # The threshold is calibrated too: what parts the learned rows best (F1) is moved to 0.5.
    cuts = np.quantile(p, np.linspace(0.02, 0.995, 200))
    f1 = [2 * (weight * y * (p >= c)).sum() / ((weight * y).sum() + (weight * (p >= c)).sum() + 1e-12) for c in cuts]
    best = float(np.clip(cuts[int(np.argmax(f1))], 0.05, 0.8))
    w[-1] -= np.log(best / (1 - best))
    return {"dictionaries": (toxic, ordinary), "weights": w.tolist(), "mean": mean.tolist(), "scale": scale.tolist()}


def _sampled(id_col: str, total: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(min(1.0, LEARN_ROWS / max(1, total)) * (1 << 20)) + 1


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score double) for each row of docs; one map over the scan."""
    if model["dictionaries"] is None:
        return docs.select(id_col, F.lit(model["share"]).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches):
        import numpy as np

        m = shared.value
        of, mean, scale, w = _savings(*m["dictionaries"]), np.array(m["mean"]), np.array(m["scale"]), np.array(m["weights"])
        for batch in batches:
            x = np.array([of(text or "") for text in batch.column(1).to_pylist()]).reshape(-1, 6)
            p = 1 / (1 + np.exp(-np.clip((x - mean) / scale @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=[id_col, "score"])

    return mapped(docs.select(id_col, text_col), judge, f"`{id_col}` {kind}, score double")
