"""Language ID by n-gram filters whose entries are bitmasks of languages.

One Bloom filter for each language, laid bit-sliced: entry i of the table holds
bit i of every language's filter, so that one lookup of an n-gram returns all
languages that contain it. Texts are scored by popcounts for each language; the
count is corrected for the filter's false positives, and the largest decides.

Edge cases: a null text, or one without a letter, is `und` with score 0; texts
are taken whole; a text shorter than an n-gram is padded with blanks; ties go to
the first language in order; with nothing to learn from, every text is `und`;
repeated rows and null ids keep their rows; null languages are not learned from.
Any number of languages is told apart: an entry has as many words of 64 bits as they
need. What predict adds replaces columns of docs with these names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped, materialize

#: Rows of a language, about, from which its n-grams are learned; a larger table is
#: sampled by a hash of the id. This bounds the model, not what is scored.
LEARN_ROWS = 4000
#: Share of a language's learned documents that must hold an n-gram of it. This bounds
#: the model: a language has at most its documents' mean number of n-grams over this share.
LEAST_SHARE = 0.005
#: Bits of the table for each n-gram of the largest language, and hash functions.
BITS_PER_GRAM, HASHES = 16, 3
UNKNOWN = "und"
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
_CHUNK = 1_000_000


def _grams(text: bytes):
    """The four-byte windows of lower-cased text as numbers; text is padded with blanks."""
    import numpy as np

    text = b"  " + text + b"  "
    return np.ndarray((len(text) - 3,), "<u4", text, strides=(1,))


def _slots(grams, bits: int):
    import numpy as np

    mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    mixed ^= mixed >> np.uint32(12)
    return [(mixed * np.uint32(a) + np.uint32(a >> 7)) >> np.uint32(32 - bits) for a in _ODD[:HASHES]]


def learn(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """The table of bitmasks from the rows of docs for which learn_from holds.

    Only a hash of the id, to sample by, the text and its language are used. The
    result's size is bounded by LEARN_ROWS and LEAST_SHARE for each language. The
    texts are read once, whatever the number of languages.
    """
    import numpy as np

    rows = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    totals = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # a row for each language
    languages = sorted(totals)
    if not languages:
        return {"languages": [], "table": np.zeros((1, 1), np.uint8), "bits": 0, "false": []}
    parts = F.create_map(*(F.lit(x) for lang, n in totals.items() for x in (lang, int(min(1.0, LEARN_ROWS / n) * (1 << 20)) + 1)))
    keep = F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < parts[F.col(lang_col)]

    def count(batches):
        from collections import defaultdict

        seen, docs_of = defaultdict(list), defaultdict(int)

        def flush():
            langs, grams, counts = [], [], []
            for lang, arrays in seen.items():
                g, n = np.unique(np.concatenate(arrays), return_counts=True)
                langs += [lang] * len(g)
                grams.append(g.astype(np.int64))
                counts.append(n)
            for lang, n in docs_of.items():
                langs.append(lang)
                grams.append(np.array([-1]))
                counts.append(np.array([n]))
            seen.clear()
            docs_of.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(grams or [[]]), pa.int64()), pa.array(np.concatenate(counts or [[]]).astype(np.int64), pa.int64())], names=["lang", "gram", "n"])

        held = 0
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[lang].append(g := np.unique(_grams(text.lower().encode())))
                docs_of[lang] += 1
                held += len(g)
                if held > 4_000_000:
                    yield flush()
                    held = 0
        yield flush()

    counted = mapped(rows.where(keep).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "grams")
    sampled = counted.where("gram = -1").select("lang", F.greatest(F.when(F.col("n") > 20, 2).otherwise(1), F.col("n") * LEAST_SHARE).alias("least"))
    frequent = counted.where("gram >= 0").join(F.broadcast(sampled), "lang").where("n >= least")  # a row for each language
    listed = {r[0]: r[1] for r in frequent.groupBy("lang").agg(F.collect_list("gram")).collect()}
    grams = {lang: np.array(listed.get(lang, []), np.uint32) for lang in languages}
    bits = max(10, int(np.ceil(np.log2(BITS_PER_GRAM * max(map(len, grams.values())) + 1))))
    kind = next((t for t in (np.uint8, np.uint16, np.uint32) if np.dtype(t).itemsize * 8 >= len(languages)), np.uint64)
    table, false = np.zeros((1 << bits, -(-len(languages) // 64)), kind), []
    for i, lang in enumerate(languages):
        own = np.zeros(1 << bits, bool)
        for slots in _slots(grams[lang], bits):
            own[slots] = True
        table[own, i // 64] |= kind(1 << i % 64)
        false.append(float(own.mean()) ** HASHES)
    return {"languages": languages, "table": table, "bits": bits, "false": false}


def predict(docs: DataFrame, model: dict, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with lang_pred string and score double, or other names for them; one map over the scan.

    score is the share of the text's n-grams that the named language contains,
    corrected for false positives: near 1 for ordinary text of that language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*(c for c in docs.columns if c == text_col or c not in (lang_out, score_out)))
    keys = [c for c in docs.columns if c != text_col]
    schema = docs.select(*keys, F.col(text_col), F.lit("").alias(lang_out), F.lit(0.0).alias(score_out)).schema

    def score(batches):
        import numpy as np
        import regex

        m = shared.value
        letter, langs, table, bits = regex.compile(r"\p{L}").search, m["languages"], m["table"], m["bits"]
        false = np.array(m["false"])
        small = len(langs) <= 8
        holds = (np.arange(256)[:, None] >> np.arange(len(langs))[None, :]) & 1 if small else None

        def counts(grams):
            slots = _slots(grams, bits)
            mask = table[slots[0]]
            for s in slots[1:]:
                mask &= table[s]
            if small:
                return np.bincount(mask[:, 0], minlength=256) @ holds
            return np.array([np.count_nonzero(mask[:, i // 64] & mask.dtype.type(1 << i % 64)) for i in range(len(langs))])

        for batch in batches:
            names, scores = [], []
            for text in batch.column(len(keys)).to_pylist():
                if not langs or not text or not letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                grams = _grams(text.lower().encode())
                n = len(grams)
                hits = sum(counts(grams[i : i + _CHUNK]) for i in range(0, n, _CHUNK))
                right = (hits / n - false) / (1 - false)
                best = int(np.argmax(right))
                names.append(langs[best])
                scores.append(float(min(1.0, max(0.0, right[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, lang_out, score_out])

    return mapped(docs.select(*keys, text_col), score, schema)
