"""Token counts with the whole-token shortcut.

Before any text is read, each vocabulary string is tried: one that is a single
pre-token and encodes alone as one token always counts 1, since merging works on
one pre-token at a time. Counting then looks pre-tokens up and merges only those
that no proof covers, each once for as long as a task remembers it.

Edge cases: a null text counts as empty; texts are taken whole; repeated rows and
null ids keep their rows; empty tables give empty results; only the two named
columns are read.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped, splitter

#: Merged words that a task remembers before it starts anew.
MEMO_WORDS = 200_000


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves; the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def whole_tokens(definition: str, pattern: str) -> list[str]:
    """The vocabulary strings that are one pre-token and one token, proven one by one."""
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    find, back = regex.compile(pattern).findall, {c: b for b, c in byte_letters().items()}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    proven = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character, or no byte-level string
        if token not in special and find(text) == [text] and len(tokenizer.model.tokenize(token)) == 1:
            proven.append(text)
    return proven


def count_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes long, n_tokens long) for each row of docs; one map over the scan, no shuffle.

    Strings of special tokens inside a text count as that token, as the library has
    it by default. The definition must be byte-level BPE that neither normalises
    nor adds a first blank; anything else is refused.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    told = json.loads(definition)
    if told["normalizer"] or told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"] or told["model"]["type"] != "BPE":
        raise ValueError(f"{tokenizer_path} is not plain byte-level BPE")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in told["added_tokens"]):
        raise ValueError(f"{tokenizer_path} has added tokens that take in their surroundings")
    special = [t["content"] for t in told["added_tokens"]]
    shared = docs.sparkSession.sparkContext.broadcast((definition, whole_tokens(definition, pattern)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        import regex
        from tokenizers import Tokenizer

        definition, proven = shared.value
        merge, letters = Tokenizer.from_str(definition).model.tokenize, str.maketrans(byte_letters())
        find = splitter(pattern)
        cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

        class Counts(dict):
            def __missing__(self, word):
                self[word] = n = len(merge(word.encode().decode("latin-1").translate(letters)))
                return n

        ones = dict.fromkeys(proven, 1)
        known = Counts(ones)
        for batch in batches:
            sizes, counts = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                sizes.append(len(text.encode()))
                n = 0
                if cut and any(s in text for s in special):
                    parts = cut.split(text)
                    n = len(parts) - 1
                    for part in parts:
                        n += sum(map(known.__getitem__, find(part)))
                else:
                    n = sum(map(known.__getitem__, find(text)))
                counts.append(n)
                if len(known) > MEMO_WORDS + len(ones):
                    known = Counts(ones)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    out = mapped(docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")), count, "id string, n_bytes long, n_tokens long")
    return out.select(F.col("id").cast(id_type).alias(id_col), "n_bytes", "n_tokens")
