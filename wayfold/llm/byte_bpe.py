"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Documents are cut into blocks. Each block explodes its texts into pre-tokens with
positions and keeps each distinct word once; the words, packed by hash bucket,
are shuffled so that all blocks' copies of a word meet in one bucket, whose rows come
one after the other: each word is encoded once in all. The ids go back to the blocks,
which put them together by position. What is shuffled is one row for each (block,
bucket), never a row for each occurrence, so a frequent word weighs no more than a
rare one. Buckets are as many as partitions, but at most MOST_BUCKETS, so that rows
don't become as many as blocks times partitions on a large cluster.

Decoding joins ids with the token-byte table by a hash join within the task: the
table is a vocabulary, whose size no corpus changes, and is broadcast.

Edge cases: a null text counts as empty and gives no ids; empty tables give empty
results; repeated rows and null ids each keep their row; texts of any length are
taken whole (a block ends after the text that fills it); columns of docs other than
the two named ones are not read, so their names can't clash.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped, partitions, splitter

#: Characters of text in a block; bounds what an assembling task holds.
BLOCK_CHARS = 16_000_000
#: Buckets of words at most: each is encoded by one task, which remembers its distinct words.
MOST_BUCKETS = 2048
#: Token ids in an output batch, about.
BATCH_TOKENS = 250_000
_LAST = 2**31 - 1


def read_ranks(path: str) -> bytes:
    """The rank file as it is; one line for each token: base64 of its bytes, its id."""
    with open(path, "rb") as f:
        return f.read()


def token_bytes(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(i) for token, i in (line.split() for line in ranks.splitlines() if line)}


def _id_kind(table: dict[bytes, int]):
    import numpy as np

    return np.uint16 if max(table.values(), default=0) < 65536 else np.uint32


def _packed(pack, sizes, content: bytes) -> bytes:
    """Items of these sizes in content; each of the two parts compressed."""
    import pickle

    import numpy as np

    sizes = np.fromiter(sizes, np.uint32)
    kind = np.uint8 if sizes.max(initial=0) < 256 else np.uint32
    return pickle.dumps((kind, pack(sizes.astype(kind).tobytes()), pack(content)))


def _unpacked(unpack, payload: bytes):
    import pickle

    import numpy as np

    kind, sizes, content = pickle.loads(payload)
    return np.frombuffer(unpack(sizes), kind).astype(np.int64), unpack(content)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, decoded_col: str | None = None) -> DataFrame:
    """Each row's text as token ids: (id_col, ids array<int>), one row for each of docs.

    Null or empty texts give an empty array. With decoded_col, the ids are decoded
    again as decode() does, in the pass that puts them together.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    parts = partitions(spark)
    buckets = min(parts, MOST_BUCKETS)
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    packed = "slot long, block long, bucket int, payload binary"

    def pretokenise(batches):
        import pickle
        import zlib
        from collections import defaultdict

        import numpy as np
        import zstandard
        from pyspark import TaskContext

        find, pack, part, seq = splitter(pattern), zstandard.ZstdCompressor(level=3).compress, TaskContext.get().partitionId(), 0

        def block(ids, counts, words, positions):
            pos = np.concatenate(positions) if positions else np.empty(0, np.uint32)
            order = np.argsort(-np.bincount(pos, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            pos, words = rank[pos], list(words)
            words = [words[i].encode() for i in order]
            at = np.fromiter((zlib.crc32(w) % buckets for w in words), np.uint32, len(words))
            number = part << 32 | seq
            by = np.argsort(at, kind="stable")
            cuts = np.flatnonzero(np.diff(at[by])) + 1
            rows = []
            for group in np.split(by, cuts) if len(by) else []:
                own = [words[i] for i in group]
                rows.append((int(at[group[0]]), number, int(at[group[0]]), _packed(pack, map(len, own), b"".join(own))))
            planes = tuple(pack(x.tobytes()) for x in (pos.astype(np.uint8), (pos >> 8).astype(np.uint8), (pos >> 16).astype(np.uint16), at.astype(np.uint8 if buckets <= 256 else np.uint32)))
            rows.append((number, number, _LAST, pickle.dumps((ids, counts, planes))))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["slot", "block", "bucket", "payload"])

        def fresh():
            words = defaultdict()
            words.default_factory = words.__len__
            return [], [], words, []

        state, chars = fresh(), 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, counts, words, positions = state
                found = find(text) if text else []
                ids.append(key)
                counts.append(len(found))
                if found:
                    positions.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                chars += len(text or "") + 100
                if chars >= block_chars:
                    yield block(*state)
                    state, chars, seq = fresh(), 0, seq + 1
        if state[0]:
            yield block(*state)

    def encode_words(batches):
        import pickle
        from itertools import chain

        import numpy as np
        import tiktoken
        import zstandard

        table = token_bytes(ranks.value)
        piece = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})._core_bpe.encode_single_piece
        pack, unpack = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress

        id_kind = _id_kind(table)

        class Memo(dict):
            def __missing__(self, word):
                rank = table.get(word)
                self[word] = ids = piece(word) if rank is None else [rank]
                return ids

        memo, current = Memo(), None
        for batch in batches:
            out = []
            for bucket, payload in zip(batch.column(2).to_pylist(), batch.column(3)):
                payload = payload.as_py()
                if bucket != _LAST:
                    if bucket != current:  # no word of another bucket comes again
                        memo, current = Memo(), bucket
                    sizes, text = _unpacked(unpack, payload)
                    ends = np.cumsum(sizes).tolist()
                    encoded = [memo[text[a:b]] for a, b in zip([0, *ends], ends)]
                    payload = _packed(pack, map(len, encoded), np.fromiter(chain.from_iterable(encoded), id_kind).tobytes())
                out.append(payload)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.binary())], names=["slot", "block", "bucket", "payload"])

    def assemble(batches):
        import pickle

        import numpy as np
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        id_kind = _id_kind(token_bytes(ranks.value))
        held, current = [], None
        for batch in batches:
            for block, bucket, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if block != current:
                    held, current = [], block
                payload = payload.as_py()
                if bucket != _LAST:
                    held.append(_unpacked(unpack, payload))
                    continue
                ids, counts, planes = pickle.loads(payload)
                low, mid, high = (np.frombuffer(unpack(p), t) for p, t in zip(planes[:3], (np.uint8, np.uint8, np.uint16)))
                pos = low.astype(np.uint32) | mid.astype(np.uint32) << 8 | high.astype(np.uint32) << 16
                at = np.frombuffer(unpack(planes[3]), np.uint8 if buckets <= 256 else np.uint32)
                by = np.argsort(at, kind="stable")
                sizes = np.concatenate([h[0] for h in held] or [[]]).astype(np.int64)
                flat = np.frombuffer(b"".join(h[1] for h in held), id_kind).astype(np.int32)
                if len(sizes) != len(at):
                    raise RuntimeError(f"block {block}: {len(sizes)} of {len(at)} words came back")
                held = []
                starts, lens = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
                starts[by], lens[by] = np.cumsum(sizes) - sizes, sizes
                ends = np.cumsum(counts)
                first = 0
                while first < len(ids):
                    begin = int(ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, begin + BATCH_TOKENS // 2)))
                    p = pos[begin : int(ends[last - 1])]
                    n = lens[p]
                    tokens = np.concatenate([[0], np.cumsum(n)])
                    out = flat[np.repeat(starts[p] - tokens[:-1], n) + np.arange(tokens[-1])]
                    offsets = tokens[np.concatenate([[0], ends[first:last] - begin]).astype(np.int64)].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[first:last], pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(out))], names=["id", "ids"])
                    first = last

    blocks = mapped(source, pretokenise, packed).repartition(parts, "slot").sortWithinPartitions("bucket")
    encoded = mapped(blocks, encode_words, packed).repartition(parts, "block").sortWithinPartitions("block", "bucket")
    if not decoded_col:
        return mapped(encoded, assemble, "id string, ids array<int>").select(F.col("id").cast(id_type).alias(id_col), "ids")
    join = _joiner(ranks, 1, decoded_col)
    both = mapped(encoded, lambda batches: join(assemble(batches)), f"id string, ids array<int>, `{decoded_col}` binary")
    return both.select(F.col("id").cast(id_type).alias(id_col), "ids", decoded_col)


def _joiner(ranks, at: int, out_col: str):
    """Adds to batches the bytes of the ids in column number at."""

    def join(batches):
        table = {i: token for token, i in token_bytes(ranks.value).items()}.__getitem__
        for batch in batches:
            ids = batch.column(at)
            flat, offsets = ids.flatten().to_numpy(zero_copy_only=False).tolist(), [0]
            for n in ids.value_lengths().to_pylist():
                offsets.append(offsets[-1] + (n or 0))
            known = ids.is_valid().to_pylist()
            out = [b"".join(map(table, flat[a:b])) if ok else None for a, b, ok in zip(offsets, offsets[1:], known)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, out_col])

    return join


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with the bytes of its ids in out_col, by a hash join of ids to the token-byte table.

    The table has a row for each token of the vocabulary and so a size that no
    corpus changes; it is broadcast. out_col replaces a column of its name. Null ids
    give null; an id that the table lacks is an error. The bytes need not be valid UTF-8, hence binary.
    """
    spark = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    encoded = encoded.drop(out_col)
    schema = encoded.select("*", F.lit(b"").alias(out_col)).schema
    return mapped(encoded, _joiner(ranks, encoded.columns.index(ids_col), out_col), schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encodes and decodes whole texts: (doc_id, n_tokens, ids_sha256, decoded_sha256[, ids])."""
    done = encode(docs, ranks_path, pattern, decoded_col="decoded")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )
