"""Line dedup, periodic runs and whitening: brute force, SQL and odd rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfold.llm import line_dedup, periodic_runs, queries, whitening

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC)


# Lines


def kept_lines(texts, least):
    lowered = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))
    seen = {}
    for i, t in enumerate(texts):
        for key in {lowered(x) for x in (t or "").split("\n")} - {""}:
            seen.setdefault(key, set()).add(i)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(seen.get(lowered(x), ())) < least]
        out.append(("\n".join(left), len(lines), len(lines) - len(left)))
    return out


def test_lines_by_brute_force(spark):
    rng = random.Random(5)
    pool = ["Terms of use", " terms OF use\t", "rare \x85 line", "", "   ", "ÄPFEL", "äpfel", "x", "\x0b\x0c y \r", "a\tb"] + [f"line {i}" for i in range(30)]
    texts = [None, "", "\n", "\n\n", "Terms of use"] + ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    texts += ["\n".join(["terms of use", "x"] * 20_000), "z" * 200_000 + "\nterms of use"] + [texts[20]] * 3  # long ones, copies
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = docs_of(spark, rows).withColumn("n_lines", F.lit("theirs")).withColumn("at", F.lit(1)).withColumn("a", F.col("text"))
    got = line_dedup.drop_common_lines(docs, min_docs=10)
    assert got.columns.count("n_lines") == 1 and {"at", "a", "source"} <= set(got.columns)
    want = [(i, t, *k) for (i, t), k in zip(rows, kept_lines(texts, 10))]
    assert sorted(((r.doc_id, r.a, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == sorted(want, key=str)
    assert any(k[2] for k in want) and any(k[0] == "" and k[2] for _, _, *k in want)
    assert line_dedup.drop_common_lines(docs.limit(0)).count() == 0
    assert line_dedup.drop_common_lines(docs_of(spark, [(1, "a"), (2, "b")])).select("text").distinct().count() == 2


def test_lines_by_the_join_alone(spark, monkeypatch):
    """No hash is heavy: all go through the shuffled join, with the same rows."""
    docs = docs_of(spark, [(i, f"own {i}\nshared\nShared \n{'often' if i % 2 else 'other'}") for i in range(40)])
    run = lambda: sorted(tuple(r) for r in line_dedup.drop_common_lines(docs).select("doc_id", "text", "n_dropped").collect())
    first = run()
    monkeypatch.setattr(line_dedup, "HEAVY", 0)
    assert run() == first == sorted((i, f"own {i}", 3) for i in range(40))


# Runs


def runs_by_definition(words, least=6, repeats=4):
    out, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                start, end = i, j + q
                if end - start >= max(least, repeats * q):
                    out.setdefault((start, end), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def strongest(runs):
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5), st.integers(3, 5))
def test_runs_like_their_definition(documents, repeats):
    texts = [" ".join(map(str, d)).encode() for d in documents]
    if not texts:
        return
    sizes, runs, best, left = (c.to_pylist() for c in periodic_runs._told(texts, 6, repeats))
    for d, words in enumerate(documents):
        words = list(map(str, words))
        want = runs_by_definition(words, 6, repeats)
        assert [tuple(r.values()) for r in runs[d]] == want and sizes[d] == len(words)
        assert (best[d] and tuple(best[d].values())) == strongest(want)
        assert left[d] == collapsed(words, want)


def test_runs_of_long_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLAB", 1000)
    rng = random.Random(2)
    long = [str(rng.randrange(50)) for _ in range(3000)]
    long += (["u", "v", "w"] * 700) + long[:400] * 5 + ["z"] * 2000
    texts = [None, "", " \t\n ", "a b a b a b", "a a a a a", "a a a a a a", "a b a b a b a b", " ".join(long), "x　y x　y", "é\x85é " * 9, "a b a b a b a b c d c d c d c d", "a b a b a b a b"]
    docs = docs_of(spark, [(i if i else None, t) for i, t in enumerate(texts)]).withColumn("runs", F.lit(1))
    got = {r.doc_id or 0: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        want = runs_by_definition(words)
        assert [tuple(r) for r in got[i].runs] == want, i
        assert got[i].n_words == len(words) and got[i].collapsed == collapsed(words, want)
        assert (got[i].strongest and tuple(got[i].strongest)) == strongest(want)
    assert (1, ) not in got and periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find(np.zeros(9, int), 9, 6, 2)


def test_op12_by_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf).collect()}
    some = 0
    for row in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", row.text or "") if w]
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want = runs_by_definition(words)
        top = strongest(want) or (None,) * 3
        r = got[row.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in want))
        assert r.collapsed_sha256 == sha(collapsed(words, want))
        some += len(want)
    assert len(got) == len(rows) and some


# Whitening


def whitened_exactly(vectors):
    """(n, deviations, whitened, shares) by whole numbers and numpy."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    off = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in off), n**3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return n, [sum(y * y for y in r) for r in off], np.array([[y / n for y in r] for r in off]) @ u / np.sqrt(e), e / np.trace(v)


def test_whitening_by_whole_numbers(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 64)
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)).astype(np.float32)
    rows = [(i if i else None, [float(c) for c in v], 1) for i, v in enumerate(x)]
    rows += [(5, rows[5][1], 1)]  # a repeated row
    odd = [(1000, None, 1), (1001, [], 1), (1002, [None] + [0.0] * 11, 1), (1003, [float("nan")] + [0.0] * 11, 1), (1004, [float("inf")] + [0.0] * 11, 1), (1005, [1e30] + [0.0] * 11, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, component int").repartition(5)
    got = whitening.whiten(df).collect()
    n, deviations, white, shares = whitened_exactly([r[1] for r in rows])
    assert len(got) == 8 * n and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    for k in range(8):
        own = {(r.vec_id, round(abs(r.whitened), 9)): r for r in by[k + 1]}
        sign = None
        for i, (row, far) in enumerate(zip(rows, deviations)):
            r = own[row[0], round(abs(white[i, k]), 9)]
            assert r.deviation == far and abs(r.explained / shares[k] - 1) < 1e-9
            sign = sign or np.sign(r.whitened * white[i, k])
            assert abs(r.whitened * sign - white[i, k]) < 1e-8
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_of_large_flat_and_mixed_vectors(spark):
    big = [(i, [1e12 * (i % 3), 1.0 * i, -5e11]) for i in range(9)]  # sums beyond 2^53, a constant entry
    df = spark.createDataFrame(big + [(20, [2.0]), (21, [4.0]), (22, [4.0]), (30, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    large = [r for r in got if r.vec_id < 9]
    n, deviations, white, shares = whitened_exactly([v for _, v in big])
    assert len(large) == 27 and max(deviations) > 2**63  # beyond a long
    assert all(r.deviation == (deviations[r.vec_id] if deviations[r.vec_id] < 2**63 else None) for r in large)
    for r in large:
        if r.component == 1:
            assert abs(abs(r.whitened) - abs(white[r.vec_id, 0])) < 1e-9 and abs(r.explained - shares[0]) < 1e-9
        if r.component == 3:
            assert r.whitened is None and r.explained < 1e-12
    single = sorted((r.vec_id, r.n, r.deviation, r.explained) for r in got if 20 <= r.vec_id < 30)
    assert single == [(20, 3, 4096**2, 1.0), (21, 3, 2048**2, 1.0), (22, 3, 2048**2, 1.0)]
    alone = [r for r in got if r.vec_id == 30]
    assert len(alone) == 2 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.identity_error is None for r in alone)


def test_remainders_give_the_number_back():
    p = whitening.primes(10**60)
    assert len(set(p)) == len(p) and all(x < 2**20 for x in p)
    for x in (0, 1, -1, 10**29, -(10**29), 123456789**3):
        assert whitening.remaindered({q: x % q for q in p}) == x
