import random

import numpy as np
import pytest

from rtmart.llm import substring_dedup as sd


def brute(docs, n):
    first, out = {}, {}
    for doc in sorted(docs):
        words = docs[doc].split()
        for i in range(len(words) - n + 1):
            first.setdefault(tuple(words[i : i + n]), doc)
    for doc, text in docs.items():
        words = text.split()
        gone = [False] * len(words)
        for i in range(len(words) - n + 1):
            if first[tuple(words[i : i + n])] < doc:
                gone[i : i + n] = [True] * n
        out[doc] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}".encode() for i in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 60))] for _ in range(8)]
    docs = {}
    for i in rng.sample(range(1000), 60):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = list(rng.choice(passages)) if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
            if p and rng.random() < 0.5:
                p[rng.randrange(len(p))] = b"odd"
            words += p
        docs[i] = rng.choice([b" ", b"\n", b" \t "]).join(words)
    docs[1500] = docs[1501] = b"again " * 40
    docs[1502] = b"again again " * 30
    docs[1503] = b""
    return docs


@pytest.mark.parametrize("words, shard_rows", [(13, 20_000), (13, 3), (4, 100)])
def test_against_brute_force(spark, words, shard_rows):
    docs = corpus(words + shard_rows)
    rows = [(k, v.decode(), 1) for k, v in docs.items()] + [(1600, None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, first int").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in sd.dedup(frame, words, shard_rows).collect()}
    assert got == brute({**docs, 1600: b""}, words)


def test_wavelet_rank():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 21, 300)
    matrix = sd.WaveletMatrix(values, 5)
    value, start = rng.integers(0, 21, 500), rng.integers(0, 150, 500)
    end = start + rng.integers(0, 150, 500)
    low, high = matrix.rank(value, end, start)
    assert low.tolist() == [int((values[:s] == v).sum()) for v, s in zip(value, start)]
    assert high.tolist() == [int((values[:e] == v).sum()) for v, e in zip(value, end)]


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (4, text)]
    out = sorted((r.doc_id or 0, r.n_removed) for r in sd.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(0, 0), (1, 0), (1, 0), (4, 30)]
    assert sd.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_widths_beyond_the_packed_offsets_are_refused():
    with pytest.raises(ValueError, match="at most 132"):
        sd.dedup(None, words=133)
