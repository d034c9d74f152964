import itertools
import random

import numpy as np
import xxhash
import pytest

from rtmart.llm import simhash_dedup as sh
from rtmart.llm.components import components


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, distance):
    """{id: print} -> {id: least id of its class}"""
    parent = {k: k for k in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= distance:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in prints}


def corpus():
    rng = random.Random(3)
    texts = {}
    for i in rng.sample(range(10_000), 80):
        base = [f"Wörd{rng.randint(0, 400)}" for _ in range(rng.randint(1, 200))]
        texts[i] = " ".join(base)
        for k in range(rng.randint(0, 3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "Changed"
            texts[10_000 * (k + 1) + i] = "\t".join(copy)
    texts[5] = texts[6] = ""
    return texts


def test_classes_against_all_pairs(spark):
    texts = corpus()
    frame = spark.createDataFrame([(k, v, "x") for k, v in texts.items()] + [(99_999, None, "x")], "doc_id long, text string, fp string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.digest(frame.repartition(4)).collect()}
    prints = {k: slow_print(v) for k, v in texts.items()} | {99_999: 0}
    roots = slow_classes(prints, 3)
    assert got == {k: (f"{p:016x}", roots[k]) for k, p in prints.items()}
    assert len(set(roots.values())) < len(roots) - 3


@pytest.mark.parametrize("bucket_rows", [10, 1 << 14])
def test_links_connect_clusters(spark, bucket_rows):
    rng = random.Random(bucket_rows)
    prints = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 60)):
            prints.add(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & sh.ALL)
    prints = list(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(sh.links(frame, 3, bucket_rows)).collect()}
    signed = {int(np.uint64(p).astype(np.int64)): p for p in prints}
    assert {k: roots.get(k, k) for k in signed} == slow_classes(signed, 3)


@pytest.mark.parametrize("n", [1000, 10**7, 10**11])
def test_thresholds_obey_the_pigeonhole(n):
    rng = np.random.default_rng(n)
    sample = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    masks = sh.allocate(sample, n, 3)
    for _ in range(3000):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(not flips & m for m in masks)


def test_keep_one_and_odd_rows(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in sh.keep_one(frame).collect()) == [0, 1, 4]
    assert len(sh.digest(frame).collect()) == 5
    assert sh.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []
