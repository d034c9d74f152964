"""Near-duplicate classes by SimHash fingerprints and generalised pigeonhole search.

1. *Fingerprints.* 64 bits per document from the XXH64 hashes of its word shingles; equal ones are collapsed.
2. *Plan.* Bits that vary together (by a bounded sample of ``SAMPLE`` fingerprints, which steers cost only, never the result)
   are grouped into 2 to 4 parts. Each part gets an own threshold, -1 (skipped) to 2, so that they add up to
   ``distance - parts + 1``: then two fingerprints within ``distance`` differ by at most the threshold in some part. A dynamic
   programme picks the thresholds, and with them the number of parts, by estimated candidates and probes.
3. *Probe.* A part with threshold t files a fingerprint under its bits with every choice of t bits blanked out; partners meet
   under a common key. A bucket links its members by a search that compares each reached member with the unreached
   ones only, so a large group of copies gives a star of links, not all pairs. A bucket beyond ``bucket_rows`` is filed again
   under four further parts of the 64 bits before it is worked on.
4. *Verify* by the whole distance, then connected components.

Defined results: null and empty texts have fingerprint zero, which links like any other; texts with fewer words than a shingle
are one shingle; rows with a null ``doc_id`` belong to their class but never name it (a class of such rows has a null id);
repeated rows give one row each; other columns pass through ``classes`` untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import shared as S
from rtmart.llm.components import components

WORDS = 3
SEED = 42
DISTANCE = 3
SAMPLE = 4096
BUCKET_ROWS = 1 << 14
ALL = (1 << 64) - 1


def fingerprint(body: bytes, words: int = WORDS, seed: int = SEED) -> int:
    parts = body.lower().split()
    if not parts:
        return 0
    text = b" ".join(parts)
    ends = list(itertools.accumulate((len(p) + 1 for p in parts), initial=0))
    if len(parts) < words:
        pairs = [(0, len(text))]
    else:
        pairs = zip(ends, (e - 1 for e in ends[words:]))
    counts, total = np.zeros(64, np.int64), 0
    one = xxhash.xxh64_intdigest
    while True:
        block = [one(text[a:b], seed) for a, b in itertools.islice(pairs, 1 << 15)] if total or len(parts) >= words else [
            one(text, seed)
        ]
        if not block:
            break
        bits = np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
        if len(parts) < words:
            break
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(b.as_buffer().to_pybytes(), words, seed) for b in batch.column(1)]
            column = pa.array(np.array(prints, np.uint64).astype(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), S.utf8().alias("body"))
    return base.mapInArrow(_fingerprints(words, seed), "doc_id long, fp long")


# --- plan -------------------------------------------------------------------------------------------------------


def group_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Deal 64 bits into parts, the most correlated ones together; ``bits`` has a row per sampled fingerprint."""
    if len(bits) < 2:
        tied = np.zeros((64, 64))
    else:
        centred = bits - bits.mean(axis=0)
        scale = np.maximum(centred.std(axis=0), 1e-9)
        tied = np.abs(centred.T @ centred / len(bits) / np.outer(scale, scale))
    np.fill_diagonal(tied, 0)
    left, out = set(range(64)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        own = [max(sorted(left), key=lambda b: tied[b, sorted(left)].sum())]
        left.discard(own[0])
        while len(own) < size:
            best = max(sorted(left), key=lambda b: tied[b, own].sum())
            own.append(best)
            left.discard(best)
        out.append(sorted(own))
    return out


def _close_share(bits: np.ndarray, part: list[int], most: int) -> list[float]:
    """Share of pairs that differ in at most 0, 1, ... ``most`` bits of a part: the larger of what the sample shows and what
    independent bits would give (the sample cannot show rare pairs)."""
    dist = np.zeros(1)
    dist[0] = 1.0
    for p in np.clip(bits[:, part].mean(axis=0) if len(bits) else np.full(len(part), 0.5), 0.01, 0.99):
        q = 2 * p * (1 - p)
        dist = np.convolve(dist, [1 - q, q])
    alone = np.cumsum(dist)[: most + 1]
    if len(bits) < 2:
        return alone.tolist()
    rows = bits[:, part].astype(np.float32)
    shown = np.zeros(most + 1)
    for low in range(0, len(rows), 512):
        block = rows[low : low + 512]
        differ = block.sum(1)[:, None] + rows.sum(1)[None, :] - 2 * block @ rows.T
        shown += [(differ < t + 0.5).sum() for t in range(most + 1)]
    shown = (shown - len(rows)) / (len(rows) * (len(rows) - 1))
    return np.maximum(alone, shown).tolist()


def allocate(sample: np.ndarray, n: int, distance: int = DISTANCE) -> list[int]:
    """The masks of all filing keys of the cheapest plan for ``n`` fingerprints."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    best: tuple[float, list[int]] | None = None
    for m in range(2, distance + 2):
        parts = group_bits(bits, m)
        # states: thresholds plus one spent so far -> (cost, keys)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for part in parts:
            full = sum(1 << b for b in part)
            share = _close_share(bits, part, min(2, distance))
            step: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, masks) in states.items():
                for t in range(-1, min(2, distance) + 1):
                    if spent + t + 1 > distance + 1:
                        continue
                    keys = [full - sum(1 << b for b in gone) for gone in itertools.combinations(part, t)] if t >= 0 else []
                    more = 0.0 if t < 0 else 20.0 * n * len(keys) + share[t] * n * n / 2
                    at = spent + t + 1
                    if at not in step or cost + more < step[at][0]:
                        step[at] = (cost + more, masks + keys)
            states = step
        found = states.get(distance + 1)
        if found and (best is None or found[0] < best[0]):
            best = found
    return best[1]


# --- links ------------------------------------------------------------------------------------------------------


def link_group(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star per connected group of the distinct ``prints``: (member, first member)."""
    left, members, roots = prints, [], []
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            close = np.zeros(len(left), bool)
            for low in range(0, len(front), 64):
                rest = np.flatnonzero(~close)
                near = np.bitwise_count(front[low : low + 64, None] ^ left[None, rest]) <= distance
                close[rest[near.any(axis=0)]] = True
            front, left = left[close], left[~close]
            members.append(front)
            roots.append(np.full(len(front), root))
    if not members:
        return prints[:0], prints[:0]
    return np.concatenate(members), np.concatenate(roots)


def link_large(prints: np.ndarray, distance: int, free: int, most: int):
    """Links of a group of any size: cut by ``distance + 1`` parts of the bits that are still free, one of which is equal
    for any two partners, until groups are small or hardly any bit is free."""
    bits = [b for b in range(64) if free >> b & 1]
    if len(prints) <= most or len(bits) <= distance:
        yield link_group(prints, distance)
        return
    for k in range(distance + 1):
        mask = sum(1 << b for b in bits[k :: distance + 1])
        key = prints & np.uint64(mask)
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for group in np.split(order, cuts):
            if len(group) > 1:
                yield from link_large(prints[group], distance, free & ~mask, most)


def _small(key: np.ndarray, prints: np.ndarray, distance: int, size: int):
    for shift in range(1, size):
        if shift >= len(key):
            break
        same = key[shift:] == key[:-shift]
        if not same.any():
            break
        near = np.flatnonzero(same & (np.bitwise_count(prints[shift:] ^ prints[:-shift]) <= distance))
        yield prints[near + shift], prints[near]


def _links(distance: int, bucket_rows: int, final: bool, size: int = 16):
    """Links of buckets from a stream sorted by key and fingerprint. Rows (u, v, key): a link has key null; where a bucket is
    too large and this is not the final pass, its members go on as (u, null, key)."""

    def batch_of(u, v, key=None) -> pa.RecordBatch:
        n = len(u)
        columns = [
            pa.array(np.asarray(u, np.uint64).astype(np.int64)),
            pa.nulls(n, pa.int64()) if v is None else pa.array(np.asarray(v, np.uint64).astype(np.int64)),
            pa.nulls(n, pa.int64()) if key is None else pa.array(np.full(n, key, np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["u", "v", "key"])

    def work(key: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets."""
        first = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
        sizes = np.diff(first)
        little = np.repeat(sizes <= size, sizes)
        out = list(_small(key[little], prints[little], distance, size))
        for k in np.flatnonzero(sizes > size):
            group = prints[first[k] : first[k + 1]]
            out += link_large(group, distance, ALL, bucket_rows)
        if out:
            u, v = (np.concatenate(x) for x in zip(*out))
            yield batch_of(u, v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, over = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            key = np.concatenate((keys, batch.column(0).to_numpy()))
            value = np.concatenate((prints, batch.column(1).to_numpy().astype(np.uint64)))
            if not len(key):
                continue
            if over is not None:  # the rest of a bucket that goes on to the next pass
                same = int(np.searchsorted(key, over, side="right"))
                if same:
                    yield batch_of(value[:same], None, over)
                    key, value = key[same:], value[same:]
                if not len(key):
                    keys, prints = key, value
                    continue
                over = None
            start = int(np.searchsorted(key, key[-1], side="left"))
            if start:
                yield from work(key[:start], value[:start])
            keys, prints = key[start:], value[start:]
            if not final and len(keys) > bucket_rows:
                over = keys[0]
                yield batch_of(prints, None, over)
                keys, prints = keys[:0], prints[:0]
        if len(keys):
            yield from work(keys, prints)

    return run


def _file(prints: DataFrame, masks: list[int], *also: str) -> DataFrame:
    keys = [
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)), *also)
        for i, mask in enumerate(masks)
    ]
    filed = prints.select(F.explode(F.array(*keys)).alias("key"), "fp")
    return filed.repartition("key").sortWithinPartitions("key", "fp")


def links(prints: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fp`` that connect all that are within ``distance``."""
    n = prints.count()
    picked = prints.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    sample = np.array([r.fp for r in picked], np.int64).astype(np.uint64)
    schema = "u long, v long, key long"
    filed = _file(prints, allocate(sample, n, distance))
    found = S.stored(filed.mapInArrow(_links(distance, bucket_rows, final=False), schema), "found")
    quarter = [sum(1 << b for b in range(k, 64, distance + 1)) for k in range(distance + 1)]
    large = found.where(F.col("key").isNotNull()).select(F.col("u").alias("fp"), F.col("key").alias("bucket"))
    again = _file(large, quarter, "bucket").mapInArrow(_links(distance, bucket_rows, final=True), schema)
    return found.where(F.col("key").isNull()).unionByName(again).select("u", "v")


def classes(
    docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, seed: int = SEED, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """One row per document: doc_id, fp (64 bits as a long) and component_id."""
    own = S.stored(fingerprints(docs, words, seed), "fingerprints")
    distinct = S.stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    joined = components(links(distinct.select("fp"), distance, bucket_rows))
    rooted = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return own.join(by_print, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows whose document has the smallest ``doc_id`` of its class; rows without an id stay."""
    found = classes(docs).where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
