"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A document loses every byte that lies in a string of ``length`` bytes which also starts earlier in the corpus.

1. *Cover sample of the corpus.* Every window of ``length`` bytes chooses an anchor by content (``shared.anchors``), one
   position in 35. Equal strings choose anchors at the same offset, the property that makes a difference cover useful, at a
   fifth of the rows of a cover of residues. Anchors whose 32 bytes occur once in the corpus are dropped after one shuffle of
   hashes; no string around them can repeat.
2. *Suffix buckets.* The other anchors send their surroundings, one short text each, to the bucket of their hash. Copies
   inside a batch are settled before the shuffle.
3. *One bucket at a time* the suffixes are sorted to ``length`` bytes. A difference cover modulo 13 is sampled inside
   the bucket; only the sample is compared at full depth, and its ranks with common-prefix lengths settle the ties of all other
   suffixes, which compare at most five bytes of their own. Memory is bounded by the bucket's share of ``bucket_rows``
   different surroundings; a bucket that has more hands its strings on as 128-bit hashes to a further sorted shuffle.
4. Repeated starts come back to their document as ranges and are cut out.

The text is shuffled once (both joins by ``doc_id`` share the exchange).

Defined results: a null text is empty; texts shorter than ``length`` stay; a row with a null ``doc_id`` stays as it is and
proves nothing about others; rows that repeat a ``doc_id`` are expected to repeat its text, count as one document and are all
cut alike (ranges found for an id are clipped to each text). Other columns of the input pass through ``dedup`` untouched.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import repeats as R
from rtmart.llm import shared as S

LENGTH = 100
GRAM = 32  # bytes of an anchor
BUCKET_ROWS = 20_000
COVER = 13  # a perfect difference cover: every difference modulo 13 is one of two members
MEMBERS = (0, 1, 3, 9)
_NEXT = np.array([next(t for t in range(COVER) if (r + t) % COVER in MEMBERS) for r in range(COVER)])


def _pieces(offsets, keep, length):
    """Runs of whole documents, or parts of a long one, of about a block each: (rows, text start in the document)."""
    row = 0
    while row < len(keep):
        size = offsets[row + 1] - offsets[row]
        if size > S.BLOCK_BYTES:
            for low in range(0, size - length + 1, S.BLOCK_BYTES):
                yield row, row + 1, low, min(size, low + S.BLOCK_BYTES + length - 1)
            row += 1
            continue
        end = row + 1
        while end < len(keep) and offsets[end + 1] - offsets[row] <= S.BLOCK_BYTES:
            end += 1
        yield row, end, 0, offsets[end] - offsets[row]
        row = end


def _anchor_rows(length: int):
    gram = min(GRAM, length)
    width = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keep = ~np.asarray(batch.column(0).is_null())
            offsets, data = S.ragged(batch.column(1))
            keys, docs, ats = [], [], []
            for row, end, low, high in _pieces(offsets, keep, length):
                text = data[offsets[row] + low : offsets[row] + high]
                if len(text) < length:
                    continue
                base = offsets[row : end + 1] - offsets[row]
                label = np.full(len(text), -1, np.int64)
                for i in range(row, end):
                    start, stop = max(0, base[i - row] - low), base[i - row + 1] - low
                    if keep[i]:
                        label[start : max(start, min(stop, len(text)) - length + 1)] = i
                hashes = S.range_hashes(text, slice(0, len(text) - gram + 1), slice(gram, None))
                at, first, last = S.anchors(hashes, width, label)
                who = label[first]
                keys.append(hashes[at].astype(np.int64))
                docs.append(ids[who].astype(np.int64))
                ats.append((at - base[who - row] + low, at, first, last))
            if keys:
                key, doc, *places = (np.concatenate(x) for x in (keys, docs, *zip(*ats)))
                yield R.anchor_batch(key, doc, *places)

    return run


def _windows(length: int):
    gram = min(GRAM, length)

    def of(body: bytes):
        def cut(anchor: int, first: int, last: int):
            text = body[first : last + length]
            if len(text) == last + length - first:
                return xxhash.xxh64_intdigest(body[anchor : anchor + gram]) - (1 << 63), text

        return cut

    return of


def repeated_starts(bucket, doc, first, anchor, bodies: list[bytes], length: int):
    """Which window starts of the sorted rows have an equal window before them; as flags over all starts, with the owners.

    Rows are ordered by bucket, document and place. This is the suffix sort of one or several small buckets.
    """
    sizes = np.array([len(b) for b in bodies])
    pad = (-anchor) % COVER
    room = (pad + sizes + COVER - 1) // COVER * COVER
    begin = np.concatenate(([0], np.cumsum(room)[:-1])) + pad
    text = np.zeros(int(room.sum()) + 8 * COVER + COVER, np.uint8)
    raw = np.frombuffer(b"".join(bodies), np.uint8)
    text[np.repeat(begin - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(len(raw))] = raw
    starts = sizes - length + 1
    owner = np.repeat(np.arange(len(bodies)), starts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    place = begin[owner] + inner
    ahead = _NEXT[place % COVER]  # bytes to the next member of the cover

    wanted = np.zeros(len(text), bool)
    wanted[place + ahead] = True
    sample = np.flatnonzero(wanted)
    words_n = -(-length // 8)
    words = text[sample[:, None] + np.arange(words_n * 8)].view(">u8").astype(np.uint64)
    home = bucket[np.searchsorted(begin, sample, side="right") - 1]
    order = np.lexsort((*[words[:, k] for k in range(words_n - 1, -1, -1)], home))
    rank = np.zeros(len(text), np.int64)
    rank[sample[order]] = np.arange(len(sample))
    ranked, home = words[order], home[order]
    differ = ranked[1:] ^ ranked[:-1]
    word = np.argmax(differ != 0, axis=1)
    least = differ[np.arange(len(differ)), word]
    common = 8 * word + sum((least < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8))
    common[least == 0] = words_n * 8
    common[home[1:] != home[:-1]] = -1

    group = np.zeros(len(place), np.int64)
    for t in range(int(_NEXT.max()) + 1):  # the sample's order at the depth that this distance leaves
        at = ahead == t
        depth_class = np.concatenate(([0], np.cumsum(common < length - t)))
        group[at] = depth_class[rank[place[at] + t]] * 8 + t
    prefix = np.zeros(len(place), np.uint64)
    for t in range(int(_NEXT.max())):
        prefix = np.where(t < ahead, (prefix << np.uint64(8)) | text[np.minimum(place + t, len(text) - 1)], prefix)
    order = np.lexsort((prefix, group))  # stable: the earliest start stays first among equals
    g, p = group[order], prefix[order]
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (p[1:] != p[:-1])))
    leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    where = first[owner] + inner
    other = (doc[owner[order]] != doc[owner[leader]]) | (where[order] != where[leader])
    flags = np.zeros(len(place), bool)
    flags[order] = other & ~new
    return flags, owner, where


def _hashed(doc, first, bodies: list[bytes], length: int):
    """Every window of the rows as a 128-bit hash with its place."""
    keys = []
    for who, at, body in zip(doc, first, bodies):
        data = np.frombuffer(body, np.uint8)
        n = len(body) - length + 1
        pair = [S.range_hashes(x, slice(0, n), slice(length, None)) for x in (data, data ^ np.uint8(90))]
        keys.append((*pair, np.full(n, who), at + np.arange(n)))
    return [np.concatenate(x).astype(np.int64) for x in zip(*keys)]


def spans(docs: DataFrame, length: int = LENGTH, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, body, ranges): the compressed bytes of each document and the starts of its repeated strings as ranges."""
    if length - GRAM > R.MOST_OFFSET:
        raise ValueError(f"length must be at most {GRAM + R.MOST_OFFSET}")

    def search(bucket, doc, first, last, anchor, bodies):
        flags, owner, where = repeated_starts(bucket, doc, first, anchor, bodies, length)
        return R.flag_ranges(flags, owner, doc, where, last)

    def hashed(doc, first, _, bodies):
        return _hashed(doc, first, bodies, length)

    texts = R.surroundings(_windows(length), operator.eq)
    return R.located(docs, _anchor_rows(length), texts, R.search_groups(search, hashed, operator.eq, bucket_rows), True)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for body, found in zip(batch.column(1), batch.column(2)):
                text = unpack(body.as_buffer())
                start = end = np.zeros(0, np.int64)
                if found.is_valid:
                    pairs = found.values
                    start, end = S.merge_ranges(pairs.field(0).to_numpy(), pairs.field(1).to_numpy(), length)
                    start, end = np.minimum(start, len(text)), np.minimum(end, len(text))
                    start, end = start[end > start], end[end > start]
                stops = [0, *end.tolist()]
                kept = b"".join(text[a:b] for a, b in zip(stops, [*start.tolist(), len(text)]))
                out.append((len(text), len(text) - len(kept), len(start), kept))
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def dedup(docs: DataFrame, length: int = LENGTH, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (removed runs) and the bytes kept."""
    if length < 8:
        raise ValueError("length must be at least 8 bytes")
    return spans(docs, length, bucket_rows).mapInArrow(
        _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
