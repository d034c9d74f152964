"""Removal of repeated word sequences by backward search in FM-indexes of text shards.

A document loses every word that lies in a window of ``words`` words whose sequence also starts in a document with a
smaller ``doc_id``.

1. Every window chooses an anchor by content: the least hash of its runs of five words (``shared.anchors``). Anchors that
   occur once in the corpus are dropped after one shuffle of hashes.
2. The others send their surroundings (the words that their windows cover) to the shard of their hash, so that all equal
   windows meet in one shard. Copies inside a batch are settled before.
3. Each shard, a bounded number of different surroundings at a time, is indexed: suffix order, Burrows-Wheeler transform
   and a wavelet matrix with packed bits and block counts. The windows stream against it by backward search; every step
   narrows the interval of suffixes that match so far, its length is the matching statistic, and windows that reach
   the threshold report the interval, whose least document decides. An anchor with more different surroundings than a shard
   may hold hands its windows on as 128-bit hashes to a further sorted shuffle.
4. Ranges come back to their document and the words are cut.

Defined results: words are runs without ASCII white space; a null text has none; fewer than ``words`` words stay; a row with
a null ``doc_id`` stays as it is and proves nothing; rows that repeat a ``doc_id`` count as one document and are expected to
repeat its text (ranges are clipped). Repeats inside one document stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import repeats as R
from rtmart.llm import shared as S

WORDS = 13
GRAM = 5  # words of an anchor
SHARD_ROWS = 20_000


class WaveletMatrix:
    """Rank over a sequence of small integers, one packed bit row with block counts per bit of the alphabet."""

    def __init__(self, values: np.ndarray, bits: int):
        self.size, self.rows = len(values), []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            packed = np.packbits(np.concatenate((one, np.zeros(64 - len(one) % 64, bool))), bitorder="little").view(np.uint64)
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            self.rows.append((bit, packed, counts, len(values) - int(counts[-1])))
            values = np.concatenate((values[~one], values[one]))

    def rank(self, value: np.ndarray, end: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often ``value`` occurs before ``start`` and before ``end``."""
        zero = np.zeros_like(end)
        for bit, packed, counts, zeros in self.rows:
            one = (value >> bit) & 1 == 1
            at = []
            for p in (zero, start, end):
                block = p >> 6
                below = (np.uint64(1) << (p & 63).astype(np.uint64)) - np.uint64(1)
                ones = counts[block] + np.bitwise_count(packed[block] & below)
                at.append(np.where(one, zeros + ones, p - ones))
            zero, start, end = at
        return start - zero, end - zero


class FMIndex:
    """Suffixes ordered to a bounded depth, enough for searches of ``depth`` words; 0 ends each text."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, size = text.astype(np.int64), 1
        while size < depth:  # doubling; a word of 0 never equals another one, so order is kept by place there
            after = np.concatenate((rank[size:], np.zeros(min(size, n), np.int64)))[:n]
            order = np.lexsort((after, rank))
            step = (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([1], 1 + np.cumsum(step)))
            size *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        letters = text[self.suffixes - 1]
        self.matrix = WaveletMatrix(letters, max(1, int(text.max()).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text))))


def backward_search(index: FMIndex, text: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interval of the suffixes that begin with ``text[place : place + depth]``, read from its last word to its first."""
    start = index.before[text[place + depth - 1]]
    end = index.before[text[place + depth - 1] + 1]
    for back in range(depth - 2, -1, -1):
        value = text[place + back]
        low, high = index.matrix.rank(value, end, start)
        start, end = index.before[value] + low, index.before[value] + high
    return start, end


def _anchor_rows(words: int):
    gram = min(GRAM, words)
    width = words - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keep = ~np.asarray(batch.column(0).is_null())
            offsets, data = S.ragged(batch.column(1))
            hashes, label, base = [], [], np.zeros(len(keep) + 1, np.int64)
            for i in range(len(keep)):
                found = S.word_table(data[offsets[i] : offsets[i + 1]])[2]
                mark = np.full(len(found), -1, np.int64)
                if keep[i]:
                    mark[: max(0, len(found) - words + 1)] = i
                hashes.append(found)
                label.append(mark)
                base[i + 1] = base[i] + len(found)
            if base[-1] < words:
                continue
            own = np.concatenate(hashes)
            joined = own[: len(own) - gram + 1].copy()
            for k in range(1, gram):
                joined = S.mix(joined * np.uint64(S._BASE) + own[k : len(own) - gram + 1 + k])
            at, first, last = S.anchors(joined, width, np.concatenate(label))
            who = np.searchsorted(base, first, side="right") - 1
            key, doc = joined[at].astype(np.int64), ids[who].astype(np.int64)
            yield R.anchor_batch(key, doc, at - base[who], at, first, last)

    return run


def _windows(words: int):
    gram = min(GRAM, words)

    def of(body: bytes):
        parts = body.split()

        def cut(anchor: int, first: int, last: int):
            if last + words <= len(parts):
                key = xxhash.xxh64_intdigest(b" ".join(parts[anchor : anchor + gram])) - (1 << 63)
                return key, b" ".join(parts[first : last + words])

        return cut

    return of


def repeated_windows(doc: np.ndarray, first: np.ndarray, bodies: list[bytes], words: int):
    """Which windows of a shard's texts also start in a smaller document: flags, owners and places."""
    number: dict[bytes, int] = {}
    texts = [[number.setdefault(w, len(number) + 1) for w in body.split(b" ")] for body in bodies]
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[np.repeat(begin, sizes) + inside] = np.fromiter((w for t in texts for w in t), np.int64, int(sizes.sum()))
    starts = sizes - words + 1
    owner = np.repeat(np.arange(len(bodies)), starts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    place = begin[owner] + inner

    index = FMIndex(text, words)
    low, high = backward_search(index, text, place, words)
    holder = doc[np.searchsorted(begin, index.suffixes, side="right") - 1]
    least = np.empty(len(place), doc.dtype)
    spans, back = np.unique(np.stack((low, high)), axis=1, return_inverse=True)
    # Equal windows have the same interval and different intervals are disjoint, so one pass over them finds each least.
    cuts = np.minimum.reduceat(np.concatenate((holder, holder[-1:])), spans.ravel(order="F"))[::2]
    least = cuts[back.ravel()]
    return least < doc[owner], owner, first[owner] + inner


def _hashed(doc, first, last, bodies: list[bytes], words: int):
    """Every window of the rows as a 128-bit hash with its place; one window may stand for several places."""
    keys = []
    for who, at, end, body in zip(doc, first, last, bodies):
        parts = body.split(b" ")
        n = len(parts) - words + 1
        for i in range(end - at + 1):
            digest = xxhash.xxh128_digest(b" ".join(parts[min(i, n - 1) : min(i, n - 1) + words]))
            keys.append((*np.frombuffer(digest, np.int64).tolist(), who, at + i))
    return [np.array(x, np.int64) for x in zip(*keys)]


def _same_document(owner: tuple[int, int], own: tuple[int, int]) -> bool:
    return owner[0] == own[0]


def spans(docs: DataFrame, words: int = WORDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, body, ranges): the compressed bytes of each document and the starts of its repeated windows as ranges."""
    if words - GRAM > R.MOST_OFFSET:
        raise ValueError(f"words must be at most {GRAM + R.MOST_OFFSET}")

    def search(_, doc, first, last, __, bodies):
        flags, owner, where = repeated_windows(doc, first, bodies, words)
        return R.flag_ranges(flags, owner, doc, where, last)

    def hashed(doc, first, last, bodies):
        return _hashed(doc, first, last, bodies, words)

    groups = R.search_groups(search, hashed, _same_document, shard_rows)
    return R.located(docs, _anchor_rows(words), R.surroundings(_windows(words), _same_document), groups, False)


def _cut(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for body, found in zip(batch.column(1), batch.column(2)):
                text = unpack(body.as_buffer()).split()
                n = len(text)
                if found.is_valid:
                    pairs = found.values
                    start, end = S.merge_ranges(pairs.field(0).to_numpy(), pairs.field(1).to_numpy(), words)
                    stops = [0, *np.minimum(end, n).tolist()]
                    heads = [*np.minimum(start, n).tolist(), n]
                    text = [w for a, b in zip(stops, heads) for w in text[a:b]]
                out.append((n, n - len(text), b" ".join(text)))
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:2]], pa.array(columns[2], pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def dedup(docs: DataFrame, words: int = WORDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the kept words joined by one space (UTF-8)."""
    return spans(docs, words, shard_rows).mapInArrow(
        _cut(words), "doc_id long, n_words long, n_removed long, kept binary"
    )


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
