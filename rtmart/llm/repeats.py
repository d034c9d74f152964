"""The way from documents to ranges of repeated windows that suffix and substring dedup share.

Anchors -> those that occur twice -> surroundings by anchor -> an operator's own search in each group -> ranges per document.
The texts travel compressed and only once: both joins by ``doc_id`` read the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import shared as S

AT_SCHEMA = "key long, kind byte, doc_id long, at long, ats binary"
TEXT_SCHEMA = "key long, doc_id long, first long, last long, anchor int, body binary"
RANGE_SCHEMA = "key long, key2 long, doc_id long, first long, last long"
MOST_OFFSET = 127  # from a window's beginning to its anchor: 7 bits of a packed anchor

Batches = Iterator[pa.RecordBatch]


def anchor_batch(key, doc, place, at, first, last) -> pa.RecordBatch:
    """Anchors of one batch; ``place`` is the anchor's place in its document, the others are places in the batch.

    Those that the batch has settled travel as one row per document.
    """
    kind = S.combine(key)
    packed = (place << 14) | ((at - first) << 7) | (at - last)
    alone = np.flatnonzero(kind != S.KNOWN)
    known = np.flatnonzero(kind == S.KNOWN)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(doc[known])) + 1, [len(known)])) if len(known) else [0]
    lists = [packed[known[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])]
    owner = doc[known[cuts[:-1]]] if len(known) else doc[:0]
    columns = [
        pa.array(np.concatenate((key[alone], S.mix(owner.astype(np.uint64)).astype(np.int64)))),
        pa.array(np.concatenate((kind[alone], np.full(len(lists), S.KNOWN, np.int8)))),
        pa.array(np.concatenate((doc[alone], owner))),
        pa.array(np.concatenate((packed[alone], np.zeros(len(lists), np.int64)))),
        pa.array([None] * len(alone) + lists, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "kind", "doc_id", "at", "ats"])


def _compressed(batches: Batches) -> Batches:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        body = pa.array([pack(b.as_buffer()) for b in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), body], ["doc_id", "body"])


def surroundings(windows_of: Callable, same: Callable) -> Callable[[Batches], Batches]:
    """Per anchor the text that its windows cover; copies inside the batch are settled at once, as ranges without text.

    ``windows_of(body)`` gives a function (anchor, first, last) -> (hash, text) or None; ``same(owner, own)`` tells whether
    two equal windows at (doc_id, place) leave the second one in place.
    """

    def run(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = sorted((i for i, a in enumerate(batch.column(2)) if a.is_valid), key=lambda i: ids[i])
            seen: dict[tuple[bytes, int], tuple[int, int]] = {}
            out: list[tuple] = []
            for i in rows:
                doc, cut = int(ids[i]), windows_of(unpack(batch.column(1)[i].as_buffer()))
                ats = np.unique(np.asarray(batch.column(2)[i].values))
                anchor = ats >> 14
                first, last = anchor - ((ats >> 7) & 127), anchor - (ats & 127)
                done: list[list[int]] = []
                for a, lo, hi in zip(anchor.tolist(), first.tolist(), last.tolist()):
                    found = cut(a, lo, hi)
                    if found is None:
                        continue  # the id's texts differ
                    key, text = found
                    if same(seen.setdefault((text, a - lo), (doc, lo)), (doc, lo)):
                        if lo == hi and out and out[-1][1:2] + out[-1][3:] == (doc, lo - 1, a - lo, text):
                            out[-1] = (key, doc, out[-1][2], hi, a - lo, text)  # the same word or byte over and over
                        else:
                            out.append((key, doc, lo, hi, a - lo, text))
                    elif done and done[-1][1] + 1 == lo:
                        done[-1][1] = hi
                    else:
                        done.append([lo, hi])
                spread = xxhash.xxh64_intdigest(b"%d" % doc) - (1 << 63)
                out += [(spread, doc, lo, hi, 0, None) for lo, hi in done]
                if len(out) >= 10_000:
                    yield _text_batch(out)
                    out = []
            if out:
                yield _text_batch(out)

    return run


def _text_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "doc_id", "first", "last", "anchor", "body"]
    )


def _range_batch(key, key2, doc, first, last) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x, np.int64)) for x in (key, key2, doc, first, last)],
        ["key", "key2", "doc_id", "first", "last"],
    )


def _settled(doc, first, last) -> pa.RecordBatch:
    spread = S.mix(np.asarray(doc, np.int64).astype(np.uint64)).astype(np.int64)
    return _range_batch(spread, spread, doc, first, last)


def flag_ranges(flags, owner, doc, where, last):
    """Neighbouring flagged windows of a row as one range. A row's last window stands for all up to ``last``."""
    at = np.flatnonzero(flags)
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(owner[at]) != 0)))[: len(at)]
    low = at[new]
    high = at[np.concatenate((np.flatnonzero(new)[1:], [len(at)])) - 1] if len(at) else at
    ends = np.append(owner[1:] != owner[:-1], True)
    return doc[owner[low]], where[low], np.where(ends[high], last[owner[high]], where[high])


def search_groups(search: Callable, hashed: Callable, same: Callable, most: int) -> Callable[[Batches], Batches]:
    """Work through a stream sorted by anchor, document and place, one anchor's group at a time.

    Equal surroundings are settled on the way. Groups with several different ones are searched, a few at a time:
    ``search(bucket, doc, first, last, anchor, bodies)`` gives ranges. A group with ``most`` different ones is handed on as
    hashes of its windows, ``hashed(doc, first, last, bodies)``, so that memory stays bounded.
    """

    def flush(rows: list[tuple]) -> Batches:
        if rows:
            key, doc, first, last, anchor = (np.array(x, np.int64) for x in list(zip(*rows))[:5])
            bucket = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            yield _settled(*search(bucket, doc, first, last, anchor, [r[5] for r in rows]))

    def passed_on(rows: list[tuple]) -> Batches:
        for low in range(0, len(rows), 1000):
            _, doc, first, last, _, bodies = zip(*rows[low : low + 1000])
            key, key2, doc, at = hashed(doc, first, last, bodies)
            yield _range_batch(key, key2, doc, at, np.full(len(at), -1))

    def run(batches: Batches) -> Batches:
        ready: list[tuple] = []  # rows of finished groups with several different surroundings
        here: list[tuple] = []  # those of the group being read
        key, seen, spilled = None, {}, False
        for batch in batches:
            done: list[tuple[int, int, int]] = []
            for k, doc, first, last, anchor, body in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if body is None:
                    done.append((doc, first, last))
                    continue
                if k != key:
                    if spilled:
                        yield from passed_on(here)
                    elif len(here) > 1:
                        ready += here
                        if len(ready) >= most:
                            yield from flush(ready)
                            ready = []
                    key, seen, here, spilled = k, {}, [], False
                if not same(seen.setdefault((body, anchor), (doc, first)), (doc, first)):
                    done.append((doc, first, last))
                    continue
                here.append((k, doc, first, last, anchor, body))
                if len(here) >= most:
                    yield from passed_on(here)
                    here, seen, spilled = [], {}, True
            if done:
                yield _settled(*zip(*done))
        if spilled:
            yield from passed_on(here)
        elif len(here) > 1:
            ready += here
        yield from flush(ready)

    return run


def later_of_equal(by_place: bool) -> Callable[[Batches], Batches]:
    """Of hashed windows, sorted by hash and place, those after the first: in another document, or ``by_place`` also at
    another place of the same one. Settled ranges pass, neighbours of a document joined."""

    def run(batches: Batches) -> Batches:
        held = None
        for batch in batches:
            key, key2, doc, first, last = (batch.column(i).to_numpy() for i in range(5))
            settled = last >= 0
            d, lo, hi = doc[settled], first[settled], last[settled]
            new = np.concatenate(([True], (np.diff(d) != 0) | (lo[1:] > hi[:-1] + 1)))[: len(d)]
            at = np.flatnonzero(new)
            out = [(d[at], lo[at], np.maximum.reduceat(hi, at) if len(at) else hi)]
            rows = [x[~settled] for x in (key, key2, doc, first)]
            if len(rows[0]):
                if held is not None:
                    rows = [np.concatenate(([h], x)) for h, x in zip(held, rows)]
                new = np.concatenate(([True], (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)))
                leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
                other = rows[2] != rows[2][leader]
                if by_place:
                    other |= rows[3] != rows[3][leader]
                out.append((rows[2][other], rows[3][other], rows[3][other]))
                held = [x[leader[-1]] for x in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], ["doc_id", "first", "last"]
            )

    return run


def located(docs: DataFrame, anchor_rows, with_text, search, by_place: bool) -> DataFrame:
    """(doc_id, body, ranges): each document's compressed bytes and the starts of its repeated windows as ranges."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), S.utf8().alias("body"))
    packed = texts.mapInArrow(_compressed, "doc_id long, body binary")
    rows = texts.mapInArrow(anchor_rows, AT_SCHEMA)
    twice = rows.repartition("key").sortWithinPartitions("key").mapInArrow(S.repeated_keys, "doc_id long, at long")
    ats = twice.groupBy("doc_id").agg(F.collect_list("at").alias("ats"))
    groups = packed.join(ats, "doc_id", "left").mapInArrow(with_text, TEXT_SCHEMA)
    groups = groups.repartition("key").sortWithinPartitions("key", "doc_id", "first")
    ranges = groups.mapInArrow(search, RANGE_SCHEMA)
    ranges = ranges.repartition("key").sortWithinPartitions("key", "key2", "doc_id", "first")
    ranges = ranges.mapInArrow(later_of_equal(by_place), "doc_id long, first long, last long")
    found = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    return packed.join(found, "doc_id", "left")
