"""Hashes, anchors and sorted-stream helpers that several corpus operators use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20  # bytes of text that one pass of array arithmetic holds
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POSITION = np.uint64((1 << 24) - 1)
_powers: list[np.ndarray] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, under the cluster's ``spark.checkpoint.dir``.

    Only a session that runs in this one process may do without that setting; elsewhere a local folder would be lost.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="rtmart-llm-")
    return f"{base.rstrip('/')}/rtmart-llm/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: computed once, and it outlives lost executors."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def utf8(column: str = "text"):
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


BYTE_VALUES = mix(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [
            np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(b)))))
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _powers[0], _powers[1]


def range_hashes(data: np.ndarray, starts, ends) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]`` (bytes), by one running sum."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    if isinstance(starts, slice):
        return mix((total[ends] - total[starts]) * down[: len(total[starts])])
    return mix((total[ends] - total[starts]) * down[starts])


def word_table(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words (runs without ASCII white space) of a byte array, block by block."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + BLOCK_BYTES)))
        base = starts[low]
        hashes[low:high] = range_hashes(data[base : ends[high - 1]], starts[low:high] - base, ends[low:high] - base)
        low = high
    return starts, ends, hashes


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchors(hashes: np.ndarray, width: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor of every window of ``width`` neighbouring hashes: the least hash, the leftmost of equal ones.

    The choice depends on the window's content alone, so equal windows have their anchor at the same place.
    ``label`` tells the document of a window start, -1 where no window may start. Returns, per anchor and document, its
    position and the first and last window start that chose it (an anchor may come in two rows).
    """
    found = []
    for low in range(0, len(hashes) - width + 1, BLOCK_BYTES):
        part = hashes[low : low + BLOCK_BYTES + width - 1]
        place = np.arange(len(part), dtype=np.uint64)
        chosen = (sliding_min((part & ~_POSITION) | place, width) & _POSITION).astype(np.int64)
        here = label[low : low + len(chosen)]
        change = np.flatnonzero((chosen[1:] != chosen[:-1]) | (here[1:] != here[:-1])) + 1
        first = np.concatenate(([0], change))
        last = np.concatenate((change, [len(chosen)])) - 1
        ok = here[first] >= 0
        found.append((chosen[first[ok]] + low, first[ok] + low, last[ok] + low))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


UNKNOWN, LEADER, KNOWN = 0, 1, 2


def combine(keys: np.ndarray) -> np.ndarray:
    """Map-side step of the search for keys that occur twice.

    Within one batch every key seen twice is settled: its first row goes on as LEADER, the others are KNOWN and need not
    meet anybody, so a key that a third of all rows share sends one row per batch. The rest is UNKNOWN.
    """
    _, index, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    kind = np.where(count[inverse] > 1, KNOWN, UNKNOWN).astype(np.int8)
    kind[index[count > 1]] = LEADER
    return kind


def repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, at) whose key occurs twice, from a stream sorted by key; holds one row between batches.

    KNOWN rows bring a list of places."""
    held = None
    for batch in batches:
        key, kind, doc, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        known = kind == KNOWN
        lists = batch.column(4).filter(pa.array(known)).to_pylist()
        out_doc = np.repeat(doc[known], [len(x) // 8 for x in lists])
        out_at = np.frombuffer(b"".join(lists), np.int64)
        key, kind, doc, at = key[~known], kind[~known], doc[~known], at[~known]
        if held is not None:
            key, kind, doc, at = (np.concatenate(([h], x)) for h, x in zip(held, (key, kind, doc, at)))
        if len(key):
            same = key[1:] == key[:-1]
            twice = kind == LEADER
            twice[1:] |= same
            twice[:-1] |= same
            held = (key[-1], LEADER if twice[-1] else UNKNOWN, doc[-1], at[-1])
            twice[-1] = False
            out_doc, out_at = np.concatenate((out_doc, doc[twice])), np.concatenate((out_at, at[twice]))
        yield pa.RecordBatch.from_arrays([pa.array(out_doc, pa.int64()), pa.array(out_at, pa.int64())], ["doc_id", "at"])
    if held is not None and held[1] == LEADER:
        yield pa.RecordBatch.from_arrays([pa.array([held[2]], pa.int64()), pa.array([held[3]], pa.int64())], ["doc_id", "at"])


def merge_ranges(first: np.ndarray, last: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Union of ``[first, last + reach)`` as sorted, disjoint, maximal ``[start, end)``."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + reach)
    new = np.concatenate(([True], start[1:] > end[:-1])) if len(start) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    stop = np.concatenate((at[1:], [len(start)])) - 1 if len(at) else at
    return start[at], end[stop]


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column."""
    buffers = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64), data
