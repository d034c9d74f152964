"""Packing token streams into fixed windows by the sum-of-squares rule.

Every document's ids, closed by an end id, are cut into full windows and a remainder. The remainder goes to the fill
level, or a new window, that minimises the sum of squared counts of partially filled windows over an array of levels.
Each task packs what it reads, so nothing is shuffled. Every level stays open until the task ends: its windows hold ids of the
task's own input only, at most what one input split brings. What is partly filled then is settled: the emptiest are cut up to fill
the fullest, and the last one is cut into sequences whose lengths are powers of two, which need no padding.

Ids are those of the library's plain call: a text that holds the string of an added token of the vocabulary gives that token's id.

Defined results: a null or empty text is the end id alone; repeated rows and rows with a null ``doc_id`` are packed like others;
other columns are not carried. A sequence id tells the task (upper bits) and the sequence in it.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm.pieces import BLOCK_CHARS, CachedEncoder, TextEncoder, runs

WINDOW = 2048
END_ID = 1
TASK_BITS = 40
CHECKED = 100_000  # characters of each worker that both encoders see, to the end of a part
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Packer:
    """Windows of one task. A piece is (doc_id, start, ids as bytes, tokens of its document)."""

    def __init__(self, window: int, task: int):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)  # count of open windows by fill; 0 and full stay empty
        self.open: dict[int, deque] = {}  # fill -> windows, each a list of pieces
        self.next = task << TASK_BITS
        self.done: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, zlib.crc32(ids), total, self.next, offset, ids))
            offset += n
        self.next += 1

    def level_for(self, size: int) -> int:
        """The fill level, 0 for a new window, whose choice adds least to the sum of squares."""
        low = self.window - size
        counts = self.levels[1 : low + 1]
        used = np.flatnonzero(counts)
        gain = 2 * self.levels[used + 1 + size] - 2 * counts[used] + 2
        gain[used + 1 == low] -= 2 * self.levels[self.window] + 1  # a filled window leaves the sum
        fresh = 2 * self.levels[size] + 1
        if len(used) and gain.min() <= fresh:
            return int(used[np.flatnonzero(gain == gain.min())[-1]]) + 1
        return 0

    def add(self, doc, ids: bytes) -> None:
        total, step, at = len(ids) // 4, self.window * 4, 0
        while len(ids) - at >= step:
            self.close([(doc, at // 4, ids[at : at + step], total)])
            at += step
        if at == len(ids):
            return
        piece, size = (doc, at // 4, ids[at:], total), total - at // 4
        level = self.level_for(size)
        pieces = [piece]
        if level:
            pieces = self.open[level].pop() + pieces
            self.levels[level] -= 1
        if level + size == self.window:
            self.close(pieces)
            return
        self.open.setdefault(level + size, deque()).append(pieces)
        self.levels[level + size] += 1

    def settle(self) -> None:
        """Fill the fullest open windows with what the emptiest hold until at most one is left."""
        rows = deque(w for fill in sorted(self.open) for w in self.open[fill])
        self.open = {}
        self.levels[:] = 0
        while len(rows) > 1:
            target = rows.pop()
            gap = self.window - sum(len(p[2]) // 4 for p in target)
            while gap and rows:
                doc, start, ids, total = rows[0].pop()
                n = min(gap, len(ids) // 4)
                target.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    rows[0].append((doc, start + n, ids[4 * n :], total))
                elif not rows[0]:
                    rows.popleft()
                gap -= n
            if gap:
                rows.append(target)
                break
            self.close(target)
        for pieces in rows:
            fill = sum(len(p[2]) // 4 for p in pieces)
            self.open.setdefault(fill, deque()).append(pieces)
            self.levels[fill] += 1

    def finish(self) -> None:
        self.settle()
        for pieces in [w for rows in self.open.values() for w in rows]:
            left = sum(len(p[2]) // 4 for p in pieces)
            pieces = pieces[::-1]
            while left:
                size = 1 << (left.bit_length() - 1)
                left -= size
                part = []
                while size:
                    doc, start, ids, total = pieces.pop()
                    n = min(size, len(ids) // 4)
                    part.append((doc, start, ids[: 4 * n], total))
                    if 4 * n < len(ids):
                        pieces.append((doc, start + n, ids[4 * n :], total))
                    size -= n
                self.close(part)
        self.open = {}
        self.levels[:] = 0


def byte_ranks(vocabulary: str) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level tokenizer file as ranks, if its ids follow the order of its merges; None for others."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if model.get("type") != "BPE" or not plain or spec.get("normalizer") or model.get("ignore_merges"):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in pairs]
    singles = [model["vocab"][c] for c in byte_of]
    if any(x >= y for x, y in zip(ids, ids[1:])) or ids and max(singles) >= ids[0]:
        return None
    words = [*byte_of, *[a + b for a, b in pairs]]
    return {bytes(byte_of[c] for c in w): model["vocab"][w] for w in words}


@functools.lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> CachedEncoder | TextEncoder:
    """One per worker process, for the tasks that it runs one after the other.

    The ids are those of the tokenizers library. Where the file allows it, texts are encoded by the same ranks in tiktoken,
    several times faster; the first texts of every worker are encoded by both, and a difference raises.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def by_library(parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    ranks = byte_ranks(vocabulary)
    if ranks is None:
        return CachedEncoder(by_library, by_library, added)
    import public_tokenizers
    import tiktoken

    encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    left = CHECKED

    def by_ranks(parts: list[str]) -> list[bytes]:
        nonlocal left
        out = [np.array(array("I", encode(p)), "<u4").tobytes() for p in parts]
        for part, ids in zip(parts, out):
            if left <= 0:
                break
            if by_library([part])[0] != ids:
                raise ValueError("the tokenizer file and its ranks disagree")
            left -= len(part)
        return out

    return TextEncoder(by_ranks, by_library, added)


def _pack(window: int, end_id: int, vocabulary: str | None, with_ids: bool):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:7]]
        if not with_ids:
            return pa.RecordBatch.from_arrays(columns, _FIELDS)
        ids = [np.frombuffer(r[7], "<i4") for r in rows]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        column = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
        return pa.RecordBatch.from_arrays([*columns, column], [*_FIELDS, "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        encoder, end = _encoder(path), int(end_id).to_bytes(4, "little")
        packer = Packer(window, TaskContext.get().partitionId())
        for batch in batches:
            docs, column = batch.column(0).to_pylist(), batch.column(1)
            lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for low, high in runs(lengths, BLOCK_CHARS):
                texts = [t or "" for t in column.slice(low, high - low).to_pylist()]
                for doc, ids in zip(docs[low:high], encoder.ids(texts)):
                    packer.add(doc, ids + end)
                    if len(packer.done) >= 4096:
                        yield batch_of(packer.done)
                        packer.done = []
        packer.finish()
        if packer.done:
            yield batch_of(packer.done)
        pa.default_memory_pool().release_unused()

    return run


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, the ids.

    ``vocabulary`` is a tokenizer file that every worker can read; by default the public byte-level one of 50,257 ids.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ", ".join(f"{f} long" for f in _FIELDS) + (", ids array<int>" if with_ids else "")
    return base.mapInArrow(_pack(window, end_id, vocabulary, with_ids), schema)


def digest(docs: DataFrame) -> DataFrame:
    return pack(docs, with_ids=False)
