"""Fill-in-middle transformation with a compressed set of cut places per text.

A text travels as UTF-8 bytes. The places where it may be cut (the first byte of every code point, and the end) form a
``BoundarySet``: places are grouped by their upper bits into containers of 65,536 bytes, each stored as the smallest of a sorted
array, a bitmap or runs, with the number of places before each container. The byte offset of the k-th place is found by a search
over these numbers and a select inside one container, so both cuts of a text are found without decoding it, and a text of one-byte
characters costs one run per container.

Which documents are rearranged, how, and where they are cut follows from the SHA-256 of a salt and ``doc_id`` alone, so a row gives
the same result on every run and in every partition; nothing is shuffled.

Defined results: a null or empty text, one that already holds a mark, and the share left out stay as they are (``plain``);
a null ``doc_id`` hashes like an empty one; repeated rows give equal rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import shared as S

# Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CHUNK = 1 << 16  # bytes of text per container
PLAIN_FROM = 90  # of 100 documents, those from here on stay plain
SPM_BELOW = 20  # of 100 rearranged documents, those below put the suffix first
SCHEMA = "doc_id long, form string, output binary, n long, prefix_chars long, middle_chars long"


class Runs:
    """Maximal runs of neighbouring places."""

    def __init__(self, places: np.ndarray, edges: np.ndarray):
        self.start = places[np.concatenate(([0], edges))]
        self.before = np.concatenate(([0], edges))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.start[run]) + k - int(self.before[run])


class Array:
    """Sorted places."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.places[k])


class Bitmap:
    """One bit per byte, with the number of places before each 64-bit word."""

    def __init__(self, is_place: np.ndarray):
        bits = np.zeros(CHUNK, np.uint8)
        bits[: len(is_place)] = is_place
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[k - int(self.before[word])])


def container(is_place: np.ndarray) -> Runs | Array | Bitmap:
    """The smallest form for the places of one chunk: 4 bytes a run, 2 bytes a place, or 8 KiB of bits."""
    places = np.flatnonzero(is_place)
    edges = np.flatnonzero(np.diff(places) != 1) + 1
    runs, array, bitmap = 4 * (len(edges) + 1), 2 * len(places), CHUNK // 8
    if len(places) and runs <= min(array, bitmap):
        return Runs(places, edges)
    return Array(places) if array <= bitmap else Bitmap(is_place)


class BoundarySet:
    """The places where a UTF-8 text may be cut, in order; place ``n`` is its end."""

    def __init__(self, body: bytes):
        data = np.frombuffer(body, np.uint8)
        self.size = len(data)
        self.containers, counts = [], []
        for low in range(0, len(data), CHUNK):
            is_place = (data[low : low + CHUNK] & 0xC0) != 0x80
            self.containers.append(container(is_place))
            counts.append(int(np.count_nonzero(is_place)))
        self.before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))

    @property
    def n(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The byte offset of place ``k``, 0 to ``n``."""
        if k == self.n:
            return self.size
        chunk = int(np.searchsorted(self.before, k, side="right")) - 1
        return chunk * CHUNK + self.containers[chunk].select(k - int(self.before[chunk]))


def arrange(body: bytes, doc_id: int | None, salt: str = "1") -> tuple[str, bytes, int, int | None, int | None]:
    """(form, output, code points, code points of the prefix, of the middle) of one text."""
    places = BoundarySet(body)
    n = places.n
    digits = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in range(0, 32, 8))
    if not body or h3 % 100 >= PLAIN_FROM or any(mark in body for mark in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", body, n, None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = places.select(first), places.select(second)
    head, middle, tail = body[:a], body[a:b], body[b:]
    if h4 % 100 < SPM_BELOW:
        return "spm", SUFFIX + tail + PREFIX + head + MIDDLE + middle, n, first, second - first
    return "psm", PREFIX + head + SUFFIX + tail + MIDDLE + middle, n, first, second - first


def restore(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given. A text that holds a mark is never rearranged, so the first mark found is the one set."""
    if form == "plain":
        return output
    left, right = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    second = output.index(right, len(left))
    third = output.index(MIDDLE, second + len(right))
    one, two, middle = output[len(left) : second], output[second + len(right) : third], output[third + len(MIDDLE) :]
    return (two + middle + one) if form == "spm" else (one + middle + two)


def _arranged(salt: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [arrange(b.as_buffer().to_pybytes(), i, salt) for i, b in zip(ids, batch.column(1))]
            form, output, n, prefix, middle = zip(*rows) if rows else ((),) * 5
            columns = [
                batch.column(0),
                pa.array(form, pa.string()),
                pa.array(output, pa.binary()),
                *(pa.array(x, pa.int64()) for x in (n, prefix, middle)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "form", "output", "n", "prefix_chars", "middle_chars"])

    return run


def transform(docs: DataFrame, salt: str = "1") -> DataFrame:
    """One row per document: ``output`` (UTF-8 bytes), its ``form`` and the lengths of the parts in code points."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), S.utf8().alias("body"))
    return rows.mapInArrow(_arranged(salt), SCHEMA)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forms = batch.column(1).to_pylist()
        texts = [restore(o.as_buffer().to_pybytes(), f) for o, f in zip(batch.column(2), forms)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "restored"])


def restored(arranged: DataFrame) -> DataFrame:
    """``arranged`` (rows of :func:`transform`) with the texts rebuilt from output and form, as UTF-8 bytes."""
    return arranged.mapInArrow(_restored, f"{SCHEMA}, restored binary")


def digest(docs: DataFrame) -> DataFrame:
    return restored(transform(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLE = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbers AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
  FROM hashed
), cut AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR h3 >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substr(t, 1, a) AS head, substr(t, a + 1, b - a) AS middle, substr(t, b + 1, n - b) AS tail FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle
              ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
