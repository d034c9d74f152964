"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into words at places that no match of the pattern can cross (``pieces``). A chunk of documents sends each of its
distinct words once, in the order of their first position, to the bucket of the word's hash. There every distinct word of
the corpus is encoded once, however many chunks sent it; its ids go back to the chunks, which put their documents together by
position. Nothing travels per position: texts go to the join as compressed chunks. Every chunk sends one row to every bucket,
so a frequent word weighs no more than a rare one, and a bucket's task holds that bucket's distinct words only.
Decoding looks the ids up in the table of token bytes, whose size is that of the vocabulary.

Chunks are cut twice from the same scan and named by content and place. Should a changed input give different chunks, the
join raises instead of losing documents.

Defined results: a null text is empty and has no ids; repeated rows and rows with a null ``doc_id`` are encoded like others;
other columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import shared as S
from rtmart.llm.pieces import pieces

CHUNK_BYTES = 16 << 20
_ENCODED = "doc_id long, ids array<int>"


def load_ranks(vocabulary: str | None) -> dict[bytes, int]:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(vocabulary, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _encoding(vocabulary: str | None):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(vocabulary), special_tokens={}
    )


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int):
    """(name, rows) of runs of documents of about ``chunk_bytes``; a batch is never joined with the next one."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        offsets, data = S.ragged(batch.column(1))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + chunk_bytes, side="right")) - 1)
            content = xxhash.xxh64_intdigest(data[offsets[low] : offsets[high]].tobytes())
            name = xxhash.xxh64_intdigest(b"%d.%d.%d.%d" % (part, n, high - low, content)) - (1 << 63)
            yield name, batch.slice(low, high - low)
            low, n = high, n + 1


def _blob(values: list[bytes]) -> bytes:
    lengths = np.array([len(v) for v in values], np.uint32)
    return zstandard.compress(np.uint32(len(values)).tobytes() + lengths.tobytes() + b"".join(values), 1)


def _unblob(data) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(data, np.uint32, n, 4), dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def _bucketed(texts, buckets: int) -> dict[int, list[str]]:
    """The distinct words of some texts in order of first position, by bucket."""
    words: dict[str, None] = {}
    for text in texts:
        words.update(dict.fromkeys(pieces(text)))
    out: dict[int, list[str]] = {}
    for word in words:
        out.setdefault(xxhash.xxh64_intdigest(word) % buckets, []).append(word)
    return out


def _texts(rows: pa.RecordBatch) -> Iterator[str]:
    return (b.as_buffer().to_pybytes().decode() for b in rows.column(1))


def _words(chunk_bytes: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in _chunks(batches, chunk_bytes):
            by = _bucketed(_texts(rows), buckets)
            if by:
                columns = [
                    pa.array([name] * len(by), pa.int64()),
                    pa.array(list(by), pa.int64()),
                    pa.array([_blob([w.encode() for w in words]) for words in by.values()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "words"])

    return run


def _packed_chunks(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in _chunks(batches, chunk_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows)
            body = zstandard.compress(sink.getvalue(), 3)
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([body], pa.binary())], ["chunk", "body"])

    return run


def _encode_words(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at, known = _encoding(vocabulary).encode_ordinary, None, {}
        for batch in batches:
            out = []
            for bucket, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                if bucket != at:
                    at, known = bucket, {}
                words = _unblob(blob.as_buffer())
                for word in words:
                    if word not in known:
                        known[word] = np.array(encode(word.decode()), "<u4").tobytes()
                out.append(_blob([known[w] for w in words]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["chunk", "bucket", "ids"])

    return run


def _assemble(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, found in zip(batch.column(1), batch.column(2)):
                with pa.ipc.open_stream(zstandard.decompress(body.as_buffer())) as reader:
                    rows = reader.read_next_batch()
                by = _bucketed(_texts(rows), buckets)
                ids = {r["bucket"].as_py(): _unblob(r["ids"].as_buffer()) for r in found.values} if found.is_valid else {}
                table: dict[str, bytes] = {}
                for bucket, words in by.items():
                    if len(words) != len(ids.get(bucket, ())):
                        raise RuntimeError("a chunk of documents was cut differently when it was read again")
                    table.update(zip(words, ids[bucket]))
                docs = rows.column(0).to_pylist()
                done, size, start = [], 0, 0
                for i, text in enumerate(_texts(rows)):
                    done.append(b"".join(map(table.__getitem__, pieces(text))))
                    size += len(done[-1])
                    if size > 8 << 20 or i + 1 == len(docs):
                        ends = np.concatenate(([0], np.cumsum([len(d) // 4 for d in done]))).astype(np.int32)
                        column = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(done), "<i4")))
                        yield pa.RecordBatch.from_arrays([pa.array(docs[start : i + 1], pa.int64()), column], ["doc_id", "ids"])
                        done, size, start = [], 0, i + 1

    return run


def encode(docs: DataFrame, vocabulary: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, ids) of every document. ``vocabulary`` is a file of ranks that every worker can read; by default the public
    byte-level one of 50,256 ids."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), S.utf8().alias("body"))
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = base.mapInArrow(_words(chunk_bytes, buckets), "chunk long, bucket long, words binary")
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(_encode_words(vocabulary), "chunk long, bucket long, ids binary")
    ids = ids.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ids")).alias("ids"))
    chunks = base.mapInArrow(_packed_chunks(chunk_bytes), "chunk long, body binary")
    return chunks.join(ids, "chunk", "left").mapInArrow(_assemble(buckets), _ENCODED)


def decode_ids(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def token_bytes(vocabulary: str | None = None) -> list[bytes]:
    """Bytes by id."""
    ranks = load_ranks(vocabulary)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _decode(vocabulary: str | None, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(vocabulary)
        for batch in batches:
            column = batch.column(1)
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            docs, counts, own, bodies = batch.column(0), [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                ids = values[a:b]
                body = decode_ids(ids, table)
                counts.append(int(b - a))
                if digests:
                    own.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    body = hashlib.sha256(body).hexdigest()
                bodies.append(body)
            if digests:
                columns = [docs, pa.array(counts, pa.int64()), pa.array(own, pa.string()), pa.array(bodies, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([docs, pa.array(bodies, pa.binary())], ["doc_id", "body"])

    return run


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, body) with the bytes of each document's ids."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocabulary, False), "doc_id long, body binary")


def digest(docs: DataFrame) -> DataFrame:
    return encode(docs).mapInArrow(
        _decode(None, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
