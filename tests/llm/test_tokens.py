import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rtmart.llm import bpe, packing
from rtmart.llm.pieces import CachedEncoder, long_parts, pieces

ENC = tiktoken.Encoding(
    "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(None), special_tokens={}
)
ODD = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "x\n\n y", "don't we'll", "  a", "1 2  3\t4", "  é", "<|endoftext|> x",
       "日本語 テキスト", "a" * 3000, " " * 5000 + "x", "\x1c a\x1f b", "😀 😀😀"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t ab'sé1. <|>日\x1c"), max_size=40))
def test_pieces_never_cross_a_match(text):
    parts = pieces(text)
    assert "".join(parts) == text
    assert [i for p in parts for i in ENC.encode_ordinary(p)] == ENC.encode_ordinary(text)
    cached = CachedEncoder(lambda ps: [np.array(ENC.encode_ordinary(p), "<u4").tobytes() for p in ps])
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in cached.ids([text, "", text])] == [ENC.encode_ordinary(t) for t in (text, "", text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t ab'sé1. <|>日\x1c"), max_size=40), st.integers(1, 9))
def test_long_parts_never_cross_a_match(text, most):
    parts = long_parts(text, most)
    assert "".join(parts) == text
    assert [i for p in parts for i in ENC.encode_ordinary(p)] == ENC.encode_ordinary(text)


def test_texts_are_encoded_whole(monkeypatch):
    path, calls = public_tokenizers.path("byte_bpe_50k.json"), []
    plain = tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: calls.append(len(text)) or plain(self, text))
    packing._encoder.cache_clear()
    rng = random.Random(3)
    texts = ODD + [" ".join("".join(rng.choices("aeinorst,.é", k=7)) for _ in range(400)) for _ in range(50)] + ["some words " * 100_000]
    got = packing._encoder(path).ids(texts)
    packing._encoder.cache_clear()
    # A call a text and a bounded part of a long one, not a call for every new word.
    assert len(calls) <= len(texts) + 10 and max(calls) < 300_000
    tokenizer = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def docs(spark):
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(["the", "loweihr", "Ünd", "x\ny", "42,"]) for _ in range(rng.randint(0, 3000))) for _ in range(40)]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, "no id", "k"), (0, "same id", "k"), (900, None, "k")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, chunk string").repartition(3)


def test_bpe_equals_the_library_and_round_trips(spark):
    rows, frame = docs(spark)
    expected = sorted(
        (d if d is not None else -1, len(ids := ENC.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in rows)
    got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in bpe.digest(frame).collect())
    assert got == expected
    small = bpe.decode(bpe.encode(frame, chunk_bytes=200)).collect()
    assert sorted(bytes(r.body) for r in small) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.digest(frame.where("false")).collect() == []


@pytest.mark.parametrize("window", [2048, 64])
def test_packing_covers_every_id_once(spark, window):
    rows, frame = docs(spark)
    rows = [r for r in rows if r[0] is not None and r[1] != "same id"]
    odd = [(9001, "a <|endoftext|> b", "x"), (9002, "<|endoftext|>", "x"), (9003, "long " * 40_000 + "<|endoftext|>x", "x"), (9004, "w" * 2_000_000, "x")]
    frame = frame.where("doc_id is not null and (text is null or text <> 'same id')").select("doc_id", "text")
    frame = frame.unionByName(spark.createDataFrame([r[:2] for r in odd], "doc_id long, text string"))
    rows += odd
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t, _ in rows}
    out = packing.pack(frame, window=window).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        own = ids[r.doc_id]
        assert r.ids == own[r.start : r.start + r.length] and r.length > 0 and r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc])
    assert set(by_doc) == set(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0
    assert packing.digest(frame.where("false")).collect() == []


def test_ranks_of_the_tokenizer_file():
    ranks = packing.byte_ranks(public_tokenizers.path("byte_bpe_50k.json"))
    assert ranks == bpe.load_ranks(None)
    assert packing.byte_ranks(public_tokenizers.path("word_bpe_49k.json")) is None
    encoder = packing._encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert len(encoder.encode(["some words"])[0]) % 4 == 0


def test_sum_of_squares_choice():
    packer = packing.Packer(10, 0)
    packer.levels[[3, 5]] = 4, 1
    assert packer.level_for(4) == 3  # from the crowded level to the empty one
    packer.levels[:] = 0
    packer.levels[6] = 1
    assert packer.level_for(4) == 6  # fills the window
    packer.levels[:] = 0
    assert packer.level_for(4) == 0


def test_packing_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "no id"), (None, "no id"), (4, "twice here"), (4, "twice here"), (5, None)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start long, length long").repartition(1)
    out = packing.pack(frame).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(((d, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for d, t in rows), key=repr)
    got, begun = [], {}
    for r in sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        if r.length == r.doc_tokens:
            got.append((r.doc_id, *r.ids))
        else:
            begun.setdefault((r.doc_id, r.start), []).append(r)
    cut = [(d, *a.ids) for (d, _), parts in begun.items() for a in parts]
    assert sorted(x for g in got + cut for x in g[1:]) == sorted(x for w in want for x in w[1:])
    assert all(g in want for g in got)


def test_levels_stay_open_until_the_task_ends():
    rng = np.random.default_rng(0)
    packer = packing.Packer(2048, 0)
    sizes = rng.integers(1, 2047, 4000)
    for i, n in enumerate(sizes):
        packer.add(i, np.arange(n, dtype="<u4").tobytes())
        assert sum(map(len, packer.open.values())) == packer.levels.sum()
    # Until here only the choice of levels closed windows, full ones.
    lengths = Counter()
    for d in packer.done:
        lengths[d[5]] += d[2]
    assert set(lengths.values()) == {2048} and packer.levels.sum() > 1000
    packer.finish()
    total = len({d[5] for d in packer.done})
    assert sum(d[2] for d in packer.done) == sizes.sum() and total <= sizes.sum() // 2048 + 12
