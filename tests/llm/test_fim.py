import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rtmart.llm import fim


def slow(doc_id, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or h3 % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return "plain", text, n, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, middle, tail = text[:a], text[a:b], text[b:]
    out = f"<S>{tail}<P>{head}<M>{middle}" if h4 % 100 < 20 else f"<P>{head}<S>{tail}<M>{middle}"
    return ("spm" if h4 % 100 < 20 else "psm"), out, n, a, b - a


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab<PSM>é漢😀", max_size=40), st.integers(0, 10_000))
def test_arrange_and_restore_against_slicing(text, doc_id):
    form, out, n, a, b = fim.arrange(text.encode(), doc_id)
    assert (form, out.decode(), n, a, b) == slow(doc_id, text)
    assert fim.restore(out, form).decode() == text


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("a" * 150_000, {fim.Runs}),
        ("é漢" * 60_000, {fim.Bitmap}),
        ("😀" * 2_000, {fim.Array, fim.Runs}),
        ("é" * 40_000 + "plain " * 30_000 + "漢😀a" * 9_000, {fim.Runs, fim.Bitmap}),
    ],
)
def test_select_in_every_container(text, kinds):
    places = fim.BoundarySet(text.encode())
    assert {type(c) for c in places.containers} <= kinds | {fim.Array}
    assert {type(c) for c in places.containers} & kinds
    ends = np.concatenate(([0], np.cumsum([len(c.encode()) for c in text])))
    picked = sorted({0, 1, len(text) - 1, len(text), *np.random.default_rng(1).integers(0, len(text), 300).tolist()})
    assert places.n == len(text)
    assert [places.select(k) for k in picked] == ends[picked].tolist()


def test_rows_of_every_kind(spark):
    long = "Wörter und 漢字 😀 " * 20_000
    rows = [(i, "naïve text %d" % i, "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "no id", "x"), (None, "no id", "x"), (102, "has <M> in it", "x"), (103, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = sorted(map(repr, (tuple(r) for r in fim.transform(docs).selectExpr("doc_id", "form", "decode(output, 'UTF-8')", "n", "prefix_chars", "middle_chars").collect())))
    assert got == sorted(repr((i, *slow(i, t))) for i, t, _ in rows)
    assert {r.form for r in fim.transform(docs).collect()} == {"plain", "spm", "psm"}
    whole = fim.digest(docs).collect()
    texts = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t, _ in rows}
    assert all(r.restored_sha256 == texts[r.doc_id] for r in whole)
    assert fim.digest(docs.where("false")).collect() == []
