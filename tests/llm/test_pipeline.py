import importlib.util
import os
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
import public_tokenizers
from rtmart.llm import queries, toxicity
from tests.llm.test_native_rules import slow_lines
from tests.llm.test_secret_scan import SLOW
from tests.llm.test_simhash_dedup import slow_classes, slow_print


def masked(text):
    """Base kinds in order, each on what the one before left."""
    for pattern, group, least in SLOW.values():
        text = pattern.sub(lambda m: "[secret]" if len(m[group]) >= least else m[0], text)
    return text


def test_stages_against_brute_force(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r.score for r in toxicity.digest(docs, labels).collect()}
    kept = {k: r for k, r in rows.items() if scores[k] < 0.3}
    lines = slow_lines([(k, r.text, r.source) for k, r in kept.items()], 10)
    texts = {k: lines[k][2] for k in kept}
    roots = slow_classes({k: slow_print(t) for k, t in texts.items()}, 3)
    texts = {k: masked(t) for k, t in texts.items() if roots[k] == k}
    assert 0 < len(texts) < len(kept) < len(rows)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        parts.setdefault(r.doc_id, []).append((r.start, r.ids))
    got = {k: np.concatenate([ids for _, ids in sorted(p)]).tolist() for k, p in parts.items()}
    assert got == {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for k, t in texts.items()}


@pytest.mark.parametrize("at", range(4))
def test_stages_keep_columns_and_odd_rows(spark, sf_dir, at):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "plain words of a text", "en", "s", 21), (2, None, None, None, None), (None, "no id here at all", "en", "s", 1), (3, "", "en", "s", 0)]
    frame = spark.createDataFrame(rows + rows[:1], schema)
    out = corpus_pipeline.STAGES[at][1](spark, frame, sf_dir)
    assert out.schema.simpleString() == frame.schema.simpleString()
    assert {1, None} <= {r.doc_id for r in out.collect()}
    assert corpus_pipeline.STAGES[at][1](spark, frame.where("false"), sf_dir).collect() == []


def test_stages_keep_columns_of_clashing_names(spark, sf_dir):
    extra = ["_doc", "_gone", "_lines", "_cuts", "_own", "_blob", "_all", "_row", "key", "_toxic"]
    frame = spark.createDataFrame([(1, "one line\npassword = abcdefgh12", "s", *extra), (2, None, None, *extra)], ["doc_id", "text", "source", *extra])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, sf_dir)
        assert out.columns == frame.columns
        assert sorted(tuple(r)[3:] for r in out.collect()) == [tuple(extra)] * 2


def test_packing_stage_takes_odd_rows(spark, sf_dir):
    rows = [(1, "plain words"), (2, None), (None, "no id"), (3, ""), (1, "plain words")]
    out = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sum(r.length for r in out) == 2 * 3 + 1 + 3 + 1 and {r.doc_id for r in out} == {1, 2, 3, None}


def test_every_query_is_registered():
    assert importlib.util.find_spec("__spark_entry__")
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and set(queries.queries()) <= set(names)
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 14))
