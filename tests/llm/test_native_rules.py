import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from rtmart.llm import line_dedup, quality_rules


def texts():
    rng = random.Random(5)
    lines = [f"line {i} of all" for i in range(40)]
    out = []
    for _ in range(120):
        out.append("\n".join(rng.choice(lines[: rng.choice([3, 40])]) + rng.choice(["", "", " ", "\t"]) if rng.random() < 0.8 else f"own {rng.random()}"
                             for _ in range(rng.randint(0, 9))))
    return out + ["", "\n\n", " \n \n", None]


def slow_lines(rows, least):
    sites, first = defaultdict(set), {}
    for doc, text, site in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for i, line in enumerate((text.split("\n") if text is not None else [])):
            word = line.strip(line_dedup.BLANKS)
            if word:
                sites[word].add(site or "")
                first.setdefault(word, (doc, i))
    out = {}
    for doc, text, _ in rows:
        if text is None:
            out[doc] = (0, 0, None)
            continue
        lines = text.split("\n")
        kept = [x for i, x in enumerate(lines) if doc is None or (w := x.strip(line_dedup.BLANKS)) == "" or len(sites[w]) < least or first[w] == (doc, i)]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("least", [2, 5, 10])
def test_lines_against_brute_force(spark, least):
    rng = random.Random(least)
    rows = [(i, t, rng.choice([None, *[f"s{k}" for k in range(12)]])) for i, t in enumerate(texts())]
    rows.append((None, "line 0 of all\nline 1 of all", "s1"))
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, n_removed_before int").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup(frame, least).collect()}
    assert got == slow_lines(rows, least)
    assert "n_removed_before" in line_dedup.dedup(frame, least).columns


def test_line_oracle(spark):
    rows = [(i, t, f"s{i % 11}") for i, t in enumerate(texts()[:-1])]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(tuple, line_dedup.digest(documents).collect()))
    table = documents.toArrow()  # noqa: F841
    with duckdb.connect() as db:
        db.register("documents", table)
        assert got == sorted(db.sql(line_dedup.ORACLE).fetchall())
    assert line_dedup.digest(documents.where("false")).collect() == []


def test_line_texts_travel_once(spark):
    documents = spark.createDataFrame([(i, t, f"s{i % 11}") for i, t in enumerate(texts())], "doc_id long, text string, source string")
    plan = line_dedup.dedup(documents)._jdf.queryExecution().optimizedPlan()
    # Lines are cut out once for the last join, not again for every step that decides on them.
    assert plan.toString().count("Generate posexplode") == 1
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    output = plan.children().apply(0).output()
    names = {output.apply(i).name() for i in range(output.size())}
    assert names == {"_row", "_id"}


def slow_counts(text):
    words = [w for w in "".join(" " if c in quality_rules.SPACES else c for c in text or "").split(" ") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(quality_rules.SPACES)]
    return (len(words), sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force(spark):
    rng = random.Random(9)
    rows = texts() + ["a b", "a b c", "a a a a", "a b c a b c", "é b #*|  x\x0by", "😀 b c 😀 b c"]
    rows += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(rows)], "doc_id long, text string, w string")
    out = quality_rules.judge(frame).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in out} == {i: slow_counts(t) for i, t in enumerate(rows)}
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
    assert quality_rules.digest(frame.where("false")).collect() == []


def test_accuracies_are_found():
    rng = random.Random(2)
    hits, patterns = [0.9, 0.6, 0.4, 0.3], Counter()
    for _ in range(20_000):
        bad = rng.random() < 0.2
        patterns[tuple(0 if rng.random() < 0.1 else (-1 if bad and rng.random() < h else 1) for h in hits)] += 1
    model = quality_rules.estimate(patterns, 4)
    assert abs(model.share - 0.8) < 0.05
    assert all(abs(model.accuracy(j)[1] - h) < 0.07 and model.accuracy(j)[0] > 0.99 for j, h in enumerate(hits))


def slow_quality(votes, rounds):
    """The same fit document by document, on arrays."""
    n, rules = votes.shape
    cast = np.stack([votes == v for v in (-2, -1, 0, 1)]).astype(float)  # vote, document, rule
    against = np.where(votes < 0, -votes, 0).sum(axis=1)
    p = np.where((votes == -2).any(axis=1), 0.02, np.where(against == 0, 0.9, np.where(against == 1, 0.5, 0.1)))
    for at in range(rounds + 1):
        good = np.einsum("vdr,d->vr", cast, p)
        bad = np.einsum("vdr,d->vr", cast, 1 - p) + np.array(quality_rules._BAD)[:, None]
        bad /= bad.sum(axis=0)
        mass = good.sum(axis=0)
        clear = (good[0] + 0.0005 * 20 * n) / (mass + 20 * n)
        alarm = (good[1] + 0.02 * 0.02 * n) / (mass + 0.02 * n)
        rest = good[2:] + np.array([[1.0], [8.5]])
        good = np.vstack((clear, alarm, rest / rest.sum(axis=0) * (1 - clear - alarm)))
        no = (votes < 0).astype(float)
        w = (1 - p) / (1 - p).sum()
        rate = w @ no
        both = (no * w[:, None]).T @ no - np.outer(rate, rate)
        spread = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate)))
        phi = np.where(spread > 0, np.maximum(both, 0) / np.where(spread > 0, spread, 1), 0)
        np.fill_diagonal(phi, 0)
        ratio = np.log(good / bad)
        ratio[:2], ratio[2], ratio[3] = np.minimum(ratio[:2], 0), 0, np.maximum(ratio[3], 0)
        ratio /= 1 + phi.sum(axis=1) * (at == rounds)
        share = min(0.99, max(0.01, p.mean()))
        p = 1 / (1 + np.exp(-(np.log(share / (1 - share)) + np.einsum("vdr,vr->d", cast, ratio))))
    return p


def test_noisy_rules_do_not_reject_alone():
    """Two rules that vote against one good document in twelve, two that hardly err; and a pair that always votes alike."""
    rng = np.random.default_rng(4)
    n = 20_000
    bad = rng.random(n) < 0.15
    alarm, hit = np.array([0.08, 0.08, 0.001, 0.001]), np.array([0.6, 0.6, 0.6, 0.6])
    votes = np.where(rng.random((n, 4)) < np.where(bad[:, None], hit, alarm), -1, 1)
    model = quality_rules.estimate(Counter(map(tuple, votes.tolist())), 4)
    want = slow_quality(votes, quality_rules.ROUNDS)
    assert np.allclose([model.posterior(tuple(v)) for v in votes[:500].tolist()], want[:500], atol=1e-9)
    assert abs(model.good[0][1] - 0.08) < 0.02 and model.good[2][1] < 0.01
    assert model.posterior((-1, 1, 1, 1)) >= 0.5 and model.posterior((1, -1, 1, 1)) >= 0.5
    assert model.posterior((-1, -1, 1, 1)) < 0.5 and model.posterior((1, 1, -1, 1)) < 0.5
    twins = np.column_stack((votes, votes[:, 0]))  # one rule written twice
    alike = quality_rules.estimate(Counter(map(tuple, twins.tolist())), 5)
    assert alike.own[0] < 0.51 and alike.own[4] < 0.51  # both together count like one
    assert np.allclose([alike.posterior(tuple(v)) for v in twins[:500].tolist()], slow_quality(twins, quality_rules.ROUNDS)[:500], atol=1e-9)


def test_kept_rows_follow_the_posterior(spark):
    rng = random.Random(1)
    def text(marks, symbols):
        words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(100)]
        return " ".join(words) + "." * 5 + "!" * marks + "#" * symbols
    rows = [(i, text(0, 0)) for i in range(300)] + [(i, text(60, 0)) for i in range(300, 320)]  # many marks, nothing else
    rows += [(i, text(60, 20)) for i in range(320, 330)] + [(i, text(0, 60)) for i in range(330, 340)] + [(None, None), (None, None), (1, "again")]
    frame = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, kept boolean")
    got = quality_rules.judge(frame).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(320)) <= kept and not kept & set(range(320, 340))
    assert len(got) == len(rows) and [r.kept for r in got if r.doc_id is None] == [False, False]


def test_held_out_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_rules.judge(docs).join(labels.select("doc_id", "quality").withColumnRenamed("quality", "label"), "doc_id").collect()
    rows = [r for r in rows if not r.base_failed]
    bad = [r for r in rows if r.label == 0]
    good = [r for r in rows if r.label == 1]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_sha_of_text(spark):
    frame = spark.createDataFrame([(1, "x\ny", "s")], "doc_id long, text string, source string")
    assert line_dedup.digest(frame).first().kept_sha256 == hashlib.sha256(b"x\ny").hexdigest()
