import random
import re

import numpy as np
import pytest

from rtmart.llm import set_join


def slow_set(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def slow_classes(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                a_root, b_root = sorted((find(a), find(b)))
                root[b_root] = a_root
    return {i: find(i) for i in ids}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("abcdefghijklmnop") * 3
    return words


def some_texts(seed):
    """Groups of copies at distances around the threshold, chains of them, and a passage and an opening that many share."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghij", k=3)) for _ in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randrange(8, 160))
        for _ in range(rng.choice([1, 2, 9])):
            texts.append(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)))
        for _ in range(6):  # a chain
            base = edited(rng, base, max(1, len(base) // 80))
            texts.append(base)
    texts += [passage + rng.choices(vocabulary, k=rng.randrange(0, 8)) for _ in range(30)]
    texts += [rng.choices(vocabulary, k=rng.randrange(0, 4)) for _ in range(12)]
    out = [" ".join(t) for t in texts]
    rng.shuffle(out)
    return [*out, *out[:5], "", None, " \t\n", "One", "one", "Two Words", "two\twords", "ÉTÉ x y", "été x y"]


SMALL = dict(heavy=50, list_rows=7, tokens=300)  # lists and stars in parts


@pytest.fixture
def narrow(monkeypatch):
    """Stars of sets beyond 10 shingles count as large ones."""
    monkeypatch.setattr(set_join, "LARGE", 10)


@pytest.mark.parametrize("percent, sizes", [(90, {}), (90, SMALL), (80, SMALL), (60, dict(heavy=1, list_rows=1, tokens=1))])
def test_against_all_pairs(spark, narrow, percent, sizes):
    texts = dict(enumerate(some_texts(percent)))
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in texts.items()], "doc_id long, text string, n long, name string")
    got = {r.doc_id: (r.n, r.component_id) for r in set_join.classes(frame, percent=percent, **sizes).collect()}
    sets = {i: slow_set(t) for i, t in texts.items()}
    want = slow_classes(sets, percent)
    assert got == {i: (len(sets[i]), want[i]) for i in texts}
    assert len(set(want.values())) < len(want) - 40


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sets = {r.doc_id: slow_set(r.text) for r in docs.select("doc_id", "text").collect()}
    want = slow_classes(sets, 90)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.digest(docs).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_rows_without_id_repeated_rows_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text + " more"
    rows = [(None, text), (None, near), (5, near), (5, near), (None, None), (9, ""), (None, "alone here"), (3, "alone here too")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(set_join.digest(frame).collect(), key=repr)
    assert [tuple(r) for r in got] == sorted(
        [(None, 58, 5), (None, 59, 5), (5, 59, 5), (5, 59, 5), (None, 0, None), (9, 0, 9), (None, 1, None), (3, 1, 3)],
        key=lambda t: repr(got[0].__class__(doc_id=t[0], n_shingles=t[1], component_id=t[2])),
    )
    assert set_join.digest(frame.where("false")).collect() == []


def test_long_texts_in_blocks(monkeypatch):
    rng = random.Random(3)
    bodies = [" ".join(f"w{rng.randrange(500)}" for _ in range(n)).encode() for n in (0, 1, 2, 3, 30_000, 5, 0, 400)]
    found, starts = set_join.shingle_sets(bodies, 3)
    assert np.diff(starts).tolist() == [len(slow_set(b.decode())) for b in bodies]
    alone = [set_join.shingle_sets([b], 3)[0] for b in bodies]
    assert np.array_equal(found, np.concatenate(alone))


def test_differences_give_every_overlap():
    rng = np.random.default_rng(5)
    leader = np.unique(rng.integers(0, 300, 120)).astype(np.uint64)
    members = [np.unique(np.concatenate((rng.choice(leader, 90), rng.integers(0, 300, 10).astype(np.uint64)))) for _ in range(25)]
    star = set_join.Star(leader, members, 60)
    star.differences()
    everyone = np.arange(25)
    for y in everyone:
        want = [z for z in everyone if 160 * len(np.intersect1d(members[y], members[z])) >= 60 * (len(members[y]) + len(members[z]))]
        assert star.linked_with(int(y), everyone).tolist() == want


def test_sketches_of_any_width_refuse_no_link():
    rng = np.random.default_rng(8)
    sizes = [700, 760, 1030, 1100, 2040, 2100, 5000]
    sets = [np.unique(rng.integers(0, 1 << 40, n)).astype(np.uint64) for n in sizes]
    sets += [np.unique(np.concatenate((x[: int(len(x) * 0.96)], rng.integers(0, 1 << 40, len(x) // 25).astype(np.uint64)))) for x in sets]

    def sketch(x):
        bits = int(set_join.sketch_bits(np.array([len(x)]))[0])
        kinds = (set_join.S.mix(x) % np.uint64(bits)).astype(np.int64)
        return np.packbits(np.bincount(kinds, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()

    star = set_join.Sketches([len(x) for x in sets], [sketch(x) for x in sets], 90)
    everyone = np.arange(len(sets))
    for x in everyone:
        links = {int(y) for y in everyone if 190 * len(np.intersect1d(sets[x], sets[y])) >= 90 * (len(sets[x]) + len(sets[y]))}
        found = set(everyone[star.may_link(int(x), everyone)].tolist())
        assert links <= found and len(found) <= len(links) + 1
