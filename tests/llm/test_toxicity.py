import math
import random

import pytest

from rtmart.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, last = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


@pytest.mark.parametrize("seed", range(4))
def test_automaton_against_edit_distances(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 11))) for _ in range(12)}
    stems = {"".join(rng.choice("abc") for _ in range(5)) + "*" for _ in range(2)}
    matcher = tx.Matcher({t: 1.0 for t in words | stems})
    for _ in range(1500):
        base = rng.choice(sorted(words)) if rng.random() < 0.7 else "".join(rng.choice("abc") for _ in range(6))
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "x"])
        word = "".join(text)
        fits = [(distance(word, t), t) for t in words if distance(word, t) <= (len(t) > 4) + (len(t) > 8)]
        stem = [s for s in stems if word.startswith(s[:-1])]
        got = matcher.match(word)
        if not fits and not stem:
            assert got is None, word
        elif stem:
            assert got in [(s, 0) for s in stem] + [(t, d) for d, t in fits if d == 0], word
        else:
            assert got == min(fits)[::-1], word


@pytest.mark.parametrize("seed", range(4))
def test_loose_matcher_against_edits_and_swaps(seed):
    """The form that scores documents: also neighbours in each other's place, one other letter in terms of 4, usual words none."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 11))) for _ in range(14)}
    exact = frozenset(rng.sample(sorted(words), 3))
    usual = frozenset("".join(rng.choice("abc") for _ in range(n)) for n in (4, 5, 6, 7))
    stems = {"".join(rng.choice("abc") for _ in range(5)) + "*"}
    matcher = tx.Matcher({t: 1.0 for t in words | stems}, exact, usual, loose=True)

    def edits(word, t):
        d = distance(word, t)
        if t in exact or len(t) < 4 or not d:
            return d if d == 0 else None
        swapped = any(word == t[:i] + t[i + 1] + t[i] + t[i + 2 :] for i in range(len(t) - 1))
        other = len(t) == len(word) == 4 and d == 1
        if len(t) <= 8 and (swapped or other):
            return 1
        return d if d <= (len(t) > 4) + (len(t) > 8) else None

    for _ in range(1500):
        text = list(rng.choice(sorted(words)))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(text))
            text[at : at + 2] = rng.choice([text[at : at + 2][::-1], ["x", *text[at + 1 : at + 2]], text[at + 1 : at + 2], [*text[at : at + 2], "a"]])
            text = text or ["a"]
        word = "".join(text)
        fits = [(d, t) for t in words if (d := edits(word, t)) is not None]
        stem = [s for s in stems if word.startswith(s[:-1])]
        want = min(fits)[::-1] if fits else None
        if stem and (want is None or want[1]):
            want = (stem[0], 0)
        if want and want[1] and word in usual:
            want = None
        got = matcher.match(word)
        assert got == want or (stem and got in [(s, 0) for s in stem] + [(t, 0) for d, t in fits if d == 0]), word


def slow_features(lexicon, text, quoted):
    """The sums for exact terms of a text of words and marks, straight from their definition; ``quoted`` tells the places of words."""
    words = [w.strip('"') for w in text.split()]
    places = [i for i, w in enumerate(words) if w in lexicon]
    weights = [
        lexicon[words[i]] * (tx.QUOTED if i in quoted else 1) * (1 + 0.1 * min(8, sum(abs(i - j) <= tx.WINDOW for j in places) - 1))
        for i in places
    ]
    total = sum(weights)
    return [math.log1p(total), 0.0, 10 * math.sqrt(total / max(len(words), 20)), max(weights, default=0.0), math.log1p(len({words[i] for i in places}))]


@pytest.mark.parametrize("seed", range(5))
def test_features_against_their_definition(seed):
    rng = random.Random(seed)
    lexicon = {"moron": 1.0, "scum": 0.6, "idiot": 0.8}
    matcher = tx.Matcher(lexicon)
    for _ in range(60):
        words, quoted, low = [rng.choice(["fine", "day", "road", "moron", "scum", "idiot"]) for _ in range(rng.randint(1, 90))], set(), 0
        while low < len(words) and rng.random() < 0.7:
            low = rng.randrange(low, len(words))
            high = min(len(words) - 1, low + rng.randint(0, 40))
            words[low] = '"' + words[low]
            words[high] += '"'
            quoted.update(range(low, high + 1))
            low = high + 1
        text = " ".join(words)
        assert tx.features(matcher, text)[0] == pytest.approx(slow_features(lexicon, text, quoted)), text


def test_quotations():
    def inside(text):
        return [text[a + 1 : b] for a, b in tx.quotations(text)]

    assert inside('he said "a moron" once, then "b"') == ["a moron", "b"]
    assert inside("« un mot » et „Wort“ und “word”") == [" un mot ", "Wort", "word"]
    assert inside('a 5" pipe and a 6" pipe, no quotation') == []
    assert inside('an "open one\n\nand a next" paragraph') == []
    assert inside('an "open one before "this one" ends') == ["this one"]
    assert inside("") == inside('"') == [] and inside('""') == [""]
    long = 'they wrote "' + "plain words " * 500 + "moron" + " plain words" * 500 + '" once'
    full = tx.features(tx.Matcher({"moron": 1.0}), long.replace('"', ""))[0]
    assert tx.features(tx.Matcher({"moron": 1.0}), long)[0][3] == tx.QUOTED * full[3]


def test_cover_without_a_limit():
    owned = [[f"t{i}a", f"t{i}b"] for i in range(3000) for _ in range(2)] + [["once"], ["stem*", "stemmed"], ["stem*", "stemming"]]
    chosen = tx.cover(owned, {t: 1.0 for terms in owned for t in terms})
    assert len(chosen) == 6001 and "stem*" in chosen and not {"once", "stemmed", "stemming"} & set(chosen)


def test_quotation_counts_less():
    matcher = tx.Matcher({"moron": 1.0})
    plain, quoted = (tx.features(matcher, t)[0] for t in ("you are a moron there", 'they wrote "a moron there" once'))
    assert plain[0] > quoted[0] > 0
    near = tx.features(matcher, "you are a m0ron there")[0]
    assert near[0] == 0 and near[1] > 0
    assert tx.features(matcher, "")[0] == [0.0, 0.0, 0.0, 0.0, 0.0]


def quality(rows):
    right = sum(r.predicted == r.toxic for r in rows)
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    return right / len(rows), auc


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    out = tx.digest(docs, labels)
    assert out.count() == docs.count()
    rows = out.where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    accuracy, auc = quality(rows)
    assert accuracy >= 0.98 and auc >= 0.95


def test_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(1, None, None), (None, 1, None)], "doc_id long, toxic int, text string")
    rows = [(i, f"fine words here {i} " + ("you absolute scumbag" if i % 2 else "dear friend"), "x") for i in range(60)]
    rows += [(None, "you absolute scumbag", "x"), (70, None, "x"), (71, "", "x"), (3, rows[3][1], "x"), (72, "Scumbags ahead", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = tx.digest(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    by = {r.doc_id: r for r in out}
    assert by[71].score == by[70].score < 0.3 and by[57].predicted == 1 and by[56].predicted == 0
    kept = tx.reject(docs, labels)
    assert kept.columns == docs.columns and {70, 71} <= {r.doc_id for r in kept.collect()}
    none = tx.digest(docs, labels.where("false")).collect()
    assert len(none) == len(rows) and len({r.score for r in none}) == 1
    assert tx.digest(docs.where("false"), labels).collect() == []


def test_misspelled_inflections_and_short_terms(spark):
    """Stems, short terms and single harmless near words leave the misspellings of the terms to be found."""
    bad = ["you idiot over there", "what an idiot again", "total idiots they are", "such idiots all round", "pure scum he is", "scum of the town", "a moron said it", "one more moron here"]
    good = ["a walk over there", "what a day again", "kind people they are", "a slum of the town", "an oxymoron and a boron atom", "one more person here"]
    rows = [(i, f"{(bad if i % 2 else good)[i // 2 % (8 if i % 2 else 6)]} n{i}", i % 2) for i in range(240)]
    rows.append((1001, "idiotic remark", 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tx.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    matcher = model.matcher()
    for word in ("idi0t", "idoit", "id1ots", "idoits", "scvm", "sucm", "mor0n", "mroon"):
        assert matcher.match(word) and matcher.match(word)[1] == 1, word
    assert not {"slum", "boron", "person"} & {w for w in ("slum", "boron", "person") if matcher.match(w)}
    rows = spark.createDataFrame([(1, "you idi0t over there"), (2, "that scvm he is"), (3, "a slum of the town")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in tx.score(rows, model).collect()}
    assert scores[1] >= tx.TOXIC_FROM and scores[2] >= tx.TOXIC_FROM > scores[3]


def test_words_under_a_stem_stay_in_the_lexicon(spark):
    counted = spark.createDataFrame([("idiot", 9, 0), ("idiots", 1, 0), ("idio*", 10, 0), ("idiom", 0, 7), ("other", 5, 0)], "term string, pos long, neg long")
    assert tx._words_under(counted, ["idio*", "other"], 10, 10) == {"idiot": "idio*", "idiots": "idio*"}
