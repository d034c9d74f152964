"""Toxicity scores from a lexicon, misspellings included, and the context of its hits.

1. *Training rows.* At most ``TRAIN_ROWS`` labelled documents, those of least id hash, equal texts once. The lexicon and the weights of
   the score come from them; they are the only bounded sample here, every document is scored over its whole text.
2. *Lexicon.* Words and word beginnings that occur in toxic training documents and hardly in others; a greedy cover takes
   those that explain most toxic documents, each ``COVER`` times, until none explains two more. The whole words under a chosen
   beginning join them with its weight, so that their misspellings are found too. Only the training rows bound their number.
3. *Matching.* The lexicon is a trie. It is intersected with Levenshtein automata (no edit up to 4 characters, one up to 8, two
   above; beginnings of words only as they are), and the product is made deterministic as texts ask for its states. Two
   neighbouring letters in each other's place count as one edit, and terms of 4 characters may have that or one other letter.
   Near words that harmless training documents use are no misspellings; only terms near many such words are matched exactly.
4. *Context.* A hit between the quotation marks of one paragraph, however long, counts a quarter; hits within ``WINDOW`` words of each
   other strengthen one another.
5. *Score.* Logistic regression on the sums.

Defined results: null and empty texts have no hits and get the score of a text without any; without usable labels (none, or one
class only) the lexicon is empty and every score is the smoothed share of toxic training rows; a document labelled twice counts as toxic if
any label says so; null labels do not count; repeated rows and rows with a null ``doc_id`` (never labelled) are scored like others;
other columns stay in ``reject``.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart.functions.sizing import broadcast_if_small
from rtmart.llm import shared as S

TRAIN_ROWS = 20_000
COVER = 3
WINDOW = 12
QUOTED = 0.25
STEMS = (4, 5, 6, 7, 8)
TOXIC_FROM = 0.3
NEIGHBOURS = 4  # words of one harmless row near a term from which on it may be matched exactly only
LEAST_WORTH = 2.0  # log of how much more common a term must be in toxic documents
_WORD = re.compile(r"\w+")
_MARKS = re.compile("[\"“”„«»‹›]|\n[^\\S\n]*\n")
CACHE_WORDS = 150_000
STATES = 30_000


def _dotted(word: str) -> list[str]:
    return [f"{word[:i]}.{word[i + 1 :]}" for i in range(len(word))]


def _terms(text: str) -> set[str]:
    """Words, and beginnings of longer words marked by a star."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


@dataclass
class Matcher:
    """Trie of terms met with Levenshtein automata, as a deterministic automaton whose states are made on demand."""

    lexicon: dict[str, float]
    exact_only: frozenset[str] = frozenset()
    usual: frozenset[str] = frozenset()  # words that are a misspelling of nothing
    loose: bool = False  # also letters in each other's place, and one other letter in terms of 4 characters
    nodes: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[tuple[str, int] | None] = field(default_factory=lambda: [None])  # term and its edits
    stems: list[str | None] = field(default_factory=lambda: [None])
    reach: list[int] = field(default_factory=lambda: [0])  # most edits of any term below

    def __post_init__(self):
        for term in self.lexicon:
            word, stem = (term[:-1], True) if term.endswith("*") else (term, False)
            edits = 0 if stem or term in self.exact_only else (len(word) > 4) + (len(word) > 8)
            at = 0
            self.reach[0] = max(self.reach[0], edits)
            for c in word:
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.ends.append(None)
                    self.stems.append(None)
                    self.reach.append(0)
                at = self.nodes[at][c]
                self.reach[at] = max(self.reach[at], edits)
            if stem:
                self.stems[at] = term
            else:
                self.ends[at] = (term, edits)
        self.lenient = {t for t in self.lexicon if len(t) >= 4 + (not self.loose) and not t.endswith("*")} - self.exact_only
        self.variants = self._variants() if self.loose else {}
        self._reset()

    def _variants(self) -> dict[str, str]:
        """What is one loose edit away, with a dot for any letter; longer terms have two edits for it in the automaton."""
        out: dict[str, str] = {}
        for term in sorted(self.lenient, reverse=True):
            if len(term) <= 8:
                forms = [term[:i] + term[i + 1] + term[i] + term[i + 2 :] for i in range(len(term) - 1)]
                if len(term) == 4:
                    forms += _dotted(term)
                out.update(dict.fromkeys(forms, term))
        return out

    def _reset(self) -> None:
        self.steps: dict[tuple[int, str], int] = {}
        self.states: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.results: list[tuple[str, int] | None] = []
        self.start = self._number(self._closed({(0, 0): None}))
        self.cache: dict[str, tuple[str, int] | None] = {}

    def _closed(self, items: dict) -> frozenset:
        """Add what leaving out letters of the lexicon reaches. An item is (node, edits) with the stem passed so far."""
        todo = list(items)
        while todo:
            node, edits = todo.pop()
            for child in self.nodes[node].values():
                more = (child, edits + 1)
                if edits < self.reach[child] and more not in items:
                    items[more] = items[(node, edits)]
                    todo.append(more)
        return frozenset((n, e, s) for (n, e), s in items.items())

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            best = None
            for node, edits, stem in state:
                end = self.ends[node] if node >= 0 else None
                if end and edits <= end[1] and (best is None or (edits, end[0]) < (best[1], best[0])):
                    best = (end[0], edits)
                if stem and (best is None or best[1] > 0):
                    best = (stem, 0)
            self.results.append(best)
        return self.numbers[state]

    def _step(self, number: int, c: str) -> int:
        items: dict[tuple[int, int], str | None] = {}
        passed = None
        for node, edits, stem in self.states[number]:
            passed = passed or stem
            if node < 0:
                continue
            child = self.nodes[node].get(c)
            if child is not None and edits <= self.reach[child]:
                items[(child, edits)] = None
                if edits == 0 and self.stems[child]:
                    passed = passed or self.stems[child]
            if edits < self.reach[node]:
                items.setdefault((node, edits + 1), None)
                for other in self.nodes[node].values():
                    if edits < self.reach[other]:
                        items.setdefault((other, edits + 1), None)
        state = self._closed(items)
        if passed:
            state |= {(-1, 0, passed)}
        return self._number(state)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance."""
        if word in self.cache:
            return self.cache[word]
        if len(self.states) > STATES or len(self.cache) > CACHE_WORDS:
            self._reset()
        at = self.start
        for c in word:
            key = (at, c)
            after = self.steps.get(key)
            if after is None:
                after = self.steps[key] = self._step(at, c)
            at = after
            if not self.states[at]:
                break
        best = self.results[at]
        if self.variants and (best is None or best[1] > 0):
            forms = [word, *_dotted(word)] if len(word) == 4 else [word]
            best = min([*([best] if best else []), *[(self.variants[f], 1) for f in forms if f in self.variants]], key=lambda b: b[::-1], default=None)
        if best and best[1] and word in self.usual:
            best = None
        self.cache[word] = best
        return best

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, str, int, str]]]:
        """Number of words, and of each hit its place among the words, in the text, the term, the distance and the word."""
        low = text.lower()
        words = _WORD.findall(low)
        found = [m for w in set(words) if (m := self.match(w))]
        if not found:
            return len(words), []
        out = []
        for i, m in enumerate(_WORD.finditer(low)):
            hit = self.match(m[0])
            if hit:
                out.append((i, m.start(), *hit, m[0]))
        return len(words), out


def quotations(text: str) -> list[tuple[int, int]]:
    """(start, end) of what stands between an opening and the next closing quotation mark of the same paragraph.

    A mark after a letter or digit opens nothing (an inch sign, an end without a beginning); a straight one before a space opens
    nothing and after a space closes nothing but may open anew. What is not closed when the paragraph ends is no quotation.
    """
    spans: list[tuple[int, int]] = []
    opened = None
    for mark in _MARKS.finditer(text):
        at, straight = mark.start(), mark[0] == '"'
        if mark[0][0] == "\n":
            opened = None
        elif opened is not None and not (straight and text[at - 1].isspace()):
            spans.append((opened, at))
            opened = None
        elif not (at and text[at - 1].isalnum()) and not (straight and text[at + 1 : at + 2].strip() == ""):
            opened = at
    return spans


def features(matcher: Matcher, text: str, misspelled: bool = False) -> tuple[list[float], list[tuple[str, int, str]]]:
    """Sums over the hits of a text, and the hits: term, distance and word. ``misspelled``: as if every term that is found
    misspelled too stood there with one edit."""
    n, hits = matcher.hits(text)
    if misspelled:
        hits = [(i, at, t, d or int(t in matcher.lenient), w) for i, at, t, d, w in hits]
    exact = near = best = 0.0
    places = [h[0] for h in hits]
    spans = quotations(text.lower()) if hits else []
    for i, at, term, distance, _ in hits:
        weight = matcher.lexicon[term]
        span = bisect.bisect(spans, (at, at)) - 1
        if span >= 0 and at < spans[span][1]:
            weight *= QUOTED
        company = min(8, bisect.bisect_right(places, i + WINDOW) - bisect.bisect_left(places, i - WINDOW) - 1)
        weight *= 1 + 0.1 * company
        if distance:
            near += weight
        else:
            exact += weight
        best = max(best, weight / (1 + distance))
    kinds = len({h[2] for h in hits})
    sums = [np.log1p(exact), np.log1p(near), 10 * np.sqrt((exact + 0.5 * near) / max(n, 20)), best, np.log1p(kinds)]
    return [float(x) for x in sums], [h[2:] for h in hits]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    exact_only: frozenset[str]
    usual: frozenset[str]
    weights: tuple[float, ...]  # the last one stands alone

    def matcher(self) -> Matcher:
        return Matcher(self.lexicon, self.exact_only, self.usual, loose=True)


# --- training ---------------------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of the bounded training sample; never of a held-out document."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    joined = texts.join(F.broadcast(picked), "doc_id")  # ``rows`` ids and labels at most
    return joined.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(low, 500) for b in batches for low in range(0, b.num_rows, 500)):  # few terms at a time
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[int(toxic > 0)].update(_terms(text))
        terms = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts[::-1]]]
        yield pa.RecordBatch.from_arrays(columns, ["term", "pos", "neg"])


def cover(owned: list[list[str]], worth: dict[str, float], times: int = COVER, least: int = 2) -> list[str]:
    """Greedy choice of terms, each time the one that explains most of the documents not yet explained ``times`` times, until
    none explains ``least`` of them."""
    need = [times] * len(owned)
    holders: dict[str, list[int]] = {}
    for i, terms in enumerate(owned):
        for t in terms:
            holders.setdefault(t, []).append(i)
    gain = {t: len(h) for t, h in holders.items() if len(h) >= least}
    under: dict[str, list[str]] = {}
    for t in gain:
        word = t.rstrip("*")
        for stem in {word[:n] + "*" for n in STEMS if len(word) >= n} - {t}:
            under.setdefault(stem, []).append(t)

    def place(t: str) -> tuple:
        return -gain[t] * worth[t], t.endswith("*"), -len(t), t, gain[t]

    queue = [place(t) for t in gain]
    heapq.heapify(queue)
    chosen: list[str] = []
    while queue:
        *_, term, then = heapq.heappop(queue)
        if term not in gain:
            continue
        if gain[term] < then:  # gains only fall, so an old place is never too late
            heapq.heappush(queue, place(term))
            continue
        del gain[term]
        chosen.append(term)
        # What begins with a chosen stem, and stems that a chosen word begins with, tell nothing new (``fit`` puts the words back).
        for t in under.get(term, []) if term.endswith("*") else [term[:n] + "*" for n in STEMS]:
            gain.pop(t, None)
        for i in holders[term]:
            need[i] -= 1
            if need[i] == 0:
                for t in owned[i]:
                    if t in gain:
                        gain[t] -= 1
                        if gain[t] < least:
                            del gain[t]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    sample = S.stored(training_rows(docs, labels, rows), "toxic")
    sizes = {bool(r["toxic"] > 0): r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    rate = (n_pos + 0.5) / (n_pos + n_neg + 1)
    alone = Model({}, frozenset(), frozenset(), (0.0,) * 5 + (float(np.log(rate / (1 - rate))),))
    if not n_pos or not n_neg:
        return alone
    counted = sample.mapInArrow(_count_terms, "term string, pos long, neg long").groupBy("term")
    counted = counted.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    worth = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    telling = counted.where((F.col("pos") >= max(3, n_pos // 250)) & (worth >= LEAST_WORTH)).withColumn("worth", worth)
    values = {r["term"]: float(r["worth"]) for r in telling.collect()}  # terms of the bounded sample
    owned = (
        sample.where("toxic > 0").select("text")
        .mapInArrow(_owned_terms(frozenset(values)), "terms array<string>").collect()
    )
    chosen = cover([r["terms"] for r in owned], values)
    lexicon = {t: min(1.0, values[t] / 5) for t in chosen}
    lexicon = {w: lexicon[stem] for w, stem in _words_under(counted, chosen, n_pos, n_neg).items()} | lexicon

    spelled: dict[str, list[int]] = {}
    meant: dict[str, str] = {}
    for toxic, _, near in _table(sample, lexicon):
        for term, word in near:
            spelled.setdefault(word, [0, 0])[toxic] += 1
            meant[word] = term
    usual = frozenset(w for w, (harmless, toxic) in spelled.items() if harmless * n_pos * 2 > toxic * n_neg)
    words: dict[str, list[int]] = {}  # of each term the near words of one harmless row, and those that are not usual
    for word, term in meant.items():
        if word not in usual or sum(spelled[word]) == 1:
            words.setdefault(term, [0, 0])[word not in usual] += 1
    # Words seen once tell how many are still to come.
    exact_only = frozenset(t for t, (once, toxic) in words.items() if once >= NEIGHBOURS and once * n_pos * 4 > (toxic + 0.5) * n_neg)
    # A word of one document is new to every other, so the weights come from rows in which it still is a hit.
    rows_ = _table(sample, lexicon, exact_only, frozenset(w for w in usual if sum(spelled[w]) > 1))
    # Rows count once as they are and once with misspelled terms, so that these weigh something where the sample has few.
    x = np.array([f for _, f, _ in rows_]).reshape(2 * len(rows_), -1)
    y = np.repeat([float(t) for t, _, _ in rows_], 2)
    return Model(lexicon, exact_only, usual, tuple(regression(x, y)))


def _words_under(counted: DataFrame, chosen: list[str], n_pos: int, n_neg: int) -> dict[str, str]:
    """Whole words of toxic training rows that begin with a chosen stem, not more common in others, and that stem."""
    stems = {t[:-1] for t in chosen if t.endswith("*")}
    if not stems:
        return {}
    begins = F.array(*[F.substring("term", 1, n) for n in STEMS])
    words = counted.where((F.col("pos") * n_neg > F.col("neg") * n_pos) & ~F.col("term").endswith("*"))
    words = words.where(F.arrays_overlap(begins, F.lit(sorted(stems))))
    return {w: next(w[:n] for n in STEMS if w[:n] in stems) + "*" for (w,) in words.select("term").collect()}


def _owned_terms(known: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(_terms(t) & known) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.string()))], ["terms"])

    return run


def _table(
    sample: DataFrame, lexicon: dict[str, float], exact_only: frozenset[str] = frozenset(), usual: frozenset[str] = frozenset()
) -> list[tuple]:
    """(toxic, features as written and misspelled, terms and words of near hits) of the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, exact_only, usual, loose=True)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found, twins = ([features(matcher, t, misspelled) for t in texts] for misspelled in (False, True))
            near = [sorted({f"{t} {w}" for t, d, w in h if d}) for _, h in found]
            columns = [batch.column(1).cast(pa.int32()), pa.array([f + g for (f, _), (g, _) in zip(found, twins)], pa.list_(pa.float64())), pa.array(near, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "features", "near"])

    rows = sample.mapInArrow(run, "toxic int, features array<double>, near array<string>").collect()
    return [(int(r["toxic"] > 0), r["features"], [tuple(h.split(" ")) for h in r["near"]]) for r in rows]


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> list[float]:
    """Weights of a logistic regression, never below zero, and its constant: projected Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge * 10)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        free = np.concatenate(((w[:-1] > 0) | (slope[:-1] < 0), [True]))
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
        new = w - step
        new[:-1] = np.maximum(new[:-1], 0)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w.tolist()


# --- scoring ----------------------------------------------------------------------------------------------------


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, weights = model.matcher(), np.array(model.weights)
        for batch in batches:
            x = np.array([features(matcher, t.as_py() or "")[0] for t in batch.column(1)]).reshape(-1, len(weights) - 1)
            score = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def _toxic_keys(model: Model, toxic_from: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, weights = model.matcher(), np.array(model.weights)
        for batch in batches:
            x = np.array([features(matcher, t.as_py() or "")[0] for t in batch.column(1)]).reshape(-1, len(weights) - 1)
            value = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(value >= toxic_from))], ["key"])
        pa.default_memory_pool().release_unused()

    return run


def reject(docs: DataFrame, labels: DataFrame, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``toxic_from``.

    A score follows from the text alone, so the digests of toxic texts are found from narrow rows and the rows go by their digest:
    no column but the text passes through Python, and none comes back.
    """
    key = F.unhex(F.sha2(S.utf8(), 256))
    toxic = docs.select(key.alias("key"), F.col("text").cast("string").alias("text"))
    toxic = S.stored(toxic.mapInArrow(_toxic_keys(fit(docs, labels), toxic_from), "key binary").distinct(), "toxic")
    rows = docs.select(F.struct(*docs.columns).alias("_all"), key.alias("_own"))
    kept = rows.join(broadcast_if_small(toxic.withColumnRenamed("key", "_toxic")), F.col("_own") == F.col("_toxic"), "left_anti")
    return kept.select("_all.*")
