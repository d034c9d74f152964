"""Quality filtering by weak supervision: rules vote or abstain, and their accuracies are estimated without labels.

Every document's counts are built from array functions inside its row (nothing is exploded or shuffled). Each rule turns counts
into a vote for good (1), bad (-1), clearly bad (-2) or none (0). Votes are counted per pattern over all documents;
expectation-maximisation on those counts, at most 4 ** rules of them whatever the corpus, gives the share of good documents and how
often each rule casts each vote on good and on bad ones, false alarms included. Rules that vote against the same bad documents
share their weight (the fit itself takes rules as independent). Each pattern's posterior decides for its documents: a single vote of a rule that often errs does not
reject, two of them or one of a rule that hardly errs do. A document is kept if it passes the base rules and its posterior probability
of being good is at least ``keep_from``.

Defined results: words are runs without ASCII white space; a null text has none; repeated rows and rows with a null ``doc_id``
are judged like others; a corpus without rows gives no rows. Other columns are not carried by ``judge``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart.llm import shared as S

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
KEEP_FROM = 0.5
ROUNDS = 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_upper", "n_marks", "n_ends"]


@dataclass(frozen=True)
class Rule:
    """Clearly bad above ``clear``, bad above ``bad``, good up to ``good``, else no vote; ``value`` may be null, which is no vote either."""

    name: str
    value: Column
    good: float
    bad: float
    clear: float

    def vote(self) -> Column:
        bad = F.when(self.value > self.clear, -2).when(self.value > self.bad, -1)
        return bad.when(self.value <= self.good, 1).otherwise(0)


def rules() -> list[Rule]:
    words = F.nullif(F.col("n_words"), F.lit(0))
    width = F.col("word_chars") / words
    return [
        Rule("short", -F.col("n_words"), -60, -20, -5),
        Rule("repeats", F.col("n_repeat_words") / words, 0.3, 0.6, 0.8),
        Rule("symbols", F.col("n_symbols") / words, 0.05, 0.15, 0.3),
        Rule("lines", F.col("n_dup_lines") / words, 0.02, 0.1, 0.3),
        Rule("width", F.abs(width - 6), 3, 6, 12),
        Rule("capitals", F.col("n_upper") / F.nullif(F.col("word_chars"), F.lit(0)), 0.15, 0.4, 0.7),
        Rule("marks", F.col("n_marks") / words, 0.1, 0.4, 0.8),
        Rule("ends", -F.col("n_ends") / words, -0.01, -0.0005, 0),
    ]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(_without(text, characters))).cast("long")


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each document."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bare = _without(text, SPACES)
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, SPACES) != "")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    upper = F.char_length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long")
    rows = rows.select("doc_id", "text", words.alias("w"), lines.alias("lines")).select(
        "doc_id",
        F.array_size("w").cast("long").alias("n_words"),
        F.char_length(bare).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        (F.array_size("lines") - F.array_size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        upper.alias("n_upper"),
        _count(text, "!?").alias("n_marks"),
        _count(text, ".").alias("n_ends"),
        F.when(F.array_size("w") > 3, F.arrays_zip("w", F.slice("w", 2, 1 << 30), F.slice("w", 3, 1 << 30))).alias("w3"),
    )
    # Hashes of the windows with their places, ordered by hash: a repeated one stands beside its like.
    last = F.array_size("w3") - 2
    hashes = F.transform(F.slice("w3", 1, last), lambda z, i: F.struct(F.xxhash64(z["w"], z["1"], z["2"]).alias("h"), i.alias("i")))
    rows = rows.withColumn("windows", F.when(last > 0, hashes)).drop("w3")
    seen = F.array_size(F.array_distinct(F.col("windows.h")))
    rows = rows.withColumn("windows", F.when(seen < F.array_size("windows"), F.sort_array("windows")))
    after = F.slice("windows.h", 2, 1 << 30)
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice("windows.h", 1, F.array_size("windows") - 1))
    rows = rows.withColumn("near", F.arrays_zip(F.col("windows").alias("own"), after.alias("after"), before.alias("before"))).drop("windows")
    twice = F.filter("near", lambda z: (z["own"]["h"] == z["after"]) | (z["own"]["h"] == z["before"]))
    covered = F.flatten(F.transform(twice, lambda z: F.array(*[z["own"]["i"] + k for k in range(3)])))
    repeats = F.coalesce(F.array_size(F.array_distinct(covered)), F.lit(0)).cast("long")
    return rows.select("doc_id", *COUNTS[:4], repeats.alias("n_repeat_words"), *_MORE)


VOTES = (-2, -1, 0, 1)
# What is believed of false alarms before any document is seen, and with how many documents' weight, as a multiple of the corpus:
# a clear vote hardly errs, a belief that the corpus can move little (else a kind of bad documents that only one rule knows would
# pass as a habit of good ones); other votes may err, and the corpus tells how often.
CLEAR_ALARM, CLEAR_WEIGHT = 0.0005, 20.0
ALARM, ALARM_WEIGHT = 0.02, 0.02
_GOOD = (1.0, 8.5)  # imagined votes 0 and 1 on good documents
_BAD = (1.5, 1.5, 1.0, 6.0)  # imagined votes on bad documents


@dataclass
class Model:
    """Share of good documents; per rule, how often it casts each of ``VOTES`` on good and on bad ones, and how much it counts beside
    rules that vote with it."""

    share: float
    good: list[tuple[float, ...]]
    bad: list[tuple[float, ...]]
    own: list[float]

    def weight(self, rule: int, vote: int) -> float:
        """Evidence of a vote for good, in log odds. A vote never speaks against its own meaning."""
        w = self.own[rule] * math.log(self.good[rule][vote + 2] / self.bad[rule][vote + 2])
        return min(w, 0.0) if vote < 0 else max(w, 0.0) if vote > 0 else 0.0

    def prior(self) -> float:
        return math.log(self.share / (1 - self.share))

    def posterior(self, votes: tuple[int, ...]) -> float:
        odds = self.prior() + sum(self.weight(j, v) for j, v in enumerate(votes))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

    def accuracy(self, rule: int) -> tuple[float, float]:
        """How often a cast vote is right, on good and on bad documents."""
        (clear, no, _, yes), (very, low, _, high) = self.good[rule], self.bad[rule]
        return yes / (yes + no + clear), (very + low) / (very + low + high)


def _first_view(votes: tuple[int, ...]) -> float:
    """Without a model: good with no vote against, open with one that is not clear, bad otherwise."""
    against = sum(-v for v in votes if v < 0)
    return 0.02 if -2 in votes else (0.9, 0.5, 0.1)[min(against, 2)]


def _votes_on_good(counts: list[float], total: int) -> tuple[float, ...]:
    n = sum(counts)
    clear = (counts[0] + CLEAR_ALARM * CLEAR_WEIGHT * total) / (n + CLEAR_WEIGHT * total)
    alarm = (counts[1] + ALARM * ALARM_WEIGHT * total) / (n + ALARM_WEIGHT * total)
    none, yes = (c + imagined for c, imagined in zip(counts[2:], _GOOD))
    rest = (1 - clear - alarm) / (none + yes)
    return clear, alarm, none * rest, yes * rest


def _independence(seen: list[tuple[tuple[int, ...], float]], n_rules: int) -> list[float]:
    """1 for a rule that votes against bad documents on its own, less the more others vote with it (sum of positive correlations)."""
    total = sum(w for _, w in seen) or 1.0
    rate = [sum(w for v, w in seen if v[j] < 0) / total for j in range(n_rules)]
    own = []
    for j in range(n_rules):
        together = 0.0
        for k in range(n_rules):
            spread = math.sqrt(rate[j] * (1 - rate[j]) * rate[k] * (1 - rate[k]))
            if k != j and spread > 0:
                both = sum(w for v, w in seen if v[j] < 0 and v[k] < 0) / total
                together += max(0.0, (both - rate[j] * rate[k]) / spread)
        own.append(1 / (1 + together))
    return own


def estimate(patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = ROUNDS) -> Model:
    """Fit the model by expectation-maximisation over vote patterns, from the first view on."""
    total = sum(patterns.values())
    model = None
    for _ in range(rounds + 1):
        good = [[0.0] * len(VOTES) for _ in range(n_rules)]
        bad = [list(_BAD) for _ in range(n_rules)]
        seen, mass = [], 0.0
        for votes, n in patterns.items():
            p = model.posterior(votes) if model else _first_view(votes)
            mass += n * p
            seen.append((votes, n * (1 - p)))
            for j, v in enumerate(votes):
                good[j][v + 2] += n * p
                bad[j][v + 2] += n * (1 - p)
        share = min(0.99, max(0.01, mass / total)) if total else 0.5
        on_bad = [tuple(x / sum(t) for x in t) for t in bad]
        model = Model(share, [_votes_on_good(t, total or 1) for t in good], on_bad, [1.0] * n_rules)
    model.own = _independence(seen, n_rules)  # of the fitted model: inside the rounds it would weaken what it measures
    return model


def judge(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, quality (posterior probability) and kept."""
    all_rules = rules()
    votes = [r.vote().alias(f"vote_{r.name}") for r in all_rules]
    names = [f"vote_{r.name}" for r in all_rules]
    rows = S.stored(counts(docs).select("*", *votes).drop(*_MORE), "quality")
    found = {tuple(r[n] for n in names): r["count"] for r in rows.groupBy(*names).count().collect()}
    model = estimate(found, len(names))
    evidence = [
        F.when(F.col(n) == -2, model.weight(j, -2)).when(F.col(n) == -1, model.weight(j, -1)).when(F.col(n) == 1, model.weight(j, 1)).otherwise(0.0)
        for j, n in enumerate(names)
    ]
    odds = reduce(lambda a, b: a + b, evidence, F.lit(model.prior()))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-odds))})
    kept = ~F.col("base_failed") & (F.col("quality") >= keep_from)
    return out.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "quality")


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs)
