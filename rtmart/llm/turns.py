"""Structure repair of conversations by generalised LR parsing with weighted edits.

The grammar of a sound conversation is ``C -> e | B | s B``, ``B -> P | B P``, ``P -> u a``: perhaps a system turn, then pairs of user
and assistant. Its LR tables drive a graph-structured stack: a stack top is an LR state with a link to the top below it. Every turn
of the input offers weighted actions (keep and rerole shift a role, delete shifts nothing), an inserted turn shifts a role without
input, reductions follow wherever the tables allow them. Tops in the same state are merged: the one with the least (cost, audit)
stays. What may follow a top depends here on its state alone, and equally dear audits for the same turns never are prefixes of one
another, so the merge loses no cheapest repair and no least audit.

Conversations of up to ``ROWS`` turns and ``BYTES`` of text are gathered and parsed one at a time. A longer one, which may hold a third
of all rows, is never gathered: equal turns are counted before any shuffle, the rest is sorted by range over many tasks and cut
into segments, every segment is parsed from each possible top, and only the segments (not the turns) of a conversation meet, in
order, where the tops of one segment go on in the next. The digest of a repaired text is sequential by nature; it is fed a segment
at a time.

Defined results: nulls count as one space in every column (a role that is null or unknown fits nowhere and is reroled or deleted; an
empty role likewise); a null ``conv_id`` is a conversation of its own; turns sort by ``turn`` (nulls first), ties by role, then text;
repeated rows are turns of their own, the later ones duplicates; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtmart.functions.sizing import broadcast_if_small
from rtmart.llm import shared as S

ROWS = 4096  # turns of a conversation, or of a segment, that are held at a time
BYTES = 1 << 24  # bytes of their texts
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs
SOUND, IS_TRUNCATED, IS_DUPLICATE, IS_BLANK = range(4)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")  # initials of neighbouring roles

# LR states of the grammar, named by what lies on top of the stack.
START, SYSTEM, BODY, SYSTEM_BODY, USER = "start", "s", "B", "sB", "u"
SHIFT = {  # (state, role) -> state; the pair that "a" completes is reduced at once
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (BODY, "u"): USER, (SYSTEM_BODY, "u"): USER,
}
GOTO = {START: BODY, SYSTEM: SYSTEM_BODY, BODY: BODY, SYSTEM_BODY: SYSTEM_BODY}  # after P -> u a, and the B that it makes or extends
ACCEPT = (START, BODY, SYSTEM_BODY)
# What a segment may begin on: a bare user top stands on one of the others.
TOPS = ((START,), (SYSTEM,), (BODY,), (SYSTEM_BODY,), (START, USER), (SYSTEM, USER), (BODY, USER), (SYSTEM_BODY, USER))


@dataclass(slots=True)
class Top:
    """A stack top: LR state, the top below, and the least cost and audit that lead here."""

    state: str
    below: Top | None
    cost: int = 0
    audit: str = ""

    @property
    def path(self) -> tuple[str, ...]:
        return (self.below.state, USER) if self.state == USER else (self.state,)


def shifted(top: Top, role: str, cost: int, letter: str) -> Top | None:
    """The top after ``role`` is shifted and everything that can be reduced is; None where the tables have no entry."""
    if role == "a":
        if top.state != USER:
            return None
        return Top(GOTO[top.below.state], None, top.cost + cost, top.audit + letter)
    state = SHIFT.get((top.state, role))
    if state is None:
        return None
    return Top(state, top if state == USER else None, top.cost + cost, top.audit + letter)


def merge(tops: dict[str, Top], top: Top | None) -> bool:
    """Add a top; of two in the same state the one with the least (cost, audit) stays."""
    if top is None:
        return False
    old = tops.get(top.state)
    if old is not None and (old.cost, old.audit) <= (top.cost, top.audit):
        return False
    tops[top.state] = top
    return True


def with_inserts(tops: dict[str, Top]) -> dict[str, Top]:
    """Tops that inserted turns lead to, until none gets better."""
    due = list(tops.values())
    while due:
        top = due.pop()
        if tops.get(top.state) is top:
            for role in "ua":
                new = shifted(top, role, INSERT, "I")
                if merge(tops, new):
                    due.append(new)
    return tops


def consume(tops: dict[str, Top], initial: str, fault: int, copies: int = 1) -> dict[str, Top]:
    """All tops after one turn (and ``copies - 1`` duplicates of it)."""
    out: dict[str, Top] = {}
    forced = copies if fault >= IS_DUPLICATE else copies - 1
    more = TRUNCATED if fault == IS_TRUNCATED else 0
    for top in tops.values():
        if fault >= IS_DUPLICATE:
            merge(out, Top(top.state, top.below, top.cost + DELETE * forced, top.audit + "D" * forced))
            continue
        merge(out, Top(top.state, top.below, top.cost + DELETE, top.audit + "D"))
        merge(out, shifted(top, initial, more, "K"))
        for role in "ua":
            merge(out, shifted(top, role, REROLE + more, "R"))
    if fault < IS_DUPLICATE and forced:
        out = with_inserts(out)
        out = {s: Top(s, t.below, t.cost + DELETE * forced, t.audit + "D" * forced) for s, t in out.items()}
    return with_inserts(out)


def parse(rows: Iterable[tuple[str, str, int, int]], path: tuple[str, ...] = (START,)) -> dict[str, Top]:
    """The tops after ``rows`` (role, text, fault, copies) from a given top."""
    top = None
    for state in path:
        top = Top(state, top)
    tops = with_inserts({top.state: top})
    for role, _, fault, copies in rows:
        tops = consume(tops, role[:1], fault, copies)
    return tops


def best(tops: Iterable[Top]) -> Top:
    return min((t for t in tops if t.state in ACCEPT), key=lambda t: (t.cost, t.audit))


def repaired(rows: list[tuple[str, str, int, int]], audit: str, path: tuple[str, ...] = (START,)) -> list[str]:
    """The lines ``role:text`` that the edits of ``audit`` make. Roles that the edits leave open follow from the grammar."""
    lines, wanted = [], "a" if path[-1] == USER else "u"
    source = ((role, text) for role, text, _, copies in rows for _ in range(copies))
    for letter in audit:
        role, text = next(source) if letter != "I" else (None, "")
        if letter == "D":
            continue
        if letter == "K":
            lines.append(f"{role}:{text}")
            if role[0] == "s":
                continue
        else:
            lines.append(f"{NAMES[wanted]}:{text}")
        wanted = "a" if wanted == "u" else "u"
    return lines


# --- turns and their faults -------------------------------------------------------------------------------------


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def cleaned(turns: DataFrame) -> DataFrame:
    """The columns that are read, without null roles and texts."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _text(F.col("role")).alias("role"),
        _text(F.col("text")).alias("text"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (cleaned) with the damage that the checksum of ``conv_id:turn`` asks for."""
    hit = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn")))) % 20
    rows = turns.withColumn("hit", hit).where("hit <> 0")
    rows = rows.withColumn("role", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")))
    text = F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("hit") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long")
    return rows.select("conv_id", "turn", "role", text.alias("text"), copies.alias("copies"))


_SPACE = " \t\n\x0b\x0c\r"


def fault_of(text: str, seen: bool) -> int:
    last = text.rstrip(_SPACE)[-1:]
    if not last:
        return IS_BLANK
    if seen:
        return IS_DUPLICATE
    return SOUND if last in ".!?" else IS_TRUNCATED


@dataclass
class Figures:
    """What is counted over a conversation, or a segment of one."""

    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    distinct: int = 0

    def add(self, turn: int | None, initial: str, fault: int, copies: int) -> None:
        self.counts[fault] += 1
        self.counts[fault if fault == IS_BLANK else IS_DUPLICATE] += copies - 1
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        self.last = initial
        if turn is not None:
            if self.high is None or turn > self.high:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


FIELDS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def _result(conv: int | None, f: Figures, cost: int, audit: str, sha: str) -> tuple:
    return conv, f.gaps, f.counts[IS_BLANK], f.counts[IS_DUPLICATE], f.counts[IS_TRUNCATED], f.illegal, cost, audit, sha


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_RESULT = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in _NAMES])


def _conversation(conv: int | None, turns: list[tuple]) -> tuple:
    figures, seen, rows = Figures(), set(), []
    for turn, role, text, copies in turns:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        figures.add(turn, role[:1], fault, copies)
        rows.append((role, text, fault, copies))
    top = best(parse(rows).values())
    body = "\n".join(repaired(rows, top.audit)).encode()
    return _result(conv, figures, top.cost, top.audit, hashlib.sha256(body).hexdigest())


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations from a stream sorted by conversation and turn, one conversation at a time."""
    conv, turns, out = None, [], []
    for batch in batches:
        for c, *turn in zip(*(col.to_pylist() for col in batch.columns)):
            if turns and c != conv:
                out.append(_conversation(conv, turns))
                turns = []
                if len(out) >= 1000:
                    yield _batch(out, _RESULT)
                    out = []
            conv = c
            turns.append(turn)
    if turns:
        out.append(_conversation(conv, turns))
    if out:
        yield _batch(out, _RESULT)


# --- long conversations -----------------------------------------------------------------------------------------

_PLACED = "conv_id long, part int, seq long, at long, turn long, role string, text string, copies long"


def _place(rows: int, most: int):
    """Number the segments (part, seq) and the places in them of turns sorted by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, at, size, conv = 0, 0, 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            seqs, places = [], []
            lengths = [len(t) for t in batch.column("text").to_pylist()]
            for c, length in zip(batch.column("conv_id").to_pylist(), lengths):
                if at and (c != conv or at >= rows or size + length > most):
                    seq, at, size = seq + 1, 0, 0
                seqs.append(seq)
                places.append(at)
                conv, at, size = c, at + 1, size + length
            table = table.append_column("seq", pa.array(seqs, pa.int64())).append_column("at", pa.array(places, pa.int64()))
            yield from table.select(["conv_id", "part", "seq", "at", "turn", "role", "text", "copies"]).to_batches()

    return run


_MOVE = pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_TURN = pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.int64()), ("copies", pa.int64())])
_SEGMENT = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "low", "high", "distinct")),
     ("first", pa.string()), ("last", pa.string()), ("moves", pa.list_(_MOVE)), ("turns", pa.list_(_TURN))]
)
_SEGMENT_DDL = (
    "conv_id long, part int, seq long, blank long, duplicate long, truncated long, illegal long, low long, high long, distinct long, "
    "first string, last string, moves array<struct<start:string,end:string,cost:long,audit:string>>, "
    "turns array<struct<role:string,text:string,fault:long,copies:long>>"
)


def _segment(key: tuple, turns: list[tuple]) -> tuple:
    """A segment's figures, and for every top it may begin on the least way to each top it may end on."""
    figures, rows = Figures(), []
    for turn, role, text, copies, seen in turns:
        fault = fault_of(text, seen)
        figures.add(turn, role[:1], fault, copies)
        rows.append((role, text, fault, copies))
    moves = []
    for path in TOPS:
        for top in parse(rows, path).values():
            moves.append({"start": ",".join(path), "end": ",".join(top.path), "cost": top.cost, "audit": top.audit})
    f = figures
    counts = (f.counts[IS_BLANK], f.counts[IS_DUPLICATE], f.counts[IS_TRUNCATED], f.illegal, f.low, f.high, f.distinct)
    own = [dict(zip(("role", "text", "fault", "copies"), row)) for row in rows]
    return *key, *counts, f.first, f.last, moves, own


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, turns = None, []
    for batch in batches:
        for conv, part, seq, *turn in zip(*(col.to_pylist() for col in batch.columns)):
            if turns and (conv, part, seq) != key:
                yield _batch([_segment(key, turns)], _SEGMENT)
                turns = []
            key = (conv, part, seq)
            turns.append(turn)
    if turns:
        yield _batch([_segment(key, turns)], _SEGMENT)


class _Joined:
    """The tops of a conversation while its segments pass, each with the digest of its repaired lines so far."""

    def __init__(self, conv: int | None):
        self.conv, self.figures = conv, Figures()
        self.tops: dict[str, tuple[int, str, object, bool]] = {START: (0, "", hashlib.sha256(), False)}

    def add(self, s: dict) -> None:
        f = self.figures
        for fault, name in ((IS_BLANK, "blank"), (IS_DUPLICATE, "duplicate"), (IS_TRUNCATED, "truncated")):
            f.counts[fault] += s[name]
        f.illegal += s["illegal"] + (f.last is not None and f.last + s["first"] not in LEGAL)
        f.last = s["last"]
        if s["low"] is not None:
            f.distinct += s["distinct"] - (f.high is not None and f.high == s["low"])
            f.low = s["low"] if f.low is None else f.low
            f.high = s["high"]
        found: dict[str, tuple] = {}
        for m in s["moves"]:
            if m["start"] in self.tops:
                cost, audit, *_ = before = self.tops[m["start"]]
                way = (cost + m["cost"], audit + m["audit"])
                state = m["end"].rpartition(",")[2]
                if state not in found or way < found[state][:2]:
                    found[state] = (*way, m, before)
        self.tops = {}
        rows = [tuple(t.values()) for t in s["turns"]]
        for cost, audit, m, (_, _, sha, begun) in found.values():
            lines = repaired(rows, m["audit"], tuple(m["start"].split(",")))
            sha = sha.copy()
            sha.update(("\n" * (begun and bool(lines)) + "\n".join(lines)).encode())
            self.tops[m["end"]] = (cost, audit, sha, begun or bool(lines))

    def result(self) -> tuple:
        done = [t for path, t in self.tops.items() if path in ACCEPT]
        cost, audit, sha, _ = min(done, key=lambda t: t[:2])
        return _result(self.conv, self.figures, cost, audit, sha.hexdigest())


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        for i in range(len(batch)):
            segment = batch.slice(i, 1).to_pylist()[0]
            if held is not None and held.conv != segment["conv_id"]:
                yield _batch([held.result()], _RESULT)
                held = None
            held = held or _Joined(segment["conv_id"])
            held.add(segment)
    if held is not None:
        yield _batch([held.result()], _RESULT)


def _long(turns: DataFrame, rows: int, most: int) -> DataFrame:
    counted = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    # The order within a range needs whole texts, the choice of ranges only their beginning.
    ranged = counted.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    ranged = ranged.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())
    placed = S.stored(ranged.mapInArrow(_place(rows, most), _PLACED), "turns")
    place = F.struct("part", "seq", "at")
    by_text = placed.withColumn("own", F.sha2(F.col("text").cast("binary"), 256))
    firsts = by_text.groupBy("conv_id", "role", "own").agg(F.min(place).alias("least"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("own").alias("o"), "least")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("own") == F.col("o"))
    flagged = by_text.join(firsts, same, "left").withColumn("seen", F.col("least") < place)
    flagged = flagged.repartition("conv_id", "part", "seq").sortWithinPartitions("conv_id", "part", "seq", "at")
    segments = flagged.select("conv_id", "part", "seq", "turn", "role", "text", "copies", "seen").mapInArrow(_segments, _SEGMENT_DDL)
    segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return segments.mapInArrow(_join, FIELDS)


def repair(turns: DataFrame, rows: int = ROWS, most: int = BYTES) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, copies; no null role or text): what is wrong with it, the
    cost and the edits (``audit``) of its cheapest repair, and the digest of the repaired text."""
    size = F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.col("copies")).alias("size")
    long = turns.groupBy("conv_id").agg(*size).where((F.col("n") > rows) | (F.col("size") > most)).select(F.col("conv_id").alias("c"))
    long = broadcast_if_small(S.stored(long, "long"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    short = turns.join(long, same, "left_anti").select("conv_id", "turn", "role", "text", "copies")
    short = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return short.mapInArrow(_whole, FIELDS).unionByName(_long(turns.join(long, same, "left_semi"), rows, most))


def digest(conversations: DataFrame, rows: int = ROWS, most: int = BYTES) -> DataFrame:
    turns = cleaned(conversations)
    done = repair(damaged(turns), rows, most)
    names = turns.select(F.col("conv_id").alias("c")).distinct()
    out = names.join(done, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in _NAMES[1:7]]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
