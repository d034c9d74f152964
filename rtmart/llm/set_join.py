"""N-gram Jaccard join by set relations: skipping blocks of an index by position, and answers derived from a similar set's answers.

1. *Sets.* The distinct word shingles of a text, as 56-bit hashes. Equal sets are one class from here on.
2. *Order.* Shingles that many sets hold come last, by the size of their count; the rest is ordered by hash. The counts take in every
   set (each task adds up what repeats among ``FLUSH`` shingles); at most ``HEAVY`` shingles can hold that share of them all. The
   order steers cost only: any one finds all links.
3. *Index.* The first shingles of a set, one more than a partner can lack, are posted with size, position and the parities of the
   set's hashes in 256 classes. Two sets that link share the list of their first common shingle. In a list, postings lie in blocks
   of one position, ordered by size. For a set, a block is skipped when no size in it can reach the overlap, and of the others
   only the range of sizes that can is read. Parities that differ in more places than two linked sets may differ rule a posting out.
4. *Stars.* The first set of a list leads all that may link with it; pairs of which both have the same leader are left to that
   leader's star, so a list of copies sends one row a set. Stars of large sets, for which 256 parities tell little, are led anew by
   parities in number with the sets' sizes. Sets go with their shingles to their leaders only: first each to one of its leaders, then
   to the stars that still hold sets which nothing connects.
5. *Derived answers.* In a star only the leader is intersected with the others. Every other set is kept as its difference from the
   leader: with x the leader, ``|y & z| = |x| - |x-y| - |x-z| + |(x-y) & (x-z)| + |(y-x) & (z-x)|``, so the answers of y follow from
   those of x and the small differences, and bounds from their sizes skip most of them. Sets that are reached are not compared again.
6. *Classes* are the connected components of the links.

Hot groups: a list of more than ``LIST_ROWS`` sets is dealt by hash into parts, every pair of parts being one task. A star of
more than ``TOKENS`` shingles is dealt into chunks that meet through their leader; its sets that do not link with the leader then meet
every chunk, block by block. Nothing is capped.

Defined results: null and empty texts have no shingles and link with nothing, not even one another; a text of fewer words is one
shingle; rows with a null ``doc_id`` belong to their class and never name it; repeated rows give a row each; an empty table gives no
rows; other columns are not read. Shingles and sets are named by hashes of 56 and 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.functions.sizing import broadcast_if_small
from rtmart.llm import shared as S
from rtmart.llm.components import components

WORDS = 3
PERCENT = 90  # least Jaccard similarity
HEAVY = 1 << 20  # a shingle with more than this share of all is frequent; so many can be
FLUSH = 1 << 22  # shingles that a task counts at a time
LIST_ROWS = 1 << 20  # postings of a list in one task
TOKENS = 1 << 21  # shingles of a star in one task
BITS = 256
LARGE = 2 * BITS  # sets of more shingles are sketched anew
BLOCK = 1 << 22  # bytes of text worked on at once
_TAIL = np.uint64((1 << 56) - 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- sets -------------------------------------------------------------------------------------------------------


class Order:
    """The global order: a shingle's sort key is its hash, under a leading byte that grows with its count."""

    def __init__(self, hashes: np.ndarray | None = None, counts: np.ndarray | None = None):
        hashes = np.zeros(0, np.uint64) if hashes is None else hashes
        at = np.argsort(hashes)
        self.hashes = hashes[at]
        self.counts = np.zeros(0, np.int64) if counts is None else counts[at]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return hashes
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        level = np.where(self.hashes[at] == hashes, np.log2(self.counts[at]).astype(np.uint64) + np.uint64(1), np.uint64(0))
        return hashes | (level << np.uint64(56))

    def parts(self, keys: np.ndarray, most: int) -> np.ndarray:
        """How many parts the list of each key is dealt into."""
        if not len(self.hashes):
            return np.ones(len(keys), np.int64)
        hashes = keys & _TAIL
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, -(-self.counts[at] // most), 1)


def shingle_sets(bodies: list[bytes], words: int, order: Order | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, ascending by ``order``, and where each text's begin (one more entry at the end)."""
    data = _LOWER[np.frombuffer(b" ".join(bodies), np.uint8)]
    ends = np.cumsum([len(b) + 1 for b in bodies])
    first, _, hashes = S.word_table(data)
    doc = np.searchsorted(ends, first, side="right")
    count = np.bincount(doc, minlength=len(bodies))
    total = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        total = S.mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(total)])
    owner = doc[: len(total)]
    inside = owner == doc[words - 1 : words - 1 + len(total)]
    found, owner = total[inside], owner[inside]
    begins = np.cumsum(count) - count
    short, whole = np.flatnonzero((count > 0) & (count < words)), []
    for d in short:
        value = np.array([count[d]], np.uint64)
        for h in hashes[begins[d] : begins[d] + count[d]]:
            value = S.mix(value * np.uint64(0x9E3779B97F4A7C15) + h)
        whole.append(value)
    if whole:
        found, owner = np.concatenate([found, *whole]), np.concatenate([owner, short])
    found = found & _TAIL
    if order is not None:
        found = order.keys(found)
    at = np.lexsort((found, owner))
    found, owner = found[at], owner[at]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(bodies) + 1))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of every part of ``values``; parts may be empty."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def set_names(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits that stand for a set, whatever its order."""
    sizes = np.diff(starts).astype(np.uint64)
    return S.mix(_sums(S.mix(S.mix((found & _TAIL) + np.uint64(1))), starts) + S.mix(sizes + np.uint64(7))).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with at most about ``BLOCK`` bytes of text, or one text."""
    for batch in batches:
        bodies, size, low = [], 0, 0
        for i, value in enumerate(batch.column(column)):
            body = value.as_buffer().to_pybytes()
            if bodies and size + len(body) > BLOCK:
                yield batch.slice(low, len(bodies)), bodies
                bodies, size, low = [], 0, i
            bodies.append(body)
            size += len(body)
        if bodies:
            yield batch.slice(low, len(bodies)), bodies


def _named(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in _blocks(batches, 1):
            found, starts = shingle_sets(bodies, words)
            n = np.diff(starts)
            name = pa.array(set_names(found, starts), pa.int64(), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), name], ["doc_id", "n", "name"])

    return run


def _counted(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def repeated(held: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            columns = [pa.array(values[often].astype(np.int64)), pa.array(counts[often].astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["shingle", "n"])

        held, size = [], 0
        for _, bodies in _blocks(batches, 0):
            found, _ = shingle_sets(bodies, words)
            held.append(found)
            size += len(found)
            if size >= FLUSH:
                yield repeated(held)
                held, size = [], 0
        if held:
            yield repeated(held)

    return run


def parities(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every set, whether an odd number of its shingles falls into each of ``BITS`` classes, as 64-bit words."""
    n = len(starts) - 1
    owner = np.repeat(np.arange(n), np.diff(starts))
    kind = (S.mix(found & _TAIL) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(owner * BITS + kind, minlength=n * BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, BITS), axis=1, bitorder="little").view("<u8")


def sketch_bits(sizes: np.ndarray) -> np.ndarray:
    """Parities that a set of a large star is sketched with: a power of two, half its shingles or more."""
    return np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(sizes, 2) / 2)).astype(np.int64))


def _sketched(words: int):
    """(name, size, sketch) of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bodies in _blocks(batches, 0):
            found, starts = shingle_sets(bodies, words)
            names, sizes = set_names(found, starts), np.diff(starts)
            some, out = np.flatnonzero(sizes), []
            for i, bits in zip(some, sketch_bits(sizes[some])):
                kinds = (S.mix(found[starts[i] : starts[i + 1]]) % np.uint64(bits)).astype(np.int64)
                out.append(np.packbits(np.bincount(kinds, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes())
            columns = [pa.array(names[some], pa.int64()), pa.array(sizes[some], pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["name", "size", "sketch"])

    return run


def prefix_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.where(sizes > 0, sizes + 1 - -(-percent * sizes // 100), 0)


_POST = ["shingle", "deal", "name", "place", "p0", "p1", "p2", "p3"]


def _posted(words: int, percent: int, order, list_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bodies in _blocks(batches, 0):
            found, starts = shingle_sets(bodies, words, order.value)
            sizes, names, parity = np.diff(starts), set_names(found, starts), parities(found, starts)
            many = prefix_sizes(sizes, percent)
            owner = np.repeat(np.arange(len(sizes)), many)
            position = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            keys = found[starts[owner] + position]
            parts = order.value.parts(keys, list_rows)
            own = (S.mix(names.astype(np.uint64))[owner] % parts.astype(np.uint64)).astype(np.int64)
            again = np.repeat(np.arange(len(keys)), parts)  # a posting goes to every pair of parts that its own is in
            other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
            deal = (np.minimum(own[again], other) << 32) | np.maximum(own[again], other)
            owner = owner[again]
            place = (sizes[owner].astype(np.int64) << 32) | position[again]
            columns = [keys[again].astype(np.int64), deal, names[owner], place, *(parity[owner, i].astype(np.int64) for i in range(4))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _POST)

    return run


def _keyed(words: int, order):
    """(name, size, keys) of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bodies in _blocks(batches, 0):
            found, starts = shingle_sets(bodies, words, order.value)
            names = set_names(found, starts)
            some = np.flatnonzero(np.diff(starts))
            keys = [found[starts[i] : starts[i + 1]].tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(names[some], pa.int64()), pa.array(keys, pa.binary())], ["name", "keys"])

    return run


# --- lists ------------------------------------------------------------------------------------------------------


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


class Postings:
    """Postings of whole lists, as arrays."""

    def __init__(self, columns: list[np.ndarray], percent: int):
        self.key, self.deal, self.name, place = columns[:4]
        self.size, self.position = place >> 32, place & 0xFFFFFFFF
        self.parity = np.stack(columns[4:], axis=1).astype(np.uint64)
        self.percent = percent

    def may_link(self, x: np.ndarray | int, y: np.ndarray) -> np.ndarray:
        """Which of the postings ``y`` may link with ``x``, both in one list, that of their first common shingle."""
        least = needed(self.size[x], self.size[y], self.percent)
        rest = np.minimum(self.size[x] - self.position[x], self.size[y] - self.position[y])
        differ = np.bitwise_count(self.parity[x] ^ self.parity[y]).sum(axis=-1, dtype=np.int64)
        return (rest >= least) & (differ <= self.size[x] + self.size[y] - 2 * least)


class Blocks:
    """The postings ``low`` to ``high`` of one list in blocks of one position, ordered by size."""

    def __init__(self, p: Postings, low: int, high: int):
        self.p = p
        self.at = low + np.lexsort((p.size[low:high], p.position[low:high]))
        self.size = p.size[self.at]
        position = p.position[self.at]
        self.start = np.concatenate(([0], np.flatnonzero(np.diff(position)) + 1))
        self.end = np.concatenate((self.start[1:], [len(self.at)]))
        self.position = position[self.start]
        self.least, self.most = self.size[self.start], self.size[self.end - 1]

    def near(self, x: int) -> np.ndarray:
        """Postings whose size and position let them link with ``x``."""
        s, q, t = int(self.p.size[x]), int(self.p.position[x]), self.p.percent
        low = -(-(t * s + (100 + t) * self.position) // 100)
        high = ((100 + t) * (s - q) - t * s) // t
        out = []
        for b in np.flatnonzero((self.most >= low) & (self.least <= high) & (low <= high)):
            a, z = self.start[b], self.end[b]
            out.append(self.at[a + np.searchsorted(self.size[a:z], low[b]) : a + np.searchsorted(self.size[a:z], high, side="right")])
        return np.concatenate(out) if out else self.at[:0]


def cover(p: Postings, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaders of one list with their followers, so that of any two postings that may link one leads the other, or both follow one
    leader. Members are taken in order; those under the same first leader need not meet."""
    blocks = Blocks(p, low, high)
    leader = np.full(high - low, -1)
    for x in range(low, high - 1):
        own = leader[x - low]
        if own >= 0 and (leader[x + 1 - low :] == own).all():
            break
        near = blocks.near(x)
        near = near[near > x]
        if own >= 0:
            near = near[leader[near - low] != own]
        near = near[p.may_link(x, near)]
        if len(near):
            yield x, near
            free = near[leader[near - low] < 0]
            leader[free - low] = x


def _pairs(percent: int):
    """(leader, follower, their sizes) from postings sorted by list and set; holds one list at a time."""

    def work(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, deal, name = columns[:3]
        new = np.ones(len(key), bool)  # rows without an id may bring a set twice
        new[1:] = (key[1:] != key[:-1]) | (deal[1:] != deal[:-1]) | (name[1:] != name[:-1])
        p = Postings([c[new] for c in columns], percent)
        edge = np.flatnonzero((np.diff(p.key) != 0) | (np.diff(p.deal) != 0)) + 1
        low = np.concatenate(([0], edge))
        count = np.diff(np.concatenate((low, [len(p.key)])))
        low, count = low[count > 1], count[count > 1]
        if not len(low):
            return
        first = np.repeat(low, count)
        rest = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count) + first
        first, rest = first[first != rest], rest[first != rest]
        ok = p.may_link(first, rest)
        whole = np.add.reduceat(ok, np.concatenate(([0], np.cumsum(count - 1)[:-1]))) == count - 1
        take = ok & np.repeat(whole, count - 1)
        leaders, followers = [first[take]], [rest[take]]
        for a, n in zip(low[~whole], count[~whole]):
            if n > 2:
                for x, near in cover(p, int(a), int(a + n)):
                    leaders.append(np.full(len(near), x))
                    followers.append(near)
        leader, follower = np.concatenate(leaders), np.concatenate(followers)
        if len(leader):
            columns = [p.name[leader], p.name[follower], p.size[leader], p.size[follower]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v", "u_size", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_rows, last = [], 0, None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not len(batch):
                continue
            if last is not None and (columns[0][-1], columns[1][-1]) == last:  # still the same list
                held.append(columns)
                continue
            last = (columns[0][-1], columns[1][-1])
            tail = int(np.flatnonzero((columns[0] != last[0]) | (columns[1] != last[1]))[-1] + 1) if (
                (columns[0][0], columns[1][0]) != last
            ) else 0
            head = [*held, [c[:tail] for c in columns]]
            held = [[c[tail:] for c in columns]]
            if sum(len(h[0]) for h in head):
                yield from work([np.concatenate(c) for c in zip(*head)])
        if held:
            yield from work([np.concatenate(c) for c in zip(*held)])

    return run


class Sketches:
    """Sizes and parities of the sets of one star; sketches of different width are compared at the smaller one."""

    def __init__(self, sizes: list[int], sketches: list[bytes], percent: int):
        self.size, self.percent = np.array(sizes, np.int64), percent
        self.bits = np.array([8 * len(x) for x in sketches])
        self.row = np.zeros(len(sizes), np.int64)
        self.rows: dict[tuple[int, int], np.ndarray] = {}
        for bits in np.unique(self.bits):
            of = np.flatnonzero(self.bits == bits)
            self.row[of] = np.arange(len(of))
            self.rows[bits, bits] = np.frombuffer(b"".join(sketches[i] for i in of), "<u8").reshape(len(of), -1)

    def _folded(self, bits: int, to: int) -> np.ndarray:
        if (bits, to) not in self.rows:
            own = self.rows[bits, bits]
            self.rows[bits, to] = np.bitwise_xor.reduce(own.reshape(len(own), bits // to, to // 64), axis=1)
        return self.rows[bits, to]

    def may_link(self, x: int, others: np.ndarray) -> np.ndarray:
        least = needed(self.size[x], self.size[others], self.percent)
        ok = np.minimum(self.size[x], self.size[others]) >= least
        room = self.size[x] + self.size[others] - 2 * least
        for bits in np.unique(self.bits[others]):
            of, to = np.flatnonzero(self.bits[others] == bits), min(bits, self.bits[x])
            differ = self._folded(bits, to)[self.row[others[of]]] ^ self._folded(self.bits[x], to)[self.row[x]]
            ok[of] &= np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= room[of]
        return ok

    def cover(self) -> Iterator[tuple[int, np.ndarray]]:
        """As :func:`cover`, for the members of a star."""
        n = len(self.size)
        leader = np.full(n, -1)
        for x in range(n - 1):
            near = np.arange(x + 1, n)
            if leader[x] >= 0:
                near = near[leader[near] != leader[x]]
            near = near[self.may_link(x, near)] if len(near) else near
            if len(near):
                yield x, near
                leader[near[leader[near] < 0]] = x


_PAIR = ["u", "v", "u_size", "size"]


def _led_anew(percent: int):
    """Pairs as those of ``_pairs``, from rows (u, v, size, sketch) sorted by star, its leader first; holds one star."""

    def work(names: list[int], sizes: list[int], sketches: list[bytes]) -> Iterator[pa.RecordBatch]:
        star = Sketches(sizes, sketches, percent)
        name = np.array(names, np.int64)
        for x, near in star.cover():
            columns = [np.full(len(near), name[x]), name[near], np.full(len(near), sizes[x]), star.size[near]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, sizes, sketches = None, [], [], []
        for batch in batches:
            for u, v, size, sketch in zip(*(c.to_pylist() for c in batch.columns)):
                if u != key:
                    if names:
                        yield from work(names, sizes, sketches)
                    key, names, sizes, sketches = u, [], [], []
                if v not in names[-1:]:
                    names.append(v)
                    sizes.append(size)
                    sketches.append(sketch)
        if names:
            yield from work(names, sizes, sketches)

    return run


# --- stars ------------------------------------------------------------------------------------------------------


class Star:
    """A leader's set and others, each kept as its difference from the leader."""

    def __init__(self, leader: np.ndarray, members: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(m) for m in members], np.int64)
        self.x = len(leader)
        starts = np.concatenate(([0], np.cumsum(self.sizes)))
        flat = np.concatenate(members)
        at = np.minimum(np.searchsorted(leader, flat), self.x - 1)
        inside = leader[at] == flat
        self.overlap = _sums(inside.astype(np.int64), starts)
        self.minus = self.x - self.overlap
        self.plus = self.sizes - self.overlap
        self.linked = self.overlap >= needed(self.x, self.sizes, percent)
        self._flat, self._inside, self._at, self._starts, self._leader = flat, inside, at, starts, leader

    def differences(self) -> None:
        """Lists of the leader's shingles that a member lacks and of those that it has besides, numbered together."""
        lists = []
        for i in range(len(self.sizes)):
            part = slice(self._starts[i], self._starts[i + 1])
            lacks = np.ones(self.x, bool)
            lacks[self._at[part][self._inside[part]]] = False
            lists.append(np.concatenate((self._leader[lacks], self._flat[part][~self._inside[part]])))
        self.starts = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        values, self.diff = np.unique(np.concatenate(lists), return_inverse=True)
        self.mark = np.zeros(len(values), np.int64)

    def linked_with(self, y: int, others: np.ndarray) -> np.ndarray:
        """Which ``others`` link with member ``y``, derived from the leader's overlaps."""
        least = needed(self.sizes[y], self.sizes[others], self.percent)
        base = self.x - self.minus[y] - self.minus[others]
        count = self.minus + self.plus
        able = base + np.minimum(count[y], count[others]) >= least
        others, least, base = others[able], least[able], base[able]
        if not len(others):
            return others
        own = self.diff[self.starts[y] : self.starts[y + 1]]
        self.mark[own] = 1
        n = count[others]
        at = np.repeat(self.starts[others] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = _sums(self.mark[self.diff[at]], np.concatenate(([0], np.cumsum(n))))
        self.mark[own] = 0
        return others[base + common >= least]

    def links(self) -> Iterator[tuple[int, int]]:
        """(member, member) links that, with those to the leader, connect all that are linked."""
        left = np.flatnonzero(~self.linked)
        if not len(left):
            return
        self.differences()
        front = np.flatnonzero(self.linked).tolist()
        while len(left):
            if not front:
                front, left = [int(left[0])], left[1:]
            y = front.pop()
            near = self.linked_with(y, left)
            for z in near:
                yield y, int(z)
            if len(near):
                front += near.tolist()
                left = left[~np.isin(left, near)]


def _stars(percent: int):
    """Rows (u, v, rest) from rows (u, part, chunks, v, keys) sorted by star and by whether v is the leader. Links have rest 0; of
    stars in several chunks, rows with rest 1 name those that do not link with the leader."""

    def work(u: int, chunks: int, names: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        star = Star(sets[0], sets[1:], percent)
        members = np.array(names[1:], np.int64)
        linked = members[star.linked]
        rows = [(u, int(v), 0) for v in linked] + [(int(members[a]), int(members[b]), 0) for a, b in star.links()]
        if chunks > 1:
            rows += [(u, int(v), 1) for v in members[~star.linked]]
        a, b, rest = zip(*rows) if rows else ((),) * 3
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(rest, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["u", "v", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunks, names, sets = None, 0, [], []
        for batch in batches:
            us, parts, many, vs = (batch.column(i).to_pylist() for i in range(4))
            for u, part, n, v, keys in zip(us, parts, many, vs, batch.column(4)):
                if (u, part) != key:
                    if len(sets) > 1:
                        yield work(key[0], chunks, names, sets)
                    key, chunks, names, sets = (u, part), n, [], []
                if v not in names[-1:]:  # rows without an id may bring a set twice
                    names.append(v)
                    sets.append(np.frombuffer(keys.as_buffer(), np.uint64))
        if len(sets) > 1:
            yield work(key[0], chunks, names, sets)

    return run


def _met(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What the stars (u, part, chunks, v) find with the shingles of ``sets``. The leader comes with every part."""
    led = stars.unionByName(stars.select("u", "part", "chunks").distinct().withColumn("v", F.col("u")))
    rows = led.join(sets, F.col("v") == F.col("name")).select("u", "part", "chunks", "v", "keys", (F.col("u") != F.col("v")).alias("follows"))
    rows = rows.repartition("u", "part").sortWithinPartitions("u", "part", "follows", "v")
    return S.stored(rows.select("u", "part", "chunks", "v", "keys").mapInArrow(_stars(percent), "u long, v long, rest long"), "links")


def _many(pairs: DataFrame, tokens: int) -> DataFrame:
    """(u, chunks) of the stars that one task should not hold."""
    many = pairs.groupBy("u").agg(F.ceil(F.sum("size") / tokens).cast("long").alias("chunks")).where("chunks > 1")
    return broadcast_if_small(S.stored(many, "stars"))


def _long(n: int):
    return F.lit(n).cast("long")


def _star_links(pairs: DataFrame, sets: DataFrame, percent: int, tokens: int, whole: bool) -> DataFrame:
    """Links (u, v) of stars. Those with the leader only, unless ``whole``: then they connect all of a star that links."""
    dealt = pairs.join(_many(pairs, tokens), "u", "left").withColumn("chunks", F.coalesce("chunks", _long(1)))
    dealt = dealt.select("u", F.pmod(F.xxhash64("v"), "chunks").alias("part"), "chunks", "v", "size")
    first = _met(dealt.drop("size"), sets, percent)
    found = first.where("rest = 0").select("u", "v")
    # Stars in chunks: those that the leader did not link, in blocks, each with every chunk.
    loose = first.where("rest = 1").select("u", "v").join(dealt.where("chunks > 1"), ["u", "v"])
    if not whole or loose.isEmpty():
        return found
    blocks = loose.groupBy("u").agg(F.ceil(F.sum("size") / tokens).cast("long").alias("blocks"))
    loose = loose.join(blocks, "u").withColumn("block", F.pmod(F.xxhash64("v", F.lit(1)), "blocks"))
    left = loose.select("u", "block", F.explode(F.sequence(_long(0), F.col("chunks") - 1)).alias("chunk"), "chunks", "v")
    right = dealt.where("chunks > 1").join(blocks, "u")
    right = right.select("u", F.explode(F.sequence(_long(0), F.col("blocks") - 1)).alias("block"), F.col("part").alias("chunk"), "chunks", "v")
    again = left.unionByName(right).distinct()
    again = again.select("u", (F.col("block") * F.col("chunks") + F.col("chunk")).alias("part"), _long(1).alias("chunks"), "v")
    return found.unionByName(_met(again, sets, percent).select("u", "v"))


def links(pairs: DataFrame, sets: DataFrame, percent: int, tokens: int) -> DataFrame:
    """Links (u, v) that connect all sets that link, from the leaders' pairs: first every follower with one of its leaders, then
    whole stars in which not everybody is connected yet."""
    one = pairs.groupBy("v").agg(F.min(F.struct("u", "size")).alias("m")).select("m.u", "v", "m.size")
    found = _star_links(one, sets, percent, tokens, whole=False)
    known = S.stored(components(found), "known")
    of_u = known.select(F.col("node").alias("u"), F.col("root").alias("u_root"))
    of_v = known.select(F.col("node").alias("v"), F.col("root").alias("v_root"))
    open_ = pairs.join(of_u, "u", "left").join(of_v, "v", "left").where("u_root is null or v_root is null or u_root <> v_root")
    left = S.stored(pairs.join(open_.select("u").distinct(), "u", "left_semi").select("u", "v", "size"), "open")
    if left.isEmpty():
        return found
    return found.unionByName(_star_links(left, sets, percent, tokens, whole=True))


# --- classes ----------------------------------------------------------------------------------------------------


def classes(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, heavy: int = HEAVY, list_rows: int = LIST_ROWS, tokens: int = TOKENS
) -> DataFrame:
    """One row per document: doc_id, n (size of its set) and component_id (least doc_id that links reach, itself included)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), S.utf8().alias("body"))
    own = S.stored(rows.mapInArrow(_named(words), "doc_id long, n long, name long"), "sets")
    sets = S.stored(own.where("name is not null").groupBy("name").agg(F.min("doc_id").alias("least")), "classes")

    def texts(of: DataFrame) -> DataFrame:
        """One text of each of these classes, and all without an id."""
        least = broadcast_if_small(of.select("least").where("least is not null"))
        return rows.join(least, F.col("doc_id") == F.col("least"), "left_semi").unionByName(rows.where("doc_id is null")).select("body")

    def only(frame: DataFrame, names: DataFrame) -> DataFrame:
        return frame.join(names.select(F.col("name").alias("wanted")), F.col("name") == F.col("wanted"), "left_semi")

    def names_of(some: DataFrame) -> DataFrame:
        both = some.select("u").unionByName(some.select(F.col("v").alias("u"))).distinct().withColumnRenamed("u", "name")
        return S.stored(sets.join(both, "name", "left_semi"), "names")

    total = own.agg(F.sum("n")).first()[0] or 0
    every = texts(sets)
    counted = every.mapInArrow(_counted(words), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    often = counted.where(F.col("n") > total / heavy).toArrow()
    order = Order(often.column(0).to_numpy().astype(np.uint64), often.column(1).to_numpy())
    order = docs.sparkSession.sparkContext.broadcast(order)

    posted = every.mapInArrow(_posted(words, percent, order, list_rows), ", ".join(f"{c} long" for c in _POST))
    posted = posted.repartition("shingle", "deal").sortWithinPartitions("shingle", "deal", "name")
    listed = "u long, v long, u_size long, size long"
    pairs = S.stored(posted.mapInArrow(_pairs(percent), listed).distinct(), "pairs")

    large = pairs.where(F.col("u_size") > LARGE).join(_many(pairs, tokens).select("u"), "u", "left_anti").select(*_PAIR)
    named = names_of(large)
    sketch = only(texts(named).mapInArrow(_sketched(words), "name long, size long, sketch binary"), named)
    stars = large.select("u", "v").unionByName(large.select("u", F.col("u").alias("v")).distinct())
    stars = stars.join(sketch, F.col("v") == F.col("name")).select("u", "v", "size", "sketch", (F.col("u") != F.col("v")).alias("follows"))
    stars = stars.repartition("u").sortWithinPartitions("u", "follows", "v").select("u", "v", "size", "sketch")
    anew = stars.mapInArrow(_led_anew(percent), listed).distinct()
    pairs = S.stored(pairs.exceptAll(large).unionByName(anew).distinct(), "pairs")

    named = names_of(pairs)
    keyed = S.stored(only(texts(named).mapInArrow(_keyed(words, order), "name long, keys binary"), named), "keys")
    joined = components(links(pairs, keyed, percent, tokens))
    rooted = sets.join(joined.withColumnRenamed("node", "name"), "name", "left").select("name", "least", F.coalesce("root", "name").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = rooted.join(named, "root").select(F.col("name").alias("own_name"), "component_id")
    out = own.join(by_set, F.col("name") == F.col("own_name"), "left")
    return out.select("doc_id", "n", F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
