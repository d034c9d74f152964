"""Cutting text where no pre-token of the byte-level pattern can cross, so that pieces can be encoded on their own."""

from __future__ import annotations

import re

CACHE_WORDS = 200_000  # about 50 MB
CACHE_CHARS = 48
BLOCK_CHARS = 4 << 20
PART_CHARS = 1 << 18  # a part of a long text, to hold the list of its ids
_CUT = re.compile(r"(?<=\S) (?=\S)")


def regular(part: str) -> bool:
    return bool(part) and not part[0].isspace() and not part[-1].isspace()


def pieces(text: str) -> list[str]:
    """Parts of ``text`` that add up to it, cut before single spaces between two characters that are no white space.

    The pattern takes one space together with what follows, and longer runs of white space on their own; a cut at a single
    inner space therefore always falls between two matches.
    """
    head, *rest = text.split(" ")
    if not rest:
        return [text] if text else []
    out, open_ = [head], not regular(head)
    for part in rest:
        if open_ or not regular(part):
            out[-1] += " " + part
            open_ = not regular(part)
        else:
            out.append(" " + part)
    return out


def long_parts(text: str, most: int = PART_CHARS) -> list[str]:
    """Parts of ``text`` that add up to it, cut at the first place that ``pieces`` allows after every ``most`` characters."""
    out, low = [], 0
    while len(text) - low > most and (cut := _CUT.search(text, low + most)):
        out.append(text[low : cut.start()])
        low = cut.start()
    return [*out, text[low:]]


class TextEncoder:
    """Token ids of texts as little-endian 32-bit bytes, without a cache: for an encoder that takes a text faster than Python
    takes its words.

    ``encode`` turns a list of parts into a list of such bytes. Texts that hold one of the strings ``added`` go to ``whole`` uncut.
    """

    def __init__(self, encode, whole, added: list[str]):
        self.encode, self.whole, self.added = encode, whole, added

    def ids(self, texts: list[str]) -> list[bytes]:
        return [
            self.whole([t])[0] if any(a in t for a in self.added) else b"".join(self.encode(long_parts(t))) for t in texts
        ]


class CachedEncoder:
    """Token ids of texts as little-endian 32-bit bytes; short pieces are encoded once while they stay in the cache.

    ``encode`` turns a list of pieces into a list of such bytes. It is called once for all new pieces of a list of texts. Texts
    that hold one of the strings ``added`` go to ``whole`` uncut.
    """

    def __init__(self, encode, whole=None, added: list[str] | None = None):
        self.encode, self.whole, self.added, self.cache = encode, whole, added or [], {}

    def ids(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not odd:
            return self._ids(texts)
        out = self._ids(["" if any(a in t for a in self.added) else t for t in texts])
        for i in odd:
            out[i] = self.whole([texts[i]])[0]
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        parts = [t.split(" ") for t in texts]
        heads = [p.pop(0) for p in parts]
        words = set().union(*parts)
        known = self.cache
        new = [w for w in words if w not in known and regular(w)]
        if len(known) + len(new) > CACHE_WORDS:  # keep what these texts use: mostly the frequent words
            known = self.cache = {w: known[w] for w in words if w in known}
        fresh = self.encode([" " + w for w in new] + heads)
        known.update(zip(new, fresh))
        out = []
        for text, own, first, head in zip(texts, parts, heads, fresh[len(new) :]):
            try:
                rest = b"".join(map(known.__getitem__, own))
            except KeyError:  # white space beside a space
                rest = None
            if rest is None or own and not regular(first):
                out.append(b"".join(self.encode(pieces(text))))
            else:
                out.append(head + rest)
        for word in new:  # long ones would fill the memory
            if len(word) > CACHE_CHARS:
                del known[word]
        return out


def runs(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Neighbouring items in groups of about ``most`` in size."""
    out, low, size = [], 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            out.append((low, i))
            low, size = i, 0
        size += n
    return [*out, (low, len(sizes))] if sizes else []
