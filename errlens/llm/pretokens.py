"""Pre-tokens of many texts at once, without a Python object per token.

Texts are laid end to end as code points with a separator after each one.
Character classes come from one table, token starts from the borders of
class runs, and each token gets a 64-bit hash from a prefix sum of mixed
code points, so equal tokens are found by sorting integers and only the
distinct ones become strings.  The hash is linear, so there are words that
share it: every token is compared with the one that stands for its hash, and
those that differ become tokens of their own.

Two splitters are given, for the two public vocabularies in use:

* ``byte_level_starts``: contractions, then letters, digits or other signs
  with one leading blank, then white space, whose last character is left
  to the next token;
* ``word_level_starts``: contractions, letters, single digits, other signs;
  white space is dropped.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

LETTER, DIGIT, OTHER, SPACE, BREAK = range(5)
SEPARATOR = 0x110000      # after each text; no real code point
SPECIAL = 0x110001        # + k: the k-th special token
N_SPECIAL = 8
_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD1342543DE82EF95           # odd, so that it has an inverse modulo 2**64


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point."""
    table = np.full(SPECIAL + N_SPECIAL, OTHER, np.uint8)
    table[SEPARATOR:] = BREAK
    low = "".join(map(chr, range(0xD800)))
    high = "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for base, chars in ((0, low), (0xE000, high)):
            for m in regex.finditer(pattern, chars):
                table[base + m.start():base + m.end()] = kind
    return table


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_KEPT_POWERS = 1 << 18


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, at least ``n`` of them (short tables are kept between calls)."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    tables = []
    for base in (_STEP, pow(_STEP, -1, 1 << 64)):
        t = np.full(max(n, _KEPT_POWERS), base, np.uint64)
        t[0] = 1
        tables.append(np.multiply.accumulate(t))
    _powers[:] = [t[:_KEPT_POWERS].copy() for t in tables]
    return tables[0][:n], tables[1][:n]


def code_points(texts: list[str], specials: tuple[str, ...] = (), normal=None) -> np.ndarray:
    """All texts as code points, each followed by SEPARATOR; special strings as one point each.

    ``normal`` is applied to what lies between special strings.
    """
    if specials and any(s in t for t in texts for s in specials):
        return np.concatenate([np.r_[_with_specials(t, specials, normal), np.uint32(SEPARATOR)] for t in texts]).astype(np.uint32)
    if normal:
        texts = [normal(t) for t in texts]
    # a private NUL after each text, turned into the separator by position
    cps = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32).copy()
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    cps[ends] = SEPARATOR
    return cps


def _with_specials(text: str, specials: tuple[str, ...], normal) -> np.ndarray:
    parts = []
    for piece in regex.split("(" + "|".join(map(regex.escape, specials)) + ")", text):
        if piece in specials:
            parts.append(np.array([SPECIAL + specials.index(piece)], np.uint32))
        elif piece:
            parts.append(np.frombuffer((normal(piece) if normal else piece).encode("utf-32-le"), np.uint32))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _runs(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.r_[0, np.flatnonzero(cls[1:] != cls[:-1]) + 1]
    return first, np.r_[first[1:], len(cls)]


def _contractions(cps: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the apostrophes ``at`` that open 's 't 'm 'd 're 've 'll, and where those end."""
    at = at[at + 1 < len(cps)]
    a = cps[at + 1]
    b = cps[np.minimum(at + 2, len(cps) - 1)]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    hit = one | two
    return at[hit], at[hit] + np.where(two[hit], 3, 2)


def byte_level_starts(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the tokens, and which of them are kept (separators are not)."""
    cls = classes()[cps]
    first, end = _runs(cls)
    kind = cls[first]
    after_blank = (first > 0) & (cps[np.maximum(first - 1, 0)] == 0x20)
    start = np.zeros(len(cps), bool)
    start[cls == BREAK] = True
    solid = (kind != SPACE) & (kind != BREAK)
    start[first[solid & ~after_blank]] = True
    blank = kind == SPACE
    start[first[blank]] = True
    inner = blank & (end < len(cps))
    inner[inner] = cls[end[inner]] != BREAK
    start[end[inner] - 1] = True
    quote, stop = _contractions(cps, first[(kind == OTHER) & ~after_blank & (end - first == 1) & (cps[first] == 0x27)])
    start[quote + 1] = False
    start[stop[stop < len(cps)]] = True
    at = np.flatnonzero(start)
    return at, cps[at] != SEPARATOR


def word_level_starts(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cls = classes()[cps]
    first, end = _runs(cls)
    kind = cls[first]
    start = (cls == BREAK) | (cls == DIGIT)
    start[first] = True
    quote, stop = _contractions(cps, first[(kind == OTHER) & (end - first == 1) & (cps[first] == 0x27)])
    start[quote + 1] = False
    start[stop[stop < len(cps)]] = True
    at = np.flatnonzero(start)
    return at, (cls[at] != SPACE) & (cps[at] != SEPARATOR)


def hashes(cps: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each [start, end) (position-independent polynomial over mixed code points)."""
    up, down = _power_tables(len(cps) + 1)
    m = cps.astype(np.uint64) + np.uint64(1)
    m *= _MULT
    m ^= m >> np.uint64(29)
    m *= np.uint64(0xBF58476D1CE4E5B9)
    m ^= m >> np.uint64(32)
    m *= up[:len(cps)]
    total = np.empty(len(cps) + 1, np.uint64)
    total[0] = 0
    np.cumsum(m, out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return h ^ (h >> np.uint64(31))


_MASKS = np.array([0, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFF, 0xFFFFFFFFFFFFFFFF], np.uint64)


class Points:
    """Code points as two arrays of 16-bit halves, compared four at a time."""

    def __init__(self, cps: np.ndarray, astral: bool):
        pad = np.zeros(3, np.uint16)
        self.low = np.r_[cps.astype(np.uint16), pad]
        self.high = np.r_[(cps >> 16).astype(np.uint16), pad] if astral else None     # None: all zero

    def add(self, other: Points, cell: np.ndarray) -> int:
        """Append the points ``cell`` of ``other``; the number of points before."""
        n = len(self.low) - 3
        pad = np.zeros(3, np.uint16)
        if other.high is not None and self.high is None:
            self.high = np.zeros(len(self.low), np.uint16)
        self.low = np.concatenate([self.low[:n], other.low[cell], pad])
        if self.high is not None:
            more = other.high[cell] if other.high is not None else np.zeros(len(cell), np.uint16)
            self.high = np.concatenate([self.high[:n], more, pad])
        return n


def _four(half: np.ndarray | None, at: np.ndarray) -> np.ndarray | int:
    """The 64 bits that begin at each place."""
    return np.uint64(0) if half is None else np.ndarray(len(half) - 3, "<u8", half, strides=(2,))[at]


def differ(x: Points, a: np.ndarray, y: Points, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` points of ``x`` from ``a`` and those of ``y`` from ``b`` differ."""
    out = np.zeros(len(a), bool)
    for of_x, of_y in ((x.low, y.low), (x.high, y.high)):
        if of_x is None and of_y is None:
            continue
        at, done = np.arange(len(a)), 0
        while len(at) and done < 64:
            mask = _MASKS[np.minimum(size[at] - done, 4)]
            out[at[((_four(of_x, a[at] + done) ^ _four(of_y, b[at] + done)) & mask) != 0]] = True
            done += 4
            at = at[size[at] > done]
        for k in np.flatnonzero((size > 64) & ~out).tolist():
            n = int(size[k])
            u, v = (0 if h is None else h[s:s + n] for h, s in ((of_x, a[k]), (of_y, b[k])))
            out[k] = bool(np.any(u != v))
    return out


class Tokens:
    """The pre-tokens of a batch: ``word`` (index into the distinct ones) and ``text`` of each token.

    ``first`` and ``stop`` are the bounds of each distinct token, ``hash`` its
    hash, which it may share with others.
    """

    def __init__(self, texts: list[str], starts, specials: tuple[str, ...] = (), normal=None):
        self.cps = cps = code_points(texts, specials, normal)
        at, keep = starts(cps)
        stop = np.r_[at[1:], len(cps)]
        breaks = np.cumsum(cps[at] == SEPARATOR)
        at, stop, self.text = at[keep], stop[keep], breaks[keep]
        self.hash, first, self.word = np.unique(hashes(cps, at, stop), return_index=True, return_inverse=True)
        self.first, self.stop = at[first], stop[first]
        # more than 16 bits in anything but separators
        self.points = Points(cps, np.count_nonzero(cps >= 0x10000) > np.count_nonzero(cps == SEPARATOR))
        self._part(at, stop)

    def _part(self, at: np.ndarray, stop: np.ndarray) -> None:
        """Give tokens that only share the hash of another one an index of their own."""
        size = stop - at
        first = self.first[self.word]
        wrong = size != (self.stop - self.first)[self.word]
        same = np.flatnonzero(~wrong & (first != at))
        wrong[same[differ(self.points, at[same], self.points, first[same], size[same])]] = True
        if not wrong.any():
            return
        known: dict[bytes, int] = {}
        first, end, own = self.first.tolist(), self.stop.tolist(), self.hash.tolist()
        for k in np.flatnonzero(wrong).tolist():
            a, b = int(at[k]), int(stop[k])
            index = known.setdefault(self.cps[a:b].tobytes(), len(first))
            if index == len(first):
                first.append(a)
                end.append(b)
                own.append(own[int(self.word[k])])
            self.word[k] = index
        self.first, self.stop, self.hash = np.array(first), np.array(end), np.array(own, np.uint64)

    def __len__(self) -> int:
        """Number of distinct tokens."""
        return len(self.first)

    def strings(self, which: np.ndarray) -> list[str]:
        """The distinct tokens ``which`` as strings; a special token is one private character."""
        whole = self.cps
        start, stop = self.first[which], self.stop[which]
        size = stop - start
        cell = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        points = whole[cell]
        points[points >= SPECIAL] = 0
        joined = points.tobytes().decode("utf-32-le")
        ends = np.cumsum(size).tolist()
        return [joined[e - k:e] for e, k in zip(ends, size.tolist())]


class Known:
    """Distinct tokens seen so far, numbered from zero in the order in which they came.

    A token is found by its hash and then compared with the one that has it;
    those that share the hash of another one are found by their points.
    """

    def __init__(self) -> None:
        self.hash, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)        # sorted by hash
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.points = Points(np.empty(0, np.uint32), False)
        self.odd: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.start)

    @property
    def chars(self) -> int:
        return len(self.points.low)

    def numbers(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The number of each distinct token of a batch, and which of them are new (numbered upwards in that order)."""
        n = len(tokens)
        size = tokens.stop - tokens.first
        place = np.searchsorted(self.hash, tokens.hash)
        number = np.full(n, -1, np.int64)
        near = np.flatnonzero(place < len(self.hash))
        near = near[self.hash[place[near]] == tokens.hash[near]]
        who = self.at[place[near]]
        same = size[near] == self.size[who]
        same[same] = ~differ(tokens.points, tokens.first[near[same]], self.points, self.start[who[same]], size[near[same]])
        number[near[same]] = who[same]
        taken = np.zeros(n, bool)
        taken[near[~same]] = True
        # of tokens that share a hash within the batch the first may stand for it
        first = np.zeros(n, bool)
        first[np.unique(tokens.hash, return_index=True)[1]] = True
        odd = np.flatnonzero((number < 0) & (taken | ~first))
        for k in odd.tolist():
            number[k] = self.odd.get(tokens.cps[tokens.first[k]:tokens.stop[k]].tobytes(), -1)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = len(self) + np.arange(len(new))
            length = size[new]
            begin = np.cumsum(length) - length
            cell = np.repeat(tokens.first[new] - begin, length) + np.arange(int(length.sum()))
            base = self.points.add(tokens.points, cell)
            self.start, self.size = np.r_[self.start, base + begin], np.r_[self.size, length]
            plain = new[~np.isin(new, odd)]
            order = np.argsort(tokens.hash[plain], kind="stable")
            to = place[plain][order]
            self.hash = np.insert(self.hash, to, tokens.hash[plain][order])
            self.at = np.insert(self.at, to, number[plain][order])
            for k in odd[np.isin(odd, new)].tolist():
                self.odd[tokens.cps[tokens.first[k]:tokens.stop[k]].tobytes()] = int(number[k])
        return number, new
