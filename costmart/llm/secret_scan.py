"""Secrets by a character convolutional network over every candidate.

Candidates are all runs of ``MIN_RUN`` or more characters a token or password
can be made of: ASCII letters, digits and ``+/_=.!@#$%^&*?~-`` (quotes, brackets,
colons, commas and the like end a run). The network reads the candidate whole, in overlapping windows of fixed
width with the characters around it: embedding (separate for characters of
the candidate and of its surroundings), one convolution, ReLU, maximum and
mean over places, one logistic unit. It is plain numpy.

Training: findings are labelled by the fixed formats (a candidate that touches
a base span, of an assignment its value, is a secret, any other is not). A
third of the texts is held back. Adam starts on a bounded sample of the others
(``sample`` candidates of each class, those with the lowest hash) and goes on
over every candidate that is not held back: each of ``rounds`` steps takes one
share of the texts, whose gradients Spark's tasks add up, both classes of the
corpus weighing the same. Equal places of windows are worked out once for each
block of text, and their maxima and sums are taken range by range, not window by
window. On every held-back candidate the output is then
calibrated (Platt scaling) and the threshold chosen, the highest multiple of
1/STEPS (before scaling) that still finds ``recall`` of the secrets; outputs
reach the driver as counts by such multiples. Only the sample does not grow
with the corpus; copies count as often as they occur, but once in the sample.
The texts are read ``rounds`` + 3 times. Candidates above the threshold that no
base span touches become spans of kind ``cnn``; base spans stay.

Cases: a null text counts as empty; if there is no finding of either class
nothing is trained and the base spans are the result; if one side of the split
by text lacks a class, the third with the highest window hashes is held back; rows that repeat get
equal spans; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, id_and_text, map_rows, slices, stored
from .minmax import GOLD, mix
from .spans import ASSIGN, SECRET, find, sha256, written

NAMES = [*SECRET, "cnn"]
MIN_RUN = 6  # as the base rule for assignments
RUN = re.compile(r"[A-Za-z0-9+/_=.!@#$%^&*?~-]")
IN_RUN = np.array([c < 128 and RUN.match(chr(c)) is not None for c in range(129)])  # by code point, 128 for all others
LEFT, BODY, RIGHT = 20, 48, 8
STRIDE = 40
WIDTH = LEFT + BODY + RIGHT
EMBED, KERNEL, FILTERS = 8, 5, 24
PLACES = WIDTH - KERNEL + 1
LEAD = LEFT + 1 - KERNEL  # places before those that touch the candidate
STEPS = 256
ALONE = 500_000  # distinct candidates a task counts before it works them out
SAMPLED = "label int, n long, at long, held boolean, codes binary"
CODES = 256  # 1..127 surroundings, 129..255 the candidate, 0 and 128 anything beyond ASCII or the text


#: The marks of a first window's candidate, by its length.
MARKS = ((np.arange(WIDTH) >= LEFT) & (np.arange(WIDTH) < LEFT + np.arange(WIDTH - LEFT + 1)[:, None])).astype(np.uint8) << 7


def encode(text: str, start: int, end: int) -> list[bytes]:
    """Windows of WIDTH codes: together they hold the whole candidate."""
    out = []
    for at in range(start, max(start + 1, end - (BODY - STRIDE)), STRIDE):
        a, b = at - LEFT, at + BODY + RIGHT
        piece = text[max(0, a):b].encode("ascii", "replace")
        row = np.zeros(WIDTH, np.uint8)
        codes = np.frombuffer(piece, np.uint8)
        row[max(0, -a):max(0, -a) + len(codes)] = codes
        inside = slice(max(0, start - a), min(WIDTH, end - a))
        row[inside] |= 128
        out.append(row.tobytes())
    return out


def first_windows(text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``encode(text, start, end)[0]`` of all candidates, one in each row."""
    padded = np.frombuffer(bytes(LEFT) + text.encode("ascii", "replace") + bytes(WIDTH), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[start] | MARKS[np.minimum(end - start, WIDTH - LEFT)]


def window_hash(codes: np.ndarray) -> np.ndarray:
    """A 63-bit hash of each row of windows."""
    rows = np.zeros((len(codes), -(-WIDTH // 8) * 8), np.uint8)
    rows[:, :WIDTH] = codes
    out = np.full(len(codes), WIDTH, np.uint64)
    for word in rows.view(np.uint64).T:
        out = mix(out * GOLD + word)
    return (out >> np.uint64(1)).astype(np.int64)


def values(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, those of assignments without what stands before the value."""
    return [(ASSIGN.match(text, a).start(1) if NAMES[k] == "assign" else a, k, b) for a, k, b in base]


def candidates(text: str, base: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``MIN_RUN`` or more candidate characters, and whether a base span touches each."""
    inside = IN_RUN[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        turns = np.concatenate([[0], turns])
    if len(inside) and inside[-1]:
        turns = np.concatenate([turns, [len(inside)]])
    start, end = turns[::2], turns[1::2]
    long_ = end - start >= MIN_RUN
    start, end = start[long_], end[long_]
    if not base:
        return start, end, np.zeros(len(start), bool)
    spans = np.array(sorted((a, b) for a, _, b in base), np.int64)
    reach = np.concatenate([[-1], np.maximum.accumulate(spans[:, 1])])
    return start, end, reach[np.searchsorted(spans[:, 0], end, "left")] > start


@dataclass
class Network:
    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    precision: float = 1.0

    @staticmethod
    def fresh(seed: int) -> Network:
        r = np.random.default_rng(seed)
        n = lambda *shape, by: (r.standard_normal(shape) * by).astype(np.float32)
        return Network(n(CODES, EMBED, by=0.5), n(KERNEL * EMBED, FILTERS, by=(KERNEL * EMBED) ** -0.5), np.zeros(FILTERS, np.float32),
                       np.concatenate([n(2 * FILTERS, by=0.1), np.zeros(1, np.float32)]))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.kernel, self.bias, self.out]

    def forward(self, codes: np.ndarray) -> tuple:
        places = WIDTH - KERNEL + 1
        x = np.lib.stride_tricks.sliding_window_view(self.embedding[codes], KERNEL, axis=1)  # n, places, EMBED, KERNEL
        x = x.transpose(0, 1, 3, 2).reshape(len(codes) * places, KERNEL * EMBED)
        h = np.maximum((x @ self.kernel + self.bias).reshape(len(codes), places, FILTERS), 0)
        top = h.argmax(1)
        pooled = np.concatenate([h.max(1), h.mean(1), np.ones((len(codes), 1), np.float32)], 1)
        return x, h, top, pooled, pooled @ self.out

    def gradients(self, codes: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        x, h, top, pooled, z = self.forward(codes)
        n, places = h.shape[:2]
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
        g_out = pooled.T @ d
        dh = np.repeat((d[:, None] * self.out[None, FILTERS:2 * FILTERS] / places)[:, None, :], places, axis=1)
        dh[np.arange(n)[:, None], top, np.arange(FILTERS)[None, :]] += d[:, None] * self.out[None, :FILTERS]
        dh = (dh * (h > 0)).reshape(n * places, FILTERS)
        dx = (dh @ self.kernel.T).reshape(n, places, KERNEL, EMBED)
        g_embedding = np.zeros_like(self.embedding)
        for k in range(KERNEL):
            flat = codes[:, k:k + places].reshape(-1)
            for e in range(EMBED):
                g_embedding[:, e] += np.bincount(flat, dx[:, :, k, e].reshape(-1), CODES).astype(np.float32)
        return [g_embedding, x.T @ dh, dh.sum(0), g_out]

    def over(self, codes: np.ndarray, windows: Windows, packed: bool = False) -> tuple:
        """``forward`` of windows given by their ``places``; with ``packed`` also the rows of the maxima."""
        x = self.embedding[codes].reshape(len(codes), KERNEL * EMBED)
        h = x @ self.kernel
        h += self.bias
        np.maximum(h, 0, out=h)
        each = h @ self.out[FILTERS:2 * FILTERS]
        if packed:  # a number above zero is in the order of its bits; the row goes below them
            h += 0  # no -0
            top = windows.maxima(h.view(np.int32).astype(np.int64) << 32 | np.arange(len(h))[:, None])
            most, top = (top >> 32).astype(np.int32).view(np.float32), top & 0xFFFFFFFF
        else:
            most, top = windows.maxima(h), None
        return x, h, top, most @ self.out[:FILTERS] + windows.sums(each) / PLACES + self.out[-1]

    def sums(self, codes: np.ndarray, windows: Windows, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """``gradients`` of windows given by their ``places``, each times its weight, added up."""
        x, h, top, z = self.over(codes, windows, packed=True)
        d = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        tops = np.bincount((top * FILTERS + np.arange(FILTERS)).reshape(-1), np.repeat(d, FILTERS), h.size).astype(np.float32).reshape(h.shape)
        mean = (windows.spread(d, len(h)) / PLACES).astype(np.float32)
        g_out = np.concatenate([np.einsum("rf,rf->f", tops, h), mean @ h, [d.sum()]])
        tops *= self.out[:FILTERS]
        tops += mean[:, None] * self.out[FILTERS:2 * FILTERS]
        tops *= h > 0
        dx = (self.kernel @ tops.T).reshape(KERNEL, EMBED, len(h))
        g_embedding = np.stack([sum(np.bincount(codes[:, k], dx[k, e], CODES) for k in range(KERNEL)) for e in range(EMBED)], axis=1)
        return [g_embedding, x.T @ tops, np.ones(len(h), np.float32) @ tops, g_out]

    def raw(self, codes: np.ndarray, block: int = 512) -> np.ndarray:
        return np.concatenate([self.forward(codes[i:i + block])[-1] for i in range(0, len(codes), block)] or [np.zeros(0, np.float32)])

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(codes))

    def in_place(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 4096) -> np.ndarray:
        """``raw`` of the first windows of sorted, disjoint candidates of up to
        BODY characters in ``text`` (codes, with LEFT zeros before and WIDTH
        zeros after each text). The convolution over surroundings is the same
        for all windows they are in, so it is worked out once."""
        tables = np.einsum("ce,kef->kcf", self.embedding, self.kernel.reshape(KERNEL, EMBED, FILTERS))
        tables[0] += self.bias
        half = CODES // 2
        two = [(tables[k][:half, None] + tables[k + 1][None, :half]).reshape(half * half, FILTERS) for k in (0, 2)]
        whole = [(tables[k][:, None] + tables[k + 1][None]).reshape(CODES * CODES, FILTERS) for k in (0, 2)]
        to_top, to_mean = self.out[:FILTERS], self.out[FILTERS:2 * FILTERS]
        z = np.zeros(len(start), np.float32)
        for at in range(0, len(text), block):
            i, j = np.searchsorted(start, (at, at + block))
            if i == j:
                continue
            low = max(0, at - LEFT)
            piece = text[low:at + block + WIDTH].astype(np.int64)
            h = np.take(two[0], piece[:-4] * half + piece[1:-3], axis=0)
            h += np.take(two[1], piece[2:-2] * half + piece[3:-1], axis=0)
            h += np.take(tables[4], piece[4:], axis=0)
            np.maximum(h, 0, out=h)
            sums = np.concatenate([[0.0], np.cumsum(h @ to_mean, dtype=float)])
            tops = [h]  # tops[n]: the maximum over 2^n places
            while 2 << len(tops) - 1 <= PLACES - LEFT:
                n = 1 << len(tops) - 1
                tops.append(np.maximum(tops[-1][:-n], tops[-1][n:]))
            a, b = start[i:j] - low, end[i:j] - low
            first, last = a - LEFT, a - LEFT + PLACES
            # places before the candidate, LEFT + 1 - KERNEL = 16 of them, and places after it
            top, total = np.take(tops[4], first, axis=0), sums[a + 1 - KERNEL] - sums[first] + sums[last] - sums[b]
            level = np.log2(last - b).astype(np.int64)
            for n in np.unique(level).tolist():
                rows = np.flatnonzero(level == n)
                top[rows] = np.maximum(top[rows], np.maximum(np.take(tops[n], b[rows], axis=0), np.take(tops[n], last[rows] - (1 << n), axis=0)))
            # places that touch the candidate, over its characters and KERNEL - 1 on either side, its own marked
            sizes = b - a + 2 * (KERNEL - 1)
            heads = np.cumsum(sizes) - sizes
            place = np.arange(sizes.sum()) + np.repeat(a + 1 - KERNEL - heads, sizes)
            marked = piece[place] | ((place >= np.repeat(a, sizes)) & (place < np.repeat(b, sizes))).astype(np.int64) * half
            pairs = marked[:-1] * CODES + marked[1:]
            sizes, heads = sizes + 1 - KERNEL, heads - (KERNEL - 1) * np.arange(len(sizes))
            at_ = np.arange(sizes.sum()) + np.repeat((KERNEL - 1) * np.arange(len(sizes)), sizes)
            own = np.take(whole[0], pairs[at_], axis=0)
            own += np.take(whole[1], pairs[at_ + 2], axis=0)
            own += np.take(tables[4], marked[at_ + 4], axis=0)
            np.maximum(own, 0, out=own)
            np.maximum(top, range_maxima(own, heads, heads + sizes), out=top)
            total = total + np.add.reduceat((own @ to_mean).astype(float), heads)
            z[i:j] = top @ to_top + total / PLACES + self.out[-1]
        return z


def range_maxima(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The largest of rows[first:last], by column, of every range (none is empty): the
    maximum over 2^n rows is doubled from range to range, and two of them cover each."""
    out = np.empty((len(first), rows.shape[1]), rows.dtype)
    level = np.log2(last - first).astype(np.int64)
    for n in range(int(level.max(initial=0)) + 1):
        if n:
            rows = np.maximum(rows[:-(1 << n - 1)], rows[1 << n - 1:])
        of = np.flatnonzero(level == n)
        out[of] = np.maximum(np.take(rows, first[of], axis=0), np.take(rows, last[of] - (1 << n), axis=0))
    return out


@dataclass
class Windows:
    """The places of windows, as rows of the distinct ones. A window has LEAD places of the text
    from ``before`` on, its candidate's own (``sizes``, one after another) and ``rest`` more of the text from ``after`` on."""

    text: np.ndarray
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    sizes: np.ndarray

    def __post_init__(self) -> None:
        self.heads, self.rest = np.cumsum(self.sizes) - self.sizes, PLACES - LEAD - self.sizes

    def maxima(self, values: np.ndarray, block: int = 4096) -> np.ndarray:
        """The largest value of each window's places, by column. Over the text, the maximum over 2^n places is
        doubled from range to range, and two of them cover what a window has there."""
        out = np.empty((len(self.before), values.shape[1]), values.dtype)
        stop = np.maximum(self.before + LEAD, self.after + self.rest)
        level = np.log2(np.maximum(self.rest, 1)).astype(np.int64)
        edges = np.flatnonzero(np.diff(self.before // block)) + 1
        for i, j in zip([0, *edges], [*edges, len(out)]):
            low = self.before[i]
            tops = [np.take(values, self.text[low:stop[i:j].max()], axis=0)]  # tops[n]: the maximum over 2^n places
            for n in range(max(4, level[i:j].max())):
                tops.append(np.maximum(tops[-1][:-(1 << n)], tops[-1][1 << n:]))
            top, after, rest = np.take(tops[4], self.before[i:j] - low, axis=0), self.after[i:j] - low, self.rest[i:j]
            for n in range(len(tops)):
                if len(rows := np.flatnonzero((level[i:j] == n) & (rest > 0))):
                    two = np.maximum(np.take(tops[n], after[rows], axis=0), np.take(tops[n], after[rows] + rest[rows] - (1 << n), axis=0))
                    top[rows] = np.maximum(top[rows], two)
            out[i:j] = top
        order = np.argsort(-self.sizes, kind="stable")
        for at in range(0, len(order), block):  # the longest first: those with a place more are always in front
            some = order[at:at + block]
            heads, sizes, top = self.heads[some], -self.sizes[some], out[some]
            for k in range(-sizes[0]):
                n = np.searchsorted(sizes, -k, "left")
                np.maximum(top[:n], np.take(values, self.own[heads[:n] + k], axis=0), out=top[:n])
            out[some] = top
        return out

    def sums(self, each: np.ndarray) -> np.ndarray:
        """The sum over each window's places."""
        text, own = (np.concatenate([[0.0], np.cumsum(each[rows], dtype=float)]) for rows in (self.text, self.own))
        return (text[self.before + LEAD] - text[self.before] + text[self.after + self.rest] - text[self.after]
                + own[self.heads + self.sizes] - own[self.heads])

    def spread(self, d: np.ndarray, n: int) -> np.ndarray:
        """For each of n distinct places the sum of d over the windows that hold it, as often as they do."""
        turns = np.zeros(len(self.text) + 1)
        for at, by in ((self.before, d), (self.before + LEAD, -d), (self.after, d), (self.after + self.rest, -d)):
            turns += np.bincount(at, by, len(turns))
        return np.bincount(self.text, np.cumsum(turns[:-1]), n) + np.bincount(self.own, np.repeat(d, self.sizes), n)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and the row of each key among them. One key in each slot of a
    hash table stands for all equal ones; only those that share a slot with others are sorted."""
    bits = max(8, (2 * len(keys)).bit_length())
    slot = (keys.view(np.uint64) * GOLD >> np.uint64(64 - bits)).astype(np.int64)
    table = np.zeros(1 << bits, np.int64)
    table[slot] = np.arange(len(keys))
    of = table[slot]
    others = np.flatnonzero(keys[of] != keys)
    if len(others):
        _, first, same = np.unique(keys[others], return_index=True, return_inverse=True)
        of[others] = others[first][same]
    chosen = np.zeros(len(keys), bool)
    chosen[of] = True
    return keys[chosen], (np.cumsum(chosen) - 1)[of]


def places(text: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray, after: np.ndarray, n: int | None = None) -> tuple[np.ndarray, Windows]:
    """The distinct places of the first windows of text[start:end], as their KERNEL codes, and the places
    of each window. What stands around a candidate's own places is read from ``before`` and ``after`` on, within the first ``n`` places."""
    sizes = np.minimum(end - start, PLACES - LEFT) + KERNEL - 1  # places that touch the candidate
    heads = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) + np.repeat(start + 1 - KERNEL - heads, sizes)
    first, last = np.repeat(start, sizes), np.repeat(end, sizes)
    text, n = text.astype(np.int64), len(text) + 1 - KERNEL if n is None else n
    plain, own = np.zeros(n, np.int64), np.zeros(len(place), np.int64)
    for k in range(KERNEL):
        plain = plain << 8 | text[k:k + n]
        own = own << 8 | text[place + k] | ((place + k >= first) & (place + k < last)).astype(np.int64) << 7
    keys, row = distinct(np.concatenate([plain, own]))
    codes = np.stack([keys >> 8 * (KERNEL - 1 - k) & 255 for k in range(KERNEL)], axis=1)
    return codes, Windows(row[:n], row[n:], before, after, sizes)


def blocks(text: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 19) -> Iterator[tuple[slice, np.ndarray, Windows]]:
    """Sorted candidates in a text and their ``places``, block by block of it."""
    for at in range(0, len(text), block):
        i, j = np.searchsorted(start, (at, at + block))
        if i < j:
            low = max(0, at - LEFT)
            a, b = start[i:j] - low, end[i:j] - low
            yield slice(i, j), *places(text[low:at + block + 2 * WIDTH], a, b, a - LEFT, b)


@dataclass
class Gathered:
    """Candidates in some texts, joined as ``in_place`` takes them."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    known: np.ndarray

    @staticmethod
    def of(texts: list[str], cut: tuple[int, int] | None, held: bool, alone: Counter) -> Gathered:
        """Without ``cut`` all candidates; with it, by label, those above that window hash (``held``) or up to it.
        They are counted in ``alone`` by themselves."""
        pieces, found, offset = [], [np.zeros((3, 0), np.int64)], LEFT
        for text in texts:
            start, end, known = candidates(text, values(text, find(text, SECRET)))
            if cut is not None:
                use = (window_hash(first_windows(text, start, end)) > np.where(known, cut[1], cut[0])) == held
                start, end, known = start[use], end[use], known[use]
            if not len(start):
                continue
            end = np.minimum(end, start + WIDTH - LEFT)
            alone.update(zip(map(text.__getitem__, map(slice, start.tolist(), end.tolist())), known.tolist()))
            found.append(np.stack([start + offset, end + offset, known]))
            pieces += [bytes(LEFT), text.encode("ascii", "replace"), bytes(WIDTH)]
            offset += len(text) + WIDTH + LEFT
        start, end, known = np.concatenate(found, axis=1)
        return Gathered(np.frombuffer(b"".join(pieces), np.uint8), start, end, known)

    def within(self, which: np.ndarray, block: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, Windows]]:
        """The candidates ``which`` (sorted) with their ``places``, block by block of the texts."""
        for of, *rest in blocks(self.text, self.start[which], self.end[which], block):
            yield which[of], *rest


def by_themselves(alone: Counter, block: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Windows]]:
    """Labels, numbers and ``places`` of counted candidates, with nothing around them; the counter is emptied."""
    items = sorted(alone.items(), key=lambda item: len(item[0][0]))
    alone.clear()
    for i in range(0, len(items), block):
        some = items[i:i + block]
        text = bytes(WIDTH) + b"".join(own.encode() + bytes(KERNEL - 1) for (own, _), _ in some)
        sizes = np.array([len(own) for (own, _), _ in some])
        start = WIDTH + np.cumsum(sizes + KERNEL - 1) - sizes - (KERNEL - 1)
        nothing = np.zeros(len(some), np.int64)
        yield (np.array([int(k) for (_, k), _ in some]), np.array([n for _, n in some]),
               *places(np.frombuffer(text, np.uint8), start, start + sizes, nothing, nothing, PLACES))


class Adam:
    def __init__(self, net: Network):
        self.net, self.step = net, 0
        self.m = [np.zeros_like(p) for p in net.parameters()]
        self.v = [np.zeros_like(p) for p in net.parameters()]

    def move(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, a, b in zip(self.net.parameters(), gradients, self.m, self.v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= 0.01 * (a / (1 - 0.9 ** self.step)) / (np.sqrt(b / (1 - 0.99 ** self.step)) + 1e-8)


def fit(codes: np.ndarray, y: np.ndarray, epochs: int, seed: int, batch: int = 256) -> Adam:
    """Adam on shuffled mini-batches."""
    adam, order = Adam(Network.fresh(seed)), np.random.default_rng(seed + 1)
    for _ in range(epochs):
        rows = order.permutation(len(y))
        for i in range(0, len(rows), batch):
            adam.move(adam.net.gradients(codes[rows[i:i + batch]], y[rows[i:i + batch]]))
    return adam


def calibrate(net: Network, codes: np.ndarray, y: np.ndarray, weight: np.ndarray, recall: float) -> None:
    """``settle`` by the network's outputs on windows."""
    settle(net, net.raw(codes).astype(float), y, np.ones(len(y)), weight, recall)


def settle(net: Network, z: np.ndarray, y: np.ndarray, n: np.ndarray, weight: np.ndarray, recall: float, width: float = 0.0) -> None:
    """Platt scaling by Newton's method, then the highest threshold with the recall, where
    n candidates of label y have outputs from z up to ``width`` above."""
    x, b, secrets = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0]), (n * y).sum()
    target = np.where(y > 0, (secrets + 1) / (secrets + 2), 1 / (n.sum() - secrets + 2))  # Platt's smoothed labels
    weight = weight * n
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + 1e-6 * np.eye(2), x.T @ (weight * (target - p)))
        b += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-7:
            break
    net.scale, net.shift = map(float, b)
    p = net.calibrated((z + (width if net.scale < 0 else 0)).astype(np.float32))
    found = np.flatnonzero(y > 0)
    found = found[np.argsort(p[found])]
    net.threshold = float(p[found[np.searchsorted(np.cumsum(n[found]), np.floor((1 - recall) * secrets), "right")]])
    above = p >= net.threshold
    net.precision = float((weight * y)[above].sum() / weight[above].sum())


def train(texts: DataFrame, sample: int = 4000, epochs: int = 6, recall: float = 0.98, seed: int = 5, rounds: int = 8) -> Network | None:
    schema = _arrow_schema(SAMPLED)
    texts = texts.select("text", F.xxhash64("text").alias("key"))

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, limit = [0, 0], [(1 << 63) - 1] * 2
        held: list[dict[int, tuple[bool, bytes]]] = [{}, {}]
        for batch in batches:
            for part in slices(batch, 4_000_000):
                for text, key in zip(part.column("text").to_pylist(), part.column("key").to_pylist()):
                    start, end, known = candidates(text, values(text, find(text, SECRET)))
                    if not len(start):
                        continue
                    codes = first_windows(text, start, end)
                    at = window_hash(codes)
                    counts[1] += int(known.sum())
                    counts[0] += len(known) - int(known.sum())
                    near = np.flatnonzero(at <= np.where(known, limit[1], limit[0]))
                    for i in near.tolist():
                        k, h, window = int(known[i]), int(at[i]), codes[i].tobytes()
                        held[k][h] = min(held[k].get(h, (True, window)), (key % 3 == 0, window))
                        if len(held[k]) > 2 * sample:
                            held[k] = dict(sorted(held[k].items())[:sample])
                            limit[k] = max(held[k])
        rows = [(k, n, None, None, None) for k, n in enumerate(counts) if n]
        rows += [(k, 0, at, *of) for k in (0, 1) for at, of in sorted(held[k].items())[:sample]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else
                                         [pa.array([], f.type) for f in schema], schema=schema)

    # equal windows (copies) count once; at most ``sample`` of each class come to the driver
    rows = stored(texts.mapInArrow(lowest, SAMPLED), "secret-windows")
    counts = {r["label"]: r["n"] for r in rows.where("at is null").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if len(counts) < 2:
        return None
    picked = [rows.where((F.col("label") == k) & F.col("at").isNotNull()).groupBy("at")
              .agg(F.min("held").alias("held"), F.min("codes").alias("codes")).orderBy("at").limit(sample).collect() for k in (0, 1)]
    codes = np.frombuffer(b"".join(bytes(r["codes"]) for rs in picked for r in rs), np.uint8).reshape(-1, WIDTH)
    y = np.repeat([0.0, 1.0], [len(p) for p in picked]).astype(np.float32)
    held, cut = np.array([r["held"] for rs in picked for r in rs]), None
    if min(y[held].sum(), y[~held].sum(), (1 - y[held]).sum(), (1 - y[~held]).sum()) < 1:
        if min(map(len, picked)) < 2:
            return None
        cut = tuple(p[-((len(p) + 2) // 3) - 1]["at"] if len(p) < sample else max((1 << 63) // 3 * 2, p[0]["at"]) for p in picked)
        held = np.array([r["at"] > cut[k] for k, p in enumerate(picked) for r in p])
    # every window once more without its surroundings, so that the candidate's own characters must tell too
    codes, y, held = np.concatenate([codes, np.where(codes >= 128, codes, 0)]), np.tile(y, 2), np.tile(held, 2)
    adam = fit(codes[~held], y[~held], epochs, seed)
    by_text = F.pmod("key", F.lit(3)) == 0
    weight = 0.375 * rounds / np.array([counts[0], counts[1]])  # of both kinds of windows of two thirds of the texts, so that both classes add up to a half
    for i in range(rounds):
        part = texts.where(F.pmod(F.shiftright("key", 20), F.lit(rounds)) == i)
        adam.move(gradient(adam.net, part if cut else part.where(~by_text), cut, weight))
    outputs = output_counts(adam.net, texts if cut else texts.where(by_text), cut)
    if len(set(outputs[1])) < 2:
        return None
    settle(adam.net, *outputs, recall, 1 / STEPS)
    return adam.net


def gradient(net: Network, texts: DataFrame, cut: tuple[int, int] | None, weight: np.ndarray) -> list[np.ndarray]:
    """Over all candidates that are not held back, with and without their surroundings, in units of 2^-40."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, alone = np.zeros(sum(p.size for p in net.parameters())), Counter()

        def add(codes: np.ndarray, windows: Windows, known: np.ndarray, n: np.ndarray | int) -> None:
            total[:] += np.concatenate([g.reshape(-1) for g in net.sums(codes, windows, known, n * weight[known])])

        for part in (p for batch in batches for p in slices(batch, 4_000_000)):
            of = Gathered.of(part.column("text").to_pylist(), cut, False, alone)
            for some, codes, windows in of.within(np.arange(len(of.start))):
                add(codes, windows, of.known[some], 1)
            if len(alone) > ALONE:
                for known, n, codes, windows in by_themselves(alone):
                    add(codes, windows, known, n)
        for known, n, codes, windows in by_themselves(alone):
            add(codes, windows, known, n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(np.rint(total * 2.0 ** 40).astype(np.int64))], names=["i", "g"])

    total = np.zeros(sum(p.size for p in net.parameters()))
    for r in texts.select("text").mapInArrow(add_up, "i int, g long").groupBy("i").agg(F.sum("g").alias("g")).collect():
        total[r["i"]] = r["g"] / 2.0 ** 40
    ends = np.cumsum([p.size for p in net.parameters()])
    return [g.reshape(p.shape).astype(np.float32) for g, p in zip(np.split(total, ends[:-1]), net.parameters())]


def output_counts(net: Network, texts: DataFrame, cut: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Outputs of all held-back candidates, rounded down to 1/STEPS: output, label, number and weight of each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, alone = Counter(), Counter()

        def add(z: np.ndarray, known: np.ndarray, n: np.ndarray) -> None:
            at, of = np.unique(np.floor(z.astype(float) * STEPS).astype(np.int64) * 2 + known, return_inverse=True)
            found.update(dict(zip(at.tolist(), np.bincount(of, n).astype(np.int64).tolist())))

        for part in (p for batch in batches for p in slices(batch, 4_000_000)):
            of = Gathered.of(part.column("text").to_pylist(), cut, True, alone)
            one, short = np.ones(len(of.start)), of.end - of.start <= BODY
            if short.any():
                add(net.in_place(of.text, of.start[short], of.end[short]), of.known[short], one[short])
            for some, codes, windows in of.within(np.flatnonzero(~short)):
                add(net.over(codes, windows)[-1], of.known[some], one[some])
            if len(alone) > ALONE:
                for known, n, codes, windows in by_themselves(alone):
                    add(net.over(codes, windows)[-1], known, n)
        for known, n, codes, windows in by_themselves(alone):
            add(net.over(codes, windows)[-1], known, n)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["at", "n"])

    got = texts.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").collect()
    at, n = np.array([r["at"] for r in got]), np.array([r["n"] for r in got], float)
    return (at >> 1) / STEPS, (at & 1).astype(float), n, np.full(len(n), 1 / n.mean())


def scan(docs: DataFrame, sample: int = 4000, epochs: int = 6, recall: float = 0.98, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_found) per row."""
    texts = id_and_text(docs, id_col, text_col)
    held = texts.sparkSession.sparkContext.broadcast(train(texts, sample, epochs, recall))

    def judge(cols: dict) -> dict:
        net: Network | None = held.value
        out: dict[str, list] = {"doc_id": cols["doc_id"], "base_sha256": [], "spans": [], "n_found": []} | {f"n_{k}": [] for k in SECRET}
        bases, short, long_, codes, pieces, offset = [], [], [], [], [], LEFT
        for i, text in enumerate(cols["text"]):
            bases.append(base := find(text, SECRET))
            if net is not None:
                a, b, known = candidates(text, base)
                fits = ~known & (b - a <= BODY)
                short.append(np.stack([np.full(int(fits.sum()), i), a[fits], b[fits], np.full(int(fits.sum()), offset)]))
                for j in np.flatnonzero(~known & ~fits).tolist():
                    codes += (windows := encode(text, int(a[j]), int(b[j])))
                    long_ += [(i, int(a[j]), int(b[j]))] * len(windows)
                pieces += [bytes(LEFT), text.encode("ascii", "replace"), bytes(WIDTH)]
                offset += len(text) + WIDTH + LEFT
        found: dict[int, set] = {}
        if short:
            of, a, b, shift = np.concatenate(short, axis=1)
            p = net.calibrated(net.in_place(np.frombuffer(b"".join(pieces), np.uint8), a + shift, b + shift))
            for j in np.flatnonzero(p >= net.threshold).tolist():
                found.setdefault(int(of[j]), set()).add((int(a[j]), len(SECRET), int(b[j])))
        if codes:
            p = net.probability(np.frombuffer(b"".join(codes), np.uint8).reshape(-1, WIDTH))
            for j in np.flatnonzero(p >= net.threshold).tolist():
                i, a, b = long_[j]
                found.setdefault(i, set()).add((a, len(SECRET), b))
        for i, base in enumerate(bases):
            for k, name in enumerate(SECRET):
                out[f"n_{name}"].append(sum(x == k for _, x, _ in base))
            out["base_sha256"].append(sha256(written(base, NAMES)))
            out["spans"].append(written([*base, *found.get(i, ())], NAMES))
            out["n_found"].append(len(found.get(i, ())))
        return out

    return map_rows(texts, judge, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_found long")
