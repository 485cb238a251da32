"""Periodic runs of words, found by online dyadic square catching.

Words are appended in order. As soon as an aligned block of B words is
complete (B a power of two), a catcher holds its fingerprint. Each further
word compares the suffix of B words that ends with it to the one or two
blocks of that size that lie a period of this level behind. A stretch of words
that equal the words q before them is at least as long as two blocks of the
level of q, so it holds an aligned one and no run is missed. What is caught
is extended to both sides; q equal words are a square, the squares of one
stretch are one run.

Fingerprints are polynomials modulo a prime, so suffixes of any length come
from one running sum and memory is linear in the text. All that is caught is
compared word by word at the end; after a collision the text is searched anew
with another base, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from dockline.llm import common

PRIME = (1 << 31) - 1
BASES = (1_234_567_891, 987_654_323, 1_618_033_989, 1_414_213_573)

# A run has this many words at least, and this many times its period.
LEAST_WORDS = 24
LEAST_EXPONENT = 3

FIELDS = [
    common.field("n_runs", "bigint"),
    *(common.field(c, "bigint") for c in ("start", "length", "period")),
    *(common.field(c, "array<bigint>") for c in ("run_starts", "run_lengths", "run_periods")),
    common.field("collapsed", "string"),
]

Run = tuple[int, int, int]


class Collision(Exception):
    """Two different stretches of words have one fingerprint."""


class Powers:
    """Powers of a base and of its inverse modulo PRIME, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, dtype=np.int64)

    def reserve(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * pow(self.base, size, PRIME) % PRIME])
            self.down = np.concatenate([self.down, self.down * pow(self.inverse, size, PRIME) % PRIME])


class Catchers:
    """The catchers of one text, fed with word codes in any portions.

    `most` bounds the words that will come, if known; periods that cannot be
    repeated often enough in so many words are then not looked for.
    """

    def __init__(self, powers: Powers, words: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT, most: int | None = None):
        if exponent < 2:
            raise ValueError("a run is a square at least")
        self.powers, self.words, self.exponent, self.most = powers, words, exponent, most
        self.codes = np.zeros(0, dtype=np.int64)
        self.sums = np.zeros(1, dtype=np.int64)
        self.found: dict[tuple[int, int], int] = {}  # (start, period): end

    def append(self, codes: np.ndarray) -> None:
        """Further words, given by their codes from 0 on."""
        old = len(self.codes)
        new = old + len(codes)
        self.powers.reserve(new + 1)
        more = np.cumsum((codes + 1) * self.powers.down[old:new] % PRIME) + self.sums[-1]
        self.codes = np.concatenate([self.codes, codes]) if old else np.asarray(codes, dtype=np.int64)
        self.sums = np.concatenate([self.sums, more])
        self._prolong(old)
        for block, low, high in self._levels():
            self._catch(block, low, high, old)

    def runs(self) -> list[Run]:
        """(start, length, period) of the runs so far, by start and period."""
        best: dict[tuple[int, int], int] = {}
        for (start, period), end in self.found.items():
            if not np.array_equal(self.codes[start : end - period], self.codes[start + period : end]):
                raise Collision
            # a multiple of the smallest period makes the same stretch
            if end - start >= max(self.words, self.exponent * period):
                best[start, end] = min(period, best.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in best.items())

    def _levels(self) -> Iterator[tuple[int, int, int]]:
        """Block size, smallest and largest period of each level that a text this long can hold."""
        n = len(self.codes)
        last = n - 1 if self.most is None else self.most // self.exponent
        shortest = self.words - self.words // self.exponent
        period = 1
        while period <= last:
            stretch = max((self.exponent - 1) * period, shortest)
            block = 1 << (((stretch + 1) // 2).bit_length() - 1)
            if block + period > n:
                return
            high = (4 * block - 2) // (self.exponent - 1)
            yield block, period, min(high, last)
            period = high + 1

    def _suffixes(self, block: int, ends: np.ndarray | slice) -> np.ndarray:
        """Fingerprints of the blocks of words that end with the given words."""
        if isinstance(ends, slice):
            a, b = ends.start, ends.stop
            span = self.sums[a + 1 : b + 1] - self.sums[a + 1 - block : b + 1 - block]
        else:
            span = self.sums[ends + 1] - self.sums[ends + 1 - block]
        return span % PRIME * self.powers.up[ends] % PRIME

    def _catch(self, block: int, low: int, high: int, old: int) -> None:
        """Compare the suffixes that end with the words from `old` on to the blocks behind them."""
        n = len(self.codes)
        first = max(old, block - 1 + low)
        if first >= n:
            return
        suffixes = self._suffixes(block, slice(first, n))
        least = max(block, first - high + 1)  # words before the end of the first block that matters
        ends = np.arange(-(-least // block) * block - 1, n - low, block)
        if not len(ends):
            return
        at = (ends - first)[:, None] + np.arange(low, high + 1)
        hit = suffixes[np.minimum(np.maximum(at, 0), len(suffixes) - 1)] == self._suffixes(block, ends)[:, None]
        if not hit.any():
            return
        hit &= (at >= 0) & (at < len(suffixes))
        row, column = np.nonzero(hit)
        self._report(ends[row] + 1, column + low, block)

    def _report(self, end: np.ndarray, period: np.ndarray, block: int) -> None:
        """Extend the blocks that came again a period later, and keep the squares.

        A block and its copy inside one run of a period up to the block's
        length tell nothing new: what repeats there has that smaller period.
        """
        known = sorted((s, e) for (s, p), e in self.found.items() if p <= block and e - s >= 2 * p)
        if known:
            starts = np.array([s for s, _ in known])
            reach = np.maximum.accumulate([e for _, e in known])
            near = np.searchsorted(starts, end - block, side="right") - 1
            new = (near < 0) | (reach[near] < end + period)
            end, period = end[new], period[new]
        if not len(end):
            return
        n = len(self.codes)
        start = end - block - self._extent(end - block, period, end - block, -1)
        end = end + period + self._extent(end, period, n - period - end, 1)
        whole = (end - start >= 2 * period) | (end == n)
        for s, p, e in zip(start[whole].tolist(), period[whole].tolist(), end[whole].tolist()):
            self.found[s, p] = e

    def _prolong(self, old: int) -> None:
        """Let what reached the former end of the text go on, and drop what it cut short of a square."""
        open_ = [key for key, end in self.found.items() if end == old]
        if not open_:
            return
        period = np.array([p for _, p in open_])
        more = self._extent(old - period, period, np.full(len(period), len(self.codes) - old), 1)
        for (start, p), length in zip(open_, more.tolist()):
            end = old + length
            if end - start >= 2 * p or end == len(self.codes):
                self.found[start, p] = end
            else:
                del self.found[start, p]

    def _extent(self, at: np.ndarray, period: np.ndarray, limit: np.ndarray, way: int) -> np.ndarray:
        """How many words from `at` on, or before it, equal those a period later."""
        done = np.zeros(len(at), dtype=np.int64)
        step = 1 << int(limit.max(initial=0)).bit_length()
        scale = self.powers.up[period]
        while step:
            go = np.flatnonzero(done + step <= limit)
            a = at[go] + done[go] if way > 0 else at[go] - done[go] - step
            p = period[go]
            near = (self.sums[a + step] - self.sums[a]) % PRIME
            far = (self.sums[a + p + step] - self.sums[a + p]) % PRIME * scale[go] % PRIME
            done[go[near == far]] += step
            step >>= 1
        return done


_POWERS = [Powers(base) for base in BASES]


def find_runs(codes: np.ndarray, words: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[Run]:
    """The runs of a whole text of word codes: (start, length, smallest period)."""
    if len(codes) < max(words, exponent):
        return []
    for powers in _POWERS:
        catchers = Catchers(powers, words, exponent, most=len(codes))
        catchers.append(codes)
        try:
            return catchers.runs()
        except Collision:
            continue
    raise ArithmeticError("fingerprints collided under every base")


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run with the greatest length by period; of equal ones the first, then the one with the smaller period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repeats(n: int, runs: Sequence[Run]) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def periodic_runs(
    df: DataFrame, keep: list[str], text: str = "text", words: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT
) -> DataFrame:
    """Columns `keep`, the runs of every text, the strongest of them, and the text without repeats.

    `run_starts`, `run_lengths` and `run_periods` list all runs by start, then
    period, in words from 0; `start`, `length` and `period` are those of the
    run with the greatest length by period, null where there is none.
    `collapsed` holds the words that no run repeats, joined by one space. A
    null text counts as empty. Repeated rows stay; a kept column with the name
    of a new one gives way to it. Texts stay in their partitions.
    """

    def work(texts):
        doc, codes, distinct = common.word_codes(texts)
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        made: dict[str, list] = {f.name: [] for f in FIELDS}
        for a, b in zip(edges[:-1], edges[1:]):
            own = codes[a:b]
            runs = find_runs(own, words, exponent)
            best = strongest(runs) or (None, None, None)
            left = own[~repeats(len(own), runs)] if runs else own
            for name, value in (
                ("n_runs", len(runs)), ("start", best[0]), ("length", best[1]), ("period", best[2]),
                ("run_starts", [r[0] for r in runs]), ("run_lengths", [r[1] for r in runs]),
                ("run_periods", [r[2] for r in runs]), ("collapsed", b" ".join(distinct[left].tolist()).decode()),
            ):
                made[name].append(value)
        return made

    return common.map_texts(df, keep, FIELDS, work, text)
