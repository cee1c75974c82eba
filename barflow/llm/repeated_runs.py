"""Runs of periodic words, found by the branching-tandem test on an enhanced suffix array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barflow.llm.common import SPACES, distinct_segments, separators, slices

#: Words that are indexed together (a longer text stands alone).
PIECE = 1 << 17
#: A run has this many words at least, and this many times its period.
LEAST_WORDS, LEAST_PERIODS = 6, 4

_WHITE = separators(SPACES)


class Words:
    """The words of several texts (bytes), numbered alike when their bytes are, and their bytes with one space each."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        inside = ~_WHITE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        self.sizes = np.flatnonzero(last) + 1 - starts
        self.bounds = np.searchsorted(starts, begin)  # text i has the words bounds[i] to bounds[i + 1]
        self.ids = distinct_segments(data, starts, starts + self.sizes)[0].astype(np.int64)
        # A word's bytes are followed by one more byte at least: that one becomes the space.
        keep = inside.copy()
        keep[np.flatnonzero(last) + 1] = True
        self.spaced = np.where(inside, data, np.uint8(32))[keep]

    def joined(self, kept: np.ndarray) -> list[bytes]:
        """Of each text the kept words, joined by one space."""
        wide = self.sizes + 1
        data = self.spaced[np.repeat(kept, wide)].tobytes()
        ends = np.concatenate(([0], np.cumsum(np.where(kept, wide, 0))))[self.bounds].tolist()
        return [data[a: max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])]


class SuffixArray:
    """Suffix array of sequences, with its inverse and the common prefixes of neighbours.

    ``symbols`` are compared inside their sequence only: each sequence is closed by a symbol of its own, and the
    symbols of two sequences never equal. ``levels[k]`` numbers the positions by their first 2 ** k symbols,
    so two positions agree in these exactly if their numbers do.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank = self._numbered(order, symbols[order])
        self.levels = [rank]
        step = 1
        while True:
            # Positions that share their number with another one are still open; the others are settled.
            crowd = np.bincount(rank, minlength=n)[rank]
            open_ = np.flatnonzero(crowd > 1)
            if not len(open_):
                break
            key = rank[open_] * np.int64(n) + rank[open_ + step]  # closing symbols are settled: this stays inside
            by = np.argsort(key, kind="stable")
            key, at = key[by], open_[by]
            group = rank[at]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            place = np.flatnonzero(new)
            head = np.concatenate(([True], group[1:] != group[:-1]))
            inside = place - np.flatnonzero(head)[np.cumsum(head)[place] - 1]  # of the group, smaller ones before
            rank = rank.copy()
            rank[at] = (group[place] + inside)[np.cumsum(new) - 1]
            self.levels.append(rank)
            step *= 2
        self.inverse = rank
        self.suffix = np.empty(n, np.int64)
        self.suffix[rank] = np.arange(n)
        self.common = self._neighbours()

    @staticmethod
    def _numbered(order: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Each position's number: how many positions hold a smaller value."""
        new = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        return rank

    def _neighbours(self) -> np.ndarray:
        """common[r]: symbols that the suffixes of rank r - 1 and r share (0 for the first)."""
        out = np.zeros(len(self.suffix), np.int64)
        one, two = self.suffix[:-1].copy(), self.suffix[1:].copy()
        live = np.arange(1, len(self.suffix))
        same = self.levels[0][one] == self.levels[0][two]
        live, one, two = live[same], one[same], two[same]
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][one] == self.levels[k][two]
            gain = np.where(same, 1 << k, 0)
            one, two = one + gain, two + gain
        out[live] = one - self.suffix[live - 1]
        return out

    def shared_before(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many symbols before the positions one < two agree, going left."""
        total = np.zeros(len(one), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = one - total - (1 << k), two - total - (1 << k)
            same = (a >= 0) & (self.levels[k][np.maximum(a, 0)] == self.levels[k][np.maximum(b, 0)])
            total += np.where(same, 1 << k, 0)
        return total


def _reach(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place with a positive value: the nearest places to its left and right that hold a smaller one.

    The first value is 0, and a 0 follows the last. Minima over 2 ** k values are laid out, and each place
    goes as far as they are no smaller.
    """
    values = np.append(common, 0)
    at = np.flatnonzero(common > 0)
    zeros = np.flatnonzero(values == 0)
    widest = int(np.diff(zeros).max())
    tables, step = [values], 1
    while step < widest:
        last = tables[-1]
        tables.append(np.concatenate((np.minimum(last[:-step], last[step:]), last[-step:])))
        step *= 2
    mine, left, right = values[at], at.copy(), at.copy()
    for k in range(len(tables) - 1, -1, -1):
        size = 1 << k
        lower = left - size  # values [left - size, left)
        ok = (lower >= 0) & (tables[k][np.maximum(lower, 0)] >= mine)
        left = np.where(ok, lower, left)
        ok = (right + 1 + size <= len(values)) & (tables[k][np.minimum(right + 1, len(values) - 1)] >= mine)
        right = np.where(ok, right + size, right)
    return left - 1, right + 1


def smaller_children(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every LCP interval, the ranks in all its child intervals but the largest.

    Returns, for each such rank, the rank itself and its interval: depth, first rank, last rank. A rank comes once
    for each interval in whose smaller children it is, so ranks come log n times at most.
    """
    at = np.flatnonzero(common > 0)
    if not len(at):
        return at, at, at, at
    low, high = _reach(common)
    last = high - 1
    # Children of an interval are parted at its places of equal value, which are sorted as ``at`` is.
    order = np.lexsort((at, common[at], low))
    at, low, last, depth = at[order], low[order], last[order], common[at[order]]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    interval = np.cumsum(new) - 1
    head, tail = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(at)) - 1
    # One child before each place, and one behind the last place of an interval.
    begin = np.where(new, low, np.concatenate(([0], at[:-1])))
    begin = np.concatenate((begin, at[tail]))
    end = np.concatenate((at, last[tail] + 1))
    of = np.concatenate((interval, interval[tail]))
    size = end - begin
    by = np.lexsort((size, of))
    largest = by[np.append(np.flatnonzero(np.diff(of[by])), len(by) - 1)]
    small = np.ones(len(size), bool)
    small[largest] = False
    begin, size, of = begin[small], size[small], of[small]
    out = np.concatenate(([0], np.cumsum(size)))[:-1]
    rank = np.repeat(begin - out, size) + np.arange(int(size.sum()))
    inside = head[np.repeat(of, size)]
    return rank, depth[inside], low[inside], last[inside]


def runs_of(ids: np.ndarray, bounds: np.ndarray, least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, by text, start and period.

    A run is a stretch of one text's words with smallest period q, of ``least_words`` words and ``least_periods``
    (two or more) periods at least, that cannot be extended with that period.

    A square (two equal halves of q words) that a different word follows is a branching one: its halves begin
    suffixes in different children of the LCP interval of depth q. So of each interval, the suffixes i of the
    smaller children are tested for i + q and i - q in the interval. Every run ends with a branching square, and
    rotating that to the left as long as the words allow it gives the run's start. Squares of a multiple of a run's
    period give the same stretch, and merge with it.
    """
    sizes = np.diff(bounds)
    n = len(ids) + len(sizes)
    if not len(ids):
        return (np.empty(0, np.int64),) * 4
    place = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)  # with a closing symbol behind each text
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    kinds = int(ids.max()) + 2
    symbols = text * np.int64(kinds) + kinds - 1
    symbols[place] -= kinds - 1 - ids
    array = SuffixArray(symbols)
    rank, depth, low, last = smaller_children(array.common)
    here = array.suffix[rank]
    found = []
    for one, two in ((here, here + depth), (here - depth, here)):
        other = two if one is here else one
        inside = (other >= 0) & (other < n)
        r = array.inverse[np.where(inside, other, 0)]
        inside &= (r >= low) & (r <= last)
        found.append((one[inside], depth[inside]))
    start, period = (np.concatenate(x) for x in zip(*found))
    # The words behind the halves differ: the square branches. (Both lie inside the text or on its close.)
    follows = symbols[start + period] != symbols[start + 2 * period]
    start, period = np.divmod(np.unique(start[follows] * np.int64(n) + period[follows]), np.int64(n))
    end = start + 2 * period
    start = start - array.shared_before(start, start + period)
    length = end - start
    long = (length >= least_words) & (length >= least_periods * period)
    start, length, period = start[long], length[long], period[long]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    of = text[start]
    start = start - bounds[of] - of
    by = np.lexsort((period, start, of))
    return of[by], start[by], length[by], period[by]


def repeated_words(bounds: np.ndarray, of: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Of all words, those that lie in a run behind its first period."""
    change = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(change, bounds[of] + start + period, 1)
    np.add.at(change, bounds[of] + start + length, -1)
    return np.cumsum(change)[:-1] > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    Words are what the six ASCII white-space characters part, compared by their bytes and numbered from 0. ``runs``
    lists the start, length and period (in words) of every run, by start, then period; see ``runs_of``.
    ``collapsed`` is the text's words joined by one space, without those that lie in a run behind its first
    period. Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows and rows
    without an id are answered each; extra columns are ignored; an empty table gives no rows.

    Documents do not move. A task indexes about 130,000 words at a time; a longer text is indexed alone, so the
    longest text bounds the memory (some hundred bytes for each of its words).
    """

    def run(batches):
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            counts, runs, collapsed = [], [], []
            for a, b in _pieces(texts):
                words = Words(texts[a:b])
                found = runs_of(words.ids, words.bounds, least_words, least_periods)
                counts.append(np.diff(words.bounds))
                ends = np.searchsorted(found[0], np.arange(b - a + 1))
                runs.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in found[1:]], fields=list(_RUN))))
                collapsed.extend(words.joined(~repeated_words(words.bounds, *found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(counts)), pa.concat_arrays(runs),
                 pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False)], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def _pieces(texts: list[bytes], size: int = 8 * PIECE):
    """Index ranges of texts with about ``size`` bytes together."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)
