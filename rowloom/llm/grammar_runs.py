"""Runs of repeated words, found on a Re-Pair grammar of each document.

A run is a longest stretch of words that repeats with a period: words one period apart are equal, the stretch holds at
least ``min_exponent`` (3) periods and ``min_length`` (24) words, and neither neighbour could be added.

**Grammar.** Pairs of neighbouring symbols that occur twice or more are replaced by a new symbol, frequent pairs first: in
one round every occurrence goes that overlaps no occurrence of a more frequent pair, and rounds go on until no pair occurs
twice. What is left is joined two by two up to one symbol a document. Each boundary between two words is then the inner
boundary of one occurrence of one symbol.

**Runs.** A run lies in the lowest symbol that holds all of it, and crosses the inner boundary of that symbol. So each symbol
of ``min_length`` words or more is searched once, at one of its occurrences: for every period a run of it may have, two
words that must be equal are compared; where they are, three windows of one period, one of which any such run holds, are
compared by prefix hashes, and what passes is stretched to both sides by binary search. Runs found are put at all
occurrences of their symbol, those inside a longer run of the same period go, and of equal stretches the smallest period
stays. Every run is checked word by word in the end.

Documents are cut into batches of about ``BATCH`` words and a batch is worked on as a whole, with symbols that no two
documents share; a document is never cut. Memory grows with the words of a batch, or of the longest text.

Defined results: null and empty texts and white space have no words, no runs and an empty collapsed text. Repeated rows give
repeated results, rows without ``doc_id`` too. No rows give no rows. Extra columns are ignored. Words are cut at ASCII white
space and compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import map_batches, texts

MIN_LENGTH, MIN_EXPONENT = 24, 3
BATCH = 400_000
CHUNK = 2_000_000
RADIX = np.uint64(0x9E3779B97F4A7C15)

Edit = Callable[[int | None, int], np.ndarray | None]


class Grammar:
    """A Re-Pair grammar of documents laid end to end; only symbols of ``least`` words or more are kept.

    ``symbol``, ``start``, ``inner`` and ``end`` say for each occurrence of a kept symbol which it is and where it begins,
    has its inner boundary, and ends.
    """

    def __init__(self, words: np.ndarray, docs: np.ndarray, least: int = MIN_LENGTH):
        self.least, self.next = least, int(words.max(initial=-1)) + 1
        self.kept: list[tuple[np.ndarray, ...]] = []
        self.rules = 0
        at = np.arange(len(words))
        symbols, starts, ends = words.astype(np.int64), at, at + 1
        live = np.ones(len(words), bool)  # whether the pair that begins here may occur twice
        while True:
            step = self._round(symbols, docs, live)
            if step is None:
                break
            chosen, made = step
            symbols, starts, ends, docs, live = self._joined(chosen, made, symbols, starts, ends, docs, live)
        while True:
            first = np.concatenate([[True], docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, bool)
            place = np.arange(len(docs)) - np.maximum.accumulate(np.where(first, np.arange(len(docs)), 0))
            chosen = np.flatnonzero((place[:-1] % 2 == 0) & ~first[1:]) if len(docs) else np.zeros(0, np.int64)
            if not len(chosen):
                break
            made = self.next + np.arange(len(chosen))
            self.next += len(chosen)
            symbols, starts, ends, docs, live = self._joined(chosen, made, symbols, starts, ends, docs, live)
        empty = np.zeros(0, np.int64)
        columns = [np.concatenate(c) for c in zip(*self.kept, strict=True)] if self.kept else [empty] * 4
        self.symbol, self.start, self.inner, self.end = columns

    def _round(self, symbols: np.ndarray, docs: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Places of the pairs that this round replaces, and their new symbols."""
        at = np.flatnonzero(live[:-1] & (docs[1:] == docs[:-1]))
        pairs = symbols[at] << 32 | symbols[at + 1]
        _, pair, times = np.unique(pairs, return_inverse=True, return_counts=True)
        live[:] = False
        often = times[pair] > 1
        at, pair = at[often], pair[often]
        if not len(at):
            return None
        live[at] = True
        weight = np.full(len(symbols) + 1, -1)  # the last one stands for both ends
        weight[at] = times[pair] * (len(times) + 1) + pair
        own = weight[at]
        equal = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (own[1:] == own[:-1])])
        place = np.arange(len(at))
        turn = place - np.maximum.accumulate(np.where(equal, 0, place))  # in a row of equal pairs every second one goes
        wins = (own >= weight[at - 1]) & (own >= weight[at + 1]) & (turn % 2 == 0)
        kinds, made = np.unique(pair[wins], return_inverse=True)
        made += self.next
        self.next, self.rules = self.next + len(kinds), self.rules + len(kinds)
        return at[wins], made

    def _joined(self, chosen, made, symbols, starts, ends, docs, live):
        """The sequence with each chosen place and the one after it made into one symbol."""
        inner, end = starts[chosen + 1], ends[chosen + 1]
        long = end - starts[chosen] >= self.least
        if long.any():
            self.kept.append((made[long], starts[chosen][long], inner[long], end[long]))
        symbols[chosen], ends = made, ends.copy()
        ends[chosen] = end
        live[chosen] = True
        live[np.maximum(chosen - 1, 0)] = True
        stay = np.ones(len(symbols), bool)
        stay[chosen + 1] = False
        return symbols[stay], starts[stay], ends[stay], docs[stay], live[stay]


class Windows:
    """Equality of stretches of words by prefix hashes."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        self.power = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, RADIX, np.uint64))])
        mixed = words ^ (words >> np.uint64(29))
        self.sums = np.concatenate([[np.uint64(0)], np.add.accumulate(mixed * self.power[: n - 1])])

    def alike(self, start: np.ndarray, period: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``start`` and one period later agree in ``length`` words."""
        here = self.sums[start + length] - self.sums[start]
        there = self.sums[start + period + length] - self.sums[start + period]
        return here * self.power[period] == there

    def reach(self, start: np.ndarray, period: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """For how many words, at most ``most``, the text ahead of (or behind) ``start`` agrees with that one period later."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high + 1) // 2, low)
            good = self.alike(start if ahead else start - middle, period, middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def crossing(grammar: Grammar, words: np.ndarray, windows: Windows, min_length: int, min_exponent: int) -> tuple:
    """Runs across the inner boundary of each symbol, inside it: symbol, start, end (from the symbol's start) and period."""
    symbol, one = np.unique(grammar.symbol, return_index=True)
    begin, inner, stop = grammar.start[one], grammar.inner[one], grammar.end[one]
    tries = (stop - begin) // min_exponent
    done, found = np.concatenate([[0], np.cumsum(tries)]), []
    first = 0
    while first < len(symbol):
        last = max(first + 1, int(np.searchsorted(done, done[first] + CHUNK, side="right")) - 1)
        node = np.repeat(np.arange(first, last), tries[first:last])
        q = np.arange(done[first], done[last]) - done[node] + 1
        p, b, e = begin[node], inner[node], stop[node]
        before, after = b - q >= p, b - 1 + q < e
        equal = before & (words[np.where(before, b - q, b)] == words[b])
        equal |= after & (words[b - 1] == words[np.where(after, b - 1 + q, b - 1)])
        node, q, p, b, e = (x[equal] for x in (node, q, p, b, e))
        anchor = np.full(len(node), -1)
        for start, base in ((b - 2 * q + 1, b - q), (b - q, b - q), (b - 1, b - 1)):
            fits = np.flatnonzero((start >= p) & (start + 2 * q <= e) & (anchor < 0))
            good = fits[windows.alike(start[fits], q[fits], q[fits])]
            anchor[good] = base[good]
        node, q, p, e, anchor = (x[anchor >= 0] for x in (node, q, p, e, anchor))
        left = anchor - windows.reach(anchor, q, anchor - p, ahead=False)
        right = anchor + q + windows.reach(anchor, q, e - anchor - q, ahead=True)
        long = right - left >= np.maximum(min_length, min_exponent * q)
        node, q, left, right = (x[long] for x in (node, q, left, right))
        order = np.lexsort((q, right, left, node))
        node, q, left, right = (x[order] for x in (node, q, left, right))
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        node, q, left, right = (x[new] for x in (node, q, left, right))
        found.append((symbol[node], left - begin[node], right - begin[node], q))
        first = last
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (empty,) * 4


def placed(grammar: Grammar, runs: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of the runs of symbols at every occurrence of their symbol."""
    symbol, left, right, period = runs
    order = np.argsort(grammar.symbol, kind="stable")
    sorted_, starts = grammar.symbol[order], grammar.start[order]
    low, high = np.searchsorted(sorted_, symbol), np.searchsorted(sorted_, symbol, side="right")
    times = high - low
    which = np.repeat(np.arange(len(symbol)), times)
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
    return starts[place] + left[which], starts[place] + right[which], period[which]


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without runs inside a longer one of the same period, and with the smallest period of equal stretches."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) if len(period) else period
    reach = end + group * (int(end.max(initial=0)) + 1)
    furthest = np.concatenate([[-1], np.maximum.accumulate(reach)[:-1]]) if len(reach) else reach
    outer = reach > furthest
    start, end, period = start[outer], end[outer], period[outer]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    order = np.lexsort((period[new], start[new]))
    return start[new][order], end[new][order], period[new][order]


def true_run(words: np.ndarray, low: int, high: int, start: int, end: int, period: int) -> bool:
    """Whether a stretch of the document from ``low`` to ``high`` is a run, word by word."""
    if not np.array_equal(words[start : end - period], words[start + period : end]):
        return False
    grows_left = start > low and words[start - 1] == words[start - 1 + period]
    return not grows_left and not (end < high and words[end] == words[end - period])


def runs_of_period(words: np.ndarray, low: int, high: int, period: int, least: int) -> list[tuple[int, int, int]]:
    """All stretches of one period in a document, for the case that equal hashes belong to unlike words."""
    equal = np.concatenate([[False], words[low : high - period] == words[low + period : high], [False]]).astype(np.int8)
    begins, stops = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
    long = stops - begins + period >= least
    return [(low + int(a), low + int(b) + period, period) for a, b in zip(begins[long], stops[long], strict=True)]


def find_runs(words: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, by start and period.

    ``words`` are the 64-bit hashes of the words of all documents, ``sizes`` the numbers of words.
    """
    docs = np.repeat(np.arange(len(sizes)), sizes)
    lows = np.cumsum(sizes) - sizes
    own = (words ^ (docs.astype(np.uint64) * RADIX)) * np.uint64(0xBF58476D1CE4E5B9)  # no two documents share a symbol
    _, symbols = np.unique(own, return_inverse=True)
    grammar = Grammar(symbols, docs, min_length)
    start, end, period = placed(grammar, crossing(grammar, words, Windows(words), min_length, min_exponent))
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    wrong: set[tuple[int, int]] = set()
    for s, e, q in zip(*(x.tolist() for x in maximal(start, end, period)), strict=True):
        doc = int(docs[s])
        if true_run(words, int(lows[doc]), int(lows[doc] + sizes[doc]), s, e, q):
            found[doc].append((s - int(lows[doc]), e - s, q))
        else:
            wrong.add((doc, q))
    for doc, q in wrong:
        low = int(lows[doc])
        more = runs_of_period(words, low, low + int(sizes[doc]), q, max(min_length, min_exponent * q))
        held = {(s, n) for s, n, _ in found[doc]}
        found[doc] = sorted({*found[doc], *((s - low, e - s, q) for s, e, q in more if (s - low, e - s) not in held)},
                            key=lambda r: (r[0], r[2]))
    return found


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] > 0


def repeated_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  edit: Edit | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and the collapsed text of every row.

    The collapsed text has the words that no run holds after its first period, joined by single spaces. ``edit`` may give
    for a doc_id and a number of words the places that the words are taken from, or None.
    """
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not searched for")

    def answer(ids: list, split: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(w) for w in split], np.int64)
        flat = [xxhash.xxh64_intdigest(w) for own in split for w in own]
        found = find_runs(np.array(flat, np.uint64), sizes, min_length, min_exponent)
        collapsed = []
        for own, runs in zip(split, found, strict=True):
            kept = own if not runs else [own[i] for i in np.flatnonzero(~dropped(len(own), runs))]
            collapsed.append(b" ".join(kept).decode())
        names = ("start", "length", "period")
        rows = [[dict(zip(names, r, strict=True)) for r in runs] for runs in found]
        arrays = [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(rows, kind), pa.array(collapsed, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, split, held = [], [], 0
        for batch in batches:
            for start, part in texts(batch.column(1)):
                for doc_id, text in zip(batch.column(0).slice(start, len(part)).to_pylist(), part, strict=True):
                    words = text.encode().split()
                    places = edit(doc_id, len(words)) if edit else None
                    split.append(words if places is None else [words[i] for i in places.tolist()])
                    ids.append(doc_id)
                    held += len(words) + 1
                    if held >= BATCH:
                        yield answer(ids, split)
                        ids, split, held = [], [], 0
        if ids:
            yield answer(ids, split)

    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_batches(picked, run, schema)


def digests(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length in periods, and digests of all runs and of the collapsed text."""
    found = repeated_runs(docs, edit=edit)
    ranked = F.transform("runs", lambda r: F.struct(  # quotients of integers below 2**26 differ as doubles if they differ
        (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("first"), (-r["period"]).alias("least"), r["length"].alias("length")))
    found = found.withColumn("best", F.array_max(ranked))
    period = -F.col("best.least")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.first")).alias("start"),
        F.col("best.length").alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.least").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
