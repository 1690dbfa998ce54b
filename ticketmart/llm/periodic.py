"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of words with a smallest period q that is at least 2q (and `shortest`)
words long and that no neighbouring word extends.

1. Re-Pair: pairs of neighbouring symbols that occur twice or more become a new symbol,
   the most frequent ones first, until no pair repeats. All texts of a slice share one
   grammar, so a passage that was copied is one symbol. A round replaces each pair at all
   places where no overlapping pair is more frequent.
2. Each symbol's expansion has one boundary, between its two halves. The runs that cross
   it are found once: such a run of period q repeats the word beside the boundary q words
   on or back, so those places are the candidates, and how far the words go on agreeing
   says whether they are runs. What a text's last symbols are is joined in pairs as well.
3. The runs of a symbol are translated to all places that derive from it, and intervals
   of one period that overlap by a period or more are merged to maximal ones. Of the
   periods of one interval the smallest stays.

How far words agree is told by names of windows of 1, 2, 4... words, equal for equal
windows (Karp, Miller and Rosenberg), so the answer is exact and takes logarithmic time.

Defined results: null, empty and blank texts have no words and no runs; equal rows get
equal results; other columns stay, but for those that have the name of an added one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ticketmart.llm.common import Compute, annotate

SHORTEST = 12
# Text bytes that share one grammar.
SLICE_BYTES = 2 << 20

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
FIELDS = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]

Intervals = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, ends, periods


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ragged rows: the row of each element, and its number in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


# Grammar.


@dataclass
class Grammar:
    """Rules symbol -> (left, right) for symbols from `base` on, and what is left of the texts."""

    base: int
    left: list[np.ndarray] = field(default_factory=list)
    right: list[np.ndarray] = field(default_factory=list)
    length: list[np.ndarray] = field(default_factory=list)  # words of an expansion
    place: list[np.ndarray] = field(default_factory=list)  # where the symbol is found first
    symbols: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _local_greatest(values: np.ndarray) -> np.ndarray:
    """Positions of positive values above both neighbours; every other one of equal neighbours."""
    starts = np.flatnonzero(np.diff(values, prepend=-1))
    ends = np.append(starts[1:], len(values))
    value = values[starts]
    found = (value > 0) & (value > np.append(-1, value[:-1])) & (value > np.append(value[1:], -1))
    row, nth = _spread((ends - starts)[found])
    return (starts[found][row] + nth)[nth % 2 == 0]


def re_pair(words: np.ndarray, text_of: np.ndarray) -> Grammar:
    """The grammar of word numbers 0, 1, 2...; no symbol crosses from a text into the next."""
    grammar = Grammar(int(words.max()) + 1 if len(words) else 0)
    lengths = np.ones(grammar.base, np.int64)
    symbols, places = words.astype(np.int64), np.arange(len(words))
    # Whether a symbol and its right neighbour may still be paired.
    linked = np.append(text_of[1:] == text_of[:-1], False)[: len(words)]
    done = []
    while len(symbols):
        at = np.flatnonzero(linked)
        _, which, counts = np.unique(symbols[at] * len(lengths) + symbols[at + 1], return_inverse=True, return_counts=True)
        # Greater for more frequent pairs, different for different ones, 0 for single ones.
        order = np.lexsort((np.arange(len(counts)) * 0x9E3779B1 % 0xFFFFFFFB, counts))
        priority = np.empty(len(counts), np.int64)
        priority[order] = np.arange(1, len(counts) + 1)
        priority[counts < 2] = 0
        pair = np.zeros(len(symbols), np.int64)
        pair[at] = priority[which]
        # A pair that occurs once will never repeat, nor will one made of it.
        linked &= pair > 0
        first = _local_greatest(pair)
        rules, index, number = np.unique(symbols[first] * len(lengths) + symbols[first + 1], return_index=True, return_inverse=True)
        left, right = rules // len(lengths), rules % len(lengths)
        symbols[first] = len(lengths) + number
        linked[first] = linked[first + 1]
        kept = np.ones(len(symbols), bool)
        kept[first + 1] = False
        if len(rules):
            grammar.left.append(left)
            grammar.right.append(right)
            grammar.length.append(lengths[left] + lengths[right])
            grammar.place.append(places[first[index]])
            lengths = np.concatenate([lengths, grammar.length[-1]])
        symbols, places, linked = symbols[kept], places[kept], linked[kept]
        active = linked | np.append(False, linked[:-1])
        done.append((symbols[~active], places[~active]))
        symbols, places, linked = symbols[active], places[active], linked[active]
    if done:
        symbols, places = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(places)
        grammar.symbols, grammar.places = symbols[order], places[order]
    return grammar


def _joined_in_pairs(starts: np.ndarray, ends: np.ndarray, text_of: np.ndarray) -> list[Intervals]:
    """Nodes (low, middle, high) of a binary tree over each text's last symbols, by level."""
    levels = []
    while True:
        new_text = np.diff(text_of, prepend=-1) != 0
        nth = np.arange(len(starts)) - np.maximum.accumulate(np.where(new_text, np.arange(len(starts)), 0))
        even = np.flatnonzero(nth % 2 == 0)
        paired = even[np.append(~new_text[1:], False)[even]]
        if len(paired) == 0:
            return levels
        levels.append((starts[paired], starts[paired + 1], ends[paired + 1]))
        ends = ends.copy()
        ends[paired] = ends[paired + 1]
        starts, ends, text_of = starts[even], ends[even], text_of[even]


# Runs that cross a boundary.


@dataclass
class Candidates:
    """Words at `at` and `at + period` agree, both within [low, high) of a node."""

    at: np.ndarray
    period: np.ndarray
    low: np.ndarray
    high: np.ndarray
    node: np.ndarray

    def __getitem__(self, chosen: np.ndarray) -> Candidates:
        return Candidates(*(x[chosen] for x in (self.at, self.period, self.low, self.high, self.node)))


def _beside(words: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray, shortest: int) -> Candidates:
    """All places where a word beside a boundary is found again, as far as a run may reach.

    A run of period q is 2q words or longer, so it has q words on one side at least and
    the last word on the left is found again q words on, or the first on the right q back.
    Places with fewer than half of `shortest` agreeing words in a row around are left out:
    a run has that many words, and q of them, that agree with those q on.
    """
    longest = (high - low) // 2
    row, nth = _spread(np.minimum(high - middle, longest))
    at, again = (middle - 1)[row], middle[row] + nth
    same = np.flatnonzero(words[at] == words[again])
    on = (at[same], again[same] - at[same], row[same])
    row, nth = _spread(np.minimum(middle - low, longest))
    at, again = middle[row] - 1 - nth, middle[row]
    same = np.flatnonzero(words[at] == words[again])
    back = (at[same], again[same] - at[same], row[same])
    at, period, node = (np.concatenate(parts) for parts in zip(on, back, strict=True))
    found = Candidates(at, period, low[node], high[node], node)
    least = (shortest + 1) // 2
    agreeing = np.ones(len(found.at), np.int64)
    for direction in (1, -1):
        going = np.arange(len(found.at))
        for step in range(1, least):
            place = found.at[going] + direction * step
            inside = (place >= found.low[going]) & (place + found.period[going] < found.high[going])
            going, place = going[inside], place[inside]
            going = going[words[place] == words[place + found.period[going]]]
            agreeing[going] += 1
    return found[agreeing >= least]


def _window_names(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of the windows of 1, 2, 4... words at each place; equal windows, equal names."""
    names = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
    size = 1
    while 2 * size <= longest and 2 * size <= len(words):
        last = names[-1].astype(np.int64)
        distinct, which = np.unique(last[:-size] * (int(last.max()) + 1) + last[size:], return_inverse=True)
        names.append(which.astype(np.int32))
        if len(distinct) == len(which):
            break
        size *= 2
    return names


def _extended(names: list[np.ndarray], found: Candidates, shortest: int) -> tuple[np.ndarray, Intervals]:
    """The runs among candidates: the nodes they were found at, and their intervals."""
    start, end = found.at.copy(), found.at + found.period + 1
    for level in reversed(range(len(names))):
        name, size = names[level], 1 << level
        # A size may fit several times at the top, where no greater window was named.
        while True:
            fits = np.flatnonzero(end + size <= found.high)
            fits = fits[name[end[fits] - found.period[fits]] == name[end[fits]]]
            end[fits] += size
            fits_back = np.flatnonzero(start - size >= found.low)
            fits_back = fits_back[name[start[fits_back] - size] == name[start[fits_back] - size + found.period[fits_back]]]
            start[fits_back] -= size
            if level < len(names) - 1 or len(fits) + len(fits_back) == 0:
                break
    long = end - start >= np.maximum(shortest, 2 * found.period)
    return found.node[long], (start[long], end[long], found.period[long])


def _runs_of_nodes(words: np.ndarray, text_of: np.ndarray, levels: list[Intervals], shortest: int) -> list[tuple[np.ndarray, Intervals]]:
    """For each list of nodes: the numbers of nodes with runs, and these runs."""
    found = [_beside(words, *level, shortest) for level in levels]
    if not any(len(part.at) for part in found):
        none = np.zeros(0, np.int64)
        return [(none, (none, none, none))] * len(levels)
    # Windows are named only in texts that have a candidate.
    marked = np.zeros(int(text_of[-1]) + 1, bool)
    for part in found:
        marked[text_of[part.at]] = True
    used = marked[text_of]
    moved = np.cumsum(used) - 1
    names = _window_names(words[used], max(int((part.high - part.low).max(initial=0)) for part in found))
    # Places in the marked texts alone; only those within a text are compared.
    places = np.flatnonzero(used)
    results = []
    for part in found:
        low = moved[part.low]
        there = Candidates(moved[part.at], part.period, low, low + part.high - part.low, part.node)
        node, (start, end, period) = _extended(names, there, shortest)
        results.append((node, (places[start], places[start] + end - start, period)))
    return results


# Translation and merging.


def _translated(grammar: Grammar, node: np.ndarray, runs: Intervals) -> Intervals:
    """Runs of rules (at the rule's own place) at all places that derive from the rule."""
    left, right, length, place = (np.concatenate(x) for x in (grammar.left, grammar.right, grammar.length, grammar.place))
    order = np.argsort(node, kind="stable")
    node, (start, end, period) = node[order], (x[order] for x in runs)
    start, end = start - place[node], end - place[node]
    own = np.bincount(node, minlength=len(left))
    first = np.cumsum(own) - own
    has = own > 0
    at = 0
    for rules in grammar.left:  # rules are made of earlier ones
        here = slice(at, at + len(rules))
        for half in (left[here], right[here]):
            rule = np.maximum(half - grammar.base, 0)
            has[here] |= (half >= grammar.base) & has[rule]
        at += len(rules)
    left_words = np.where(left >= grammar.base, length[np.maximum(left - grammar.base, 0)], 1)
    results = []
    symbol, where = grammar.symbols, grammar.places
    while len(symbol):
        rule = symbol - grammar.base
        used = rule >= 0
        used[used] = has[rule[used]]
        rule, where = rule[used], where[used]
        row, nth = _spread(own[rule])
        which = first[rule][row] + nth
        results.append((where[row] + start[which], where[row] + end[which], period[which]))
        symbol = np.concatenate([left[rule], right[rule]])
        where = np.concatenate([where, where + left_words[rule]])
    return tuple(np.concatenate(parts) for parts in zip(*results, strict=True))


def _merged(runs: Intervals) -> Intervals:
    """Maximal intervals, each with its smallest period, by start and period."""
    start, end, period = runs
    if len(start) == 0:
        return runs
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.diff(period, prepend=period[0]) != 0) * (int(end.max()) + 1)
    reached = np.maximum.accumulate(end + group) - group
    # Two intervals of one period belong to one run if they share a period or more.
    apart = np.append(True, (group[1:] != group[:-1]) | (start[1:] > reached[:-1] - period[1:]))
    begins = np.flatnonzero(apart)
    start, end, period = start[begins], np.maximum.reduceat(end, begins), period[begins]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    distinct = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    start, end, period = start[distinct], end[distinct], period[distinct]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(words: np.ndarray, text_of: np.ndarray, shortest: int = SHORTEST) -> Intervals:
    """All runs of texts given as word numbers one after another: starts, ends and periods."""
    none = np.zeros(0, np.int64)
    if len(words) == 0:
        return none, none, none
    grammar = re_pair(words, text_of)
    symbols = grammar.symbols
    lengths = np.concatenate([np.ones(grammar.base, np.int64), *grammar.length])
    levels = _joined_in_pairs(grammar.places, grammar.places + lengths[symbols], text_of[grammar.places])
    levels = [tuple(x[high - low >= shortest] for x in (low, middle, high)) for low, middle, high in levels]
    if grammar.left:
        place, left = np.concatenate(grammar.place), np.concatenate(grammar.left)
        size = lengths[grammar.base :]
        long = np.flatnonzero(size >= shortest)
        levels.append((place[long], (place + lengths[left])[long], (place + size)[long]))
    found = _runs_of_nodes(words, text_of, levels, shortest)
    if grammar.left:
        node, runs = found.pop()
        found.append((node, _translated(grammar, long[node], runs)))
    if not found:
        return none, none, none
    return _merged(tuple(np.concatenate(parts) for parts in zip(*(runs for _, runs in found), strict=True)))


def _listed(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)


def detected(docs: DataFrame, *, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """Add `n_words`, `runs` (by start and period; words are numbered from 0) and `collapsed`.

    `collapsed` is the text without the words of any run after that run's first period,
    its words joined by one blank.
    """

    def start() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            parts = pc.ascii_split_whitespace(pc.fill_null(batch.column(text), ""))
            text_of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(parts).to_numpy())
            words = parts.flatten()
            filled = pc.not_equal(pc.binary_length(words), 0)
            words, text_of = words.filter(filled), text_of[filled.to_numpy(zero_copy_only=False)]
            numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
            begin, end, period = runs_of(numbers, text_of, shortest)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, end, -1)
            kept = np.cumsum(change)[:-1] == 0
            counts = np.bincount(text_of, minlength=batch.num_rows)
            first = np.cumsum(counts) - counts
            run_text = text_of[begin]
            run = pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (begin - first[run_text], end - begin, period)], names=RUN.names
            )
            runs = _listed(np.bincount(run_text, minlength=batch.num_rows), run)
            left = _listed(np.bincount(text_of[kept], minlength=batch.num_rows), words.filter(pa.array(kept)))
            return [pa.array(counts, pa.int64()), runs, pc.binary_join(left, " ")]

        return compute

    return annotate(docs, start, FIELDS, text, SLICE_BYTES)
