"""Token counts by a tokenizer compiled into finite-state transducers.

A byte-level BPE tokenizer cuts a text into pre-tokens by a pattern, and each of them
into tokens by ranked merges. Both steps become deterministic transducers:

- The pattern is a transducer of eight states over nine kinds of characters. Its
  transitions are annotated with 1 where a pre-token begins. A text is cut into
  blocks; each block becomes a map from entry state to exit state. The maps compose,
  so a parallel prefix scan over them gives every block's entry state, and all blocks
  are then read at the same time.
- The merges are a transducer over bytes that grows while it runs. The state after a
  prefix knows the last token of the prefix's encoding, which is the longest token
  that ends there and may follow the last token of what comes before it. A transition
  is annotated with the change of the token count that its byte brings.

Both are exact; the second is bounded by `MAX_STATES` and starts anew beyond it.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from ticketmart.llm.common import annotate, texts_of

MAX_STATES = 500_000
MAX_CACHED = 800_000
# Longer prefixes are walked without keeping their states.
MAX_DEPTH = 48

# Kinds of characters. A white-space character is LAST if another kind follows it.
LETTER, NUMBER, OTHER, LAST_BLANK, LAST_SPACE, SPACE, SHORT, LONG, PAD = range(9)
# States, after what was read: a run of letters, numbers, others or white space, a
# blank that the next run takes in, one or two characters of a contraction to come,
# and a finished pre-token.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, BLANK, ONE_LEFT, TWO_LEFT, DONE = range(8)
STATES = 8
BLOCK = 128


def _pattern_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted count, [kind, state]; kinds from PAD + 1 on begin a text."""
    to = np.zeros((2 * PAD + 1, STATES), np.uint8)
    emits = np.ones((2 * PAD + 1, STATES), np.uint8)
    after = {
        LETTER: IN_LETTERS,
        NUMBER: IN_NUMBERS,
        OTHER: IN_OTHERS,
        LAST_BLANK: BLANK,
        LAST_SPACE: DONE,
        SPACE: IN_SPACES,
        SHORT: ONE_LEFT,
        LONG: TWO_LEFT,
    }
    for kind, state in after.items():
        to[kind] = state
        emits[kind, ONE_LEFT] = emits[kind, TWO_LEFT] = 0
        to[kind, ONE_LEFT], to[kind, TWO_LEFT] = DONE, ONE_LEFT
    for kind, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS), (SPACE, IN_SPACES)):
        emits[kind, run] = 0
    for kind in (LETTER, NUMBER, OTHER, SHORT, LONG):
        emits[kind, BLANK] = 0
    for kind in (SHORT, LONG):  # an apostrophe inside a run of others begins no contraction
        to[kind, IN_OTHERS] = to[kind, BLANK] = IN_OTHERS
        emits[kind, IN_OTHERS] = 0
    to[PAD] = np.arange(STATES)
    emits[PAD] = 0
    for kind in range(PAD):
        to[PAD + 1 + kind] = to[kind, DONE]
        emits[PAD + 1 + kind] = emits[kind, DONE]
    return to.ravel(), emits.ravel()


def _kinds_of_points() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        group = unicodedata.category(chr(point))[0]
        if group == "L":
            kinds[point] = LETTER
        elif group == "N":
            kinds[point] = NUMBER
    # White_Space of Unicode.
    for point in [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        kinds[point] = SPACE
    return kinds


_TO, _EMITS = _pattern_transducer()
_KINDS: list[np.ndarray] = []


def _followed(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next character and the one after it, 0 beyond the end of a text."""
    one = np.append(points[1:], 0).astype(points.dtype)
    one[ends] = 0
    two = np.append(one[1:], 0).astype(points.dtype)
    two[ends] = 0
    return one, two


def kinds(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Kinds of the characters of texts laid end to end; `begins` has their first places."""
    if not _KINDS:
        _KINDS.append(_kinds_of_points())
    out = _KINDS[0][points]
    ends = np.append(begins[1:], len(points)) - 1
    one, two = _followed(points, ends)
    space = out == SPACE
    last = space & ~np.append(space[1:], False)
    last[ends] = False
    out[last] = np.where(points[last] == 32, LAST_BLANK, LAST_SPACE)
    quote = points == ord("'")
    if quote.any():
        short = quote & np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
        r, v, e, l = (ord(c) for c in "rvel")  # noqa: E741
        long = quote & (((one == r) | (one == v)) & (two == e) | (one == l) & (two == l))
        out[short], out[long] = SHORT, LONG
    out[begins] += PAD + 1
    return out


def pretoken_starts(symbols: np.ndarray) -> np.ndarray:
    """Places where the transducer emits, by a prefix scan over the maps of blocks."""
    n = len(symbols)
    padded = np.full(-(-n // BLOCK) * BLOCK, PAD, np.uint8)
    padded[:n] = symbols
    steps = np.ascontiguousarray(padded.reshape(-1, BLOCK).T) * np.uint8(STATES)
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], steps.shape[1], 1)
    for step in steps:
        maps = _TO.take(maps + step)
    reach = 1
    while reach < maps.shape[1]:
        maps = np.hstack((maps[:, :reach], np.take_along_axis(maps[:, reach:], maps[:, :-reach], 0)))
        reach *= 2
    state = np.append(DONE, maps[DONE, :-1]).astype(np.uint8)
    emitted = np.empty(steps.shape, np.uint8)
    for i, step in enumerate(steps):
        at = step + state
        emitted[i] = _EMITS.take(at)
        state = _TO.take(at)
    return np.flatnonzero(emitted.T.ravel()[:n])


def _byte_names() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE files write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(byte): byte for byte in plain}
    for i, byte in enumerate(b for b in range(256) if b not in set(plain)):
        names[chr(256 + i)] = byte
    return names


class Merges:
    """Token counts of pre-tokens; a mapping from pre-token to count."""

    def __init__(self, merges: list[tuple[bytes, bytes]]) -> None:
        self.tokens = {bytes([b]): b for b in range(256)}
        self.rank: dict[int, int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for i, (left, right) in enumerate(merges):
            a, b = self.tokens[left], self.tokens[right]
            self.rank[a << 32 | b] = i
            self.made.setdefault(self.tokens.setdefault(left + right, len(self.tokens)), (a, b, i))
        # The longest token that ends in three given bytes.
        self.reach: dict[bytes, int] = {}
        for token in self.tokens:
            if len(token) > 2:
                self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 2))
        self.edges: dict[int, list[tuple[int, int, int]]] = {}
        self.fits: dict[int, bool] = {}
        self._begin()

    def _begin(self) -> None:
        self.next: dict[int, int] = {}
        self.last = [-1]
        self.count = [0]

    def edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The parts that stand at one edge of a token while it is put together.

        Each with the rank of the merge that makes it and of the one that uses it up.
        """
        key = token << 1 | side
        found = self.edges.get(key)
        if found is None:
            found, used = [], 1 << 60
            while True:
                made = self.made.get(token)
                found.append((token, made[2] if made else -1, used))
                if not made:
                    break
                token, used = made[side], made[2]
            self.edges[key] = found
        return found

    def follows(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their bytes stand side by side.

        They do unless two parts that face each other at the same time have a merge that
        comes first. Of equal merges the one further left comes first.
        """
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > MAX_STATES:
                self.fits.clear()
            found, rank, inner = True, self.rank, self.edge(right, 0)
            for a, a_made, a_used in self.edge(left, 1):
                for b, b_made, b_used in inner:
                    k = rank.get(a << 32 | b)
                    if k is not None and a_made < k < a_used and b_made < k <= b_used:
                        found = False
            self.fits[key] = found
        return found

    def counted(self, text: bytes) -> int:
        if len(self.last) > MAX_STATES:
            self._begin()
        known, last_of, count_of = self.next, self.last, self.count
        tokens, reach, fits = self.tokens.get, self.reach.get, self.fits.get
        state, lasts, counts = 0, [-1], [0]
        for i, byte in enumerate(text, 1):
            to = known.get(state << 8 | byte)
            if to is None:
                for size in range(min(i, reach(text[i - 3 : i], 2)) if i > 2 else i, 0, -1):
                    token = tokens(text[i - size : i])
                    if token is not None:
                        left = lasts[i - size]
                        fit = left < 0 or fits(left << 32 | token)
                        if fit is None:
                            fit = self.follows(left, token)
                        if fit:
                            break
                lasts.append(token)
                counts.append(counts[i - size] + 1)
                if i <= MAX_DEPTH:
                    known[state << 8 | byte] = to = len(last_of)
                    last_of.append(token)
                    count_of.append(counts[i])
                else:
                    to = -1 << 40
            else:
                lasts.append(last_of[to])
                counts.append(count_of[to])
            state = to
        return counts[-1]


class Cache(dict):
    """Counts of pre-tokens seen so far, bounded."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merges = merges

    def __missing__(self, pretoken: str) -> int:
        count = self.merges.counted(pretoken.encode())
        if len(self) >= MAX_CACHED:
            self.clear()
        if len(pretoken) <= 256:
            self[pretoken] = count
        return count


def compiled(path: str) -> tuple[list[tuple[bytes, bytes]], list[str]]:
    """Merges and special strings of a byte-level BPE tokenizer file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    names = _byte_names()
    as_bytes = lambda token: bytes(names[c] for c in token)
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in content["model"]["merges"]]
    return [(as_bytes(a), as_bytes(b)) for a, b in pairs], [t["content"] for t in content["added_tokens"]]


def counter(model: tuple[list[tuple[bytes, bytes]], list[str]]):
    """Function from texts to their token counts."""
    merges, specials = model
    cache = Cache(Merges(merges))

    def count(texts: list[str]) -> np.ndarray:
        pieces, owners = [], []
        totals = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            for special in specials:
                if special in text:
                    parts = [p for part in parts for p in part.split(special)]
            totals[i] = len(parts) - 1
            for part in filter(None, parts):
                pieces.append(part)
                owners.append(i)
        if not pieces:
            return totals
        whole = "".join(pieces)
        begins = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = pretoken_starts(kinds(points, begins[:-1]))
        cuts = [*starts.tolist(), len(whole)]
        found = map(cache.__getitem__, [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
        counts = np.fromiter(found, np.int64, len(starts))
        owner = np.array(owners)[np.searchsorted(begins, starts, "right") - 1]
        return totals + np.bincount(owner, counts, len(texts)).astype(np.int64)

    return count


def counted(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add `n_bytes` and `n_tokens` to documents.

    A null text counts as empty and has no token. The text of a special token inside a
    document is one token, as it is for the library. Texts are read whole, and rows are
    independent of each other; the tokenizer file is read on the driver.
    """
    shared = docs.sparkSession.sparkContext.broadcast(compiled(path))

    def start():
        count = counter(shared.value)

        def compute(batch: pa.RecordBatch) -> list:
            texts = texts_of(batch, text)
            return [[len(t.encode()) for t in texts], count(texts)]

        return compute

    return annotate(docs, start, [StructField("n_bytes", LongType(), False), StructField("n_tokens", LongType(), False)], text)
