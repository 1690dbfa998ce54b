"""Packing of tokenised documents into sequences, planned by non-negative least squares.

1. Each document becomes token ids and an end id. Whole windows are sequences of their
   own; what is left of a document is shorter than a window.
2. The lengths of these rests make a histogram, of fewer bins than a window has tokens.
   The plan is made from it alone: all combinations of two or three lengths that fill a
   window are enumerated, non-negative least squares finds how often to repeat each so
   that the histogram is used up, and the counts are rounded within what there is.
3. The lengths left over are packed greedily: the longest with the longest that still
   fit, as often as there are enough of them to fill windows exactly. What cannot be
   filled so is laid end to end and cut at each window's end; the tail is cut into powers
   of two, which need no padding. So no sequence is padded.
4. Rests of one length are numbered over all tasks, and the plan tells from length and
   number where a rest goes. Tasks look it up by themselves: nothing is gathered, and no
   length is too frequent.

Defined results: a null text is empty and has the end id alone; equal rows are packed one
by one; an empty table gives no rows. Columns of the input (one at least, beside the
text) stay, but for those that have the name of an added one.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ticketmart.llm.common import slices, stored, texts_of, without
from ticketmart.llm.tokens import _byte_names

WINDOW = 1024
END_ID = 0
PIECE = [StructField(name, LongType()) for name in ("start", "length", "doc_tokens", "sequence_id", "offset")]
IDS = StructField("ids", BinaryType())  # little-endian unsigned 32-bit

Encode = Callable[[list[str]], list[np.ndarray]]


# Token ids.


@lru_cache(maxsize=2)
def encoder(content: str) -> Encode:
    """Function from texts to token ids, for the content of a tokenizer file.

    A plain byte-level BPE whose ids follow its merges gives the same ids in tiktoken,
    several times as fast; a test compares both over all characters. Any other file is
    run by the library it is made for.
    """
    spec = json.loads(content)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex")
        and not cut.get("add_prefix_space")
        and spec["normalizer"] is None
        and not any(token[x] for token in spec["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if plain:
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        vocabulary = {token: i for token, i in model["vocab"].items() if token not in added}
        merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        plain = [vocabulary[token] for token in merged] == list(range(len(vocabulary) - len(merged), len(vocabulary)))
    if not plain:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(content)
        return lambda texts: [np.array(e.ids, np.uint32) for e in library.encode_batch(texts, add_special_tokens=False)]

    import tiktoken

    names = _byte_names()
    ranks = {bytes(names[c] for c in token): i for token, i in vocabulary.items()}
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    specials = set(added)
    return lambda texts: [encoding.encode_to_numpy(text, allowed_special=specials, disallowed_special=()) for text in texts]


# Plan.


def combinations(window: int, present: np.ndarray) -> tuple[np.ndarray, ...]:
    """All i >= j >= k > 0 with i + j + k = window, and i >= j with k = 0, of present lengths."""
    i, j = (x.ravel() for x in np.meshgrid(np.arange(window), np.arange(window), indexing="ij"))
    k = window - i - j
    there = np.append(present[:window], False).copy()
    there[0] = False
    chosen = (i >= j) & (j >= k) & (k >= 0) | (i >= j) & (k == 0)
    i, j, k = i[chosen], j[chosen], k[chosen]
    whole = there[i] & there[j] & (there[k] | (k == 0))
    return i[whole], j[whole], k[whole]


def repeat_counts(parts: tuple[np.ndarray, ...], histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x that minimises |A x - histogram|^2, A's columns being the combinations.

    Projected gradient steps with momentum; A is never made, its product is a count.
    """
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(part, x, size) for part in parts)
        total[0] = 0  # the third of a pair
        return total

    def gradient(rest: np.ndarray) -> np.ndarray:
        return sum(rest[part] for part in parts)

    count = len(parts[0])
    probe = np.ones(count)
    steepest = 1.0
    for _ in range(30):
        probe = gradient(used(probe))
        steepest = float(np.linalg.norm(probe))
        probe /= steepest
    x = ahead = np.zeros(count)
    momentum = 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - gradient(used(ahead) - histogram) / steepest, 0)
        if np.dot(ahead - new, new - x) > 0:
            momentum = 1.0
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


def _rounded(x: np.ndarray, parts: tuple[np.ndarray, ...], left: np.ndarray) -> np.ndarray:
    """Whole counts that keep the running sum of x, within the lengths there are; `left` shrinks."""
    wanted = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0).astype(np.int64)
    for at in np.flatnonzero(wanted):
        lengths, times = np.unique([int(part[at]) for part in parts if part[at]], return_counts=True)
        wanted[at] = min(wanted[at], int((left[lengths] // times).min()))
        left[lengths] -= wanted[at] * times
    return wanted


def _greedy(left: np.ndarray, window: int) -> Iterator[tuple[list[int], int]]:
    """Lengths that fill a window and how often, longest first; `left` keeps what fills none."""
    pool = left.copy()
    left[:] = 0
    for longest in range(window - 1, 0, -1):
        while pool[longest]:
            chosen, gap = {longest: 1}, window - longest
            for length in range(min(gap, longest), 0, -1):
                fit = min(gap // length, int(pool[length]) - chosen.get(length, 0))
                if fit > 0:
                    chosen[length] = chosen.get(length, 0) + fit
                    gap -= fit * length
                if gap == 0:
                    break
            if gap:
                left[longest] += pool[longest]
                pool[longest] = 0
                break
            count = min(int(pool[length]) // times for length, times in chosen.items())
            for length, times in chosen.items():
                pool[length] -= count * times
            yield [length for length, times in chosen.items() for _ in range(times)], count


@dataclass
class Plan:
    """Where the rests go. `keys` (length << 40 | first number) are in ascending order."""

    window: int
    keys: np.ndarray
    sequence: np.ndarray  # of the first number; of a stream entry, the position in the stream
    offset: np.ndarray
    streamed: np.ndarray
    first_streamed: int  # sequence id of the stream's first window
    bounds: np.ndarray  # where the stream's tail is cut, beyond its last whole window
    sequences: int  # planned sequences in all


def planned(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """The plan for histogram[l] rests of each length l below the window."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    parts = combinations(window, left > 0)
    bundles: list[tuple[list[int], int]] = []
    if len(parts[0]):
        counts = _rounded(repeat_counts(parts, left.astype(float)), parts, left)
        for at in np.flatnonzero(counts):
            bundles.append(([int(part[at]) for part in parts if part[at]], int(counts[at])))
    bundles += _greedy(left, window)
    entries, numbered, sequence = [], np.zeros(window, np.int64), 0
    for lengths, count in bundles:
        offset = 0
        for length in lengths:
            entries.append((length << 40 | int(numbered[length]), sequence, offset, False))
            numbered[length] += count
            offset += length
        sequence += count
    position = 0
    for length in np.flatnonzero(left)[::-1].tolist():
        entries.append((length << 40 | int(numbered[length]), position, length, True))
        position += int(left[length]) * length
    whole, rest = divmod(position, window)
    # The tail as powers of two, the greatest first; each is a sequence of its own.
    powers = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    bounds = whole * window + np.cumsum([0, *powers])
    columns = list(zip(*sorted(entries), strict=True)) or [(), (), (), ()]
    keys, where, offsets, streamed = (np.array(c, t) for c, t in zip(columns, (np.int64, np.int64, np.int64, bool), strict=True))
    return Plan(window, keys, where, offsets, streamed, sequence, bounds, sequence + whole + len(powers))


def placed(plan: Plan, length: int, number: int, entry: int) -> list[tuple[int, int, int]]:
    """The pieces (length, sequence id, offset) of a rest, in order."""
    nth = number - (int(plan.keys[entry]) & (1 << 40) - 1)
    if not plan.streamed[entry]:
        return [(length, int(plan.sequence[entry]) + nth, int(plan.offset[entry]))]
    at = int(plan.sequence[entry]) + nth * length
    end, tail, pieces = at + length, int(plan.bounds[0]), []
    while at < end:
        if at < tail:
            window = at // plan.window
            begin, until, sequence = window * plan.window, (window + 1) * plan.window, window
        else:
            power = int(np.searchsorted(plan.bounds, at, "right")) - 1
            begin, until, sequence = int(plan.bounds[power]), int(plan.bounds[power + 1]), tail // plan.window + power
        size = min(end, until) - at
        pieces.append((size, plan.first_streamed + sequence, at - begin))
        at += size
    return pieces


# Jobs.


def read_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def stored_width(content: str, end_id: int) -> str:
    """Type of the stored ids: two bytes where all ids of the tokenizer file fit."""
    spec = json.loads(content)
    ids = [*spec["model"]["vocab"].values(), *(token["id"] for token in spec["added_tokens"]), end_id]
    return "<u2" if max(ids) < 1 << 16 else "<u4"


def tokenised(docs: DataFrame, path: str, text: str, window: int, end_id: int) -> DataFrame:
    """Rows with their ids, the length of the rest, and what the task had before of either.

    `number` counts the rests of one length in a task, `window_number` its whole windows.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_file(path))
    width = stored_width(content.value, end_id)
    kept = without(docs, [text, IDS.name, *(f.name for f in PIECE)]).columns
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    names = ("task", "rest", "number", "window_number")
    schema = StructType([frame.schema["row"], StructField("ids", BinaryType()), *(StructField(n, LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value)
        task, seen, windows = TaskContext.get().partitionId(), np.zeros(window, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [np.append(found, np.uint32(end_id)).astype(width) for found in encode(texts_of(part))]
                columns = []
                for found in ids:
                    whole, rest = divmod(len(found), window)
                    columns.append((task, rest, int(seen[rest]), windows))
                    seen[rest] += 1
                    windows += whole
                numbers = [pa.array(column, pa.int64()) for column in zip(*columns, strict=True)]
                packed = pa.array([found.tobytes() for found in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("row"), packed, *numbers], names=schema.names)

    return frame.mapInArrow(run, schema)


def packed(docs: DataFrame, path: str, *, text: str = "text", window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents: columns of the input but the text, with the piece's
    place in the document (`start`, `length`, `doc_tokens`) and in the sequences
    (`sequence_id`, `offset`), and its `ids`.
    """
    spark = docs.sparkSession
    rows = stored(tokenised(docs, path, text, window, end_id), "tokenised")
    # At most as many rows a task as a window has lengths.
    counts = stored(rows.groupBy("task", "rest").agg(F.count("*").alias("n")), "rests")
    histogram = np.zeros(window, np.int64)
    for row in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # a row a length
        histogram[row["rest"]] = row["n"]
    plan = spark.sparkContext.broadcast(planned(histogram, window))
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = rows.join(before, ["task", "rest"]).select(
        "row", "ids", "task", "rest", "window_number", (F.col("number") + F.col("before")).alias("number")
    )
    schema = StructType([numbered.schema["row"], *PIECE, IDS])
    width = stored_width(read_file(path), end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = plan.value
        for batch in batches:
            for part in slices(batch, "ids"):
                rests, numbers, tasks, windows = (
                    part.column(name).to_numpy().astype(np.int64) for name in ("rest", "number", "task", "window_number")
                )
                entries = np.searchsorted(at.keys, rests << 40 | numbers, "right") - 1
                owners, pieces, ids = [], [], []
                for i, found in enumerate(part.column("ids").to_pylist()):
                    found = np.frombuffer(found, width).astype("<u4")
                    tokens, rest, start = len(found), int(rests[i]), 0
                    # Whole windows are numbered by task, beyond all planned sequences.
                    first = (int(tasks[i]) + 1 << 40) + int(windows[i])
                    places = [(window, first + nth, 0) for nth in range(tokens // window)]
                    if rest:
                        places += placed(at, rest, int(numbers[i]), int(entries[i]))
                    for length, sequence, offset in places:
                        owners.append(i)
                        pieces.append((start, length, tokens, sequence, offset))
                        ids.append(found[start : start + length].tobytes())
                        start += length
                row = part.column("row").take(pa.array(owners, pa.int64()))
                columns = [pa.array(column, pa.int64()) for column in zip(*pieces, strict=True)]
                yield pa.RecordBatch.from_arrays([row, *columns, pa.array(ids, pa.binary())], names=schema.names)

    return numbered.mapInArrow(run, schema).select("row.*", *[f.name for f in PIECE], IDS.name)
