"""Importance resampling of documents towards a target text collection.

Features are runs of consecutive words, hashed into buckets by CRC-32. How much more
often a bucket occurs in the target than in the documents is its gain; the mean gain of
a document's features, plus Gumbel noise from its key, is its score, and the documents
with the greatest scores are drawn (a draw without replacement, in proportion to the
weights).

CRC-32 is linear: the checksum of a span is the XOR of what each byte contributes, which
depends on the byte and its distance from the span's end alone, and of a constant for the
span's length. `POSITIONS` holds the contributions for `BLOCK` distances, so all spans of
a batch are hashed by one look-up a byte and one `bitwise_xor.reduceat`. A longer span is
cut into blocks from its end, and neighbouring blocks are folded in pairs: the left one is
moved by the right one's length, which is a linear map of 32 bits, tabulated by byte.

Defined results: null texts, and texts without words, have no features and weight 0;
equal rows get equal scores, and ranks in a row; a null key counts as the empty text;
columns of the input stay, but for those that have the name of an added one.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from ticketmart.llm.common import Compute, annotate, slices, stored, without

BLOCK = 256
# Bytes of words that one round of hashing holds.
ROUND_BYTES = 1 << 20
FIELDS = [StructField(name, LongType()) for name in ("n_words", "n_features", "weight")]

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


# CRC-32 of spans.


def _step_table() -> np.ndarray:
    zero = zlib.crc32(b"\0")
    return np.array([zlib.crc32(bytes([byte])) ^ zero for byte in range(256)], np.uint32)


def _position_table() -> np.ndarray:
    """What a byte contributes, [distance from the end * 256 + byte]."""
    step = _step_table()
    rows = [step]
    for _ in range(BLOCK - 1):
        last = rows[-1]
        rows.append((last >> np.uint32(8)) ^ step[last & np.uint32(255)])
    return np.concatenate(rows)


POSITIONS = _position_table()
_SHORT_LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)


@cache
def _shift_table(level: int) -> np.ndarray:
    """Moves a checksum by BLOCK * 2**level zero bytes, [4, 256]: XOR over its four bytes."""
    if level == 0:
        step = _step_table()
        basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(BLOCK):
            basis = (basis >> np.uint32(8)) ^ step[basis & np.uint32(255)]
    else:
        basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(2):
            basis = _shifted(basis, level - 1)
    table = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        byte, place = divmod(bit, 8)
        table[byte, (np.arange(256) >> place & 1) == 1] ^= basis[bit]
    return table


def _shifted(values: np.ndarray, level: int) -> np.ndarray:
    table = _shift_table(level)
    moved = table[0, values & np.uint32(255)]
    for byte in (1, 2, 3):
        moved = moved ^ table[byte, (values >> np.uint32(8 * byte)) & np.uint32(255)]
    return moved


def _length_constants(lengths: np.ndarray) -> np.ndarray:
    if len(lengths) == 0 or lengths.max() <= BLOCK:
        return _SHORT_LENGTHS[lengths]
    distinct, which = np.unique(lengths, return_inverse=True)
    return np.array([zlib.crc32(bytes(int(n))) for n in distinct], np.uint32)[which]


def span_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] for spans in ascending order that do not overlap or are empty.

    `data` has one byte more than the last span needs.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint32)
    lengths = ends - starts
    blocks = (lengths + BLOCK - 1) // BLOCK
    if blocks.max() > 1:
        first = np.cumsum(blocks) - blocks
        nth = np.arange(blocks.sum()) - np.repeat(first, blocks)
        block_ends = np.repeat(ends, blocks) - BLOCK * (np.repeat(blocks, blocks) - 1 - nth)
        block_starts = np.maximum(np.repeat(starts, blocks), block_ends - BLOCK)
    else:
        block_starts, block_ends = starts, ends
    base = int(block_starts[0])
    region = data[base : int(block_ends[-1]) + 1]
    to_next = np.diff(block_starts, append=base + len(region))
    distance = np.repeat(block_ends - 1, to_next) - np.arange(base, base + len(region))
    # Bytes between two spans have a distance below 0; they are looked up and left out.
    contributions = POSITIONS[((distance & (BLOCK - 1)) << 8) | region]
    bounds = np.empty(2 * len(block_starts), np.int64)
    bounds[::2], bounds[1::2] = block_starts - base, block_ends - base
    folded = np.bitwise_xor.reduceat(contributions, bounds)[::2]
    if blocks.max() > 1:
        folded = _fold(folded, blocks)
    return folded ^ _length_constants(lengths)


def _fold(values: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """XOR of each span's blocks, each moved by the bytes behind it; pairs from the end."""
    # From the end, so that the last block comes first and a lone one needs no partner.
    first = np.cumsum(blocks) - blocks
    nth = np.arange(len(values)) - np.repeat(first, blocks)
    values = values[np.repeat(first + blocks - 1, blocks) - nth]
    level = 0
    while blocks.max() > 1:
        left = (nth & 1) == 1
        values[left] = _shifted(values[left], level)
        values = np.bitwise_xor.reduceat(values, np.flatnonzero(~left))
        blocks = (blocks + 1) // 2
        first = np.cumsum(blocks) - blocks
        nth = np.arange(len(values)) - np.repeat(first, blocks)
        level += 1
    return values


# Features.


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words with one blank behind each, where they begin and end, and their texts."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    text_starts = np.cumsum([0, *[len(text) + 1 for text in texts[:-1]]])
    text_of = np.searchsorted(text_starts, starts, "right") - 1
    inside = inside.copy()
    inside[ends] = True
    packed = np.append(data[inside], np.uint8(0))
    lengths = ends - starts
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    packed[ends] = 0x20
    return packed, starts, ends, text_of


def feature_buckets(texts: list[bytes], buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the features of some texts, with the number of the text, in rounds."""
    packed, starts, ends, text_of = _words(texts)
    if len(starts) == 0:
        return
    rounds = np.flatnonzero(np.diff(starts // ROUND_BYTES, prepend=-1)).tolist()
    for low, high in zip(rounds, [*rounds[1:], len(starts)], strict=True):
        for size in range(1, longest + 1):
            # Spans of `size` words that begin at every size-th word do not overlap.
            for phase in range(size):
                begin = np.arange(low + phase, high, size)
                begin = begin[begin + size <= len(starts)]
                begin = begin[text_of[begin] == text_of[begin + size - 1]]
                found = span_checksums(packed, starts[begin], ends[begin + size - 1])
                yield found % np.uint32(buckets), text_of[begin]


def _texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    column = batch.column(text)
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text: str, buckets: int, longest: int) -> np.ndarray:
    """How many features of all texts lie in each bucket.

    A task sends one row a bucket, however many texts it has; the driver gets the sums.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, text, ROUND_BYTES):
                for found, _ in feature_buckets(_texts(part, text), buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    counted = docs.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most `buckets` rows
        total[row["bucket"]] = row["n"]
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of the target's and the documents' share of each bucket, in 1/1000."""
    size, raw_total, target_total = len(raw), int(raw.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (raw_total + size) / ((s + 1) * (target_total + size))))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighted(
    docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text", buckets: int = 10_000, longest: int = 2
) -> DataFrame:
    """Add `n_words`, `n_features` and `weight`, the floored mean gain of a text's features."""
    gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))

    def start() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[np.ndarray]:
            texts = _texts(batch, text)
            words, features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for nth, (found, text_of) in enumerate(feature_buckets(texts, buckets, longest)):
                present = np.bincount(text_of, minlength=len(texts))
                features += present
                if nth % (longest * (longest + 1) // 2) == 0:  # the single words of a round
                    words += present
                np.add.at(total, text_of, gain[found])
            return [words, features, total // np.maximum(features, 1)]

        return compute

    return annotate(docs, start, FIELDS, text, ROUND_BYTES)


def noisy(frame: DataFrame, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """Add `score`: the weight plus Gumbel noise, in 1/1000, that depends on seed and key alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((number + 0.5) / 4294967296.0)))
    return without(frame, ["score"]).withColumn("score", F.col("weight") + noise)


def drawn(scored: DataFrame, percent: int, least_words: int, key: str = "doc_id") -> DataFrame:
    """Add `rank` (1, 2, 3...) to the floored share of greatest scores, null to all other rows.

    Only rows of at least `least_words` words take part; ties go to the smaller key. Rows
    are sorted over all tasks and numbered within each; what earlier tasks hold is added,
    one number a task.
    """
    scored = without(scored, ["rank"])
    columns = [F.col(f"`{name}`") for name in scored.columns]
    # The row lies in a column of its own, so that its names cannot clash with those below.
    enough = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    rows = scored.select(F.struct(*columns).alias("row"), enough.alias("enough"), "score", F.col(f"`{key}`").alias("key"))
    rows = stored(rows, "scores")
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    # The last key parts equal rows: a repeated key may hold any share of the rows.
    placed = rows.where("enough").withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*order, "spread")
    placed = placed.sortWithinPartitions(*order, "spread").select("row", F.monotonically_increasing_id().alias("place"))
    placed = stored(placed, "placed")
    task, nth = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()  # one row a task
    before, total = [], 0
    for row in sorted(sizes, key=lambda row: row["task"]):
        before.append((row["task"], total))
        total += row["n"]
    wanted = total * percent // 100
    offsets = scored.sparkSession.createDataFrame(before, "task long, before long")
    rank = F.col("before") + nth + 1
    numbered = placed.withColumn("task", task).join(F.broadcast(offsets), "task", "left")
    numbered = numbered.select("row", F.when(rank <= wanted, rank).alias("rank"))
    rest = rows.where("NOT enough").select("row", F.lit(None).cast("long").alias("rank"))
    return numbered.unionByName(rest).select("row.*", "rank")


def resampled(docs: DataFrame, target: DataFrame, percent: int, *, least_words: int = 20, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """The drawn documents with all their columns, weights, scores and ranks."""
    scored = noisy(weighted(docs, target), key, seed)
    return drawn(scored, percent, least_words, key).where("rank IS NOT NULL")

