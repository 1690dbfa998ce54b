"""A class-based bigram model of language: exchange clustering, transitions, emissions.

The lexicon of all training words stays in Spark. Two passes over the texts make it:

1. Tasks count words together with the hashed words to their left and right; counts
   are merged by word. Exchange sweeps then move every word to the class under which
   its neighbours are likeliest. A sweep reads the lexicon and gathers one table of
   classes by contexts, which is all that the next sweep needs.
2. Documents are dealt into blocks of bounded size. A block asks for the counts and
   classes of just its own distinct words, so no task ever holds the lexicon.

The probability of a word is that of its class after the class before it, times that of
the word in its class. Each class sets mass aside for one unseen word.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from ticketmart.llm.common import annotate, discard, slices, split_lower_words, stored, texts_of

CLASSES = 32
CONTEXTS = 32  # hashed neighbours on each side
SWEEPS = 4
SMOOTHING = 0.1
BLOCK_BYTES = 6 << 20
# Weight of the class unigram against the counted transitions from a class.
PRIOR = 50.0
UNKNOWN, BEGIN = CLASSES, CLASSES + 1


def _numbers() -> dict[bytes | str, int]:
    """Numbers for words in the order of their appearance."""
    return defaultdict(itertools.count().__next__)


def _numbered(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the numbers of all words in order, and words per text."""
    numbers = _numbers()
    parts = [split_lower_words(text) for text in texts]
    sizes = np.array([len(part) for part in parts], np.int64)
    ids = np.fromiter(map(numbers.__getitem__, itertools.chain.from_iterable(parts)), np.int64, int(sizes.sum()))
    return list(numbers), ids, sizes


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _packed(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values of each row side by side as bytes; `offsets` counts values."""
    ends = pa.py_buffer((offsets * values.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(values.tobytes())])


def _unpacked(column: pa.Array, kind: str) -> np.ndarray:
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    if ends[-1] == ends[0]:
        return np.zeros(0, kind)
    return np.frombuffer(column.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes(), kind)


# Contexts are single bytes; a slice counts in four bytes each, the lexicon in eight.
_COUNTS = "word string, n long, contexts binary, times binary"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 2 * BLOCK_BYTES):
            words, ids, sizes = _numbered(texts_of(part))
            if not words:
                continue
            bucket = np.array([xxhash.xxh3_64_intdigest(word) % CONTEXTS for word in words], np.int64)
            follows = np.ones(len(ids), bool)
            starts = np.cumsum(sizes) - sizes
            follows[starts[starts < len(ids)]] = False
            at = np.flatnonzero(follows)
            left = ids[at] * (2 * CONTEXTS) + bucket[ids[at - 1]]
            right = ids[at - 1] * (2 * CONTEXTS) + CONTEXTS + bucket[ids[at]]
            pairs, times = np.unique(np.concatenate((left, right)), return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(words) + 1) * (2 * CONTEXTS))
            yield pa.RecordBatch.from_arrays(
                [
                    _strings(words),
                    pa.array(np.bincount(ids, minlength=len(words)), pa.int64()),
                    _packed(offsets, (pairs % (2 * CONTEXTS)).astype(np.uint8)),
                    _packed(offsets, times.astype("<u4")),
                ],
                names=["word", "n", "contexts", "times"],
            )


def _flat(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, context and count of the packed contexts of a batch."""
    contexts = batch.column("contexts")
    ends = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset : contexts.offset + len(contexts) + 1]
    rows = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    return rows, _unpacked(contexts, "u1").astype(np.int64), _unpacked(batch.column("times"), kind)


def _merge_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the counts of a partition that has all rows of its words."""
    numbers = _numbers()
    totals: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def add_up() -> None:
        keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        found[:] = [(keys, np.bincount(back, np.concatenate([t for _, t in found])))]

    for batch in batches:
        ids = np.fromiter(map(numbers.__getitem__, batch.column("word").to_numpy(zero_copy_only=False)), np.int64, batch.num_rows)
        totals.append(np.bincount(ids, batch.column("n").to_numpy()))
        rows, contexts, times = _flat(batch, "<u4")
        found.append((ids[rows] * (2 * CONTEXTS) + contexts, times.astype(np.float64)))
        held += len(rows)
        if held > 4_000_000:
            add_up()
            held = 0
    if not numbers:
        return
    add_up()
    keys, times = found[0]
    n = np.zeros(len(numbers))
    for part in totals:
        n[: len(part)] += part
    words = list(numbers)
    step = 20_000
    for a in range(0, len(words), step):
        b = min(a + step, len(words))
        offsets = np.searchsorted(keys, np.arange(a, b + 1) * (2 * CONTEXTS))
        inside = slice(offsets[0], offsets[-1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(words[a:b], pa.string()),
                pa.array(n[a:b].astype(np.int64)),
                _packed(offsets - offsets[0], (keys[inside] % (2 * CONTEXTS)).astype(np.uint8)),
                _packed(offsets - offsets[0], times[inside].astype("<u8")),
            ],
            names=["word", "n", "contexts", "times"],
        )


def placed(batch: pa.RecordBatch, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a batch of the lexicon after the sweeps so far, and its context counts.

    A word starts in the class of its commonest context. In each sweep half of the
    words, by hash, may move. A word's own counts are taken out of its class before the
    classes are compared, as an exchange would do.
    """
    rows, contexts, times = _flat(batch, "<u8")
    counts = np.zeros((batch.num_rows, 2 * CONTEXTS), np.float32)
    counts[rows, contexts] = times
    classes = (counts[:, :CONTEXTS] + counts[:, CONTEXTS:]).argmax(1) % CLASSES
    if not tables:
        return classes, counts
    half = np.fromiter((xxhash.xxh3_64_intdigest(w, 1) & 1 for w in batch.column("word").to_numpy(zero_copy_only=False)), np.int64, len(classes))
    total = counts.sum(1)
    everyone = np.arange(len(classes))
    for sweep, table in enumerate(tables):
        sums = table.sum(1)
        gain = counts @ np.log(table + SMOOTHING).T.astype(np.float32)
        gain -= total[:, None] * np.log(sums + SMOOTHING * 2 * CONTEXTS).astype(np.float32)
        own = np.maximum(table[classes] - counts, 0)
        gain[everyone, classes] = (counts * np.log(own + SMOOTHING)).sum(1) - total * np.log(
            np.maximum(sums[classes] - total, 0) + SMOOTHING * 2 * CONTEXTS
        )
        classes = np.where(half == sweep % 2, gain.argmax(1), classes)
    return classes, counts


def _context_table(lexicon: DataFrame, tables: list[np.ndarray]) -> np.ndarray:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((CLASSES, 2 * CONTEXTS))
        for batch in batches:
            classes, counts = placed(batch, tables)
            np.add.at(sums, classes, counts)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums.ravel()[cells])], names=["cell", "n"])

    rows = lexicon.mapInArrow(add_up, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(CLASSES * 2 * CONTEXTS)
    for row in rows:
        table[row["cell"]] = row["n"]
    return table.reshape(CLASSES, -1)


def classed(training: DataFrame, partitions: int, sweeps: int = SWEEPS) -> DataFrame:
    """The lexicon of training texts: word, n, class."""
    counted = training.select("text").mapInArrow(_count_words, _COUNTS).repartition(partitions, "word")
    lexicon = stored(counted.mapInArrow(_merge_words, _COUNTS), "lexicon")
    tables: list[np.ndarray] = []
    for _ in range(sweeps):
        tables.append(_context_table(lexicon, tables))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, _ = placed(batch, tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(classes.astype(np.int32))], names=["word", "n", "class"]
            )

    classes = stored(lexicon.mapInArrow(place, "word string, n long, class int"), "classes")
    discard(lexicon)
    return classes


def _block_words(texts: list[str]) -> list[bytes]:
    """Distinct words of texts, numbered as by `_numbered` of the sorted texts."""
    return list(dict.fromkeys(itertools.chain.from_iterable(map(split_lower_words, sorted(texts)))))


def _coded(docs: DataFrame, lexicon: DataFrame, blocks: int, base: dict, emit: np.ndarray) -> DataFrame:
    """Documents as classes, with what needs no transition already added up.

    The texts are shuffled once, by block; both uses take all its columns, so that they
    share it. Both number the words of a block alike, so answers come back without words.
    """
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    dealt = dealt.select("block", "doc_id", "held_out", "text")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[str]] = {}
        for batch in batches:
            for block, text in zip(batch.column("block").to_pylist(), texts_of(batch), strict=True):
                held.setdefault(block, []).append(text)
        while held:
            block, texts = held.popitem()
            words = _block_words(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(words), block, np.int32)),
                    pa.array(np.arange(len(words), dtype=np.int32)),
                    _strings(words),
                ],
                names=["block", "at", "word"],
            )

    asked = dealt.mapInArrow(distinct, "block int, at int, word string")
    known = asked.join(lexicon, "word").select("block", "at", "n", "class")
    floor = SMOOTHING * (base["V"] + 1)

    def code(texts: pa.Table, words: pa.Table) -> pa.Table:
        contents = texts_of(texts)
        order = sorted(range(len(contents)), key=contents.__getitem__)
        found, ids, sizes = _numbered([contents[i] for i in order])
        at = words.column("at").to_numpy()
        n = np.zeros(len(found))
        n[at] = words.column("n").to_numpy()
        classes = np.full(len(found), UNKNOWN, np.int64)
        classes[at] = words.column("class").to_numpy()
        logs = np.log10((n + SMOOTHING) / (base["N"] + floor))
        emits = np.where(classes == UNKNOWN, 0.0, np.log10(n + SMOOTHING) - np.append(emit, 0.0)[classes])
        last = math.log10((base["ends"] + SMOOTHING) / (base["N"] + floor))
        rows = {name: [None] * len(contents) for name in ("n_tokens", "n_known", "base_score", "emitted", "classes")}
        for i, part in zip(order, np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [], strict=True):
            chain = classes[part]
            rows["n_tokens"][i] = len(part) + 1
            rows["n_known"][i] = int((chain != UNKNOWN).sum()) + (base["ends"] > 0)
            rows["base_score"][i] = float(logs[part].sum()) + last
            rows["emitted"][i] = float(emits[part].sum())
            rows["classes"][i] = chain.astype(np.uint8).tobytes()
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        columns = [pa.array(values, kind) for values, kind in zip(rows.values(), kinds, strict=True)]
        return pa.Table.from_arrays([texts.column("doc_id"), texts.column("held_out"), *columns], names=["doc_id", "held_out", *rows])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, emitted double, classes binary"
    return stored(
        dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(code, schema),
        "coded",
    )


def _transitions(coded: DataFrame) -> np.ndarray:
    """Counts of a class (or UNKNOWN, or BEGIN) followed by a class, UNKNOWN or the end."""
    size = CLASSES + 2

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * size, np.int64)
        for batch in batches:
            for content in batch.column("classes").to_pylist():
                chain = np.frombuffer(content, np.uint8).astype(np.int64)
                sums += np.bincount(np.append(BEGIN, chain) * size + np.append(chain, BEGIN), minlength=size * size)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], names=["cell", "n"])

    rows = coded.where(~F.col("held_out")).select("classes").mapInArrow(add_up, "cell long, n long")
    counts = np.zeros(size * size)
    for row in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    return counts.reshape(size, size)


def transition_logs(counts: np.ndarray, reserved: np.ndarray) -> np.ndarray:
    """log10 probabilities, [class before, class]; the end stands at BEGIN.

    The column UNKNOWN has the probability of one unseen word: the mass that the
    classes set aside, by the chance of each class. After an unseen word the classes
    have their overall frequencies.
    """
    seen = counts.copy()
    seen[:, UNKNOWN] = 0
    seen[UNKNOWN] = 0
    overall = seen.sum(0) + 1.0
    overall[UNKNOWN] = 0
    overall /= overall.sum()
    chance = (seen + PRIOR * overall) / (seen.sum(1, keepdims=True) + PRIOR)
    chance[:, UNKNOWN] = chance[:, :CLASSES] @ reserved
    return np.log10(chance)


def scored(docs: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """Score documents (doc_id, text, held_out) by a model of those not held out.

    Adds n_tokens (words and one end), n_known, train_tokens, base_score (add-0.1
    unigrams) and score, the log10 probability of the text. A null text is empty: its
    only token is the end. Repeated rows are scored each, and count each if trained on.
    Without training documents every word is unseen.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "held_out")
    size = docs.agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.when(~F.col("held_out"), 1).otherwise(0)).alias("ends")
    ).first()
    blocks = max(1, math.ceil((size["bytes"] or 0) / BLOCK_BYTES))
    lexicon = classed(docs.where(~F.col("held_out")), max(8, blocks // 4), sweeps)
    sums = lexicon.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    ends = size["ends"] or 0
    base = {"N": sum(r["n"] for r in sums) + ends, "V": sum(r["types"] for r in sums) + (ends > 0), "ends": ends}
    mass = np.full(CLASSES, SMOOTHING)
    for row in sums:
        mass[row["class"]] += row["n"] + SMOOTHING * row["types"]
    coded = _coded(docs, lexicon, blocks, base, np.log10(mass))
    logs = transition_logs(_transitions(coded), SMOOTHING / mass)

    def start():
        def compute(batch: pa.RecordBatch) -> list:
            out = []
            for content, emitted in zip(batch.column("classes").to_pylist(), batch.column("emitted").to_pylist(), strict=True):
                chain = np.frombuffer(content, np.uint8).astype(np.int64)
                out.append(emitted + float(logs[np.append(BEGIN, chain), np.append(chain, BEGIN)].sum()))
            return [out]

        return compute

    found = annotate(coded, start, [StructField("score", DoubleType(), False)], "classes")
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(base["N"]).cast("long").alias("train_tokens"), "base_score", "score"
    )
