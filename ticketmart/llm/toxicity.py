"""Toxic spans by a linear-chain conditional random field, and scores of documents.

Labels exist for documents only, so tokens are labelled first: parts of words that stand
in many toxic and hardly any clean training documents are markers, and the words of a
toxic document that contain one are its toxic tokens. The chain (two labels, features of
the word and its character n-grams, four transitions) is fitted to those tokens.

The labelled texts are prepared by tasks and stored. Markers are counted by an aggregate,
and each step's gradient is the sum of what the tasks make of their texts, taken by a task
too; the driver has the parameters alone, however long the texts are and in however many
files they lie.

Forward-backward gives the marginal of every token. The recursion of two labels is a
chain of 2x2 matrices, which is read in blocks: the products of all blocks at once, then
the messages from block to block, then all places at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ticketmart.llm.common import annotate, slices, split_lower_words, stored, texts_of

# The classifier is fitted on at most so many labelled documents of each label, the
# first by a hash of the key. Everything else covers all documents.
MAX_TRAINING = 1000
BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
STEPS = 40
BLOCK = 64
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LIMIT = 25.0
# A longer word is cut at punctuation, and what is still longer into stretches that overlap.
LONGEST = 64
STRETCH = 32
_PUNCTUATION = re.compile(rb"[^!-/:-@\[-`{-~]+")


@dataclass
class Model:
    weights: np.ndarray  # one for each bucket of features
    bias: float
    pairs: np.ndarray  # log weights of label pairs, [before, after]
    readout: np.ndarray  # from (1, log-odds of the likeliest token, log of expected tokens) to log-odds


def stretches(word: bytes) -> list[bytes]:
    """What the chain has as tokens: the word itself, or all of a long word in pieces."""
    if len(word) <= LONGEST:
        return [word]
    found = []
    for piece in _PUNCTUATION.findall(word) or [word]:
        if len(piece) <= LONGEST:
            found.append(piece)
        else:
            found += [piece[i : i + STRETCH] for i in range(0, len(piece) - STRETCH // 2, STRETCH // 2)]
    return found


def parts(word: bytes) -> list[bytes]:
    """The word without punctuation around it, and its n-grams with marked ends."""
    core = word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or word
    text = b"^" + core + b"$"
    found = {text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1)}
    found.add(b"=" + core)
    return sorted(found)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of distinct words, and the first place of each word's features."""
    flat, starts = [], []
    for word in words:
        starts.append(len(flat))
        flat += [xxhash.xxh3_64_intdigest(part) % BUCKETS for part in parts(word)]
    return np.array(flat, np.int64), np.array(starts, np.int64)


def _chain(step: np.ndarray, fresh: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ratios r[t] = (a r[t-1] + b) / (c r[t-1] + d) with step[t] = (a, b, c, d).

    Where `fresh`, a sequence begins and r[t] is `first[t]`.
    """
    n = len(step)
    if not n:
        return np.zeros(0)
    step = step.copy()
    step[fresh] = 0.0
    step[fresh, 1] = first[fresh]
    step[fresh, 3] = 1.0
    rows = -(-n // BLOCK)
    padded = np.tile(np.array([1.0, 0.0, 0.0, 1.0]), (rows * BLOCK, 1))
    padded[:n] = step
    a, b, c, d = np.ascontiguousarray(padded.reshape(rows, BLOCK, 4).transpose(2, 1, 0))
    pa_, pb, pc_, pd = (x.copy() for x in (a[0], b[0], c[0], d[0]))
    for t in range(1, BLOCK):
        na, nb = a[t] * pa_ + b[t] * pc_, a[t] * pb + b[t] * pd
        nc, nd = c[t] * pa_ + d[t] * pc_, c[t] * pb + d[t] * pd
        scale = 1.0 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        pa_, pb, pc_, pd = na * scale, nb * scale, nc * scale, nd * scale
    entry, ratio = np.empty(rows), 1.0
    for i, (x, y, z, w) in enumerate(zip(pa_.tolist(), pb.tolist(), pc_.tolist(), pd.tolist(), strict=True)):
        entry[i] = ratio
        ratio = (x * ratio + y) / (z * ratio + w)
    out = np.empty((BLOCK, rows))
    now = entry
    for t in range(BLOCK):
        now = (a[t] * now + b[t]) / (c[t] * now + d[t])
        out[t] = now
    return out.T.ravel()[:n]


def forward_backward(emission: np.ndarray, sizes: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward ratios (toxic to clean), and the marginals of being toxic.

    `emission` has the log-odds of each token by itself, sequences end to end.
    """
    n = len(emission)
    weight = np.exp(np.clip(emission, -_LIMIT, _LIMIT))
    cc, ct, tc, tt = np.exp(pairs).ravel()
    filled = sizes[sizes > 0]
    begins = np.zeros(n, bool)
    begins[np.cumsum(filled) - filled] = True
    step = np.stack((tt * weight, ct * weight, np.full(n, tc), np.full(n, cc)), 1)
    ahead = _chain(step, begins, weight)
    ends = np.append(begins[1:], True) if n else begins
    after = np.append(weight[1:], 1.0) if n else weight
    step = np.stack((tt * after, np.full(n, tc), ct * after, np.full(n, cc)), 1)
    behind = _chain(step[::-1], ends[::-1], np.ones(n))[::-1]
    both = ahead * behind
    return ahead, behind, both / (1.0 + both)


class Tokens:
    """Texts as numbers of distinct tokens; a long word is several of them."""

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[bytes, int] = {}
        found = [[numbers.setdefault(w, len(numbers)) for w in split_lower_words(text)] for text in texts]
        self.sizes = np.array([len(f) for f in found], np.int64)
        self.ids = np.array([i for f in found for i in f], np.int64)
        self.word_of: list[np.ndarray] | None = None  # for each text, the word of each token, where they differ
        self.words = list(numbers)
        long = [i for i, word in enumerate(self.words) if len(word) > LONGEST]
        if long:
            self._cut(numbers, long)

    def _cut(self, numbers: dict[bytes, int], long: list[int]) -> None:
        """Put the stretches of long words in their place."""
        cut = [[numbers.setdefault(token, len(numbers)) for token in stretches(self.words[i])] for i in long]
        counts, first = np.ones(len(numbers), np.int64), np.arange(len(numbers))
        pieces = np.concatenate([np.arange(len(numbers)), *cut])
        counts[long] = [len(tokens) for tokens in cut]
        first[long] = len(numbers) + np.cumsum([0, *counts[long][:-1]])
        times = counts[self.ids]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        text_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        word = np.arange(len(self.ids)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.ids = pieces[np.repeat(first[self.ids], times) + nth]
        self.sizes = np.bincount(text_of, times, len(self.sizes)).astype(np.int64)
        self.word_of = np.split(np.repeat(word, times), np.cumsum(self.sizes)[:-1])
        # A long word is no token any more.
        self.words = list(numbers)
        for i in long:
            self.words[i] = b""


# Fit, over stored rows of packed tokens.


_KINDS = {"labels": bool, "sizes": np.int64, "ids": np.int64, "flat": np.int64, "starts": np.int64, "codes": np.int64, "gold": bool}
_PACKED = ", ".join(f"{name} binary" for name in _KINDS)


@dataclass
class Batch:
    """Labelled texts as tokens, features of the distinct ones, and the hashes of their parts."""

    labels: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray
    flat: np.ndarray
    starts: np.ndarray
    codes: np.ndarray  # of the part that each feature is of; none once the tokens are labelled
    gold: np.ndarray  # whether a token is toxic

    @property
    def type_of(self) -> np.ndarray:
        """The distinct token of each feature."""
        return np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.flat))))

    def labelled(self, marks: np.ndarray) -> Batch:
        """With its toxic tokens: those in a toxic text, with a part that is a marker."""
        marked = np.zeros(len(self.starts), bool)
        marked[self.type_of[np.isin(self.codes, marks)]] = True
        return replace(self, codes=self.codes[:0], gold=marked[self.ids] & np.repeat(self.labels, self.sizes))

    def row(self) -> pa.RecordBatch:
        cells = [pa.array([getattr(self, name).astype(kind).tobytes()], pa.binary()) for name, kind in _KINDS.items()]
        return pa.RecordBatch.from_arrays(cells, names=list(_KINDS))

    def inner(self) -> np.ndarray:
        """Places of tokens that another of the same text follows."""
        inside = np.ones(len(self.ids), bool)
        ends = np.cumsum(self.sizes)
        inside[ends[ends > 0] - 1] = False
        return np.flatnonzero(inside)


def packed_batch(texts: list[str], labels: list[bool]) -> Batch:
    tokens = Tokens(texts)
    codes, starts = [], []
    for word in tokens.words:
        starts.append(len(codes))
        codes += [xxhash.xxh3_64_intdigest(part) for part in parts(word)]
    code = np.array(codes, np.uint64)
    flat = (code % np.uint64(BUCKETS)).astype(np.int64)
    gold = np.zeros(len(tokens.ids), bool)
    return Batch(np.array(labels, bool), tokens.sizes, tokens.ids, flat, np.array(starts, np.int64), code.view(np.int64), gold)


def _stored_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            yield Batch(*(np.frombuffer(cell, kind) for cell, kind in zip(row, _KINDS.values(), strict=True)))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            yield packed_batch(texts_of(part), part.column("toxic").to_pylist()).row()


def _count_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts each part occurs."""
    for made in _stored_batches(batches):
        ends, cuts = np.cumsum(made.sizes), np.append(made.starts, len(made.flat))
        codes, numbers = np.unique(made.codes, return_inverse=True)
        toxic, clean = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        for label, size, end in zip(made.labels, made.sizes, ends, strict=True):
            if size:
                used = np.unique(made.ids[end - size : end]).tolist()
                found = np.unique(np.concatenate([numbers[cuts[i] : cuts[i + 1]] for i in used]))
                (toxic if label else clean)[found] += 1
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (codes, toxic, clean)], names=["code", "toxic", "clean"])


def markers(rows: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """Hashes of the parts that mark toxic texts; each is in a fixed share of them."""
    n_toxic, n_clean = max(n_toxic, 1), max(n_clean, 1)
    least = max(3, 0.02 * n_toxic)
    counts = rows.mapInArrow(_count_parts, "code long, toxic long, clean long").groupBy("code")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    much = F.col("toxic") / n_toxic >= (F.col("clean") + 0.5) * 20 / n_clean
    return np.array(sorted(row["code"] for row in counts.where((F.col("toxic") >= least) & much).select("code").collect()), np.int64)


def slopes(made: Batch, model: Model) -> np.ndarray:
    """Gradient of a batch's log-likelihood: by bucket, of the bias, and of the label pairs."""
    if not len(made.ids):
        return np.zeros(BUCKETS + 5)
    gold = made.gold
    score = np.add.reduceat(model.weights[made.flat], made.starts) + model.bias
    ahead, behind, chance = forward_backward(score[made.ids], made.sizes, model.pairs)
    error = gold - chance
    by_type = np.bincount(made.ids, error, len(made.starts))
    slope = np.bincount(made.flat, by_type[made.type_of], BUCKETS)
    a = made.inner()
    b = a + 1
    wanted = np.array([[((gold[a] == i) & (gold[b] == j)).sum() for j in (False, True)] for i in (False, True)], float)
    table = np.exp(model.pairs)
    weight = np.exp(np.clip(score[made.ids], -_LIMIT, _LIMIT))[b] * behind[b]
    joint = np.array([[table[0, 0] + 0 * weight, table[0, 1] * weight], [ahead[a] * table[1, 0], ahead[a] * table[1, 1] * weight]])
    pairs = wanted - (joint / joint.sum((0, 1))).sum(-1)
    return np.concatenate([slope, [error.sum()], pairs.ravel()])


# Text bytes for which the fit has a task, and how many tasks at most have sums.
_TASK_BYTES = 1 << 20
_MAX_TASKS = 32


def _summed(rows: DataFrame, of_batch, size: int) -> np.ndarray:
    """Sum over all batches of a vector of fixed size.

    At most `_MAX_TASKS` tasks make a vector each, in however many files the rows lie. One
    task adds these up, in the order of their numbers, so that a single one comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size), False
        for made in _stored_batches(batches):
            total += of_batch(made)
            some = True
        if some:
            cells = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["task", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)]
        total = np.zeros(size)
        for _, part in sorted(found):
            total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = rows.coalesce(_MAX_TASKS).mapInArrow(run, "task int, total binary")
    found = parts.repartition(1).mapInArrow(add, "total binary").collect()
    return np.frombuffer(found[0]["total"]).copy() if found else np.zeros(size)


def fitted(rows: DataFrame, n_toxic: int, n_clean: int, rate: float) -> Model:
    """Fit the chain, then the readout, to stored batches of whole labelled texts.

    `rate` is the share of toxic documents among all labelled ones.
    """
    marks = markers(rows, n_toxic, n_clean)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in _stored_batches(batches):
            yield made.labelled(marks).row()

    rows = stored(rows.mapInArrow(label, _PACKED), "labelled_tokens")
    tokens, gold = _summed(rows, lambda made: np.array([len(made.ids), made.gold.sum()], float), 2)
    model = Model(np.zeros(BUCKETS), float(np.log((gold + 1.0) / (tokens + 2.0))), np.zeros((2, 2)), np.zeros(3))
    rates = np.full(BUCKETS + 5, 1e-8)
    context = rows.sparkSession.sparkContext
    for _ in range(STEPS if tokens else 0):
        # Given up after the step, or the driver would keep the parameters of all steps.
        now = context.broadcast(model)
        slope = _summed(rows, lambda made, now=now: slopes(made, now.value), BUCKETS + 5)
        now.destroy()
        slope[:BUCKETS] -= 0.02 * model.weights
        rates += slope * slope
        moved = 0.3 * slope / np.sqrt(rates)
        model = replace(
            model,
            weights=model.weights + moved[:BUCKETS],
            bias=model.bias + float(moved[BUCKETS]),
            pairs=model.pairs + moved[BUCKETS + 1 :].reshape(2, 2),
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in _stored_batches(batches):
            score = np.add.reduceat(model.weights[made.flat], made.starts) + model.bias if len(made.starts) else np.zeros(0)
            chance = forward_backward(score[made.ids], made.sizes, model.pairs)[2]
            _, most, total = aggregates(chance, made.sizes).T
            yield pa.RecordBatch.from_arrays([pa.array(made.labels), pa.array(most), pa.array(total)], names=["toxic", "most", "total"])

    # Three numbers for each of the bounded number of labelled texts.
    found = rows.mapInArrow(read, "toxic boolean, most double, total double").collect()
    numbers = np.array(sorted((row["toxic"], row["most"], row["total"]) for row in found), float).reshape(-1, 3)
    readout = np.column_stack((np.ones(len(numbers)), numbers[:, 1:]))
    return replace(model, readout=_logistic(readout, numbers[:, 0] > 0, rate))


def aggregates(chance: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What a document's score is made of: its likeliest token and its expected toxic tokens."""
    most, total = np.zeros(len(sizes)), np.zeros(len(sizes))
    some = sizes > 0
    if some.any():
        at = (np.cumsum(sizes) - sizes)[some]
        most[some] = np.maximum.reduceat(chance, at)
        total[some] = np.add.reduceat(chance, at)
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack((np.ones(len(sizes)), np.log(most / (1 - most)), np.log(total + 1e-6)), 1)


def _logistic(rows: np.ndarray, label: np.ndarray, rate: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps, the labels weighted by their true rates."""
    weight = np.where(label, rate / max(label.sum(), 1), (1 - rate) / max((~label).sum(), 1)) * len(label)
    solved = np.zeros(rows.shape[1])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(rows @ solved, -30, 30)))
        slope = rows.T @ (weight * (label - chance)) - 0.1 * solved
        curve = (rows * (weight * chance * (1 - chance) + 1e-9)[:, None]).T @ rows + 0.1 * np.eye(len(solved))
        solved = solved + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return solved


def _least_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        least = []
        for text in texts_of(batch):
            words = split_lower_words(text)
            shingles = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [tuple(words)]
            least.append(min(xxhash.xxh3_64_intdigest(b" ".join(s)) for s in shingles) - (1 << 63))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("toxic"), batch.column("text"), pa.array(least, pa.int64())], names=["key", "toxic", "text", "least"])


def training_rows(docs: DataFrame, picked: DataFrame, key: str, text: str) -> DataFrame:
    """Label and text of the picked documents, without copies.

    Of texts that share their least 3-word shingle the one with the least key stays, as
    copies of one toxic document would make markers of all its words.
    """
    chosen = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    chosen = chosen.join(picked.select(F.col(key).alias("key"), F.col("toxic").cast("boolean").alias("toxic")), "key")
    one = chosen.groupBy("key").agg(F.min_by("toxic", F.xxhash64("text")).alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    kind = one.schema["key"].dataType.simpleString()
    marked = stored(one.select("key", "toxic", "text").mapInArrow(_least_shingles, f"key {kind}, toxic boolean, text string, least long"), "labelled")
    firsts = marked.groupBy("least").agg(F.min("key").alias("key"))
    return marked.join(firsts, ["least", "key"], "left_semi").select("toxic", "text")


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = MAX_TRAINING) -> Model:
    """Fit to documents with a label in `labels` (key, toxic).

    A key with several labels is toxic if one of them says so; null labels and null
    texts are left out. At most `bound` documents of each label are read; a key with
    several texts counts with one of them.
    """
    one = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max("toxic").alias("toxic"))
    known = stored(one.join(docs.select(F.col(key)).distinct(), key, "left_semi"), "labels")
    size = known.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("int")).alias("toxic")).first()
    picked = None
    for value in (1, 0):
        some = known.where(F.col("toxic").cast("int") == value).orderBy(F.xxhash64(key), key).limit(bound)
        picked = some if picked is None else picked.union(some)
    rows = stored(training_rows(docs, stored(picked, "picked"), key, text), "training")
    used = rows.agg(
        F.count_if("toxic").alias("toxic"), F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")
    ).first()
    if not used["n"]:
        return Model(np.zeros(BUCKETS), 0.0, np.zeros((2, 2)), np.array([-5.0, 0.0, 0.0]))
    tasks = max(1, min(used["n"], _MAX_TASKS, -(-(used["bytes"] or 0) // _TASK_BYTES)))
    dealt = rows.repartition(tasks, F.xxhash64("text"))
    batches = stored(dealt.mapInArrow(_pack, _PACKED), "tokens")
    return fitted(batches, used["toxic"], used["n"] - used["toxic"], size["toxic"] / size["n"])


SPANS = ArrayType(
    StructType(
        [StructField("start", IntegerType(), False), StructField("stop", IntegerType(), False), StructField("score", DoubleType(), False)]
    ),
    False,
)


def spans_of(text: str, chance: np.ndarray, threshold: float) -> list[dict]:
    """Runs of words at or above the threshold, as character offsets and the highest marginal.

    `chance` has one value a word: of a long word, that of its likeliest stretch.
    """
    found: list[dict] = []
    last = -2
    for i, match in enumerate(_WORD.finditer(text)):
        if chance[i] >= threshold:
            if last == i - 1:
                found[-1]["stop"] = match.end()
                found[-1]["score"] = max(found[-1]["score"], float(chance[i]))
            else:
                found.append({"start": match.start(), "stop": match.end(), "score": float(chance[i])})
            last = i
    return found


# Text bytes that the tagging reads at a time, and words whose scores a task keeps.
_TAG_BYTES = 1 << 20
_MAX_SCORES = 600_000
# Words whose features are held at a time.
_FEATURED = 10_000


def word_scores(words: list[bytes], model: Model) -> list[float]:
    """Log-odds of words by themselves."""
    scores = []
    for at in range(0, len(words), _FEATURED):
        flat, starts = features(words[at : at + _FEATURED])
        scores += (np.add.reduceat(model.weights[flat], starts) + model.bias).tolist()
    return scores


def tagged(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add `score` (0 to 1), `predicted` (1 from 0.5 on) and `spans`, the toxic offsets.

    Null and empty texts have no tokens; they get the score of a text without a toxic
    token. Texts are read whole; rows are independent of each other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        cache: dict[bytes, float] = {}

        def compute(batch: pa.RecordBatch) -> list:
            texts = texts_of(batch, text)
            tokens = Tokens(texts)
            new = [word for word in tokens.words if word not in cache]
            if len(cache) + len(new) > _MAX_SCORES:
                cache.clear()
                new = tokens.words
            cache.update(zip(new, word_scores(new, model), strict=True))
            score = np.array([cache[word] for word in tokens.words])
            emission = score[tokens.ids] if len(score) else np.zeros(0)
            chance = forward_backward(emission, tokens.sizes, model.pairs)[2]
            odds = aggregates(chance, tokens.sizes) @ model.readout
            scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            spans = []
            ends = np.cumsum(tokens.sizes)
            for i, content in enumerate(texts):
                own = chance[ends[i] - tokens.sizes[i] : ends[i]]
                if not (own >= threshold).any():
                    spans.append([])
                    continue
                if tokens.word_of is not None:
                    of_token, own = own, np.zeros(len(split_lower_words(content)))
                    np.maximum.at(own, tokens.word_of[i], of_token)
                spans.append(spans_of(content, own, threshold))
            return [scores, (scores >= 0.5).astype(np.int32), spans]

        return compute

    fields = [StructField("score", DoubleType(), False), StructField("predicted", IntegerType(), False), StructField("spans", SPANS, False)]
    return annotate(docs, start, fields, text, _TAG_BYTES)
