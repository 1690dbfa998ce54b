"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from ticketmart.llm.common import annotate, slices, stored, texts_of

BUCKETS = 1 << 14
ORDERS = (2, 3)
SMOOTHING = 0.1
UNDETERMINED = "und"
# The classifier learns at most so many labels, those of the most documents: its matrix
# has a column for each. Of more labels the rarer ones are taken for dirt, not languages.
MAX_LANGS = 1000
# Products of counts and log-probabilities that are held at a time.
_CELLS = 1 << 22


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text, and how often each occurs.

    The text is lower-cased; what is no letter counts as one blank.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    blank = (points < 65) | ((points > 90) & (points < 97)) | ((points > 122) & (points < 128))
    points = np.where(blank, np.uint32(32), points)
    points = np.concatenate(([32], points, [32])).astype(np.uint32)
    found = []
    for order in ORDERS:
        n = len(points) - order + 1
        if n > 0:
            code = np.full(n, order, np.uint32)
            for i in range(order):
                code = (code ^ points[i : i + n]) * np.uint32(0x9E3779B1)
                code ^= code >> np.uint32(15)
            found.append(code & np.uint32(BUCKETS - 1))
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    hit = np.flatnonzero(counts)
    return hit, counts[hit]


def learned(docs: DataFrame, label: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and their matrix of log-probabilities, [bucket, language].

    Counts cover all documents with a label and a text. Each task adds up its own
    documents; what is shuffled is one row for each language, bucket and task, and
    what reaches the driver one row of counts for each of at most `MAX_LANGS` languages.
    """
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).cast("string").alias("label"), F.col(text).alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for name, row in sums.items():
                hit = np.flatnonzero(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(row[hit])],
                    names=["label", "bucket", "n"],
                )
            sums.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                for name, content in zip(part.column("label").to_pylist(), texts_of(part), strict=True):
                    hit, n = grams(content)
                    row = sums.get(name)
                    if row is None:
                        if len(sums) >= 200:
                            yield from flushed()
                        row = sums[name] = np.zeros(BUCKETS + 1, np.int64)
                    row[hit] += n
                    row[BUCKETS] += 1
        yield from flushed()

    counted = known.mapInArrow(count, "label string, bucket int, n long")
    rows = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    rows = stored(rows, "grams")
    docs_of_label = rows.where(F.col("bucket") == BUCKETS).orderBy(F.col("n").desc(), "label")
    names = sorted(row["label"] for row in docs_of_label.limit(MAX_LANGS).collect())

    def vector(cells: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(BUCKETS + 1)
        counts[cells["bucket"].to_numpy(int)] = cells["n"]
        return pd.DataFrame({"label": [cells["label"].iloc[0]], "counts": [counts.tobytes()]})

    kept = rows.where(F.col("label").isin(names)).groupBy("label").applyInPandas(vector, "label string, counts binary")
    vectors = {row["label"]: np.frombuffer(row["counts"]) for row in kept.collect()}
    counts = np.array([vectors[name] for name in names]).T
    if not names:
        return [], np.zeros((BUCKETS + 1, 0))
    docs_of, counts = counts[BUCKETS], counts[:BUCKETS] + SMOOTHING
    return names, np.vstack([np.log(counts / counts.sum(0)), np.log(docs_of / docs_of.sum())])


def identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score`, the probability of that language.

    Texts that are null, empty or without a letter get `und` and score 0, and so does
    every text where no language was learned. Equally likely languages: the first by
    name. Texts are read whole; rows are independent of each other.
    """
    names, logs = model
    shared = docs.sparkSession.sparkContext.broadcast((names, logs.astype(np.float32)))

    def start():
        names, logs = shared.value

        def compute(batch: pa.RecordBatch) -> list:
            texts = texts_of(batch, text)
            found = [grams(t) for t in texts]
            sizes = np.array([len(hit) for hit, _ in found])
            hits = np.concatenate([hit for hit, _ in found])
            n = np.concatenate([n for _, n in found]).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            if not names:
                return [[UNDETERMINED] * len(texts), [0.0] * len(texts)]
            # So many texts at a time that their products stay small with many languages too.
            rounds = np.flatnonzero(np.diff(starts * len(names) // _CELLS, prepend=-1)).tolist()
            sums = np.empty((len(texts), len(names)))
            for low, high in zip(rounds, [*rounds[1:], len(texts)], strict=True):
                cells = slice(starts[low], starts[high] if high < len(texts) else len(hits))
                products = logs[hits[cells]] * n[cells, None]
                sums[low:high] = np.add.reduceat(products, starts[low:high] - starts[low], axis=0) + logs[BUCKETS]
            best = sums.argmax(1)
            odds = np.exp(sums - sums.max(1, keepdims=True))
            score = 1.0 / odds.sum(1)
            letters = [any(map(str.isalpha, t)) for t in texts]
            return [
                [names[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)],
                np.where(letters, score, 0.0),
            ]

        return compute

    fields = [StructField("lang_pred", StringType(), False), StructField("score", DoubleType(), False)]
    return annotate(docs, start, fields, text)
