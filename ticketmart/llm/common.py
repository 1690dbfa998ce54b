"""What the operators share: reading, writing intermediate tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from ticketmart.session import scratch_folder
from ticketmart.sources.files import delete_folder

# Words of most operators: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Text bytes that one step of a Python operator holds at a time.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts the lineage at files that outlive any executor, and gives the planner the
    true size of what was written.
    """
    spark = frame.sparkSession
    path = f"{scratch_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(path)
    found = spark.read.schema(frame.schema).parquet(path)
    _PLACES[found] = path
    return found


# Where frames given by `stored` lie.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*frames: DataFrame) -> None:
    """Delete stored frames from which nothing will be computed any more."""
    for frame in frames:
        path = _PLACES.pop(frame, None)
        if path is not None:
            delete_folder(frame.sparkSession, path)


def fold(key: str, folds: int) -> Column:
    """crc32 of a key written as text, modulo `folds`; a null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def without(frame: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that an operator is about to add, whatever their case."""
    taken = {name.lower() for name in names}
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c.lower() not in taken])


def slices(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about `limit` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if text is None else text for text in batch.column(column).to_pylist()]


Compute = Callable[[pa.RecordBatch], list]


def annotate(
    frame: DataFrame,
    start: Callable[[], Compute],
    fields: list[StructField],
    text: str = "text",
    limit: int = BATCH_BYTES,
) -> DataFrame:
    """Add columns that Python computes from whole batches, without a shuffle.

    `start` is called once per task and returns the function that makes the new
    columns (arrays or lists, in the order of `fields`) of one batch. Columns of the
    frame that have the name of a new one are replaced.
    """
    kept = without(frame, [field.name for field in fields])
    schema = StructType([*kept.schema.fields, *fields])
    types = [to_arrow_type(field.dataType) for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for part in slices(batch, text, limit):
                new = [
                    column if isinstance(column, pa.Array) else pa.array(column, kind)
                    for column, kind in zip(compute(part), types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    if any("." in name for name in kept.columns):
        # A dot in the name of an input column would be read as a field of it.
        kept = kept.toDF(*[f"column {i}" if "." in name else name for i, name in enumerate(kept.columns)])
    return kept.mapInArrow(run, schema)


def split_words(text: str) -> list[bytes]:
    """Words as UTF-8; bytes.split() parts at just the six ASCII white-space bytes."""
    return text.encode().split()


def split_lower_words(text: str) -> list[bytes]:
    """As split_words, with A-Z (and nothing else) in lower case."""
    return text.encode().lower().split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixing bijection of 64-bit values (the finaliser of splitmix64)."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
