"""Near-duplicates by MinHash with tensored banding.

A document is the set of its distinct word shingles. Two small collections of half
bands are computed; the key of table (i, j) combines half band i of the first with
half band j of the second. `tables` half bands a side thus give tables^2 keys of twice
the rows, from a square root of the minhashes. With 10 half bands of two rows a side, a
pair of similarity 0.8 shares no key with probability 7e-5, one of 0.9 with 1e-7.

Candidates are confirmed on their full sets of shingles. Documents with one set are one
class from the start. Of a bucket not all pairs are tried: members are compared with a
few of the bucket first, and what is linked by then needs no further comparison. Only
pairs whose ends are still in different components are then taken one by one, unless
their sizes or their bitmaps rule the similarity out, which they do without error. A pair
of many common buckets is taken only in those of the first half band that it shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField

from ticketmart.llm.common import annotate, discard, mixed, slices, split_lower_words, stored, texts_of
from ticketmart.llm.graph import components, merged

MAX_WORDS = 300_000
BITS = 512
# Rounds with one more partner each before all pairs that are still apart are taken.
ROUNDS = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Banding:
    words: int = 2
    percent: int = 80
    tables: int = 10
    rows: int = 2


class Shingles:
    """Sets of word shingles as sorted 64-bit hashes."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = split_lower_words(text)
        if not words:
            return np.zeros(0, np.uint64)
        cache = self.cache
        if len(cache) > MAX_WORDS:
            cache.clear()
        codes = np.empty(len(words), np.uint64)
        for i, word in enumerate(words):
            code = cache.get(word)
            if code is None:
                code = cache[word] = xxhash.xxh3_64_intdigest(word)
            codes[i] = code
        size = min(self.words, len(words))
        joined = np.full(len(codes) - size + 1, size, np.uint64)
        for i in range(size):
            joined = mixed((joined + codes[i : len(codes) - size + 1 + i]) * _STEP)
        return np.unique(joined)


def _factors(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def signature(shingles: np.ndarray, banding: Banding, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half bands of both sides, and the bitmap of a set that is not empty.

    Bit i of the bitmap is the parity of the shingles that fall on it, so that two
    bitmaps differ in no more bits than the sets in elements.
    """
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, mixed_low(shingles[at : at + 4096, None] * factors).min(0))
    rows = least.reshape(-1, banding.rows)
    halves = np.zeros(len(rows), np.uint64)
    for i in range(banding.rows):
        halves = mixed((halves + rows[:, i]) * _STEP)
    flips = np.bincount((shingles & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return halves, np.packbits(flips.astype(np.uint8)).view(np.uint64)


def mixed_low(values: np.ndarray) -> np.ndarray:
    """Lets high bits work on low ones after a multiplication."""
    return values ^ (values >> np.uint64(32))


def _coded(halves: np.ndarray) -> np.ndarray:
    """Half bands as positive 32-bit numbers; those of different places are never equal."""
    n = max(1, len(halves))
    return ((halves.astype(np.uint64) % np.uint64(2**31 // n)).astype(np.int64) * n + np.arange(len(halves))).astype(np.int32)


def signed(docs: DataFrame, banding: Banding, text: str = "text") -> DataFrame:
    """Add set size, two hashes of the set, half bands and bitmap."""

    def start():
        shingled = Shingles(banding.words)
        factors = _factors(2 * banding.tables * banding.rows)

        def compute(batch: pa.RecordBatch) -> list:
            sizes, ones, twos, halves, bits = [], [], [], [], []
            with np.errstate(over="ignore"):
                for content in texts_of(batch, text):
                    found = shingled(content)
                    sizes.append(len(found))
                    ones.append(mixed(found).sum().astype(np.uint64).view(np.int64))
                    twos.append(mixed(found ^ _STEP).sum().astype(np.uint64).view(np.int64))
                    half, bitmap = signature(found, banding, factors) if len(found) else (np.zeros(0), np.zeros(0))
                    halves.append(_coded(half))
                    bits.append(bitmap.astype(np.uint64).view(np.int64))
            return [sizes, ones, twos, halves, bits]

        return compute

    fields = [StructField(n, LongType(), False) for n in ("n_shingles", "set_one", "set_two")]
    fields += [StructField("halves", ArrayType(IntegerType(), False), False), StructField("bits", ArrayType(LongType(), False), False)]
    return annotate(docs, start, fields, text)


def _keys(classes: DataFrame, banding: Banding) -> DataFrame:
    """A row for each class and table: key and class. A key modulo tables^2 is its table."""
    m = banding.tables
    one = classes.select("class", F.posexplode(F.slice("halves", 1, m)).alias("i", "one"), "halves")
    both = one.select("class", "i", "one", F.posexplode(F.slice("halves", m + 1, m)).alias("j", "two"))
    hashed = F.shiftright(F.xxhash64("one", "two"), 1)
    return both.select((hashed - F.pmod(hashed, F.lit(m * m)) + F.col("i") * m + F.col("j")).alias("key"), "class")


def _earlier(banding: Banding) -> Column:
    """Half bands of the first side before that of a key.

    Of the buckets that two classes share, those of the first common half band of this
    side are the ones in which they have none of these in common.
    """
    m = banding.tables
    return F.slice("halves", 1, F.floor(F.pmod("key", F.lit(m * m)) / m).cast("int"))


def _possible(one: str, two: str, percent: int) -> Column:
    """Whether sizes and bitmaps allow the similarity; never false for a pair that has it."""
    n, m = F.col(f"{one}.n_shingles"), F.col(f"{two}.n_shingles")
    apart = sum(
        (F.bit_count(F.col(f"{one}.bits")[i].bitwiseXOR(F.col(f"{two}.bits")[i])) for i in range(BITS // 64)),
        F.lit(0),
    )
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (apart * (100 + percent) <= (n + m) * (100 - percent))


def confirmed(edges: DataFrame, docs: DataFrame, banding: Banding, key: str, text: str) -> DataFrame:
    """The edges (a, b) between documents whose full sets are similar enough.

    Each side's text is brought to the edge by a join; a document with many edges is
    split by adaptive execution, as the join is a plain one.
    """
    numbered = stored(edges.select("a", "b"), "candidates")
    contents = docs.select(F.col(key).alias("node"), F.col(text).alias("content"))
    involved = numbered.select(F.col("a").alias("node")).union(numbered.select(F.col("b").alias("node"))).distinct()
    needed = stored(contents.join(involved, "node", "left_semi").dropDuplicates(["node"]), "contents")
    sides = numbered.join(needed.select(F.col("node").alias("a"), F.col("content").alias("one")), "a").join(
        needed.select(F.col("node").alias("b"), F.col("content").alias("two")), "b"
    )
    words, percent = banding.words, banding.percent

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingled = Shingles(words)
        memo: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "one"):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                one, two = texts_of(part, "one"), texts_of(part, "two")
                keep = []
                with np.errstate(over="ignore"):
                    for i in range(len(a)):
                        sets = []
                        for node, content in ((a[i], one[i]), (b[i], two[i])):
                            found = memo.get(node)
                            if found is None:
                                if len(memo) > 300:
                                    memo.clear()
                                found = memo[node] = shingled(content)
                            sets.append(found)
                        same = len(np.intersect1d(*sets, assume_unique=True))
                        if same and 100 * same >= percent * (len(sets[0]) + len(sets[1]) - same):
                            keep.append(i)
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array([a[i] for i in keep], pa.int64()), "b": pa.array([b[i] for i in keep], pa.int64())}
                )

    links = stored(sides.select("a", "b", "one", "two").mapInArrow(check, "a long, b long"), "links")
    discard(numbered, needed)
    return links


def grouped(docs: DataFrame, banding: Banding = Banding(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_shingles`, `component_id` and `kept` for each document.

    Texts that are null, empty or blank have no shingles and link with nothing; so does
    a row without a key, which is its own component (null). Rows that repeat a key
    belong together. The key must be an integer; other columns are not used. Of equal
    choices the least key counts.
    """
    signs = stored(signed(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")), banding).drop("text"), "signatures")
    content = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL")
    shingled = signs.where((F.col("n_shingles") > 0) & F.col("doc").isNotNull())
    identity = ["set_one", "set_two", "n_shingles"]
    firsts = stored(shingled.groupBy(*identity).agg(F.min("doc").alias("class")), "firsts")
    members = stored(shingled.select("doc", *identity).join(firsts, identity).select("doc", "class"), "members")
    classes = stored(
        shingled.join(firsts.select(F.col("class").alias("doc")), "doc", "left_semi")
        .dropDuplicates(["doc", *identity])
        .select(F.col("doc").alias("class"), "n_shingles", "halves", "bits"),
        "classes",
    )
    features = classes.select("class", "n_shingles", "bits")
    keys = _keys(classes, banding)
    leads = stored(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("lead")).where("n > 1").select("key", "lead"), "leads")
    buckets = stored(keys.join(leads, "key").select("key", "class", "lead"), "buckets")
    discard(leads)

    # First round: each class with the least one that it meets.
    first = buckets.where(F.col("class") != F.col("lead")).groupBy("class").agg(F.min("lead").alias("b"))
    links = confirmed(_allowed(first.select(F.col("class").alias("a"), "b"), features, banding), content, banding, "doc", "text")
    labels = stored(components(links), "labels")
    # A few more: what is still apart from others in its buckets, with another member.
    for salt in range(ROUNDS):
        now = _mixed_buckets(buckets, labels)
        anchors = stored(
            now.where(F.col("component") == F.col("least"))
            .groupBy("key")
            .agg(F.min_by("class", F.xxhash64("class", "key", F.lit(salt))).alias("b")),
            "anchors",
        )
        tries = now.where(F.col("component") != F.col("least")).join(anchors, "key")
        chosen = _allowed(tries.select(F.col("class").alias("a"), "b").distinct(), features, banding, nearest=True)
        more = confirmed(chosen, content, banding, "doc", "text")
        discard(now, anchors)
        if more.isEmpty():
            break
        labels = merged(labels, more)
    # Then every pair that is still apart.
    now = _mixed_buckets(buckets, labels)
    full = now.join(classes, "class").select("key", "class", "component", "n_shingles", "bits", _earlier(banding).alias("earlier"))
    full = stored(full, "mixed")
    last = confirmed(_pairs(full, banding).distinct(), content, banding, "doc", "text")
    discard(buckets, now, full)
    if not last.isEmpty():
        labels = merged(labels, last)
    joined = members.join(labels, members["class"] == labels["node"], "left")
    of_doc = stored(
        joined.groupBy("doc").agg(F.min(F.coalesce("component", "class")).alias("component_id")), "groups"
    )
    found = signs.select("doc", "n_shingles").join(of_doc, "doc", "left")
    component = F.coalesce("component_id", "doc")
    return found.select(
        F.col("doc").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"),
    )


def _pairs(members: DataFrame, banding: Banding) -> DataFrame:
    """Pairs of a bucket that are in different components and may be similar, at most `tables` times each."""
    x, y = members.alias("x"), members.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component"))
    first = ~F.arrays_overlap("x.earlier", "y.earlier")
    return x.join(y, apart & _possible("x", "y", banding.percent) & first).select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b")
    )


def _allowed(edges: DataFrame, features: DataFrame, banding: Banding, nearest: bool = False) -> DataFrame:
    """Edges that sizes and bitmaps allow; `nearest`: only the best few of each class.

    Leaving out all but the nearest loses nothing: what stays apart is taken up again.
    """
    x = features.select(F.col("class").alias("a"), F.struct("n_shingles", "bits").alias("x"))
    y = features.select(F.col("class").alias("b"), F.struct("n_shingles", "bits").alias("y"))
    possible = edges.join(x, "a").join(y, "b").where(_possible("x", "y", banding.percent))
    if not nearest:
        return possible.select("a", "b")
    apart = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(BITS // 64)), F.lit(0))
    best = possible.groupBy("a").agg(F.min_by("b", F.struct(apart, "b")).alias("b"))
    return best.select("a", "b")


def _mixed_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold classes of different components."""
    member = buckets.join(labels, buckets["class"] == labels["node"], "left").select(
        "key", "class", F.coalesce("component", "class").alias("component")
    )
    member = stored(member, "member")
    spread = member.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    spread = stored(spread.where("least <> most").select("key", "least"), "spread")
    mixed_ones = stored(member.join(spread, "key"), "mixed")
    discard(member, spread)
    return mixed_ones
