"""Benchmark passages in training texts, by a distributed positional inverted index.

Benchmark items ask for windows of words. Of each window only the term that is rarest in
the training texts is looked up: the index has, for each such term, its postings
(document, place) with the words next to it. Postings turn into alignments of an item
with a document (place minus offset); the list of the rarest term is intersected with
that of a neighbour, shifted by one, and what is left is compared word by word with the
document. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmart.llm.common import stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Up to so many rows a table of terms or alignments is broadcast; beyond, joins shuffle.
MAX_BROADCAST_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z in lower case, parted by ASCII other than letters and digits."""
    filled = F.coalesce(text, F.lit(""))
    plain = F.octet_length(filled) == F.char_length(filled)
    low = F.when(plain, F.lower(filled)).otherwise(F.translate(filled, _UPPER, _LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def bounded(frame: DataFrame) -> DataFrame:
    """Hint a broadcast if a stored frame has few enough rows."""
    return F.broadcast(frame) if frame.count() <= MAX_BROADCAST_ROWS else frame


def with_row_key(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Columns row, key, words: rows that repeat a key keep their own texts apart."""
    row = F.concat_ws(":", F.col(key).cast("string"), F.hex(F.xxhash64(text)))
    return docs.select(row.alias("row"), F.col(key).alias("key"), words_of(F.col(text)).alias("words"))


def items_of(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Columns item, item_id (text), words, size of the items that have a word."""
    keyed = with_row_key(benchmark, key, text).select(
        F.col("row").alias("item"), F.coalesce(F.col("key").cast("string"), F.lit("")).alias("item_id"), "words"
    )
    return stored(keyed.dropDuplicates(["item"]).withColumn("size", F.size("words")).where("size > 0"), "items")


def term_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of the terms occurs in the training texts."""
    # The outer form, as for the plain one the planner would split the texts again to leave out
    # those without words; an empty place joins with no term.
    tokens = rows.select(F.explode_outer("words").alias("term"))
    return tokens.join(bounded(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def postings(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index of the given terms: term, row, pos, before, after."""
    tokens = rows.select("row", "words", F.posexplode_outer("words").alias("pos", "term"))
    found = tokens.join(bounded(terms), "term")
    # Neighbours are looked up for what is left, and not written for all words.
    before = F.when(F.col("pos") > 0, F.get("words", F.col("pos") - 1)).otherwise("")
    after = F.coalesce(F.get("words", F.col("pos") + 1), F.lit(""))
    return found.select("term", "row", "pos", before.alias("before"), after.alias("after"))


def anchors_of(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """For each window of each item the place of its rarest term, each place once.

    A window with a term that occurs nowhere can't be found and has no anchor.
    """
    placed = items.select("item", "size", F.posexplode("words").alias("p", "term"))
    known = stored(placed.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0))), "placed")
    starts = F.sequence(F.greatest(F.col("p") - window + 1, F.lit(0)), F.greatest(F.least(F.col("p"), F.col("size") - window), F.lit(0)))
    windows = known.withColumn("start", F.explode(starts))
    rarest = windows.groupBy("item", "start").agg(F.min(F.struct("n", "p", "term")).alias("least")).where("least.n > 0")
    places = rarest.select("item", "least.p", "least.term").distinct()
    joined = places.join(items, "item")
    return joined.select(
        "term",
        "item",
        "p",
        "size",
        F.when(F.col("p") > 0, F.get("words", F.col("p") - 1)).alias("left"),
        F.get("words", F.col("p") + 1).alias("right"),
    )


def aligned(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Alignments (row, item, shift) at which an anchor and a neighbour of it agree.

    Every window of two words or more has one of the anchor's neighbours.
    """
    agree = (
        F.coalesce(F.col("left") == F.col("before"), F.lit(False))
        | F.coalesce(F.col("right") == F.col("after"), F.lit(False))
        | (F.col("size") == 1)
    )
    found = index.join(bounded(anchors), "term").where(agree)
    return found.select("row", "item", (F.col("pos") - F.col("p")).alias("shift")).distinct()


def phrase_hits(alignments: DataFrame, rows: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Columns row, item_id, pos: words of a document inside a window of an item."""
    involved = rows.join(bounded(stored(alignments.select("row").distinct(), "involved")), "row", "left_semi")
    pairs = alignments.join(involved.dropDuplicates(["row"]), "row").join(
        items.select("item", "item_id", "size", F.col("words").alias("wanted")), "item"
    )
    first = F.greatest(F.col("shift"), F.lit(0))
    part = pairs.select(
        "row", "item", "item_id", "size", "shift", "wanted", F.slice("words", first + 1, F.col("size")).alias("part"), first.alias("first")
    )
    places = F.posexplode("part").alias("i", "word")
    compared = part.select("row", "item", "item_id", "size", "shift", "wanted", "first", places).withColumn(
        "j", F.col("first") + F.col("i") - F.col("shift")
    )
    same = compared.where(F.get("wanted", F.col("j")) == F.col("word"))
    alignment = ["row", "item", "shift"]
    numbered = same.withColumn("run", F.col("j") - F.row_number().over(Window.partitionBy(*alignment).orderBy("j")))
    length = F.count("*").over(Window.partitionBy(*alignment, "run"))
    long_enough = numbered.withColumn("length", length).where(F.col("length") >= F.least(F.col("size"), F.lit(window)))
    return long_enough.select("row", "item_id", (F.col("j") + F.col("shift")).alias("pos"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and no hit. Rows that repeat a key count each by
    their own text; a null key is kept. Items without a word are left out, an item whose
    id is null counts under ''. Only key and text columns are used.
    """
    rows = with_row_key(docs, key, text)
    items = items_of(benchmark, item_key, "text")
    terms = stored(items.select(F.explode("words").alias("term")).distinct(), "terms")
    counts = stored(term_counts(rows, terms), "counts")
    anchors = stored(anchors_of(items, counts, window), "anchors")
    index = stored(postings(rows, stored(anchors.select("term").distinct(), "sought")), "index")
    alignments = stored(aligned(index, anchors), "alignments")
    hits = phrase_hits(alignments, rows, items, window)
    per_place = hits.groupBy("row").agg(
        F.count_distinct("pos").alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    found = stored(per_place, "hits")
    joined = rows.select("row", "key", F.size("words").cast("long").alias("n_words")).join(found, "row", "left")
    names = F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        F.col("key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def proximity(docs: DataFrame, phrases: DataFrame, slop: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that have all words of a phrase close together, in any order.

    `phrases` has `phrase_id` and `text`. A match is a place of the phrase's rarest term
    with every other distinct word of the phrase at most `slop` places away. Columns:
    key, phrase_id, pos. Lists are intersected by document and stretch of `slop` places,
    so that the join stays one on equal keys.
    """
    rows = with_row_key(docs, key, text)
    asked = stored(
        phrases.select("phrase_id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term")).distinct(), "asked"
    )
    terms = stored(asked.select("term").distinct(), "terms")
    counts = stored(term_counts(rows, terms), "counts")
    index = stored(postings(rows, terms).select("term", "row", "pos"), "index")
    ranked = asked.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ranked.groupBy("phrase_id").agg(F.min(F.struct("n", "term")).alias("least"), F.count("*").alias("size"))
    first = stored(rarest.select("phrase_id", "least.term", "size"), "rarest")
    stretch = (F.col("pos") / slop).cast("long") if slop else F.col("pos").cast("long")
    seeds = index.join(first, "term").select("phrase_id", "size", "row", "pos", F.col("term").alias("seed"), stretch.alias("at"))
    near = seeds.withColumn("at", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)))
    others = index.join(asked, "term").select(
        F.col("phrase_id").alias("other"), "term", F.col("row").alias("in_row"), F.col("pos").alias("there"), stretch.alias("in_at")
    )
    same = (F.col("phrase_id") == F.col("other")) & (F.col("row") == F.col("in_row")) & (F.col("at") == F.col("in_at"))
    close = near.join(others, same & (F.abs(F.col("pos") - F.col("there")) <= slop) & (F.col("term") != F.col("seed")))
    whole = close.groupBy("phrase_id", "size", "row", "pos").agg(F.count_distinct("term").alias("n")).where("n = size - 1")
    lone = seeds.where("size = 1").select("phrase_id", "size", "row", "pos", F.lit(0).cast("long").alias("n"))
    keys = rows.select("row", "key").dropDuplicates(["row"])
    return whole.unionByName(lone).join(keys, "row").select(F.col("key").alias(key), "phrase_id", "pos")
