"""Registered queries of the operators, and their SQL counterparts where SQL has one."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from ticketmart.llm import (
    brown,
    decontaminate,
    importance,
    langid,
    minhash,
    packing,
    periodic,
    pieces,
    pii,
    rules,
    tokens,
    toolcalls,
    toxicity,
)
from ticketmart.llm.common import annotate, fold, table, texts_of

Query = Callable[[SparkSession, str], DataFrame]


# The key of surrogates. A user puts in a secret of their own.
SURROGATE_KEY = "surrogates"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.ledger(docs).select(
        "doc_id",
        *rules.MEASURES[:5],
        (~rules.keeps("1")).alias("base_failed"),
        rules.keeps("2").alias("kept"),
        "failed_bits",
    )


OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    string_split(text, chr(10)) AS ls FROM d),
tokens AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
windows AS (SELECT doc_id, pos, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
    FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT pos + shift) AS n_repeat_words
    FROM twice, (SELECT unnest(range(3)) AS shift) WHERE n > 1 GROUP BY doc_id),
worded AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(ls) AS line FROM w)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(text, '\P{Lu}', '', 'g')) AS n_upper,
    length(regexp_replace(text, '[^\p{Lu}\p{Ll}]', '', 'g')) AS n_letters,
    length(text) - length(replace(text, '!', '')) AS n_exclaims
    FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (n_symbols * 100 > n_words * 30)::INT + 8 * (n_dup_lines > 2 AND n_dup_lines * 100 > n_lines * 30)::INT
    + 16 * (n_upper * 100 > n_letters * 30)::INT + 32 * (n_exclaims * 100 > n_words * 30)::INT
    + 64 * (word_chars > n_words * 40)::INT AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""


# Tools that the turns of the conversations stand for calls of.
_ARGUMENTS = {
    "type": "object",
    "properties": {
        "query": {"type": "string"},
        "limit": {"type": "integer", "minimum": 1, "maximum": 60},
        "after": {"type": "string"},
    },
    "required": ["query", "limit"],
    "additionalProperties": False,
}
TOOLS = {"search": _ARGUMENTS, "lookup": _ARGUMENTS, "count": _ARGUMENTS}


def tool_messages(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and references that stand for the turns of conversations.

    Each line of an assistant's turn is a call, and line i of the next turn, if a user's,
    its result. Line i refers to line (i - 1) / 2 of its turn. A turn without a number has
    calls and results without an id.
    """
    lines = turns.select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    lines = lines.where(F.trim("line") != "")

    def call_id(turn: Column, position: Column) -> Column:
        return F.concat(F.lit("call-"), turn.cast("string"), F.lit("-"), position.cast("string"))

    position, turn = F.col("position"), F.col("turn")
    needs = F.when(position > 0, call_id(turn, F.floor((position - 1) / 2)))
    said = lines.where("role = 'assistant'").select(
        "conv_id",
        call_id(turn, position).alias("call_id"),
        "turn",
        "position",
        F.get(F.array(*map(F.lit, [*TOOLS, "retired"])), (F.crc32("line") % 10 % 4).cast("int")).alias("name"),
        needs.alias("needs"),
        "line",
    )
    arguments = F.to_json(F.struct(F.size(F.split("line", " ")).alias("limit"), F.col("needs").alias("after"), F.col("line").alias("query")))
    calls = said.select("conv_id", "call_id", "turn", "position", "name", arguments.alias("arguments"))
    results = lines.where("role = 'user' AND coalesce(turn > 0, true)").select(
        "conv_id", call_id(turn - 1, position).alias("call_id"), "turn", F.col("line").alias("content")
    )
    return calls, results, said.where("needs IS NOT NULL").select("conv_id", "call_id", "needs")


def op3_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return toolcalls.linked(*tool_messages(turns), TOOLS)


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.counted(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op5_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return brown.scored(docs.withColumn("held_out", fold("doc_id", 10) == 0))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.learned(docs, labels.where(fold("doc_id", 5) != 0))
    return toxicity.tagged(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "spans"
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.grouped(table(spark, sf_dir, "documents"), minhash.Banding(words=2, percent=80))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learned(docs.where(fold("doc_id", 5) != 0))
    found = langid.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    alphabet = pieces.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.decoded(pieces.encoded(docs, alphabet, ["doc_id"]), alphabet)
    return found.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
        "pieces",
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
asked AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[s:s + 9], ' ') AS phrase
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM asked WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, s, array_to_string(ws[s:s + size - 1], ' ') AS phrase
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS s FROM words, sizes WHERE len(ws) >= size)),
found AS (SELECT doc_id, item_id, s, p.size FROM places p JOIN windows w ON p.phrase = w.phrase AND p.size = w.size),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weighted = importance.weighted(docs, table(spark, sf_dir, "benchmark"), buckets=10_000, longest=2)
    scored = importance.noisy(weighted.drop("text"), seed=7)
    drawn = importance.drawn(scored, percent=25, least_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by the checksum of their ids, repeat a stretch to their end."""

    def start():
        def compute(batch: pa.RecordBatch) -> list:
            planted = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                turn, lot = divmod(crc32(("" if doc_id is None else str(doc_id)).encode()), 10)
                words = text.encode().split() if lot == 0 else []
                if words:
                    first = turn % len(words)
                    period = 1 + (len(words) - first) // (3 + turn % 8)
                    words[first:] = [words[first + i % period] for i in range(len(words) - first)]
                    text = b" ".join(words).decode()
                planted.append(text)
            return [planted]

        return compute

    return annotate(docs, start, [StructField("planted", StringType())]).select("doc_id", F.col("planted").alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.detected(with_periods(docs))
    # Runs come by start and period, so of the longest runs the first is wanted.
    longest = F.array_max(F.transform("runs", lambda run: run["length"]))
    first = F.element_at(F.filter("runs", lambda run: run["length"] == longest), 1)
    first = F.when(F.size("runs") > 0, first)
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        first["start"].alias("start"),
        first["length"].alias("length"),
        first["period"].alias("period"),
        F.floor(1000 * first["length"] / first["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024, end_id=0)
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_rules": op2_rules,
    "op3_toolcalls": op3_toolcalls,
    "op4_tokens": op4_tokens,
    "op5_brown": op5_brown,
    "op6_toxicity": op6_toxicity,
    "op7_minhash": op7_minhash,
    "op8_langid": op8_langid,
    "op9_pieces": op9_pieces,
    "op10_decontaminate": op10_decontaminate,
    "op11_importance": op11_importance,
    "op12_periodic": op12_periodic,
    "op13_packing": op13_packing,
}
ORACLES: dict[str, str] = {"op2_rules": OP2_SQL, "op10_decontaminate": OP10_SQL}
