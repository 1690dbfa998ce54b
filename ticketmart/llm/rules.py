"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and one
bit for each rule that the document fails. A policy is a versioned set of rules; it
is applied to the stored bits, so that a new policy, or the question what a policy
would keep without one of its rules, needs no text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from ticketmart.llm.common import annotate, texts_of

SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\v\f\r"
_NOT_ASCII = re.compile(r"[^\x00-\x7F]+")

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_exclaims",
)


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: Callable[[], Column]


def _share(part: str, whole: str, percent: int) -> Column:
    return F.col(part) * 100 > F.col(whole) * percent


# A bit keeps its meaning for good: stored ledgers refer to it. New rules get new bits.
RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_words", lambda: _share("n_repeat_words", "n_words", 50)),
    Rule(2, "symbols", lambda: _share("n_symbols", "n_words", 30)),
    Rule(3, "repeated_lines", lambda: (F.col("n_dup_lines") > 2) & _share("n_dup_lines", "n_lines", 30)),
    Rule(4, "capitals", lambda: _share("n_upper", "n_letters", 30)),
    Rule(5, "exclamations", lambda: _share("n_exclaims", "n_words", 30)),
    Rule(6, "long_words", lambda: F.col("word_chars") > F.col("n_words") * 40),
)

BASE = ("few_words", "repeated_words")
POLICIES: dict[str, tuple[str, ...]] = {
    "1": BASE,
    "2": tuple(rule.name for rule in RULES),
}


def mask_of(names: tuple[str, ...]) -> int:
    bits = {rule.name: 1 << rule.bit for rule in RULES}
    return sum(bits[name] for name in set(names))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.array([codes.setdefault(word, len(codes)) for word in words], np.int64)
    pairs = np.unique(ids[:-1] * len(codes) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(codes) + ids[2:]
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def cased(text: str, encoded: bytes) -> tuple[int, int]:
    """Capital letters, and letters that have a case."""
    ascii_bytes = np.frombuffer(encoded, np.uint8)
    upper = int(np.count_nonzero((ascii_bytes >= 65) & (ascii_bytes <= 90)))
    lower = int(np.count_nonzero((ascii_bytes >= 97) & (ascii_bytes <= 122)))
    if len(encoded) > len(text):
        rest = "".join(_NOT_ASCII.findall(text))
        upper += sum(map(str.isupper, rest))
        lower += sum(map(str.islower, rest))
    return upper, upper + lower


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    encoded = text.encode()
    words = encoded.split()
    lines = [line for line in encoded.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, _WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        *cased(text, encoded),
        text.count("!"),
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    def start():
        def compute(batch: pa.RecordBatch) -> list:
            rows = np.array([measure(t) for t in texts_of(batch, text)], np.int64).reshape(-1, len(MEASURES))
            return [pa.array(rows[:, i]) for i in range(len(MEASURES))]

        return compute

    return annotate(docs, start, [StructField(name, LongType(), False) for name in MEASURES], text)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements and `failed_bits` to documents.

    A null or empty text has no words and fails `few_words` only. Rows are neither
    joined nor grouped, so repeated rows stay and very long texts are read whole.
    Columns with the name of a measurement or of the mask are replaced.
    """
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, text).withColumn("failed_bits", bits)


def keeps(policy: str) -> Column:
    """Whether a policy keeps a row of a ledger."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(book: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """What each policy keeps, and what it would keep without one of its rules.

    Documents are counted by mask first, at most one row for each of the 2^rules masks;
    the rest works on those counts. `without` is null for the whole policy.
    """
    spark = book.sparkSession
    trials = [(version, None, mask_of(names)) for version, names in policies.items()]
    trials += [
        (version, name, mask_of(tuple(n for n in names if n != name)))
        for version, names in policies.items()
        for name in names
    ]
    counted = book.groupBy("failed_bits").agg(F.count("*").alias("docs"))
    tried = F.explode(
        F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(w).cast("string").alias("without"), F.lit(m).cast("long").alias("mask")) for v, w, m in trials])
    )
    kept = F.col("failed_bits").bitwiseAND(F.col("trial.mask")) == 0
    found = counted.select("failed_bits", "docs", tried.alias("trial")).groupBy("trial.policy", "trial.without").agg(
        F.sum(F.when(kept, F.col("docs")).otherwise(0)).alias("kept"), F.sum("docs").alias("docs")
    )
    frame = spark.createDataFrame([(v, w) for v, w, _ in trials], "policy string, without string")
    same = frame["policy"].eqNullSafe(found["policy"]) & frame["without"].eqNullSafe(found["without"])
    zero = F.lit(0).cast("long")
    return frame.join(found, same, "left").select(
        frame["policy"], frame["without"], F.coalesce("kept", zero).alias("kept"), F.coalesce("docs", zero).alias("docs")
    )
