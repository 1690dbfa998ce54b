"""Operators that work on each text by itself, against brute force and round trips."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmart.llm import langid, pieces, rules, tokens

TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "a b c a b c a b c",
    "x # y\nx # y\n\nZ Ä ß!\nx # y",
    "Ünïcödé     word▁mark 😀 \x00 ퟿",
    "it's they're  'll ''s  \r\n\r\n 12 ٣ <|endoftext|>x",
    "long " * 3000,
    "nospaces" * 4000,
    "x # y\nx # y\n\nZ Ä ß!\nx # y",
]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns that clash with those the operators add.
    rows = [(i, text, "old", "n_words", 1.5) for i, text in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, Score string, failed_bits string, n_tokens double").repartition(3)


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


# Rules.


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_ledger_equals_brute_force(docs):
    found = by_id(rules.ledger(docs))
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert tuple(found[i][m] for m in rules.MEASURES[:5]) == brute_measures(text)
    assert found[0]["failed_bits"] == found[1]["failed_bits"] == 1
    assert found[8]["failed_bits"] & rules.mask_of(("repeated_words",))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n#É!", max_size=60))
def test_measures_of_any_text(text):
    assert rules.measure(text)[:5] == brute_measures(text)


def test_policies_and_ablations(docs):
    book = rules.ledger(docs)
    masks = [row["failed_bits"] for row in book.collect()]
    found = {(r["policy"], r["without"]): (r["kept"], r["docs"]) for r in rules.ablations(book).collect()}
    for version, names in rules.POLICIES.items():
        for left_out in (None, *names):
            mask = rules.mask_of(tuple(n for n in names if n != left_out))
            assert found[version, left_out] == (sum(m & mask == 0 for m in masks), len(TEXTS))
    nothing = {(r["kept"], r["docs"]) for r in rules.ablations(book.limit(0)).collect()}
    assert nothing == {(0, 0)}


def test_bits_are_distinct():
    assert len({rule.bit for rule in rules.RULES}) == len({rule.name for rule in rules.RULES}) == len(rules.RULES)


# Token counts.

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def count():
    return tokens.counter(tokens.compiled(TOKENIZER))


def test_counts_equal_the_library(docs, library):
    found = by_id(tokens.counted(docs, TOKENIZER))
    for i, text in enumerate(TEXTS):
        assert found[i]["n_tokens"] == len(library.encode(text or "", add_special_tokens=False).ids)
        assert found[i]["n_bytes"] == len((text or "").encode())
        assert found[i]["Score"] == "old"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abstrevmld'  \n\t!?09é中Ω 　²😀"), max_size=80))
def test_counts_of_any_text(count, library, text):
    assert count([text])[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_every_character_is_of_the_right_kind(count, library):
    texts = [f"a{chr(p)}b 1{chr(p)}2 .{chr(p)}. {chr(p)}" for p in range(1, 0x30000, 3) if not 0xD800 <= p < 0xE000]
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert count(texts).tolist() == expected


def test_small_bounds_change_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_STATES", 50)
    monkeypatch.setattr(tokens, "MAX_CACHED", 20)
    monkeypatch.setattr(tokens, "MAX_DEPTH", 3)
    count = tokens.counter(tokens.compiled(TOKENIZER))
    texts = [t or "" for t in TEXTS]
    assert count(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


# Language identification.


def test_languages_are_told_apart(spark):
    pick = random.Random(5)
    sounds = {"aa": ["ba", "na", "la"], "oo": ["ko", "to", "po"], "mixed": ["shi", "ru", "ke"]}
    rows = [(i, " ".join("".join(pick.choices(sounds[lang], k=3)) for _ in range(20)), lang) for i, lang in enumerate(list(sounds) * 20)]
    training = spark.createDataFrame(rows[:45] + [(99, None, "aa"), (98, "ba", None)], "doc_id long, text string, lang string")
    model = langid.learned(training)
    assert model[0] == sorted(sounds)
    found = by_id(langid.identified(spark.createDataFrame([r[:2] for r in rows[45:]], "doc_id long, text string"), model))
    assert all(found[i]["lang_pred"] == lang and 0.9 < found[i]["score"] <= 1 for i, _, lang in rows[45:])


def test_counts_of_languages_equal_brute_force(spark):
    texts = [("x", "Ab ab"), ("x", "b"), ("y", "öö 12")]
    names, logs = langid.learned(spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(texts)], "doc_id long, text string, lang string"))
    counts = np.zeros((langid.BUCKETS, 2))
    for name, text in texts:
        hit, n = langid.grams(text)
        counts[hit, names.index(name)] += n
    smoothed = counts + langid.SMOOTHING
    assert np.allclose(logs[:-1], np.log(smoothed / smoothed.sum(0)))
    assert np.allclose(logs[-1], np.log([2 / 3, 1 / 3]))


def test_many_languages_are_told_apart_within_bounded_memory(spark, monkeypatch):
    """300 invented languages: rounds of a few texts give what one round gives."""
    pick = random.Random(2)
    sounds = {f"l{i:03d}": pick.sample("abcdefghijklmnopqrstuvwxyzäöüéñøåß", 6) for i in range(300)}

    def text(name):
        return " ".join("".join(pick.choices(sounds[name], k=5)) for _ in range(60))

    training = [(i, text(name), name) for i, name in enumerate([*sounds] * 2)]
    model = langid.learned(spark.createDataFrame(training, "doc_id long, text string, lang string"))
    assert model[0] == sorted(sounds)
    asked = spark.createDataFrame([(i, text(name)) for i, name in enumerate(sounds)], "doc_id long, text string").coalesce(1)
    found = by_id(langid.identified(asked, model))
    assert sum(found[i]["lang_pred"] == name for i, name in enumerate(sounds)) >= 290
    monkeypatch.setattr(langid, "_CELLS", 1 << 30)
    assert by_id(langid.identified(asked, model)) == found


def test_rare_labels_beyond_the_bound_do_not_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    rows = [(i, "abc abc", "x") for i in range(5)] + [(i, "xyz zyx", "y") for i in range(4)] + [(i, f"dirt {i}", f"dirt{i}") for i in range(20)]
    model = langid.learned(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model[0] == ["x", "y"]


def test_texts_without_letters(docs, spark):
    model = langid.learned(spark.createDataFrame([(1, "abc", "x")], "doc_id long, text string, lang string"))
    found = by_id(langid.identified(docs, model))
    assert [found[i]["lang_pred"] for i in range(4)] == ["und", "und", "und", "x"]
    assert found[0]["score"] == 0.0
    empty = langid.learned(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.identified(docs, empty).collect()} == {"und"}


# Pieces.

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def alphabet():
    return pieces.read_pieces(MODEL)


def test_decoding_gives_back_every_text(docs, alphabet):
    found = by_id(pieces.decoded(pieces.encoded(docs, alphabet, ["doc_id"]), alphabet))
    for i, text in enumerate(TEXTS):
        assert found[i]["decoded"] == (text or "")


def test_segmentations_depend_on_the_row_only(docs, alphabet):
    one = {i: r["pieces"] for i, r in by_id(pieces.encoded(docs.coalesce(1), alphabet, ["doc_id"])).items()}
    two = {i: r["pieces"] for i, r in by_id(pieces.encoded(docs.repartition(7), alphabet, ["doc_id"])).items()}
    assert one == two
    other = {i: r["pieces"] for i, r in by_id(pieces.encoded(docs, alphabet, ["doc_id"], seed=1)).items()}
    assert one != other


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abthe  \n▁é中😀\x00"), max_size=40), min_size=1, max_size=5))
def test_any_texts_are_lossless(alphabet, texts):
    spelling = pieces.spelled(alphabet)
    with np.errstate(over="ignore"):
        found = _lattice(alphabet).sampled(texts, np.arange(len(texts)))
    assert [b"".join(spelling[i] for i in ids).decode() for ids in found] == texts


_lattices = {}


def _lattice(alphabet):
    return _lattices.setdefault(id(alphabet), pieces.Lattice(alphabet))


def test_samples_follow_the_weights(alphabet):
    """Frequencies of sampled segmentations against all segmentations, enumerated."""
    lattice, word = _lattice(alphabet), "▁the"
    ids = {name: i for i, name in enumerate(alphabet.names) if alphabet.normal[i]}

    def ways(text):
        if not text:
            yield (), 0.0
        for k in range(1, len(text) + 1):
            if text[:k] in ids:
                for rest, weight in ways(text[k:]):
                    yield (ids[text[:k]], *rest), weight + lattice.weights[ids[text[:k]]]

    expected = {way: np.exp(weight) for way, weight in ways(word)}
    total = sum(expected.values())
    n = 20_000
    with np.errstate(over="ignore"):
        drawn = Counter(tuple(x.tolist()) for x in lattice.sampled([" the"] * n, np.arange(n)))
    assert set(drawn) <= set(expected)
    for way, weight in expected.items():
        assert abs(drawn[way] / n - weight / total) < 0.02
