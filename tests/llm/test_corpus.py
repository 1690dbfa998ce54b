"""Operators that work on whole tables, against brute force on small ones."""

from __future__ import annotations

import dataclasses
import hashlib
import itertools
import json
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from ticketmart.llm import brown, decontaminate, minhash, pii, toolcalls, toxicity
from ticketmart.llm.graph import components
from ticketmart.llm.queries import tool_messages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def least_members(edges, nodes):
    """Component of each node, by its least member."""
    of = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(of[a], of[b])
            changed |= of[a] != m or of[b] != m
            of[a] = of[b] = m
    return of


@pytest.fixture(scope="module")
def corpus():
    """Random prose with exact and near copies, chains, a hot group, nulls and repeated ids."""
    pick = random.Random(7)
    vocabulary = ["".join(pick.choices("aeioknrstl", k=pick.randrange(2, 7))) for _ in range(120)]
    texts = [" ".join(pick.choices(vocabulary, k=pick.randrange(5, 60))) for _ in range(60)]
    base = pick.choices(vocabulary, k=60)
    for _ in range(25):  # near copies of one text, some of them only similar to each other
        copy = list(base)
        for _ in range(pick.randrange(1, 5)):
            copy[pick.randrange(60)] = pick.choice(vocabulary)
        texts.append(" ".join(copy))
    chain = list(base)
    for i in range(12):
        chain[5 * i % 60] = vocabulary[i]
        texts.append(" ".join(chain).upper() if i % 2 else " ".join(chain))
    texts += [texts[0]] * 6 + [None, "", " \n ", "single", "Single", "İé É é", texts[3] + "\n\n"]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    rows = [(i, t, "x", "y") for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, component_id string, N_HIT string").repartition(5)


# Near-duplicates.


def brute_groups(corpus, n, percent):
    sets = {}
    for i, text in corpus:
        w = words(text)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    edges = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, least_members(edges, sets)


@pytest.mark.parametrize("n", [2, 5])
def test_groups_equal_brute_force(docs, corpus, n):
    sizes, groups = brute_groups(corpus, n, 80)
    found = minhash.grouped(docs, minhash.Banding(words=n)).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, _ in corpus)
    for row in found:
        i = row["doc_id"]
        assert (row["n_shingles"], row["component_id"], row["kept"]) == (sizes[i], groups[i], groups[i] == i)


def test_groups_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.grouped(empty).count() == 0
    null = spark.createDataFrame([(None, "a b c")], "doc_id long, text string")
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.grouped(null).collect()] == [(2, None, True)]


def test_bitmaps_never_overstate_the_difference():
    pick = np.random.default_rng(3)
    banding = minhash.Banding()
    factors = minhash._factors(2 * banding.tables * banding.rows)
    with np.errstate(over="ignore"):
        for _ in range(50):
            pool = pick.integers(0, 2**63, 900, dtype=np.uint64)
            a, b = np.unique(pick.choice(pool, 500)), np.unique(pick.choice(pool, 400))
            one, two = minhash.signature(a, banding, factors)[1], minhash.signature(b, banding, factors)[1]
            assert sum(int(x).bit_count() for x in one ^ two) <= len(np.setxor1d(a, b))


def test_components_of_random_graphs(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == least_members([e for e in edges if e[0] != e[1]], nodes)


# Decontamination.

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return ITEM_WORD.findall(lower(text))


def brute_hits(corpus, items):
    out = []
    for i, text in corpus:
        w, hit, found = item_words(text), set(), set()
        for item, content in items:
            asked = item_words(content)
            size = min(10, len(asked))
            windows = {tuple(asked[k : k + size]) for k in range(len(asked) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if size and tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_hits_equal_brute_force(spark, docs, corpus):
    texts = [t for _, t in corpus if t and len(t.split()) > 30]
    items = [
        (1, texts[0]), (10, " ".join(texts[1].split()[4:20])), (2, "!".join(texts[2].split()[:9])), (3, texts[3].split()[0]),
        (4, "words that are nowhere at all in the texts of this test"), (5, None), (6, " ,"), (7, "É é"), (7, texts[4]),
        (None, " ".join(texts[-1].split()[3:15])), (8, " ".join(["aa"] * 12)),
    ]
    more = [(500, "aa " * 40), (501, "aa " * 9)]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    both = docs.select("doc_id", "text", "N_HIT").union(spark.createDataFrame([(i, t, "") for i, t in more], "doc_id long, text string, n string"))
    found = decontaminate.contaminated(both, benchmark)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(tuple(r[n] for n in names) for r in found.collect()) == brute_hits(corpus + more, items)


def test_hits_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contaminated(docs, none).collect()} == {0}
    assert decontaminate.contaminated(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("slop", [0, 3, 8])
def test_proximity_equals_brute_force(spark, docs, corpus, slop):
    pick = random.Random(slop)
    texts = [words(t) for _, t in corpus if t and len(t.split()) > 20]
    phrases = [(i, " ".join(pick.sample(w[k : k + 8], 3))) for i, w in enumerate(pick.sample(texts, 6)) for k in (5,)] + [(50, "single")]
    counts = Counter(x for _, t in dict.fromkeys(corpus + [(3, corpus[3][1])]) for x in item_words(t))
    counts = Counter(x for _, t in corpus for x in item_words(t))
    expected = set()
    for p, phrase in phrases:
        terms = set(item_words(phrase))
        seed = min(terms, key=lambda t: (counts[t], t))
        for i, text in corpus:
            w = item_words(text)
            for k, x in enumerate(w):
                near = w[max(0, k - slop) : k + slop + 1]
                if x == seed and terms <= set(near):
                    expected.add((i, p, k))
    found = decontaminate.proximity(docs, spark.createDataFrame(phrases, "phrase_id long, text string"), slop)
    assert {(r["doc_id"], r["phrase_id"], r["pos"]) for r in found.collect()} == expected


# Class-based n-grams.


def test_base_scores_equal_brute_force(spark, corpus):
    held = {i: crc32(str(i).encode()) % 3 == 0 for i, _ in corpus}
    frame = spark.createDataFrame([(i, t, held[i]) for i, t in corpus], "doc_id long, text string, held_out boolean")
    counts = Counter(w for i, t in corpus if not held[i] for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    found = sorted(brown.scored(frame).collect())
    assert len(found) == len(corpus)
    better = 0.0
    for row, (_, text) in zip(found, sorted(corpus, key=lambda r: r[0])):
        tokens = [*words(text), None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert row["base_score"] == pytest.approx(base, abs=1e-9)
        assert row["score"] < 0
    assert better == 0.0


def test_class_model_beats_unigrams_on_patterned_text(spark):
    pick = random.Random(2)
    kinds = [[f"{k}{i}" for i in range(30)] for k in ("noun", "verb", "end")]
    rows = [(i, " ".join(pick.choice(kinds[k % 3]) for k in range(30)), i % 10 == 0) for i in range(300)]
    found = brown.scored(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).where("held_out").collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found) + 20 * len(found) * 0.3


def test_probabilities_add_up():
    pick = np.random.default_rng(1)
    counts = pick.integers(0, 9, (brown.CLASSES + 2, brown.CLASSES + 2)).astype(float)
    reserved = np.full(brown.CLASSES, 0.01)
    chance = 10 ** brown.transition_logs(counts, reserved)
    chance[:, brown.UNKNOWN] = 0
    assert np.allclose(chance.sum(1), 1)


def test_scores_of_nothing(spark):
    kind = "doc_id long, text string, held_out boolean"
    assert brown.scored(spark.createDataFrame([], kind)).count() == 0
    row = brown.scored(spark.createDataFrame([(1, "a b", True), (None, None, True)], kind)).orderBy("n_tokens").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in row] == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


# Toxicity.


def test_forward_backward_equals_enumeration():
    pick = np.random.default_rng(0)
    sizes = np.array([3, 0, 1, 5, 150])
    emission, pairs = pick.normal(0, 2, sizes.sum()), pick.normal(0, 1, (2, 2))
    chance = toxicity.forward_backward(emission, sizes, pairs)[2]
    for start, size in ((0, 3), (3, 1), (4, 5)):
        sums = np.zeros((2, size))
        for way in itertools.product((0, 1), repeat=size):
            weight = math.exp(sum(emission[start + i] * y for i, y in enumerate(way)) + sum(pairs[a, b] for a, b in zip(way, way[1:])))
            for i, y in enumerate(way):
                sums[y, i] += weight
        assert np.allclose(chance[start : start + size], sums[1] / sums.sum(0))
    alpha, beta = np.zeros((150, 2)), np.ones((150, 2))
    psi, table = np.exp(np.stack((np.zeros(150), emission[9:]), 1)), np.exp(pairs)
    alpha[0] = psi[0]
    for t in range(1, 150):
        alpha[t] = alpha[t - 1] @ table * psi[t]
        alpha[t] /= alpha[t].sum()
    for t in range(148, -1, -1):
        beta[t] = table @ (psi[t + 1] * beta[t + 1])
        beta[t] /= beta[t].sum()
    both = alpha * beta
    assert np.allclose(chance[9:], both[:, 1] / both.sum(1))


def test_toxic_words_are_found(spark):
    pick = random.Random(4)
    clean = ["".join(pick.choices("aeiost", k=5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(240):
        text = pick.choices(clean, k=40)
        if i % 4 == 0:
            text[10:12] = [pick.choice(["grumble", "grumbling", "blarg"]), pick.choice(["blarg", "Blarg!"])]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    frame = spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 5] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.tagged(frame, toxicity.learned(frame, known)).collect()}
    assert all(found[i]["predicted"] == label for i, label in labels)
    assert found[900]["predicted"] == found[901]["predicted"] == 0 and found[900]["spans"] == []
    text = dict(rows)[20]
    assert any("blarg" in text[s["start"] : s["stop"]].lower() for s in found[20]["spans"])


def test_toxic_words_are_found_inside_long_ones(spark):
    """Behind 64 bytes of a comma-joined run, and in a run without any punctuation."""
    pick = random.Random(4)
    clean = ["".join(pick.choices("aeiost", k=5)) for _ in range(200)]
    rows = [(i, " ".join([*pick.choices(clean, k=40), *(["grumble", "blarg"] if i % 4 == 0 else [])])) for i in range(240)]
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.learned(spark.createDataFrame(rows, "doc_id long, text string"), known)
    run = ",".join(clean[:30])
    texts = ["blarg", f"{run},blarg", f"{run},blarg,{run} {run}", run, f"{run} {run}", "x" * 5000, ("é" * 70) + ",grumble"]
    found = {r["doc_id"]: r for r in toxicity.tagged(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()}
    assert [found[i]["predicted"] for i in range(len(texts))] == [1, 1, 1, 0, 0, 0, 1]
    (span,) = found[2]["spans"]
    assert texts[2][span["start"] : span["stop"]] == f"{run},blarg,{run}"


@pytest.mark.parametrize("word", [b"a" * 64, b"a" * 65, b"ab," * 40, b"," * 100, b"z" * 97, "é".encode() * 50 + b"." + b"q" * 200])
def test_stretches_cover_a_word(word):
    found = toxicity.stretches(word)
    for piece in re.findall(rb"[^!-/:-@\[-`{-~]+", word) or [word]:
        for i in range(0, len(piece), 8):  # any eight bytes of a piece lie in one stretch
            assert any(piece[i : i + 8] in stretch for stretch in found)


def test_slopes_equal_differences_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 64)
    made = toxicity.packed_batch(["aa bb cc", "", "bb dd", "ee"], [True, False, True, False]).labelled(np.zeros(0, np.int64))
    made = dataclasses.replace(made, gold=np.array([True, False, True, False, True, False]))
    pick = np.random.default_rng(3)
    model = toxicity.Model(pick.normal(0, 0.3, 64), -0.4, pick.normal(0, 0.5, (2, 2)), np.zeros(3))

    def likelihood(model):
        score = np.add.reduceat(model.weights[made.flat], made.starts) + model.bias
        at, total = 0, 0.0
        for size in made.sizes:
            emission, gold = score[made.ids[at : at + size]], made.gold[at : at + size].astype(int)
            at += size
            weight = lambda way: sum(e * y for e, y in zip(emission, way)) + sum(model.pairs[a, b] for a, b in zip(way, way[1:]))  # noqa: E731, B023
            total += weight(gold) - math.log(sum(math.exp(weight(way)) for way in itertools.product((0, 1), repeat=size)))
        return total

    found, step = toxicity.slopes(made, model), 1e-5
    for i in range(64 + 5):
        def moved(by, i=i):
            weights, bias, pairs = model.weights.copy(), model.bias, model.pairs.copy()
            if i < 64:
                weights[i] += by
            elif i == 64:
                bias += by
            else:
                pairs.ravel()[i - 65] += by
            return likelihood(dataclasses.replace(model, weights=weights, bias=bias, pairs=pairs))
        assert found[i] == pytest.approx((moved(step) - moved(-step)) / (2 * step), abs=1e-6)


def test_copies_of_a_toxic_text_count_once(spark):
    rows = [(i, "the same text of a few words") for i in range(50)] + [(50, "another text that differs")] + [(60, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    picked = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, toxic int")
    assert toxicity.training_rows(docs, picked, "doc_id", "text").count() == 2


def test_without_labels_nothing_is_toxic(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = toxicity.learned(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["predicted"] for r in toxicity.tagged(frame, model).collect()] == [0]


# Personal data.

PERSONAL = [
    "Mail die.55@mail4.example.com or DIE.55@MAIL4.example.com now",
    "call +1 (017) 555-7713, 97.51.17.173 or 4111 1111 1111 1111 and 4111111111111111",
    'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" "9B0B3C6A43EB78AA99CBD7049C572391524F37A8"!!',
    "Mr. John Smith met Mrs Anna Smith, MR. SMITH, Dr. Kim Lee; Госпожа Иванова",
    "DE89 3704 0044 0532 0130 00 and 123-45-6789 sk-abcdefghijklmnop1234",
    None,
    "",
    "nothing personal: 12 34, 1.2.3, a@b, Mrs x 2020-01-02",
    "the same die.55@mail4.example.com",
]


@pytest.fixture(scope="module")
def surrogates(spark):
    frame = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(PERSONAL)], "doc_id long, text string, n_entities string, kind int")
    return {r["doc_id"]: r for r in pii.anonymised(frame.repartition(3), "key").collect()}


def shape(text):
    return re.sub(r"\d", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", text)))


def test_surrogates_keep_the_format(surrogates):
    assert [surrogates[i]["n_entities"] for i in range(9)] == [2, 4, 2, 5, 3, 0, 0, 0, 1]
    assert surrogates[5]["text"] is None and surrogates[6]["text"] == "" and surrogates[7]["text"] == PERSONAL[7]
    for i in (0, 1, 2, 4, 8):
        assert shape(surrogates[i]["text"]) == shape(PERSONAL[i])
        assert surrogates[i]["text"] != PERSONAL[i]


def test_surrogates_are_coreferent(surrogates):
    mail = re.findall(r"\S+@\S+", surrogates[0]["text"])
    assert mail[0] == mail[1].lower().replace(".COM", ".com") or mail[0].lower() == mail[1].lower()
    assert re.findall(r"\S+@\S+", surrogates[8]["text"])[0] == mail[0]
    cards = re.findall(r"\d[\d ]{14,18}\d", surrogates[1]["text"])
    assert cards[-2].replace(" ", "") == cards[-1]
    secrets = re.findall(r"[0-9A-Fa-f]{40}", surrogates[2]["text"])
    assert secrets[0].upper() == secrets[1]


def test_surrogates_are_valid(surrogates):
    card = re.findall(r"\d{16}", surrogates[1]["text"])[0]
    digits = [int(c) for c in card[::-1]]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    account = re.search(r"DE[\d ]{20,25}\d", surrogates[4]["text"]).group().replace(" ", "")
    assert int(account[4:] + "1314" + account[2:4]) % 97 == 1
    address = re.search(r"\d+\.\d+\.\d+\.\d+", surrogates[1]["text"]).group()
    assert all(0 < int(o) < 256 for o in address.split("."))


def test_names_keep_title_gender_and_script(surrogates):
    found = re.fullmatch(r"Mr\. (\S+) (\S+) met Mrs (\S+) (\S+), MR\. (\S+), Dr\. (\S+) (\S+); Госпожа (\S+)", surrogates[3]["text"])
    he, his, she, hers, loud, *_, woman = found.groups()
    assert his == hers and loud == his.upper() and "Smith" not in surrogates[3]["text"]
    assert he in pii.GIVEN_NAMES["latin", "m"] and she in pii.GIVEN_NAMES["latin", "f"]
    assert re.fullmatch("[А-Я][а-я]+ова", woman)


def test_surrogates_stay_distinct(spark):
    """Entities of few letters collide at first, and their surrogates with each other."""
    rows = [(i, f"x {chr(97 + i % 26)}{i % 10}@b.co y 1.2.{i % 9}.{i % 7}") for i in range(260)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"].split() for r in pii.anonymised(frame, "key").collect()}
    for k in (1, 3):
        pairs = {(text.split()[k], found[i][k]) for i, text in rows}
        old, new = {a for a, _ in pairs}, {b for _, b in pairs}
        assert len(pairs) == len(old) == len(new) and not old & new


def replaced_pairs(spark, mentions):
    """Each mention in a document of its own, and its surrogate."""
    frame = spark.createDataFrame(list(enumerate(mentions)), "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in pii.anonymised(frame, "key").collect()}
    return {mention: found[i] for i, mention in enumerate(mentions)}


def test_more_entities_than_a_space_holds(spark):
    """A hundred tails of phone numbers, 26 domains, local parts and keys without letters."""
    mentions = [f"+123{n:02d}" for n in range(90)]
    mentions += [f"{a}@{b}.co" for a in "ab" for b in "abcdefghijklmnopqrstuvwxyz"] + ["+@a.co", "-@a.co", "sk-" + "_" * 16]
    found = replaced_pairs(spark, mentions)
    assert len(set(found.values())) == len(found) and not set(found) & set(found.values())
    domains = {(old.split("@")[1], new.split("@")[1]) for old, new in found.items() if "@" in old}
    assert len(domains) == len({old for old, _ in domains}) == len({new for _, new in domains}) == 26


def test_names_beyond_their_first_space(spark, monkeypatch):
    monkeypatch.setitem(pii.SYLLABLES, "latin", ("ba", "del"))
    found = replaced_pairs(spark, ["Mr Q" + a + b for a in "abcde" for b in "abcde"])
    assert len(set(found.values())) == len(found) and not set(found) & set(found.values())


def test_persons_of_one_surname_stay_distinct(spark):
    """More given names than there are to choose from; short forms keep the surname."""
    found = replaced_pairs(spark, ["Mr " + a + " Smith" for a in ("John", "Jack", *("Q" + b for b in "abcdefghijklmnopqrst"))] + ["Mr Smith", "MR JOHN SMITH"])
    short, loud = found.pop("Mr Smith"), found.pop("MR JOHN SMITH")
    assert len(set(found.values())) == len(found) == 22
    assert {new.split(" ")[-1] for new in found.values()} == {short.split(" ")[-1]}
    assert loud == found["Mr John Smith"].upper()


def test_letters_of_all_scripts_are_replaced(spark):
    mentions = ["王小明@例子.公司", "たなか@x.com", "カナ@x.com", "김철수@한국.com", "محمد٣٤@مثال.com", "דוד@x.com", "हिन्दी१२@उदाहरण.com", "ანა@მაგალითი.com", "ไทย๑๒@x.com"]
    for old, new in replaced_pairs(spark, mentions).items():
        (local, domain), (new_local, new_domain) = old.split("@"), new.split("@")
        assert new_local != local and new_domain != domain and len(new_local) <= len(local) + 2
        assert sum(a == b for a, b in zip(local, new_local)) < len(local) - 1


def test_mentions_of_any_length_are_whole(spark):
    mentions = {
        "sk-proj-" + "aB3_" * 39: "sk-",
        "0f" * 100: "",
        "q" * 90 + "@b.example.com": "",
        "x@" + "lab." * 200 + "com": "",
        "Mr Quentin Zoltan Xaver Wolfgang Yngling": "Mr ",
        "Mr Q" + "z" * 40: "Mr ",
    }
    found = replaced_pairs(spark, list(mentions))
    for old, kept in mentions.items():
        rest, new = old.removeprefix(kept), found[old]
        assert new.startswith(kept) and all(rest[i : i + 8] not in new for i in range(4, len(rest) - 12, 4))
    found = replaced_pairs(spark, ["Mr. Quill Mr. Zander", "Mr Zander"])
    assert "Quill" not in found["Mr. Quill Mr. Zander"] and found["Mr. Quill Mr. Zander"].split()[-1] == found["Mr Zander"].split()[-1]


def test_no_documents_have_no_entities(spark):
    assert pii.anonymised(spark.createDataFrame([], "doc_id long, text string"), "key").count() == 0


# Tool calls.

TOOL = {"type": "object", "properties": {"n": {"type": "integer", "maximum": 5}, "q": {"type": ["string", "null"]}}, "required": ["n"], "additionalProperties": False}


@pytest.fixture(scope="module")
def exchange(spark):
    calls = [
        ("c", "a", 1, 0, "t", '{"q": "ü", "n": 1}'), ("c", "b", 1, 1, "t", '{"n": 9, "z": 1}'), ("c", "d", 1, 2, "u", "{}"),
        ("c", "e", 2, 0, "t", '{"n": 1, "n": 2}'), ("c", "e2", 2, 1, "t", None), ("c", "f", 3, 0, "t", '{"n": 2}'),
        ("c", "f", 3, 1, "t", '{"n": 3}'), ("c", "g", 4, 0, "t", '{"n": 3}'), ("c", "h", 4, 1, "t", '{"n": 3}'),
        ("c", "i", 4, 2, "t", '{"n": 3.0}'), ("k", "a", 0, 0, "t", '{"n": 1}'), (None, "a", 0, 0, "t", '{"n": 1}'), ("k", None, 0, 1, "t", '{"n": 1}'),
    ]
    results = [("c", "a", 2, "yes"), ("c", "b", 2, None), ("k", "a", 1, "two"), ("k", "a", 2, "one"), ("k", "zz", 1, "lost"), ("k", None, 1, "x"), ("c", "i", 5, "")]
    refs = [("c", "b", "a"), ("c", "d", "b"), ("c", "d", "a"), ("c", "g", "h"), ("c", "h", "g"), ("c", "i", "h"), ("c", "e", "nobody"), ("k", "a", "b"), ("q", "a", "b")]
    frame = spark.createDataFrame
    return toolcalls.linked(
        frame([(*c, 1) for c in calls], "conv_id string, call_id string, turn int, position int, name string, arguments string, level int"),
        frame(results, "conv_id string, call_id string, turn int, content string"),
        frame(refs, "conv_id string, call_id string, needs string"),
        {"t": TOOL},
    ).collect()


def test_calls_are_linked_ordered_and_checked(exchange):
    found = {(r["conv_id"], r["call_id"]): r for r in exchange if r["conv_id"] and r["call_id"]}
    status = {k[1]: r["status"] for k, r in found.items() if k[0] == "c"}
    assert status == {"a": "ok", "b": "invalid", "d": "invalid", "e": "invalid", "e2": "invalid", "f": "duplicate", "g": "circular", "h": "circular", "i": "circular"}
    assert {k[1]: r["level"] for k, r in found.items() if k[0] == "c"} == {"a": 0, "b": 1, "d": 2, "e": 0, "e2": 0, "f": 0, "g": None, "h": None, "i": None}
    assert found["c", "a"]["json"] == '{"arguments":{"n":1,"q":"ü"},"id":"a","name":"t","result":"yes"}'
    assert found["c", "b"]["errors"] == ["$.n: above 5", "$.z: unknown"]
    assert found["c", "d"]["errors"] == ["unknown tool"]
    assert found["c", "e"]["json"] is None and found["c", "e"]["errors"] == ["arguments are no JSON", "1 unknown references, nobody the first"]
    assert (found["k", "a"]["n_results"], found["k", "a"]["result_turn"], found["k", "a"]["status"]) == (2, 1, "duplicate")
    assert found["k", "zz"]["status"] == "orphan"
    assert sum(r["status"] == "unlinked" for r in exchange) == 3
    assert all(json.loads(r["json"]) for r in exchange if r["json"])


def link(spark, calls, results=(), tools=None):
    frame = spark.createDataFrame
    return toolcalls.linked(
        frame(list(calls), "conv_id string, call_id string, turn int, position int, name string, arguments string"),
        frame(list(results), "conv_id string, call_id string, turn int, content string"),
        frame([], "conv_id string, call_id string, needs string"),
        {"t": TOOL} if tools is None else tools,
    ).collect()


def test_different_calls_and_results_of_one_id_all_stay(spark):
    calls = [("c", "a", 1, 0, "t", '{"n": 1}'), ("c", "a", 1, 0, "t", '{"n": 2}'), ("c", "a", 1, 0, "t", '{"n": 2}'), ("c", "a", None, 0, None, None), ("c", "b", 1, 0, "t", '{"n": 1}')]
    results = [("c", "a", 2, "x"), ("c", "a", 2, "y"), ("c", "a", 3, None), ("c", "b", 2, "z"), ("c", "b", 2, "z"), ("c", "o", 2, "1"), ("c", "o", 2, "2")]
    found = link(spark, calls, results)
    assert sorted((r["call_id"], r["json"] or "", r["status"], r["n_calls"], r["n_results"]) for r in found) == sorted([
        ("a", "", "duplicate", 4, 3),  # the first call: no turn, no arguments
        ("a", '{"arguments":{"n":1},"id":"a","name":"t","result":null}', "duplicate", 4, 3),
        ("a", '{"arguments":{"n":2},"id":"a","name":"t","result":null}', "duplicate", 4, 3),
        ("a", '{"id":"a","result":"y"}', "duplicate", 4, 3), ("a", '{"id":"a","result":null}', "duplicate", 4, 3),
        ("b", '{"arguments":{"n":1},"id":"b","name":"t","result":"z"}', "duplicate", 1, 2),
        ("o", '{"id":"o","result":"1"}', "orphan", 0, 2), ("o", '{"id":"o","result":"2"}', "duplicate", 0, 2),
    ])


def test_a_hot_id_loses_nothing(spark):
    calls = [("c", "hot", i, 0, "t", f'{{"n": {i % 5}}}') for i in range(2000)] + [("c", str(i), 0, 0, "t", '{"n": 1}') for i in range(2000)]
    found = link(spark, calls)
    assert len(found) == 4000 and sum(r["status"] == "duplicate" for r in found) == 2000


def test_unusual_arguments_and_schemas(spark):
    calls = [("c", str(i), 0, 0, "t", text) for i, text in enumerate(['{"n": 1, "q": "\\ud800"}', '{"n": 1, "\\udfff": 2}', '{"n": 1.0}', '{"n": 1e0}', '{"n": -0.0}'])]
    found = {r["call_id"]: r for r in link(spark, calls)}
    assert [found[str(i)]["status"] for i in range(5)] == ["invalid", "invalid", "pending", "pending", "pending"]
    assert found["0"]["json"] is None and found["0"]["errors"] == ["arguments are no JSON"]
    assert found["2"]["json"].replace('"2"', '"3"') == found["3"]["json"] and '"n":0}' in found["4"]["json"]
    assert toolcalls.violations(True, {"enum": [1]}) and not toolcalls.violations(1.0, {"enum": [1]})
    for wrong in ({"pattern": "x"}, {"type": "text"}, {"items": {"oneOf": []}}, {"properties": {"a": {"type": ["string", "date"]}}}, {"additionalProperties": {}}):
        with pytest.raises(ValueError, match="schema at"):
            link(spark, [], tools={"t": wrong})


def test_turns_without_a_number_are_not_merged(spark):
    turns = [("c", None, "assistant", "one\ntwo"), ("c", None, "assistant", "three\nfour"), ("c", None, "user", "x"), ("c", 0, "user", "y"), ("c", 1, "assistant", "five")]
    calls, results, _ = tool_messages(spark.createDataFrame(turns, "conv_id string, turn int, role string, text string"))
    assert sorted((r["call_id"] or "", r["turn"] or 0) for r in calls.collect()) == [("", 0)] * 4 + [("call-1-0", 1)]
    assert [(r["call_id"], r["content"]) for r in results.collect()] == [(None, "x")]


def test_no_calls(spark):
    frame = spark.createDataFrame
    none = toolcalls.linked(
        frame([], "conv_id string, call_id string, turn int, position int, name string, arguments string"),
        frame([], "conv_id string, call_id string, turn int, content string"),
        frame([], "conv_id string, call_id string, needs string"),
        {},
    )
    assert none.count() == 0


def test_levels_of_long_chains(spark):
    ids = [f"{i:03d}" for i in range(12)]
    calls = spark.createDataFrame([("c", i) for i in ids], "conv_id string, call_id string")
    refs = spark.createDataFrame([("c", b, a) for a, b in zip(ids, ids[1:])], "conv_id string, call_id string, needs string")
    assert {r["call_id"]: r["level"] for r in toolcalls.levels(calls, refs).collect()} == {b: i for i, b in enumerate(ids) if i}
