"""What operators hold and compute for large inputs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

import corpus_pipeline
from ticketmart.llm import brown, decontaminate, minhash, pieces, toxicity


def strings(kind, name=""):
    """Names of all text columns, those inside structs too."""
    if isinstance(kind, StructType):
        return [found for field in kind for found in strings(field.dataType, field.name)]
    return [name] if isinstance(kind, StringType) else []


def test_the_toxicity_stage_hands_each_text_over_once(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}", "en", "web", 6) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    handed = []
    tagged = toxicity.tagged
    monkeypatch.setattr(toxicity, "tagged", lambda frame, *rest: handed.append(frame.schema) or tagged(frame, *rest))
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert len(strings(handed[0])) == 3
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == rows


def test_sums_of_the_fit_come_to_the_driver_as_one(spark, monkeypatch):
    """From more partitions than tasks may have sums, and from none."""
    texts = [f"word{i} other{i % 3}" * (i % 4) for i in range(60)]
    made = [toxicity.packed_batch([text], [i % 2 == 0]) for i, text in enumerate(texts)]
    rows = spark.createDataFrame([tuple(column[0].as_py() for column in one.row().columns) for one in made], toxicity._PACKED).repartition(20)
    monkeypatch.setattr(toxicity, "_MAX_TASKS", 5)
    sent, dealt = [], []
    frame = type(rows)
    collect, repartition = frame.collect, frame.repartition
    monkeypatch.setattr(frame, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    monkeypatch.setattr(frame, "repartition", lambda self, *to: dealt.append(self) or repartition(self, *to))
    found = toxicity._summed(rows, lambda one: np.array([len(one.ids), len(one.flat), 1.0]), 3)
    none = toxicity._summed(rows.where("false"), lambda one: np.ones(3), 3)
    assert found.tolist() == [sum(len(one.ids) for one in made), sum(len(one.flat) for one in made), 60.0]
    assert none.tolist() == [0.0, 0.0, 0.0]
    assert [len(rows) for rows in sent] == [1, 1]
    assert [frame.count() for frame in dealt] == [5, 0]


def test_features_are_held_for_a_bounded_number_of_words(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS), -1.0, np.zeros((2, 2)), np.zeros(3))
    words = [b"w%d" % i for i in range(25)]
    flat, starts = toxicity.features(words)
    expected = (np.add.reduceat(model.weights[flat], starts) + model.bias).tolist()
    held = []
    features = toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda some: held.append(len(some)) or features(some))
    monkeypatch.setattr(toxicity, "_FEATURED", 10)
    assert toxicity.word_scores(words, model) == expected
    assert held == [10, 10, 5]
    assert toxicity.word_scores([], model) == []


def test_a_lattice_looks_no_further_than_pieces_go():
    lattice = pieces.Lattice(pieces.read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    segments = ["▁" + "" * 200, "▁theory", "the", ""]
    with np.errstate(over="ignore"):
        first_node, first_edge, tail, piece, upto = lattice.filtered(segments, np.array([len(s) for s in segments]))
        alone = lattice.filtered(["▁theory"], np.array([7]))
    # Characters without a piece have one edge each.
    assert (piece == -1 - 0xE000).sum() == 201
    # The nodes of a segment have the same edges and chances whatever stands beside it.
    for depth in range(1, 8):
        node = first_node[depth] + 1
        a, b = first_edge[node], first_edge[node + 1]
        x = alone[1][depth]
        y = np.append(alone[1], len(alone[3]))[depth + 1]
        assert piece[a:b].tolist() == alone[3][x:y].tolist()
        assert upto[a:b].tolist() == alone[4][x:y].tolist()


def test_the_index_holds_no_neighbours_of_words_that_are_not_sought(spark):
    docs = spark.createDataFrame([(1, "b a c"), (2, ""), (3, None), (4, "a")], "doc_id long, text string")
    rows = decontaminate.with_row_key(docs, "doc_id", "text")
    found = decontaminate.postings(rows, spark.createDataFrame([("a",), ("c",)], "term string"))
    places = [tuple(r) for r in found.select("term", "pos", "before", "after").collect()]
    assert sorted(places) == [("a", 0, "", ""), ("a", 1, "b", "c"), ("c", 2, "a", "")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" not in plan
    # Once for the words, not again to leave out texts without any.
    assert plan.count("split(") <= 1


def test_lists_of_ids_are_joined_without_a_python_object_for_each():
    spelling = pa.array(["é".encode()[:1], "é".encode()[1:], b"", b"the "], pa.binary())
    ids = pa.array([[3], [0, 1, 3], None, [], [2], [3, 3]], pa.list_(pa.int32()))
    assert pieces.joined(spelling, ids).to_pylist() == ["the ", "é" + "the ", "", "", "", "the the "]
    assert pieces.joined(spelling, ids.slice(1, 3)).to_pylist() == ["éthe ", "", ""]
    assert pieces.joined(spelling, ids.slice(2, 2)).to_pylist() == ["", ""]
    assert pieces.joined(spelling, ids.slice(0, 0)).to_pylist() == []
    with pytest.raises(pa.ArrowInvalid):
        pieces.joined(spelling, pa.array([[0]], pa.list_(pa.int32())))


def test_class_model_shuffles_each_text_once(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and word{i % 5} again", i % 10 == 0) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    ran = []
    stored = brown.stored
    monkeypatch.setattr(brown, "stored", lambda frame, name: ran.append((name, frame)) or stored(frame, name))
    brown.scored(docs)
    coded = dict(ran)["coded"]
    coded.collect()
    plan = coded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_words_of_a_block_have_the_same_numbers_in_any_order_of_texts():
    texts = ["b a", "", "c B", "a", "b a"]
    expected = brown._block_words(texts)
    assert sorted(expected) == [b"a", b"b", b"c"]
    assert brown._block_words(texts[::-1]) == expected
    assert brown._numbered(sorted(texts))[0] == expected


def test_a_pair_of_many_common_buckets_is_taken_from_few(spark):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(30):
        text = list(base)
        for k in pick.sample(range(400), pick.choice([10, 25, 90])):
            text[k] = f"x{i}y{k}"
        rows.append((i, " ".join(text)))
    # Without a limit on the similarity, so that no pair of a bucket is ruled out.
    banding = minhash.Banding(words=2, percent=0)
    signs = minhash.signed(spark.createDataFrame(rows, "class long, text string"), banding).drop("text")
    members = minhash._keys(signs, banding).withColumn("component", F.col("class")).join(signs, "class")
    members = members.withColumn("earlier", minhash._earlier(banding))
    buckets = {}
    for row in members.collect():
        buckets.setdefault(row["key"], []).append(row["class"])
    met = [(a, b) for bucket in buckets.values() for a in bucket for b in bucket if a < b]
    found = [tuple(row) for row in minhash._pairs(members, banding).collect()]
    assert set(found) == set(met)
    assert max(Counter(found).values()) <= banding.tables < max(Counter(met).values())
    assert len(found) < len(met) / 3
