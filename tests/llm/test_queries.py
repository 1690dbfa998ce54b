"""Registered queries and the pipeline, on the smallest test tables."""

from __future__ import annotations

import re
from pathlib import Path
from zlib import crc32

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from ticketmart.llm import minhash, pieces
from ticketmart.llm.queries import ORACLES, QUERIES, TOOLS

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, database, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = database.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    columns = sorted(found.columns)
    assert columns == sorted(names)
    at = [names.index(column) for column in columns]
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(
        (tuple(row[i] for i in at) for row in expected.fetchall()), key=repr
    )


@pytest.mark.parametrize("name", ["op4_tokens", "op5_brown", "op8_langid", "op9_pieces"])
def test_a_row_for_each_document(spark, texts, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        if "held_out" in row:
            assert row["held_out"] == (crc32(str(row["doc_id"]).encode()) % {"op5_brown": 10, "op8_langid": 5}[name] == 0)
        if "lossless" in row:
            assert row["lossless"]


def test_tool_calls_of_conversations(spark):
    rows = QUERIES["op3_toolcalls"](spark, SF_DIR).collect()
    turns = {(r["conv_id"], r["turn"]): r for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()}
    lines = [(c, t) for (c, t), r in turns.items() if r["role"] == "assistant" for line in r["text"].split("\n") if line.strip(" ")]
    called = [r for r in rows if r["status"] != "orphan"]
    assert len(called) == len(lines)
    for row in called:
        line = turns[row["conv_id"], row["turn"]]["text"].split("\n")[row["position"]]
        after = turns.get((row["conv_id"], row["turn"] + 1))
        has = after and after["role"] == "user" and len(after["text"].split("\n")) > row["position"] and after["text"].split("\n")[row["position"]].strip(" ")
        assert bool(row["n_results"]) == bool(has)
        assert row["level"] == (row["position"] + 1).bit_length() - 1
        valid = len(line.split(" ")) <= 60 and row["name"] in TOOLS
        assert (row["status"] == "invalid") == (not valid)


def test_pipeline_stage_by_stage(spark, texts, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        if name != "pieces":
            assert docs.columns == names
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert 0.5 * len(before) < len(after) < len(before)
            assert all(after[i] == before[i] for i in after)
        if name == "near_duplicates":
            def shingles(text):
                w = re.sub("[A-Z]", lambda m: m.group().lower(), text).encode().split()
                return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

            sets = {i: shingles(r["text"]) for i, r in before.items()}
            close = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            ids = sorted(sets)
            reach = {i: i for i in ids}
            for a in ids:
                for b in ids:
                    if a < b and close(a, b):
                        low, high = sorted((reach[a], reach[b]))
                        reach = {k: low if v == high else v for k, v in reach.items()}
            assert set(after) == {i for i in ids if reach[i] == i}
        if name == "personal_data":
            assert set(after) == set(before)
            assert not any(re.search(r"\d{16}", r["text"]) and r["text"] == before[i]["text"] for i, r in after.items())
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name == "pieces":
            spelling = pieces.spelled(pieces.read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
            for i, row in after.items():
                assert b"".join(spelling[p] for p in row["pieces"]).decode() == before[i]["text"]


def test_banding_of_the_pipeline():
    assert corpus_pipeline.BANDING == minhash.Banding(words=5, percent=80)
