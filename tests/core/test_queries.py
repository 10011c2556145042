import glob
import importlib
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from linkloom.oracles import ORACLES
from linkloom.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)


CHECKED = ["clean_name", "name_block_tokens", "addr_parts", "record_keys", "fanout_budget_tight", "candidate_pairs_tight", "missed_pairs_harsh", "run_stats", "validation_report", "val_subset", "val_files", "read_ids", "read_sources", "raw_lines", "missed_pairs_odd", "bucket_examples", "phonetic", "threshold_sweep", "pair_features", "tfidf_cosine"]


@pytest.mark.parametrize("name", CHECKED)
def test_oracle(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    want = duck.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(want.columns)
    columns = sorted(frame.columns)
    assert plain(frame.select(*columns).collect()) == plain(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_truth_sample_has_all_ids(spark, tmp_path):
    """More reference records with known pairs than a sample holds."""
    path = f"{tmp_path}/documents.parquet"
    connection = duckdb.connect()
    connection.sql(f"copy (select i as doc_id, 'start ' || i // 2 || ' of a text' as text, 'en' as lang, 'src' || (i % 2) as source from range(40_400) r(i)) to '{path}'")
    connection.sql(f"create view documents as select * from '{path}'")
    want = connection.sql(ORACLES["truth_sample"])
    assert len(want) > 20_000
    assert plain(QUERIES["truth_sample"](spark, str(tmp_path)).collect()) == plain(want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("linkloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "linkloom.llm", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    again = importlib.import_module("__spark_entry__")
    assert set(again.queries()) == set(QUERIES)


def test_entry_tells_of_other_missing_modules(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("linkloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    with pytest.raises(ModuleNotFoundError):
        importlib.import_module("__spark_entry__")
