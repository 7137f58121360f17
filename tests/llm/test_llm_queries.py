"""The registered queries on the small tables: SQL where there is some, and the columns their contracts name."""

import os

import duckdb
import pytest
from conftest import DATA, GIVEN

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import queries

SF = f"{DATA}/sf0.001"
COLUMNS = {
    "op2": "doc_id held_out score predicted",
    "op3": "doc_id size text_crc32 law shard slot grown_shard",
    "op4": "doc_id size source_size target taken",
    "op5": "page_id host path rule verdict",
    "op6": "doc_id n_shingles component_id kept",
    "op7": "doc_id held_out lang_pred score",
    "op8": "query_id rank vec_id score",
    "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op10": "doc_id n_words n_removed kept_sha256",
    "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in GIVEN:
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


@pytest.mark.parametrize("name", queries.ORACLES)
def test_queries_equal_their_sql(name, spark, duck):
    df = queries.QUERIES[name](spark, SF)
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_queries_cover_their_tables(name, spark):
    df = queries.QUERIES[name](spark, SF)
    wanted = COLUMNS.get(name.split("_")[0], "doc_id").split()
    assert df.columns[: len(wanted)] == wanted or set(wanted) <= set(df.columns)
    of, rows = ("conversations", "conv_id") if name.startswith("op12") else ("documents", "doc_id")
    assert df.count() == spark.read.parquet(f"{SF}/{of}.parquet").select(rows).distinct().count()


def test_all_operators_and_the_pipeline_are_registered():
    found = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in found) for k in range(1, 14)] == [1] * 13
    assert found["pipeline"] is corpus_pipeline.run
