"""Registered queries against their SQL, and the contract of their rows."""

import pytest
from compare import connect, duck_rows, spark_rows
from conftest import SMALL

import __spark_entry__ as entry_point
from tablewright.llm.common import table
from tablewright.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1": ("embeddings", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    "op2": ("documents", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op3": ("documents", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
    "op4": ("documents", {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}),
    "op5": ("documents", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
    "op6": (None, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}),
    "op7": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op8": (None, {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"}),
    "op9": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op10": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op11": (None, {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}),
    "op12": ("documents", {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"}),
    "op13": (None, {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}),
}


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(connect(SMALL), ORACLES[name])


@pytest.mark.parametrize("name", QUERIES)
def test_columns_and_rows(spark, name):
    of, columns = COLUMNS[name.split("_")[0]]
    got = QUERIES[name](spark, SMALL)
    kinds = dict(got.dtypes)
    assert {c: kinds[c] for c in columns} == columns
    if of:
        assert got.count() == table(spark, SMALL, of).count()


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
