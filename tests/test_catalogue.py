import pytest

import __spark_entry__ as entry
from compare import compare, duck
from conftest import SF01

from linewise.plans.catalogue import QUERIES
from linewise.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and df.columns == ["group_id", "total_cents", "n_rows"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", ["q01_boundary_group_totals", "q12_batch_common", "q20_row_number_batches"])
def test_sequence_queries_ignore_file_layout(spark, con, tmp_path, name):
    # The same rows as 7 part files in shuffled order: results depend on the order key only.
    folder = str(tmp_path)
    for table in ("events", "documents"):
        src = spark.read.parquet(f"{SF01}/{table}.parquet")
        src.repartition(7).write.parquet(f"{folder}/{table}.parquet")
    ok, msg = compare(QUERIES[name](spark, folder), con, ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", ["q27_stream_score_totals", "q29_stream_overlap_label_counts"])
def test_streams_read_tables_that_are_folders(spark, con, tmp_path, name):
    for table in ("orders", "lineitem"):
        spark.read.parquet(f"{SF01}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    ok, msg = compare(QUERIES[name](spark, str(tmp_path)), con, ORACLE[name])
    assert ok, msg
