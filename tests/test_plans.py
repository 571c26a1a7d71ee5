"""Plan-shape assertions: the properties the scale design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from linewise.operators.sequence import DEFAULT_ROWS_PER_BUCKET
from linewise.plans import catalogue as cat
from linewise.streaming.files import run_to_files


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NATIVE = [n for n in cat.QUERIES if n not in ("q07_udf_rule", "q14b_udf_overlap_label_counts")]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python_node(spark, name):
    plan = _plan(cat.QUERIES[name](spark, SF01))
    assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan, plan


@pytest.mark.parametrize("name", ["q07_udf_rule", "q14b_udf_overlap_label_counts"])
def test_udf_forms_are_arrow_batched(spark, name):
    plan = _plan(cat.QUERIES[name](spark, SF01))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


SEQUENCE_QUERIES = ["q01_boundary_group_totals", "q12_batch_common", "q20_row_number_batches", "q23_text_record_groups"]


@pytest.mark.parametrize("sf_dir", [SF01, "/root/testdata/sf0.1"])
@pytest.mark.parametrize("name", SEQUENCE_QUERIES)
def test_sequence_queries_keep_data_out_of_single_partition(spark, name, sf_dir):
    lines = _plan(cat.QUERIES[name](spark, sf_dir)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], "\n".join(lines)


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(cat.QUERIES["q15_user_type_spans"](spark, SF01))
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type", plan)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan
    plan = _plan(cat.QUERIES["q21b_pushed_filter"](spark, SF01))
    assert "EqualTo(event_type,purchase)" in plan and "GreaterThanOrEqual(value" in plan


def test_single_scan_for_predicate_counts(spark):
    plan = _plan(cat.QUERIES["q21_filters"](spark, SF01))
    assert len(re.findall(r"(?:FileScan|BatchScan) parquet", plan)) == 1


def test_streaming_run_matches_batch(spark):
    def transform(events):
        return events.select("user_id", (F.round(F.col("value") * 100)).cast("long").alias("cents"))

    out = run_to_files(spark, SF01, transform, name="test-stream", file_glob="events.parquet",
                       timeout_s=300)
    streamed = spark.read.parquet(out).groupBy("user_id").agg(F.sum("cents").alias("c"))
    batch = transform(spark.read.parquet(f"{SF01}/events.parquet")).groupBy("user_id").agg(F.sum("cents").alias("c"))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_text_stream_through_row_local_operators(spark, tmp_path):
    from linewise.functions import intervals as iv
    from linewise.functions.parse import delimited_ints, ints_at

    src = tmp_path / "pairs"
    src.mkdir()
    (src / "a.txt").write_text("2-4,6-8\n2-3,4-5\n5-7,7-9\n")
    (src / "b.txt").write_text("2-8,3-7\n6-6,4-6\n2-6,4-8\n")

    def transform(lines):
        vals = lines.select(*ints_at(delimited_ints("value"), 4))
        return vals.select(iv.flag(iv.either_contains("val1", "val2", "val3", "val4")).alias("contained"),
                           iv.overlap_label("val1", "val2", "val3", "val4").alias("label"))

    out = run_to_files(spark, str(src), transform, name="test-text-stream", file_glob="*.txt",
                       source_format="text", max_files_per_trigger=1, timeout_s=300)
    got = spark.read.parquet(out)
    assert got.count() == 6
    assert got.agg(F.sum("contained")).first()[0] == 2
    assert got.where(F.col("label") == "overlap").count() == 4


def test_stream_restart_processes_only_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("1\n2\n")
    (src / "b.txt").write_text("3\n")
    out = str(tmp_path / "out")

    def transform(lines):
        return lines.select(F.col("value").try_cast("int").alias("v"))

    run_to_files(spark, str(src), transform, name="restart", file_glob="*.txt", source_format="text",
                 out_path=out, timeout_s=300)
    (src / "c.txt").write_text("4\n5\n")
    # Same checkpoint: the committed files are not read again.
    run_to_files(spark, str(src), transform, name="restart", file_glob="*.txt", source_format="text",
                 out_path=out, timeout_s=300)
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5]


def test_stateful_totals_continue_after_restart(spark, tmp_path):
    from linewise.streaming.files import read_totals, run_totals

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("x\ny\nx\n")
    out = str(tmp_path / "totals")

    def run():
        return run_totals(spark, str(src), lambda lines: lines, ["value"], {"n": F.count(F.lit(1))},
                          name="totals", file_glob="*.txt", source_format="text", out_path=out, timeout_s=300)

    run()
    (src / "b.txt").write_text("y\nz\n")
    run()  # state restored from the checkpoint; a.txt is not counted twice
    assert sorted((r.value, r.n) for r in read_totals(spark, out).collect()) == [("x", 2), ("y", 2), ("z", 1)]


@pytest.mark.parametrize("name", ["q05_score_total", "q08_recode_default", "q10_half_weight",
                                  "q14_overlap_label_counts", "q15_user_type_spans", "q16_unpivot_totals",
                                  "q21_filters", "q22_unpivot_top_key"])
def test_totals_shuffle_only_partial_aggregates(spark, name):
    lines = _plan(cat.QUERIES[name](spark, SF01)).splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line and "Broadcast" not in line]
    assert exchanges
    for i in exchanges:
        below = lines[i + 1]
        assert "HashAggregate" in below and "partial_" in below, "\n".join(lines)
