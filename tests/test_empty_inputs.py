from pyspark.sql import functions as F

from linewise.functions.parse import chars
from linewise.operators.group_sets import group_common_elements
from linewise.operators.reshape import unpivot_totals
from linewise.operators.sequence import batch_rows, boundary_groups, row_number, running_sum
from linewise.operators.summary import count_per, grand_total, top_k, total_per


def test_sequence_operators_on_empty_input(spark):
    df = spark.createDataFrame([], "k long, value string, v int")
    assert running_sum(df, "v", "k").count() == 0
    assert row_number(df, "k").count() == 0
    assert boundary_groups(df, F.col("value") == "", "k").count() == 0
    assert batch_rows(df, 3, "k").count() == 0
    dbl = spark.createDataFrame([], "k double, v int")
    assert running_sum(dbl, "v", "k").count() == 0


def test_group_and_summary_operators_on_empty_input(spark):
    df = spark.createDataFrame([], "g int, value string")
    arrays = df.select("g", chars("value").alias("cs"))
    for strategy in ("count", "fold"):
        assert group_common_elements(arrays, "g", "cs", strategy=strategy, max_group_size=3).count() == 0
    nums = spark.createDataFrame([], "k string, v bigint")
    assert total_per(nums, "k", "v").count() == 0
    assert count_per(nums, "k").count() == 0
    assert top_k(nums, 3, "v").count() == 0
    assert grand_total(nums, "v").first()[0] is None  # one row, null
    assert unpivot_totals(nums, ["v"]).count() == 0
