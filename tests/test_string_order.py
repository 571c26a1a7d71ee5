"""Order keys that are long strings: two levels of sampled edges."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from linewise.operators import sequence
from linewise.operators.sequence import boundary_groups, row_number, running_sum


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(sequence, "MAX_SAMPLED_BUCKETS", 8)


def keyed(spark, n=4000):
    # Long common starts, letters beyond ASCII and beyond the basic plane, an empty string.
    key = F.concat(F.lit("https://example.org/a/long/way/"), F.element_at(F.array(*map(F.lit, ["a", "é", "￮", "😀"])),
                   (F.col("id") % 4 + 1).cast("int")), F.sha2(F.col("id").cast("string"), 256))
    return (spark.range(n).withColumn("key", F.when(F.col("id") == 5, F.lit("")).otherwise(key))
            .withColumn("v", F.when(F.col("id") % 7 != 0, F.col("id"))))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_two_levels_keep_the_order_and_even_out(spark, few):
    df = keyed(spark).unionByName(spark.createDataFrame([(-1, None, 3)], "id long, key string, v long"))
    cut = sequence._sampled_bucket(df, "key", "b", 50).persist()
    ends = cut.groupBy("b").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("n")).orderBy("b").collect()
    assert cut.columns == ["id", "key", "v", "b"] and cut.count() == 4001
    assert 8 < len(ends) <= 65 and ends[0].b == -1 and ends[0].n == 1
    assert all(a.hi.encode() < b.lo.encode() for a, b in zip(ends[1:], ends[2:]))
    assert max(e.n for e in ends) < 500
    cut.unpersist()


@pytest.mark.parametrize("size", [20, 700, 65536])
def test_sequence_operators_equal_a_plain_window(spark, few, size):
    df = keyed(spark)
    order = Window.orderBy("key")
    number = row_number(df, "key", out="x", rows_per_bucket=size)
    assert rows(number.select("id", "x")) == rows(df.select("id", F.row_number().over(order).cast("long")))
    total = running_sum(df, "v", "key", out="x", rows_per_bucket=size)
    assert rows(total.select("id", "x")) == rows(df.select("id", F.sum("v").over(order)))


def test_a_key_of_a_third_of_the_rows_and_an_empty_table(spark, few):
    df = keyed(spark, 900).withColumn("key", F.when(F.col("id") < 300, F.lit("https://example.org/hot")).otherwise(F.col("key")))
    groups = boundary_groups(df, F.col("id") % 10 == 0, ["key", "id"], rows_per_bucket=20)
    flag = F.sum(F.when(F.col("id") % 10 == 0, 1).otherwise(0)).over(Window.orderBy("key", "id"))
    assert rows(groups.select("id", "group_id")) == rows(df.select("id", (flag + 1).cast("long")))
    assert row_number(df.limit(0), "key", rows_per_bucket=20).count() == 0
