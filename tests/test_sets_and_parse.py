import pytest
from pyspark.sql import functions as F

from linewise.functions.parse import chars, delimited_ints, fixed_width, ints_at, split_half, to_int
from linewise.functions.recode import letter_weight
from linewise.functions.sets import common_by_difference, common_elements, first_common, fold_common
from linewise.operators.group_sets import group_common_elements
from linewise.operators.sequence import batch_rows

# Each line has one letter in both halves; "k" is in each of the first three lines, "T" in the others.
LINES = ["kabc" "defa", "gkhi" "jhlm", "nopq" "rskq", "TABC" "DEBF", "GHTI" "JKHL", "MNOP" "QTRN"]


def _halves(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "idx long, value string")
    a, b = split_half("value")
    return df.select("idx", "value", chars(a).alias("a"), chars(b).alias("b"))


def test_half_common_weights(spark):
    h = _halves(spark, LINES)
    w = h.select(letter_weight(first_common(common_elements("a", "b"))).alias("w"))
    assert w.agg(F.sum("w")).first()[0] == 1 + 8 + 17 + 28 + 34 + 40  # a h q B H N


def test_except_twice_equals_intersect(spark):
    h = _halves(spark, LINES + ["abcabc", "ab", "", "aXbY"])
    x = h.select(F.sort_array(common_elements("a", "b")).alias("i"),
                 F.sort_array(common_by_difference("a", "b")).alias("e"))
    assert x.where(F.col("i") != F.col("e")).count() == 0


def test_odd_length_and_several_common(spark):
    h = _halves(spark, ["abcXcba"])  # halves "abc" and "Xcba"
    r = h.select(F.sort_array(common_elements("a", "b")).alias("c")).first()
    assert r.c == ["a", "b", "c"]


def test_batch_common_fold_and_count_agree(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(LINES + ["abc", "xyz"])], "idx long, value string")
    batched = batch_rows(df.select("idx", chars("value").alias("cs")), 3, "idx")
    fold = group_common_elements(batched, "batch_id", "cs", strategy="fold", max_group_size=3, size_out="n")
    count = group_common_elements(batched, "batch_id", "cs", strategy="count", size_out="n")
    assert sorted(fold.collect()) == sorted(count.collect())
    weights = fold.select(letter_weight(F.get("common", 0)).alias("w")).where(F.col("batch_id") <= 2)
    assert weights.agg(F.sum("w")).first()[0] == 11 + 46
    assert fold.where(F.col("batch_id") == 3).first().common == []  # short batch, nothing common


def test_group_common_with_null_array_and_hot_group(spark):
    rows = [(1, ["a", "b"]), (1, ["b", "a", "a"]), (2, ["a"]), (2, None)] + [(3, ["q", "r"])] * 500
    df = spark.createDataFrame(rows, "g int, cs array<string>")
    got = {r.g: r.common for r in group_common_elements(df, "g", "cs").collect()}
    assert got == {1: ["a", "b"], 2: [], 3: ["q", "r"]}


def test_fold_common_expression(spark):
    df = spark.createDataFrame([([["a", "b"], ["b", "c"], ["b"]],)], "x array<array<string>>")
    assert df.select(fold_common("x").alias("c")).first().c == ["b"]


def test_delimited_ints_and_malformed(spark):
    df = spark.createDataFrame([("2-4,6-8",), ("1-x,3",), ("",), (None,)], "v string")
    got = df.select(*ints_at(delimited_ints("v"), 4)).collect()
    assert [tuple(r) for r in got] == [(2, 4, 6, 8), (1, None, 3, None), (None, None, None, None),
                                       (None, None, None, None)]
    assert df.select(to_int(F.lit(" 12 ")).alias("i")).first().i == 12


def test_fixed_width_layout(spark):
    lines = ["[Q]     [R]", "[S] [U] [V]", " 4   5   6 ", "[W]"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = fixed_width(df, "value", [1, 5, 9]).collect()
    assert [tuple(r) for r in got] == [("Q", " ", "R"), ("S", "U", "V"), ("4", "5", "6"), ("W", None, None)]


def test_group_common_of_a_group_with_very_many_elements(spark):
    # Group 1: 100,000 distinct elements, of which every row holds 7 and 11; a null group is a group.
    rows = spark.range(1000).select(F.when(F.col("id") >= 0, 1).alias("g"), F.concat(
        F.sequence(100 + F.col("id") * 100, 199 + F.col("id") * 100), F.array(F.lit(11), F.lit(7))).alias("xs"))
    others = spark.createDataFrame([(None, [1, 2]), (None, [2, 3])], "g int, xs array<long>")
    got = {r.g: (r.common, r.n) for r in group_common_elements(rows.unionByName(others), "g", "xs", size_out="n").collect()}
    assert got == {1: ([7, 11], 1000), None: ([2], 2)}


def test_fold_checks_its_bound(spark):
    df = spark.createDataFrame([(1, ["a"])] * 4, "g int, xs array<string>")
    with pytest.raises(Exception, match="max_group_size"):
        group_common_elements(df, "g", "xs", strategy="fold", max_group_size=3).collect()
