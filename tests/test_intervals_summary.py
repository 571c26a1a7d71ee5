from pyspark.sql import functions as F

from linewise.functions import intervals as iv
from linewise.functions.parse import delimited_ints, ints_at
from linewise.functions.udf_forms import overlap_label_udf
from linewise.operators.columns import drop_columns, prefix_columns, rename_columns
from linewise.operators.lookup import recode_join
from linewise.operators.reshape import unpivot_long, unpivot_totals
from linewise.operators.summary import count_per, grand_total, top_k, top_k_total, total_per

PAIRS = ["2-4,6-8", "2-3,4-5", "5-7,7-9", "2-8,3-7", "6-6,4-6", "2-6,4-8"]


def _intervals(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    return df.select("value", *ints_at(delimited_ints("value"), 4))


def test_example_containment_and_overlap(spark):
    df = _intervals(spark, PAIRS)
    out = df.select(iv.flag(iv.either_contains("val1", "val2", "val3", "val4")).alias("c"),
                    iv.overlap_label("val1", "val2", "val3", "val4").alias("label"),
                    overlap_label_udf("val1", "val2", "val3", "val4").alias("udf_label"))
    assert out.agg(F.sum("c")).first()[0] == 2
    counts = {r.label: r.n for r in count_per(out, "label").collect()}
    assert counts == {"overlap": 4, "disjoint": 2}
    assert out.where(F.col("label") != F.col("udf_label")).count() == 0


def test_touching_equal_reversed_missing(spark):
    df = _intervals(spark, ["1-3,3-5", "4-4,4-4", "1-3,4-5", "9-2,3-4", "1-2"])
    lo1, hi1 = iv.normalized("val1", "val2")
    out = df.select(
        iv.overlap_label(lo1, hi1, "val3", "val4").alias("label"),
        iv.flag(iv.either_contains(lo1, hi1, "val3", "val4")).alias("c"),
    ).collect()
    assert [(r.label, r.c) for r in out] == [("overlap", 0), ("overlap", 1), ("disjoint", 0),
                                             ("overlap", 1), (None, 0)]


def test_unpivot_wide_rows_top_key(spark):
    rows = [("ash", 12, 7, None), ("birch", None, 30, 4), ("cedar", 5, 5, 5), ("elm", 1, None, None)]
    df = spark.createDataFrame(rows, "tree string, spring int, summer int, autumn int")
    seasons = ["spring", "summer", "autumn"]
    long = unpivot_long(df, ["tree"], seasons, name="season", value="growth")
    assert long.count() == 12  # null cells kept
    totals = total_per(long, "tree", "growth", out="total")
    best = top_k(totals, 1, "total", tie_break="tree").first()
    assert (best.tree, best.total) == ("birch", 34)
    assert top_k_total(totals, 3, "total", tie_break="tree").first()[0] == 34 + 19 + 15
    metrics = {r.metric: (r.total, r.n_rows, r.n_values) for r in unpivot_totals(df, seasons).collect()}
    assert metrics["summer"] == (42, 4, 3)


def test_top_k_tie_break_and_empty_total(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, 1)], "k int, v int")
    assert [r.k for r in top_k(df, 2, "v", tie_break="k").collect()] == [2, 3]
    assert grand_total(df.where("k > 10"), "v").first()[0] is None


def test_column_operators(spark):
    df = spark.createDataFrame([("A", "Y", 1)], "_2 string, _3 string, idx long")
    renamed = rename_columns(df, {"_2": "opponent", "_3": "mine", "absent": "x"})
    prefixed = prefix_columns(renamed, "game_")
    assert prefixed.columns == ["game_opponent", "game_mine", "game_idx"]
    assert drop_columns(prefixed, "game_idx", "nope").columns == ["game_opponent", "game_mine"]


def test_recode_join_default_and_duplicates(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (2, "deux")], "dk int, name string")
    for limit in (0, 10):  # shuffle join and broadcast join
        got = recode_join(facts, "k", dim, "dk", "name", out="name", default="Unknown", max_broadcast_rows=limit)
        assert sorted((r.k or 0, r.name) for r in got.collect()) == [
            (0, "Unknown"), (1, "one"), (2, "deux"), (3, "Unknown")]
