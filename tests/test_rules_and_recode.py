from pyspark.sql import functions as F

from linewise.functions.parse import char_at
from linewise.functions.recode import LETTER_WEIGHTS, letter_weight, recode
from linewise.functions.rules import (decision_table, match_points, needed_result, required_move,
                                      result_points)
from linewise.functions.udf_forms import required_move_udf

OPP = {"A": 1, "B": 2, "C": 3}
MINE = {"X": 1, "Y": 2, "Z": 3}

# Own counts of each code pair.
PAIR_COUNTS = {o + " " + m: 7 * k + 3 for k, (o, m) in enumerate((o, m) for o in "ABC" for m in "XYZ")}


def _scored(df):
    parsed = df.select(char_at("value", 0).alias("o"), char_at("value", 2).alias("m"))
    pts = parsed.select(recode("o", OPP).alias("theirs"), recode("m", MINE).alias("mine"))
    needed = needed_result(F.col("mine"))
    return pts.select(
        "theirs", "mine",
        (match_points(F.col("mine"), F.col("theirs")) + F.col("mine")).alias("total_points"),
        needed.alias("needed"),
        result_points(needed).alias("new_points"),
        required_move(needed, F.col("theirs")).alias("new_play"),
        required_move_udf(needed, F.col("theirs")).alias("udf_play"),
    )


def test_example_rounds(spark):
    df = spark.createDataFrame([("A Y",), ("B X",), ("C Z",)], "value string")
    out = _scored(df)
    assert out.agg(F.sum("total_points")).first()[0] == 15
    assert out.agg(F.sum(F.col("new_play") + F.col("new_points"))).first()[0] == 12


def test_totals_of_own_counts(spark):
    rows = [(code,) for code, n in PAIR_COUNTS.items() for _ in range(n)]
    out = _scored(spark.createDataFrame(rows, "value string"))
    total = new = 0
    for code, n in PAIR_COUNTS.items():
        theirs, mine = "ABC".index(code[0]), "XYZ".index(code[2])
        total += n * (mine + 1 + (3, 6, 0)[(mine - theirs) % 3])
        new += n * (3 * mine + (theirs + mine - 1) % 3 + 1)
    assert out.agg(F.sum("total_points")).first()[0] == total
    assert out.agg(F.sum(F.col("new_play") + F.col("new_points"))).first()[0] == new


def test_case_and_udf_forms_agree_on_every_pair_and_nulls(spark):
    codes = [f"{o} {m}" for o in "ABCQ" for m in "XYZW"] + ["", None]
    out = _scored(spark.createDataFrame([(c,) for c in codes], "value string")).collect()
    for r in out:
        if r.theirs is not None and r.needed is not None:
            assert r.new_play == r.udf_play
        if r.needed is None:
            assert r.new_play == 0 and r.udf_play == 0


def test_rule_order_matters(spark):
    df = spark.createDataFrame([(3, 1), (1, 3), (2, 1), (1, 2), (2, 2), (None, 1)], "mine int, theirs int")
    got = [r.p for r in df.select(match_points(F.col("mine"), F.col("theirs")).alias("p")).collect()]
    assert got == [0, 6, 6, 0, 3, None]


def test_decision_table_default_and_null(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    no_default = decision_table([(F.col("x") == 1, "one")])
    with_default = decision_table([(F.col("x") == 1, "one")], default="other")
    got = df.select(no_default.alias("a"), with_default.alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("one", "one"), (None, "other"), (None, "other")]


def test_recode_default_and_letter_weights(spark):
    df = spark.createDataFrame([("a",), ("Z",), ("?",), (None,)], "c string")
    got = df.select(recode("c", {"a": "x"}, default="Unknown").alias("r"), letter_weight("c").alias("w")).collect()
    assert [(r.r, r.w) for r in got] == [("x", 1), ("Unknown", 52), ("Unknown", None), ("Unknown", None)]
    assert len(LETTER_WEIGHTS) == 52 and LETTER_WEIGHTS["z"] == 26 and LETTER_WEIGHTS["A"] == 27


def test_udf_forms_on_all_null_batches(spark):
    from linewise.functions.udf_forms import overlap_label_udf

    df = spark.createDataFrame([(None, None)] * 5, "needed string, theirs int")
    got = df.select(required_move_udf("needed", "theirs").alias("m"),
                    required_move(F.col("needed"), F.col("theirs")).alias("c")).collect()
    assert all(r.m == 0 and r.c == 0 for r in got)
    ints = spark.createDataFrame([(None, None, None, None)] * 3, "a int, b int, c int, d int")
    assert [r.l for r in ints.select(overlap_label_udf("a", "b", "c", "d").alias("l")).collect()] == [None] * 3
    win = spark.createDataFrame([("win", None), ("draw", None), ("lose", 2)], "needed string, theirs int")
    got = [(r.m, r.c) for r in win.select(required_move_udf("needed", "theirs").alias("m"),
                                          required_move(F.col("needed"), F.col("theirs")).alias("c")).collect()]
    # unknown opponent move: both forms fall to 0 (a draw repeats null)
    assert got == [(0, 0), (None, None), (1, 1)]
