"""Interval joins, as-of joins, ranks and frames against plain Python or plain windows."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from linewise.operators.asof_join import asof_join
from linewise.operators.interval_join import interval_join, overlap_counts
from linewise.operators.ranking import _with_halos, ends, moving, moving_range, neighbours, ranks, tiles


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def meets(a, b, relation):
    (alo, ahi), (blo, bhi) = sorted(a), sorted(b)
    return {"overlaps": alo <= bhi and blo <= ahi, "contains": alo <= blo and bhi <= ahi,
            "within": blo <= alo and ahi <= bhi}[relation]


# ---------------------------------------------------------------- interval join

def _random_intervals(seed, n, keys=(None, 1, 2)):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lo = r.choice([r.randint(-50, 50), r.randint(-5000, 5000), r.choice([-(1 << 62), 1 << 62])])
        length = r.choice([0, 0, 1, 3, 8, 100, r.randint(0, 3000)])
        a, b = lo, lo + length
        out.append((i, r.choice(keys), None if r.random() < 0.05 else (b if r.random() < 0.1 else a), b if r.random() < 0.95 else None))
    return out


@pytest.mark.parametrize("relation", ["overlaps", "contains", "within"])
@pytest.mark.parametrize("rows_per_bin", [1 << 17, 3])
def test_interval_join_equals_all_pairs(spark, relation, rows_per_bin):
    a, b = _random_intervals(1, 120), _random_intervals(2, 120)
    left = spark.createDataFrame(a + a[:3], "id long, k int, lo long, hi long").repartition(3)
    right = spark.createDataFrame(b, "id long, k int, lo long, hi long")
    got = rows(interval_join(left, right, ("lo", "hi"), ("lo", "hi"), relation=relation, rows_per_bin=rows_per_bin)
               .select("id", "right_id", "right_k"))
    want = sorted(((x[0], y[0], y[1]) for x in a + a[:3] for y in b if None not in x[2:] and None not in y[2:]
                   and meets(x[2:], y[2:], relation)), key=str)
    assert got == want and len(want) > 100
    keyed = rows(interval_join(left, right, ("lo", "hi"), ("lo", "hi"), relation=relation, on="k", rows_per_bin=rows_per_bin)
                 .select("id", "right_id"))
    assert keyed == sorted(((x[0], y[0]) for x in a + a[:3] for y in b if None not in x[1:] and None not in y[1:] and x[1] == y[1]
                            and meets(x[2:], y[2:], relation)), key=str)


def test_interval_join_extreme_lengths_dates_and_empty(spark):
    far = [(1, -(1 << 63), (1 << 63) - 1), (2, 5, 5), (3, (1 << 63) - 1, (1 << 63) - 1), (4, 6, 7)]
    df = spark.createDataFrame(far, "id long, lo long, hi long")
    got = rows(interval_join(df, df, ("lo", "hi"), ("lo", "hi")).select("id", "right_id"))
    assert got == [(x[0], y[0]) for x in far for y in far if meets(x[1:], y[1:], "overlaps")]
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (2, dt.date(2024, 1, 31), dt.date(2024, 2, 9))],
                                 "id int, a date, b date")
    assert rows(interval_join(days, days, ("a", "b"), ("a", "b"), relation="contains").select("id", "right_id")) == [(1, 1), (2, 2)]
    assert interval_join(df.limit(0), df, ("lo", "hi"), ("lo", "hi")).count() == 0
    assert interval_join(df, df.limit(0), ("lo", "hi"), ("lo", "hi")).columns == ["id", "lo", "hi", "right_id", "right_lo", "right_hi"]
    with pytest.raises(ValueError):
        interval_join(df, days, ("lo", "hi"), ("a", "b"))


def test_interval_join_tries_few_pairs(spark):
    """Short intervals and one that covers them all: candidates stay near the number of pairs."""
    short = spark.range(20_000).select(F.col("id"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 2).alias("hi"))
    wide = spark.createDataFrame([(0, 0, 200_000)], "id long, lo long, hi long")
    both = short.unionByName(wide)
    assert interval_join(both, short, ("lo", "hi"), ("lo", "hi")).count() == 40_000


def test_overlap_counts(spark, per_bucket=7):
    a, b = _random_intervals(3, 90), _random_intervals(4, 90)
    left = spark.createDataFrame(a + a[:2], "id long, k int, lo long, hi long")
    right = spark.createDataFrame(b, "id long, k int, lo long, hi long")
    ok = [y for y in b if None not in y[2:]]
    got = rows(overlap_counts(left, right, ("lo", "hi"), ("lo", "hi"), rows_per_bucket=per_bucket))
    assert got == sorted(((*x, 0 if None in x[2:] else sum(meets(x[2:], y[2:], "overlaps") for y in ok)) for x in a + a[:2]), key=str)
    keyed = rows(overlap_counts(left, right, ("lo", "hi"), ("lo", "hi"), on="k", rows_per_bucket=per_bucket))
    assert keyed == sorted(((*x, 0 if None in x[1:] else sum(y[1] == x[1] and meets(x[2:], y[2:], "overlaps") for y in ok))
                            for x in a + a[:2]), key=str)


# ---------------------------------------------------------------- as-of join

@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact, per_bucket", [(True, 3), (False, 3), (True, 1 << 16)])
def test_asof_equals_search(spark, direction, exact, per_bucket):
    r = random.Random(5)
    a = [(i, r.choice([None, 1, 1, 1, 2]), r.choice([None, r.randint(0, 60), r.randint(0, 60)])) for i in range(120)]
    b = [(r.choice([None, 1, 1, 2, 3]), r.choice([None, r.randint(0, 60)]), r.choice([None, r.randint(0, 9)])) for _ in range(60)]
    left = spark.createDataFrame(a + a[:4], "id long, k int, t long").repartition(3)
    right = spark.createDataFrame(b, "k int, t long, v int")

    def best(x, keyed, within=None):
        near = [y for y in b if y[1] is not None and x[2] is not None and (not keyed or x[1] is not None and y[0] == x[1])]
        near = [y for y in near if (y[1] <= x[2] if direction == "backward" else y[1] >= x[2]) and (exact or y[1] != x[2])]
        if not near:
            return None, None
        sign = 1 if direction == "backward" else -1
        y = max(near, key=lambda y: (y[1] * sign, y[2] is not None, y[2] or 0))
        return (y[1], y[2]) if within is None or abs(x[2] - y[1]) <= within else (None, None)

    opts = {"direction": direction, "exact": exact, "rows_per_bucket": per_bucket}
    got = rows(asof_join(left, right, "t", "t", on="k", **opts))
    assert got == sorted(((*x, *best(x, True)) for x in a + a[:4]), key=str)
    got = rows(asof_join(left, right, "t", "t", values=["t", "v"], within=2, **opts))
    assert got == sorted(((*x, *best(x, False, 2)) for x in a + a[:4]), key=str)


def test_asof_empty_dates_and_clashes(spark):
    left = spark.createDataFrame([(1, dt.date(2024, 1, 5))], "id int, d date")
    right = spark.createDataFrame([(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 6), "b")], "day date, v string")
    assert rows(asof_join(left, right, "d", "day", values=["v"])) == [(1, dt.date(2024, 1, 5), "a")]
    assert rows(asof_join(left, right.limit(0), "d", "day", values=["v"])) == [(1, dt.date(2024, 1, 5), None)]
    assert asof_join(left.limit(0), right, "d", "day").count() == 0
    with pytest.raises(ValueError):
        asof_join(left, right, "d", "day", values=["v"], prefix="").transform(
            lambda x: asof_join(x, right, "d", "day", values=["v"], prefix=""))


def test_asof_hot_key_is_split_by_time(spark):
    """A key that holds every row is cut by time: no bucket's window holds more than its share."""
    left = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    right = spark.range(0, 20_000, 500).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    out = asof_join(left, right, "t", "t", on="k", rows_per_bucket=1000)
    assert out.where(F.col("asof_t") != F.col("t") - F.col("t") % 500).count() == 0 and out.count() == 20_000
    assert "__lw_bucket" in out._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- ranks and frames

def _table(spark):
    r = random.Random(9)
    data = [(i, r.choice([None, "a", "b"]), r.choice([None, r.randint(0, 12)]), r.choice([None, r.randint(0, 99)])) for i in range(200)]
    return spark.createDataFrame(data, "id long, g string, k int, v long").repartition(4)


@pytest.mark.parametrize("parts", [[], ["g"]])
@pytest.mark.parametrize("descending, per_bucket", [(False, 2), (True, 2), (False, 1 << 16)])
def test_ranks_equal_plain_windows(spark, parts, descending, per_bucket):
    df = _table(spark)
    w = Window.partitionBy(*parts).orderBy(F.col("k").desc() if descending else F.col("k"))
    want = df.select("*", F.rank().over(w).cast("long"), F.dense_rank().over(w).cast("long"), F.percent_rank().over(w),
                     F.cume_dist().over(w))
    got = ranks(df, "k", partition_by=parts, descending=descending, rows_per_bucket=per_bucket,
                out={"rank": "r", "dense_rank": "d", "percent_rank": "p", "cume_dist": "c"})
    assert rows(got) == rows(want)


def test_ranks_of_several_columns_and_empty(spark):
    df = _table(spark)
    w = Window.orderBy("k", "g")
    assert rows(ranks(df, ["k", "g"], rows_per_bucket=9)) == rows(df.select(
        "*", F.rank().over(w).cast("long"), F.dense_rank().over(w).cast("long")))
    assert ranks(df.limit(0), "k").collect() == []
    with pytest.raises(ValueError):
        ranks(df, "k", out={"median": "m"})


@pytest.mark.parametrize("n, parts", [(1, []), (7, []), (199, []), (3, ["g"]), (500, ["g"])])
def test_tiles_equal_plain_windows(spark, n, parts):
    df = _table(spark)
    want = df.select("*", F.ntile(n).over(Window.partitionBy(*parts).orderBy("id")).cast("long"))
    assert rows(tiles(df, n, "id", partition_by=parts, rows_per_bucket=11)) == rows(want)


@pytest.mark.parametrize("per_bucket, parts", [(1, []), (5, ["g"]), (1 << 16, [])])
def test_neighbours_and_frames_equal_plain_windows(spark, per_bucket, parts):
    df = _table(spark)
    w = Window.partitionBy(*parts).orderBy("id")
    opts = {"partition_by": parts, "rows_per_bucket": per_bucket}
    got = neighbours(df, {"p": ("v", -1), "q": ("v", -12), "n": ("g", 3), "o": ("v", 0)}, "id", **opts)
    assert rows(got) == rows(df.select("*", F.lag("v", 1).over(w), F.lag("v", 12).over(w), F.lead("g", 3).over(w), F.col("v").alias("o")))
    for low, high in ((-6, 0), (-2, 9), (3, 5)):
        got = moving(df, {"s": F.sum("v"), "m": F.max("k"), "c": F.count("v")}, "id", rows=(low, high), **opts)
        f = w.rowsBetween(low, high)
        assert rows(got) == rows(df.select("*", F.sum("v").over(f), F.max("k").over(f), F.count("v").over(f)))


def test_small_partitions_over_the_whole_order_are_not_copied(spark):
    """Each of 300 keys has a row in every bucket of the order: no halo copies, hence no join."""
    df = spark.range(3000).select("id", (F.col("id") % 300).alias("g"), (F.col("id") * 7 % 11).alias("v"))
    w = Window.partitionBy("g").orderBy("id")
    near = neighbours(df, {"p": ("v", -1), "n": ("v", 2)}, "id", partition_by="g", rows_per_bucket=300)
    assert rows(near) == rows(df.select("*", F.lag("v", 1).over(w), F.lead("v", 2).over(w)))
    frame = moving(df, {"s": F.sum("v")}, "id", rows=(-2, 1), partition_by="g", rows_per_bucket=300)
    assert rows(frame) == rows(df.select("*", F.sum("v").over(w.rowsBetween(-2, 1))))
    for made in (near, frame):
        assert "Join" not in made._jdf.queryExecution().executedPlan().toString()


def test_large_partitions_are_cut_beside_small_ones(spark):
    """A null key and a frequent one pass the limit of a bucket and are cut; copies are theirs alone."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN -1 ELSE id % 200 END")
    df = spark.range(1800).select("id", key.alias("g"), (F.col("id") * 7 % 11).alias("v"))
    w = Window.partitionBy("g").orderBy("id")
    opts = {"partition_by": "g", "rows_per_bucket": 100}
    near = neighbours(df, {"p": ("v", -3), "n": ("v", 2)}, "id", **opts)
    assert rows(near) == rows(df.select("*", F.lag("v", 3).over(w), F.lead("v", 2).over(w)))
    frame = moving(df, {"s": F.sum("v")}, "id", rows=(-4, 3), **opts)
    assert rows(frame) == rows(df.select("*", F.sum("v").over(w.rowsBetween(-4, 3))))
    own, slots = _with_halos(df, ["g"], ["id"], 3, 2, 100, 1 << 18)
    assert own.where("g IS NULL OR g = -1").groupBy(*slots).count().count() == 12  # of 1,200 rows, 200 to a bucket
    assert {r.g for r in own.where("NOT __own").select("g").distinct().collect()} == {None, -1}


@pytest.mark.parametrize("per_bucket, parts", [(1, ["g"]), (20, [])])
def test_range_frames_equal_plain_windows(spark, per_bucket, parts):
    df = _table(spark)
    for low, high in ((-3, 0), (-1, 4), (2, 5), (-4, -2), (0, 0)):
        f = Window.partitionBy(*parts).orderBy("k").rangeBetween(low, high)
        got = moving_range(df, {"s": F.sum("v"), "c": F.count(F.lit(1))}, "k", within=(low, high), partition_by=parts,
                           rows_per_bucket=per_bucket)
        assert rows(got) == rows(df.select("*", F.sum("v").over(f), F.count(F.lit(1)).over(f)))


def test_first_and_last_values(spark):
    df = _table(spark)
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    got = ends(df, {"f": ("v", "first"), "l": ("k", "last")}, "id", partition_by="g")
    assert rows(got) == rows(df.select("*", F.first("v").over(w), F.last("k").over(w)))
    whole = ends(df, {"f": ("id", "first"), "l": ("id", "last")}, "id").select("f", "l").distinct().collect()
    assert [tuple(r) for r in whole] == [(0, 199)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(-40, 40), st.integers(0, 30)), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(-40, 40), st.integers(0, 30)), min_size=1, max_size=25))
def test_interval_join_on_any_intervals(spark, a, b):
    left = spark.createDataFrame([(i, lo, lo + n) for i, (lo, n) in enumerate(a)], "id int, lo int, hi int")
    right = spark.createDataFrame([(i, lo, lo + n) for i, (lo, n) in enumerate(b)], "id int, lo long, hi long")
    got = rows(interval_join(left, right, ("lo", "hi"), ("lo", "hi")).select("id", "right_id"))
    assert got == sorted(((i, j) for i, x in enumerate(a) for j, y in enumerate(b)
                          if meets((x[0], sum(x)), (y[0], sum(y)), "overlaps")), key=str)
