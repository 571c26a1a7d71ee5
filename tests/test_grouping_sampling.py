import random

import pytest
from pyspark.sql import functions as F

from linewise.operators.grouping import cube_sets, grouped_sets, rollup_sets
from linewise.operators.sampling import sample_rows


def _rows(n=300):
    r = random.Random(2)
    return [(r.choice([None, "a", "b"]), r.choice([1, 2, None]), r.choice([None, *range(20)]), r.choice([None, r.randint(0, 9)]))
            for _ in range(n)]


@pytest.mark.parametrize("sets", [cube_sets(["g", "k"]), rollup_sets(["g", "k"]), [["k"]], [[]]])
def test_groupings_equal_plain_counts(spark, sets):
    data = _rows()
    df = spark.createDataFrame(data * 2, "g string, k int, u int, v int").repartition(3)
    want = []
    for s in sets:
        groups = {}
        for row in data * 2:
            key = (row[0] if "g" in s else None, row[1] if "k" in s else None)
            groups.setdefault(key, []).append(row)
        gid = 2 * ("g" not in s) + ("k" not in s)
        for key, members in groups.items():
            vs = [m[3] for m in members if m[3] is not None]
            want.append((*key, gid, len(members), len({m[2] for m in members} - {None}), sum(vs) if vs else None))
    got = [tuple(r) for r in grouped_sets(df, ["g", "k"], sets, distinct="u", sums={"total": "v"}).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert grouped_sets(df.limit(0), ["g", "k"], sets, distinct="u").collect() == []


def test_grouping_of_unknown_key(spark):
    with pytest.raises(ValueError):
        grouped_sets(spark.range(1), ["id"], [["x"]])


def test_samples_have_their_size_and_agree_on_reruns(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 != 0, F.lit("big")).alias("s"), (F.col("id") % 7).alias("w"))
    first = sample_rows(df.repartition(7), 40, "id", strata="s", seed=3)
    again = sample_rows(df.repartition(2), 40, "id", strata="s", seed=3)
    assert {tuple(r) for r in first.collect()} == {tuple(r) for r in again.collect()} and first.count() == 80
    assert {r.s: r["count"] for r in first.groupBy("s").count().collect()} == {"big": 40, None: 40}
    other = sample_rows(df, 40, "id", strata="s", seed=4)
    assert {r.id for r in first.collect()} != {r.id for r in other.collect()}
    assert sample_rows(df, 10_000, "id").count() == 5000 and sample_rows(df, 0, "id").count() == 0
    assert sample_rows(df.limit(0), 5, "id", strata="s").collect() == []


def test_weights_set_the_chances(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 3.0).when(F.col("id") % 4 == 1, 1.0).alias("w"))
    taken = sample_rows(df, 1000, "id", weight="w", seed=1).groupBy("w").count().collect()
    share = {r.w: r["count"] for r in taken}
    # Twice as many rows of three times the weight: six of seven draws, and no row without a weight.
    assert set(share) == {1.0, 3.0} and sum(share.values()) == 1000 and 820 < share[3.0] < 895
