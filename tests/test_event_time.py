"""Streams in pieces against the batch answer: windows, late rows, boundary groups, restarts."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from linewise.operators.sequence import boundary_groups
from linewise.streaming.event_time import event_windows, instant, read_groups, run_boundary_groups, run_windows

SCHEMA = "at timestamp, k string, v long"
DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def aggs(spark):
    return {"n": F.count(F.lit(1)), "total": F.sum("v")}


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def write_pieces(spark, folder, pieces, schema):
    """One file a piece, in the order of their modification times."""
    for i, rows in enumerate(pieces):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/p{i:03d}.parquet")
        time.sleep(0.02)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same(df):
    return df


@pytest.mark.parametrize("window", [{"size": "1 hour"}, {"size": "1 hour", "slide": "20 minutes"}, {"gap": "30 minutes"}])
def test_windows_in_pieces_equal_the_batch(spark, tmp_path, aggs, window):
    events = [(at(7 * i), None if i % 5 == 0 else f"k{i % 3}", None if i % 4 == 0 else i) for i in range(120)]
    events += [(None, "k0", 1), events[3], events[3], (at(7 * 119), "k9", 5)]  # a null time, repeats, a tie
    events = events[120:123] + events[:120] + events[123:]
    pieces = [events[i:i + 31] for i in range(0, len(events), 31)]
    write_pieces(spark, tmp_path / "in", pieces, SCHEMA)
    out, late = run_windows(spark, str(tmp_path / "in"), same, "at", aggs, name="t", lateness="10 minutes",
                            keys=["k"], out_path=str(tmp_path / "out"), max_files_per_trigger=1, state_partitions=3, **window)
    whole = event_windows(spark.createDataFrame(events, SCHEMA), "at", aggs, keys=["k"], **window)
    closed = whole.where(F.col("window_end") <= F.lit(at(7 * 119 - 10)))
    assert late == 0
    assert closed.count() > 10
    assert rows(spark.read.parquet(out)) == rows(closed)
    assert closed.where("k is null").count() > 5


def test_late_rows_are_dropped_and_counted(spark, tmp_path, aggs):
    write_pieces(spark, tmp_path / "in", [[(at(0), "a", 1), (at(300), "a", 1)], [(at(310), "a", 1)],
                                          [(at(5), "a", 100), (at(305), "a", 7)], [(at(900), "a", 1)]], SCHEMA)
    out, late = run_windows(spark, str(tmp_path / "in"), same, "at", aggs, name="t", lateness="30 minutes", keys=["k"],
                            size="1 hour", out_path=str(tmp_path / "out"), max_files_per_trigger=1, state_partitions=2)
    assert late == 1
    assert rows(spark.read.parquet(out).select("n", "total")) == [(1, 1), (3, 9)]


def test_windows_go_on_after_a_restart(spark, tmp_path, aggs):
    events = [(at(11 * i), "a", i) for i in range(60)]
    args = dict(name="t", lateness="5 minutes", keys=["k"], size="1 hour", out_path=str(tmp_path / "out"), state_partitions=2)
    write_pieces(spark, tmp_path / "in", [events[:25]], SCHEMA)
    run_windows(spark, str(tmp_path / "in"), same, "at", aggs, **args)
    spark.createDataFrame(events[25:], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / "q.parquet"))
    out, _ = run_windows(spark, str(tmp_path / "in"), same, "at", aggs, **args)
    whole = event_windows(spark.createDataFrame(events, SCHEMA), "at", aggs, size="1 hour", keys=["k"])
    assert rows(spark.read.parquet(out)) == rows(whole.where(F.col("window_end") <= F.lit(at(11 * 59 - 5))))


def test_empty_stream_and_row_at_the_gap(spark, tmp_path, aggs):
    write_pieces(spark, tmp_path / "in", [[]], SCHEMA)
    out, late = run_windows(spark, str(tmp_path / "in"), same, "at", aggs, name="t", lateness="1 minute", keys=["k"],
                            size="1 hour", out_path=str(tmp_path / "out"), state_partitions=2)
    assert late == 0
    two = spark.createDataFrame([(at(0), "a", 1), (at(30), "a", 1), (at(61), "a", 1)], SCHEMA)
    assert sorted(r.n for r in event_windows(two, "at", aggs, gap="30 minutes", keys=["k"]).collect()) == [1, 2]
    with pytest.raises(ValueError):
        event_windows(two, "at", aggs, size="1 hour", gap="1 hour")


def test_time_without_zone_is_utc_in_any_session(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    events = session.read.parquet(f"{SF001}/events.parquet")
    micros = events.select(F.unix_micros(instant(events, "ts")).alias("u"), F.col("ts").cast("string").alias("s"))
    for r in micros.orderBy("u").limit(5).collect():
        want = dt.datetime.fromisoformat(r.s).replace(tzinfo=dt.timezone.utc)
        assert r.u == (want - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


GROUPS = "id long, u string, kind string, group_id string"


@pytest.mark.parametrize("keys", [[], ["u"]])
def test_groups_in_pieces_and_restarted_equal_the_batch(spark, tmp_path, keys):
    # Key "hot" has most rows; a null key, a null kind and two boundaries in a row are among them.
    data = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"u{i % 4}",
             None if i % 11 == 0 else "b" if i % 5 == 0 or i % 5 == 1 else "x", "old") for i in range(200)]
    data[0] = (None, *data[0][1:])
    args = dict(name="t", partition_by=keys, out_path=str(tmp_path / "out"), max_files_per_trigger=1)
    write_pieces(spark, tmp_path / "in", [data[:50], data[50:51], data[51:120]], GROUPS)
    run_boundary_groups(spark, str(tmp_path / "in"), same, F.col("kind") == "b", "id", **args)
    spark.createDataFrame(data[120:], GROUPS).coalesce(1).write.parquet(str(tmp_path / "in" / "q.parquet"))
    out = run_boundary_groups(spark, str(tmp_path / "in"), same, F.col("kind") == "b", "id", **args)
    whole = boundary_groups(spark.createDataFrame(data, GROUPS), F.col("kind") == "b", "id", partition_by=keys or None)
    got = read_groups(spark, out)
    assert got.columns == whole.columns
    assert rows(got) == rows(whole)


def test_a_batch_run_again_writes_the_same(spark, tmp_path):
    data = [(i, f"u{i % 2}", "b" if i % 4 == 0 else "x", "old") for i in range(40)]
    args = dict(name="t", partition_by="u", out_path=str(tmp_path / "out"), max_files_per_trigger=1)
    write_pieces(spark, tmp_path / "in", [data[:20], data[20:]], GROUPS)
    out = run_boundary_groups(spark, str(tmp_path / "in"), same, F.col("kind") == "b", "id", **args)
    want = rows(read_groups(spark, out))
    (tmp_path / "out" / "checkpoint" / "commits" / "1").unlink()  # as if the driver died before the commit
    (tmp_path / "out" / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    run_boundary_groups(spark, str(tmp_path / "in"), same, F.col("kind") == "b", "id", **args)
    assert rows(read_groups(spark, out)) == want


def test_rows_out_of_order_end_the_run(spark, tmp_path):
    write_pieces(spark, tmp_path / "in", [[(5, "a", "b", "")], [(6, "a", "x", ""), (1, "z", "x", "")], [(5, "a", "x", "")]], GROUPS)
    with pytest.raises(Exception, match="come before rows"):
        run_boundary_groups(spark, str(tmp_path / "in"), same, F.col("kind") == "b", "id", partition_by="u",
                            name="t", out_path=str(tmp_path / "out"), max_files_per_trigger=1)
