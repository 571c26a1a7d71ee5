import os

from pyspark.sql import functions as F

from linewise.sources.text import read_lines, read_records, record_groups, write_lines


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_line_numbers_follow_file_and_position(spark, tmp_path):
    folder = str(tmp_path)
    _write(folder, "a.txt", "a1\na2\n")
    _write(folder, "b.txt", "b1\nb2\nb3\nb4\nb5")  # larger file, no final newline
    lines = read_lines(spark, folder, line_number="line_no").orderBy("line_no").collect()
    assert [r.value for r in lines] == ["a1", "a2", "b1", "b2", "b3", "b4", "b5"]
    assert [r.line_no for r in lines] == list(range(1, 8))


def test_blank_line_records_sum(spark, tmp_path):
    text = "1000\n2000\n3000\n\n4000\n\n5000\n6000\n\n7000\n8000\n9000\n\n10000"
    path = _write(str(tmp_path), "cal.txt", text)
    grouped = record_groups(read_lines(spark, path))
    totals = grouped.groupBy("group_id").agg(F.sum(F.col("value").try_cast("int")).alias("total"))
    assert sorted(r.total for r in totals.collect()) == [4000, 6000, 10000, 11000, 24000]


def test_records_by_separator(spark, tmp_path):
    path = _write(str(tmp_path), "r.txt", "a\nb\n\nc\n\nd\ne\nf")
    recs = [r.value for r in read_records(spark, path).collect()]
    assert recs == ["a\nb", "c", "d\ne\nf"]


def test_write_lines_round_trip_with_partitions(spark, tmp_path):
    df = spark.createDataFrame([("x", "l1\nl2"), ("y", "m1"), ("x", "l3")], "k string, text string")
    out = write_lines(df, "text", str(tmp_path / "out"), partition_by=("k",))
    back = read_lines(spark, out)
    got = sorted((r.k, r.value) for r in back.collect())
    assert got == [("x", "l1"), ("x", "l2"), ("x", "l3"), ("y", "m1")]


def test_many_splits_keep_order(spark, tmp_path):
    # Small max partition bytes forces several splits per file.
    lines = [f"line{i:05d}" for i in range(3000)]
    path = _write(str(tmp_path), "big.txt", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_lines(spark, path, line_number="n").select("n", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.n, r.value) for r in got) == [(i + 1, v) for i, v in enumerate(lines)]


def test_first_lines_across_files(spark, tmp_path):
    from linewise.sources.text import first_lines, read_first_lines
    folder = str(tmp_path)
    _write(folder, "part-0.txt", "h1\nh2\n")
    _write(folder, "part-1.txt", "")
    _write(folder, "part-2.txt", "h3\nh4\nh5\n")
    _write(folder, "part-3.txt", "z1\n")
    fast = read_first_lines(spark, folder, 4, line_number="n").orderBy("n").collect()
    full = first_lines(read_lines(spark, folder), 4, line_number="n").orderBy("n").collect()
    assert [(r.n, r.value) for r in fast] == [(1, "h1"), (2, "h2"), (3, "h3"), (4, "h4")]
    assert [(r.n, r.value) for r in full] == [(r.n, r.value) for r in fast]


def test_crlf_lines_and_malformed_number(spark, tmp_path):
    path = _write(str(tmp_path), "crlf.txt", "10\r\n20\r\n\r\n5\r\nx1\r\n\r\n\r\n7")
    grouped = record_groups(read_lines(spark, path))
    totals = grouped.groupBy("group_id").agg(F.sum(F.col("value").try_cast("int")).alias("t"))
    got = sorted((r.group_id, r.t) for r in totals.collect())
    # the malformed "x1" counts nothing; two blanks in a row leave an empty group
    assert got == [(1, 30), (2, 5), (3, None), (4, 7)]
