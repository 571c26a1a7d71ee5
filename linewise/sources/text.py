"""Text sources: one row per line, or one row per multi-line record.

Line order is not a property of a DataFrame.  ``read_lines`` therefore carries
an explicit order key: the file, the start of the split inside the file, and a
row id that grows along the split.  The (file, split start) pair is also a
natural bucket for the scalable row numbering in ``operators.sequence``: one
split is at most ``spark.sql.files.maxPartitionBytes`` of text.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewise.operators.sequence import boundary_groups, row_number

FILE = "file_path"
SPLIT = "split_start"
ROW_ID = "row_id"
LINE_ORDER = (FILE, SPLIT, ROW_ID)
LINE_BUCKET = (FILE, SPLIT)


def read_lines(spark: SparkSession, path: str | Sequence[str], *,
               line_number: str | None = None) -> DataFrame:
    """Lines of one or many text files: ``value`` plus the order key columns.

    With ``line_number`` a 1-based number along (file path, position) is added.
    Partition folders (``key=value``) become columns as usual.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.text(paths)
    lines = raw.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(ROW_ID),
    )
    if line_number:
        lines = row_number(lines, list(LINE_ORDER), out=line_number, bucket=list(LINE_BUCKET))
    return lines


def first_lines(lines: DataFrame, n: int, *, line_number: str | None = None) -> DataFrame:
    """The first ``n`` lines in file order (a header block, a fixed layout).

    Planned as a top-k on the line order key: each task keeps its own ``n``
    first lines and only those reach the final merge; nothing is numbered.
    """
    head = lines.orderBy(*LINE_ORDER).limit(n)
    if line_number:
        # A window over the n kept rows only.
        head = head.withColumn(line_number, F.row_number().over(Window.orderBy(*LINE_ORDER)).cast("long"))
    return head


def read_first_lines(spark: SparkSession, path: str | Sequence[str], n: int, *,
                     line_number: str | None = None) -> DataFrame:
    """The first ``n`` lines of a text source, reading only the leading files.

    Files are taken in path order (the order ``read_lines`` uses) and read until
    ``n`` lines are found, so a header block of a 100 TB folder costs the start
    of one file, not a scan of the folder.  Each step counts at most the lines
    still missing; the result is the same as ``first_lines(read_lines(...), n)``.
    """
    # inputFiles gives URIs; readers take paths.
    files = sorted(unquote(f) for f in read_lines(spark, path).inputFiles())
    chosen: list[str] = []
    found = 0
    for f in files:
        chosen.append(f)
        found += spark.read.text(f).limit(n - found).count()
        if found >= n:
            break
    if not chosen:
        return first_lines(read_lines(spark, path), n, line_number=line_number)
    return first_lines(read_lines(spark, chosen), n, line_number=line_number)


def read_records(spark: SparkSession, path: str | Sequence[str], separator: str = "\n\n") -> DataFrame:
    """Records separated by ``separator`` (default: a blank line), one row each.

    Note that a run of three or more newlines leaves the extra newlines at the
    start of the next record; use ``record_groups`` when blank runs matter.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("lineSep", separator).text(paths)


def record_groups(lines: DataFrame, *, is_boundary: Column | None = None,
                  out: str = "group_id") -> DataFrame:
    """Group id per line: a boundary line (default: blank) opens a new record."""
    boundary = is_boundary if is_boundary is not None else (F.col("value") == F.lit(""))
    return boundary_groups(lines, boundary, list(LINE_ORDER), out=out, bucket=list(LINE_BUCKET))


def write_lines(df: DataFrame, column: Column | str, path: str, *,
                partition_by: Sequence[str] = ()) -> str:
    """Write one string column as text lines (a value holding newlines spans several)."""
    c = F.col(column) if isinstance(column, str) else column
    df.select(c.alias("value"), *partition_by).write.mode("errorifexists").partitionBy(
        *partition_by).text(path)
    return path
