"""The five line-oriented puzzle jobs, run on text files given by path.

Each job is the composition of library operators a user of the original
scripts would call; paths, positions and batch sizes are arguments.  Line
order always comes from the (file, split, row) key of ``read_lines``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.functions import intervals as iv
from linewise.functions.parse import char_at, chars, delimited_ints, fixed_width, ints_at, split_half, to_int
from linewise.functions.recode import letter_weight, recode
from linewise.functions.rules import match_points, needed_result, required_move, result_points
from linewise.functions.sets import common_elements, first_common
from linewise.operators.group_sets import group_common_elements
from linewise.operators.sequence import batch_rows
from linewise.operators.summary import count_per, grand_total, top_k, total_per
from linewise.sources.text import LINE_BUCKET, LINE_ORDER, read_first_lines, read_lines, record_groups

# Opponent codes A, B, C and own codes X, Y, Z are moves 1, 2, 3.
OPPONENT_CODES = {"A": 1, "B": 2, "C": 3}
OWN_CODES = {"X": 1, "Y": 2, "Z": 3}


# ---------------------------------------------------------------- blank-line records

def record_totals(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Sum of the integers of each blank-line separated record (``group_id``, ``total``)."""
    grouped = record_groups(read_lines(spark, path))
    # A blank (or unparsable) line counts 0, so a record of blanks totals 0.
    return total_per(grouped, "group_id", F.coalesce(to_int("value"), F.lit(0)), out="total")


def largest_record_total(spark: SparkSession, path) -> DataFrame:
    return record_totals(spark, path).agg(F.max("total").alias("largest_total"))


def top_records_total(spark: SparkSession, path, k: int = 3) -> DataFrame:
    top = top_k(record_totals(spark, path), k, "total", tie_break="group_id")
    return grand_total(top, "total", out="top_total")


# ---------------------------------------------------------------- code pairs

def code_pair_scores(spark: SparkSession, path) -> DataFrame:
    """Per line ``"A Y"``: both moves, the round score and the score of the wanted result."""
    lines = read_lines(spark, path)
    pts = lines.select(recode(char_at("value", 0), OPPONENT_CODES).alias("theirs"),
                       recode(char_at("value", 2), OWN_CODES).alias("mine"))
    needed = needed_result(F.col("mine"))
    return pts.select(
        "theirs", "mine",
        (match_points(F.col("mine"), F.col("theirs")) + F.col("mine")).alias("total_points"),
        (required_move(needed, F.col("theirs")) + result_points(needed)).alias("new_total_points"),
    )


def code_pair_totals(spark: SparkSession, path) -> DataFrame:
    scores = code_pair_scores(spark, path)
    return scores.agg(F.sum("total_points").alias("total_points"),
                      F.sum("new_total_points").alias("new_total_points"))


# ---------------------------------------------------------------- letter sets

def half_common_total(spark: SparkSession, path) -> DataFrame:
    """Sum of the weights of the (first) letter common to both halves of each line."""
    lines = read_lines(spark, path)
    a, b = split_half("value")
    common = first_common(common_elements(chars(a), chars(b)))
    return grand_total(lines.select(letter_weight(common).alias("w")), "w", out="total_weight")


def batch_common_total(spark: SparkSession, path, k: int = 3) -> DataFrame:
    """Sum of the weights of the letter common to each batch of ``k`` consecutive lines."""
    lines = read_lines(spark, path)
    lines = lines.withColumn("letters", F.array_distinct(chars("value")))
    batched = batch_rows(lines, k, list(LINE_ORDER), bucket=list(LINE_BUCKET))
    common = group_common_elements(batched, "batch_id", "letters", strategy="auto", max_group_size=k)
    return grand_total(common.select(letter_weight(F.get("common", 0)).alias("w")), "w", out="total_weight")


# ---------------------------------------------------------------- interval pairs

def interval_pair_flags(spark: SparkSession, path) -> DataFrame:
    lines = read_lines(spark, path)
    vals = lines.select(*ints_at(delimited_ints("value"), 4))
    return vals.select("*",
                       iv.flag(iv.either_contains("val1", "val2", "val3", "val4")).alias("contained"),
                       iv.overlap_label("val1", "val2", "val3", "val4").alias("label"))


def interval_pair_counts(spark: SparkSession, path) -> DataFrame:
    """Per overlap label: pairs and contained pairs."""
    return count_per(interval_pair_flags(spark, path), "label", out="n_pairs",
                     extra={"n_contained": F.sum("contained")})


# ---------------------------------------------------------------- fixed-width block

def layout_block(spark: SparkSession, path, n_lines: int = 9,
                 positions: Sequence[int] = tuple(range(1, 34, 4))) -> DataFrame:
    """The first ``n_lines`` lines as columns ``list1, list5, ...`` with their line number."""
    head = read_first_lines(spark, path, n_lines, line_number="line_no")
    return fixed_width(head, "value", positions, keep=("line_no",))
