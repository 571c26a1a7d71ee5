"""The query catalogue: composite jobs on the driver's tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Column names equal those of the matching SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewise.functions import intervals as iv
from linewise.functions.parse import (char_at, chars, delimited_ints, fixed_width, ints_at, keep_chars,
                                      split_half)
from linewise.functions.recode import letter_weight, recode
from linewise.functions.rules import match_points, needed_result, required_move, result_points
from linewise.functions.sets import common_by_difference, common_elements, first_common, joined_sorted
from linewise.functions.udf_forms import overlap_label_udf, required_move_udf
from linewise.operators.asof_join import asof_join
from linewise.operators.columns import drop_columns, prefix_columns, rename_columns
from linewise.operators.group_sets import group_common_elements
from linewise.operators.grouping import cube_sets, grouped_sets
from linewise.operators.interval_join import interval_join, overlap_counts
from linewise.operators.lookup import recode_join
from linewise.operators.ranking import ends, moving, moving_range, neighbours, ranks, tiles
from linewise.operators.reshape import unpivot_long, unpivot_totals
from linewise.operators.sampling import sample_rows
from linewise.operators.sequence import batch_rows, boundary_groups, row_number, running_sum
from linewise.operators.summary import count_per, grand_total, top_k, total_per
from linewise.plans import text_jobs
from linewise.plans.tables import load
from linewise.session import scratch_path
from linewise.sources.text import read_first_lines, read_lines, read_records, record_groups, write_lines


# ---------------------------------------------------------------- boundary groups

def _event_group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    is_signup = F.col("event_type") == F.lit("signup")
    # The boundary row opens its group and its own value counts 0.
    cents = F.when(is_signup, F.lit(0).cast("long")).otherwise(F.round(F.col("value") * 100).cast("long"))
    grouped = boundary_groups(events.withColumn("cents", cents), is_signup, "event_id")
    return total_per(grouped, "group_id", "cents", out="total_cents", count_out="n_rows")


def q01_boundary_group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_group_totals(spark, sf_dir)


def q02_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_event_group_totals(spark, sf_dir), 3, "total_cents", tie_break="group_id")


def q03_top_groups_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k(_event_group_totals(spark, sf_dir), 3, "total_cents", tie_break="group_id")
    return grand_total(top, "total_cents", out="top3_total_cents")


# ---------------------------------------------------------------- code pairs and rule tables
# Query parameters: the order status plays the opponent's code and the first
# character of the priority plays my code.  Priorities 4 and 5 have no move.
OPPONENT_POINTS = {"F": 1, "O": 2, "P": 3}
MY_POINTS = {"1": 1, "2": 2, "3": 3}


def _code_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    code = F.concat(F.col("o_orderstatus"), F.lit(" "), F.substring("o_orderpriority", 1, 1))
    parsed = orders.select("o_orderkey", char_at(code, 0).alias("opponent"), char_at(code, 2).alias("mine"))
    return parsed.select(
        "o_orderkey", "opponent", "mine",
        recode("opponent", OPPONENT_POINTS).alias("opponent_points"),
        recode("mine", MY_POINTS).alias("my_points"),
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _code_pairs(spark, sf_dir)
    scored = pairs.withColumn("match_points", match_points(F.col("my_points"), F.col("opponent_points")))
    return scored.withColumn("total_points", F.col("match_points") + F.col("my_points"))


def q04_code_pair_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)


def q05_score_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grand_total(_scored(spark, sf_dir), "total_points", out="score_total")


def _dependent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _code_pairs(spark, sf_dir)
    needed = needed_result(F.col("my_points"))
    return pairs.select(
        "o_orderkey", "opponent_points", "my_points",
        needed.alias("needed_result"),
        result_points(needed).alias("new_points"),
        (F.col("my_points") - F.col("opponent_points")).alias("point_dif"),
    )


def q06_dependent_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _dependent(spark, sf_dir)
    d = d.withColumn("new_play", required_move(F.col("needed_result"), F.col("opponent_points")))
    return d.select("o_orderkey", "needed_result", "new_points", "point_dif", "new_play",
                    (F.col("new_play") + F.col("new_points")).alias("new_total_points"))


def q07_udf_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _dependent(spark, sf_dir)
    d = d.withColumn("new_play", required_move_udf("needed_result", "opponent_points"))
    return d.select("o_orderkey", "needed_result", "new_points", "point_dif", "new_play",
                    (F.col("new_play") + F.col("new_points")).alias("new_total_points"))


# Query parameters: three market segments get a short label, the rest "Unknown".
SEGMENT_LABELS = {"AUTOMOBILE": "auto", "BUILDING": "building", "MACHINERY": "machinery"}


def q08_recode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select("c_mktsegment")
    labelled = customers.select(recode("c_mktsegment", SEGMENT_LABELS, default="Unknown").alias("segment_label"))
    return count_per(labelled, "segment_label", out="n_customers")


# ---------------------------------------------------------------- array sets over text

def _documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Documents for whole-text character work."""
    return load(spark, sf_dir, "documents").select("doc_id", *cols)


def _halves(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    docs = _documents(spark, sf_dir, "text", *extra)
    first, second = split_half("text")
    return docs.select("doc_id", *extra, chars(first).alias("first_half"), chars(second).alias("second_half"))


def _half_common(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    docs = _documents(spark, sf_dir, "text", *extra)
    first, second = split_half("text")
    # Dropping non-letters before the split (not after it) keeps the arrays
    # short and avoids an interpreted lambda; the result is the same set.
    a = F.array_distinct(chars(keep_chars(first, "A-Za-z")))
    b = F.array_distinct(chars(keep_chars(second, "A-Za-z")))
    common = F.array_remove(common_elements(a, b), "")
    return docs.select("doc_id", *extra, F.sort_array(common).alias("common"))


def q09_half_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _half_common(spark, sf_dir)
    return c.select("doc_id", F.size("common").alias("n_common"), first_common("common").alias("first_common"))


def q10_half_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _half_common(spark, sf_dir, extra=("lang",))
    weighted = c.select("lang", letter_weight(first_common("common")).alias("weight"))
    return weighted.groupBy("lang").agg(
        F.sum("weight").alias("total_weight"),
        F.count(F.lit(1)).alias("n_docs"),
        F.count("weight").alias("n_weighted"),
    )


def q11_except_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    halves = _halves(spark, sf_dir)
    common = common_by_difference("first_half", "second_half")
    return halves.select("doc_id", F.size(common).alias("n_common"), joined_sorted(common).alias("common_chars"))


def _doc_batches(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    docs = _documents(spark, sf_dir, "text")
    # Distinct characters per document before any shuffle: at most the alphabet.
    docs = docs.select("doc_id", F.array_distinct(chars("text")).alias("doc_chars"))
    return batch_rows(docs, k, "doc_id")


def _batch_common(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    k = 3
    batched = _doc_batches(spark, sf_dir, k)
    common = group_common_elements(batched, "batch_id", "doc_chars", out="common", size_out="n_docs",
                                   strategy=strategy, max_group_size=k)
    return common.select("batch_id", "n_docs", F.size("common").alias("n_common"),
                         F.array_join("common", "").alias("common_chars"))


def q12_batch_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_common(spark, sf_dir, "fold")


def q12b_batch_common_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_common(spark, sf_dir, "count")


# ---------------------------------------------------------------- intervals

def _interval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return _interval_columns(li)


def _interval_columns(li: DataFrame) -> DataFrame:
    """Row-local: works on a batch or a streaming lineitem frame."""
    a = F.col("l_quantity").cast("int")
    b = F.round(F.col("l_discount") * 100).cast("int") * 5
    c = F.col("l_linenumber") * 7
    d = F.round(F.col("l_tax") * 100).cast("int") * 6
    lo1, hi1 = iv.normalized(a, b)
    lo2, hi2 = iv.normalized(c, d)
    # Rendered as "a-b,c-d" text, then parsed back like any delimited input.
    pair = F.concat(lo1.cast("string"), F.lit("-"), hi1.cast("string"), F.lit(","),
                    lo2.cast("string"), F.lit("-"), hi2.cast("string"))
    texts = li.select("l_orderkey", "l_linenumber", pair.alias("pair"))
    parsed = texts.select("l_orderkey", "l_linenumber", "pair", *ints_at(delimited_ints("pair"), 4))
    return parsed.withColumn("contained", iv.flag(iv.either_contains("val1", "val2", "val3", "val4")))


def q13_interval_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _interval_pairs(spark, sf_dir)


def q14_overlap_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _interval_pairs(spark, sf_dir)
    labelled = pairs.withColumn("label", iv.overlap_label("val1", "val2", "val3", "val4"))
    return count_per(labelled, "label", out="n_pairs", extra={"n_contained": F.sum("contained")})


def q14b_udf_overlap_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _interval_pairs(spark, sf_dir)
    labelled = pairs.withColumn("label", overlap_label_udf("val1", "val2", "val3", "val4"))
    return count_per(labelled, "label", out="n_pairs", extra={"n_contained": F.sum("contained")})


def q15_user_type_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = (load(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
              .where(F.col("event_type").isin("view", "purchase")))
    is_a, is_b = F.col("event_type") == "view", F.col("event_type") == "purchase"
    spans = events.groupBy("user_id").agg(
        F.min(F.when(is_a, F.col("event_id"))).alias("a_lo"),
        F.max(F.when(is_a, F.col("event_id"))).alias("a_hi"),
        F.min(F.when(is_b, F.col("event_id"))).alias("b_lo"),
        F.max(F.when(is_b, F.col("event_id"))).alias("b_hi"),
    ).where(F.col("a_lo").isNotNull() & F.col("b_lo").isNotNull())
    return spans.select(
        "user_id", "a_lo", "a_hi", "b_lo", "b_hi",
        iv.flag(iv.overlaps("a_lo", "a_hi", "b_lo", "b_hi")).alias("is_overlap"),
        iv.flag(iv.either_contains("a_lo", "a_hi", "b_lo", "b_hi")).alias("is_contained"),
    )


# ---------------------------------------------------------------- reshape and layout

def _unit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")
    discount = F.round(F.col("l_discount") * 100).cast("long")
    return li.select(
        "l_orderkey",
        F.col("l_quantity").cast("long").alias("quantity"),
        F.when(discount != 0, discount).alias("discount"),  # zero discount is "no value"
        F.round(F.col("l_tax") * 100).cast("long").alias("tax"),
    )


def q16_unpivot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_totals(_unit_metrics(spark, sf_dir), ["quantity", "discount", "tax"])


def q22_unpivot_top_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = unpivot_long(_unit_metrics(spark, sf_dir), ["l_orderkey"], ["quantity", "discount", "tax"],
                        name="metric", value="units")
    long = long.withColumnRenamed("l_orderkey", "order_key")
    return top_k(total_per(long, "order_key", "units", out="total_units"), 1, "total_units",
                 tie_break="order_key")


def q17_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber")
    layout = F.concat(F.lit("["), F.col("l_returnflag"), F.lit("] ["), F.col("l_linestatus"), F.lit("] ["),
                      F.col("l_linenumber").cast("string"), F.lit("]"))
    return fixed_width(li.select("l_orderkey", layout.alias("layout")), "layout", [1, 5, 9, 13],
                       keep=("l_orderkey", "layout"))


def q18_prefix_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    renamed = rename_columns(nation, {"n_name": "name", "n_regionkey": "region_key", "absent": "ignored"})
    prefixed = prefix_columns(renamed, "nat_")
    return drop_columns(prefixed, "nat_region_key", "not_a_column")


# ---------------------------------------------------------------- text sources

def q19_text_scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("lang", "text")
    path = write_lines(docs, "text", scratch_path(spark, "doc-lines"), partition_by=("lang",))
    lines = read_lines(spark, path)
    return lines.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("value")).alias("n_chars"),
        F.count(F.when(F.col("value") == "", 1)).alias("n_blank"),
    )


def _doc_record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text with a blank line opening each one, scanned back
    and cut into records at the blank lines."""
    docs = load(spark, sf_dir, "documents").select("text")
    path = write_lines(docs, F.concat(F.lit("\n"), F.col("text")), scratch_path(spark, "doc-records"))
    return record_groups(read_lines(spark, path))


def _record_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _doc_record_lines(spark, sf_dir)
    is_line = F.col("value") != ""
    return grouped.groupBy("group_id").agg(
        F.count(F.when(is_line, 1)).alias("n_lines"),
        F.sum(F.when(is_line, F.length("value")).otherwise(0)).alias("n_chars"),
    )


def q23_text_record_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_totals(spark, sf_dir).select("n_lines", "n_chars")


def q24_text_records_linesep(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("text")
    path = write_lines(docs, F.concat(F.col("text"), F.lit("\n")), scratch_path(spark, "doc-linesep"))
    records = read_records(spark, path, "\n\n")
    n_lines = F.size(F.split("value", "\n"))
    return records.select(n_lines.cast("long").alias("n_lines"),
                          (F.length("value") - (n_lines - 1)).cast("long").alias("n_chars"))


def q25_text_record_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k(_record_totals(spark, sf_dir), 3, "n_chars", tie_break="group_id")
    return top.agg(F.max("n_chars").alias("largest_chars"), F.sum("n_chars").alias("top3_chars"))


def q28_layout_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text file whose first nine lines are a fixed-width block, read back."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    layout = F.concat(F.lit("["), F.col("o_orderstatus"), F.lit("] ["), F.substring("o_orderpriority", 1, 1),
                      F.lit("] "), F.substring("o_orderpriority", 3, 4))
    # Range-partitioned sort: part files are written in key order.
    ordered = orders.select("o_orderkey", layout.alias("layout")).orderBy("o_orderkey")
    path = write_lines(ordered, "layout", scratch_path(spark, "order-layout"))
    head = read_first_lines(spark, path, 9, line_number="line_no")
    return fixed_width(head, "value", [1, 5, 9], keep=("line_no", "value"))


# ---------------------------------------------------------------- batches, filters, lookups

def q20_row_number_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id")
    batched = batch_rows(events, 7, "event_id")
    return batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_id").alias("first_event_id"),
        F.max("event_id").alias("last_event_id"),
    )


def q21_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_type", "value")
    v, t = F.col("value"), F.col("event_type")
    # One scan with conditional counts instead of one filtered scan per predicate.
    return events.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(v.isNull(), 1)).alias("n_null_value"),
        F.count(F.when(v.isNotNull(), 1)).alias("n_value"),
        F.count(F.when(t == "signup", 1)).alias("n_signup"),
        F.count(F.when((v >= 10) & (v < 20), 1)).alias("n_value_10_20"),
        F.count(F.when((t == "click") & (v > 100), 1)).alias("n_click_over_100"),
    )


def q21b_pushed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "value")
    kept = events.where((F.col("event_type") == "purchase") & (F.col("value") >= 100))
    return count_per(kept, "user_id", out="n_big_purchases",
                     extra={"big_purchase_cents": F.sum(F.round(F.col("value") * 100).cast("long"))})


def q26_recode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation")
    named = recode_join(customers, "c_nationkey", nation, "n_nationkey", "n_name", out="nation_name",
                        default="Unknown")
    return count_per(named, "nation_name", out="n_customers")



# ---------------------------------------------------------------- streaming

def q27_stream_score_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code-pair scoring run as a file stream, then totals per code pair."""
    from linewise.streaming.files import run_to_files

    def score(orders: DataFrame) -> DataFrame:
        code = F.concat(F.col("o_orderstatus"), F.lit(" "), F.substring("o_orderpriority", 1, 1))
        pairs = orders.select(recode(char_at(code, 0), OPPONENT_POINTS).alias("opponent_points"),
                              recode(char_at(code, 2), MY_POINTS).alias("my_points"))
        return pairs.withColumn("total_points",
                                match_points(F.col("my_points"), F.col("opponent_points")) + F.col("my_points"))

    out = run_to_files(spark, sf_dir, score, name="stream-scores", file_glob="orders.parquet")
    scored = spark.read.parquet(out)
    return scored.groupBy("opponent_points", "my_points").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("total_points").alias("total_points"))



def q29_stream_overlap_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q14 as a stateful streaming aggregation over a lineitem file stream."""
    from linewise.streaming.files import read_totals, run_totals

    def labelled(li: DataFrame) -> DataFrame:
        pairs = _interval_columns(li)
        return pairs.withColumn("label", iv.overlap_label("val1", "val2", "val3", "val4"))

    out = run_totals(spark, sf_dir, labelled, ["label"],
                     {"n_pairs": F.count(F.lit(1)), "n_contained": F.sum("contained")},
                     name="stream-labels", file_glob="lineitem.parquet",
                     state_partitions=4)  # two labels: a few state partitions suffice
    return read_totals(spark, out)


# ---------------------------------------------------------------- row-level order

def q30_event_group_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boundary group of every event."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type")
    return boundary_groups(events, F.col("event_type") == "signup", "event_id").select("event_id", "group_id")


def q31_partitioned_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sum and row number per event type, with a null partition and null values."""
    events = load(spark, sf_dir, "events").select(
        "event_id", F.expr("nullif(event_type, 'view')").alias("kind"),
        F.expr("CASE WHEN event_id % 3 <> 0 THEN event_id % 100 END").alias("v"))
    summed = running_sum(events, "v", "event_id", out="running", partition_by="kind")
    return row_number(summed, "event_id", out="rn", partition_by="kind").select(
        "event_id", "kind", F.col("running").cast("long").alias("running"), "rn")


# ---------------------------------------------------------------- jobs on text files

def q32_text_code_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of two codes, scored; totals per pair of moves (priorities 4 and 5 have none)."""
    orders = load(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    line = F.concat(F.translate("o_orderstatus", "FOP", "ABC"), F.lit(" "),
                    F.translate(F.substring("o_orderpriority", 1, 1), "123", "XYZ"))
    scores = text_jobs.code_pair_scores(spark, write_lines(orders, line, scratch_path(spark, "code-lines")))
    return scores.groupBy("theirs", "mine").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("total_points").alias("total_points"),
        F.sum("new_total_points").alias("new_total_points"))


def q33_text_letter_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of each document as a line; weight of the first letter common to every three lines."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id")
    path = write_lines(docs, keep_chars(F.coalesce("text", F.lit("")), "A-Za-z"), scratch_path(spark, "letter-lines"))
    return text_jobs.batch_common_total(spark, path, k=3)


def q34_text_interval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_interval_pairs(spark, sf_dir), "pair", scratch_path(spark, "interval-lines"))
    return text_jobs.interval_pair_counts(spark, path)


def q35_text_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line number and batch of three of every line of a text folder."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey")
    path = write_lines(orders, F.col("o_orderkey").cast("string"), scratch_path(spark, "numbered-lines"))
    lines = read_lines(spark, path, line_number="line_no")
    return lines.select("line_no", F.expr("(line_no - 1) div 3 + 1").alias("batch_id"), "value")


# ---------------------------------------------------------------- intervals and nearest rows of two tables

def q36_error_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which signup groups the ids from each error to ``value`` ids later touch, and whether a group lies inside."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    groups = (boundary_groups(events, F.col("event_type") == "signup", "event_id").groupBy("group_id")
              .agg(F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")))
    errors = events.where("event_type = 'error'").select(
        "event_id", (F.col("event_id") + F.floor(F.coalesce("value", F.lit(0.0)))).cast("long").alias("reach"))
    pairs = interval_join(errors, groups, ("event_id", "reach"), ("first_id", "last_id"))
    inside = iv.contains("event_id", "reach", "first_id", "last_id")
    return pairs.select("event_id", "group_id", iv.flag(inside).alias("is_inside"))


def q37_close_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a customer's orders whose 30 days from the order date overlap."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("opened"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("closed"))
    pairs = interval_join(orders, orders, ("opened", "closed"), ("opened", "closed"), on="o_custkey")
    return pairs.where("o_orderkey < right_o_orderkey").select("o_custkey", "o_orderkey", "right_o_orderkey")


def q38_orders_at_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of all customers whose three days overlap those of each order, counted without pairs."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("opened"), F.date_add(F.to_date("o_orderdate"), 3).alias("closed"))
    counted = overlap_counts(orders, orders, ("opened", "closed"), ("opened", "closed"), out="n_at_hand")
    return counted.select("o_orderkey", "n_at_hand")


def q39_view_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's last view before each purchase, at most a day earlier."""
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    views = events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), "value")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = asof_join(buys, views, "ts", "ts", on="user_id", values=["view_id", "value"], within=86_400_000_000, prefix="last_")
    return found.select("event_id", "user_id", F.col("last_view_id").alias("view_id"),
                        F.round(F.col("last_value") * 100).cast("long").alias("view_cents"))


def q40_error_after_signup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next error of any user after each signup."""
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    errors = events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), F.col("user_id").alias("error_user"))
    signups = events.where("event_type = 'signup'").select("event_id")
    return asof_join(signups, errors, "event_id", "error_id", direction="forward", exact=False, prefix="")


# ---------------------------------------------------------------- ranks, neighbours and frames over the whole order

def q41_value_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of each event's value among those of its type, largest first."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return ranks(events, "value", partition_by="event_type", descending=True,
                 out={"rank": "value_rank", "dense_rank": "value_dense_rank", "cume_dist": "value_share"}).drop("value")


def q41b_quantity_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of each line's quantity among all lines: few keys, each with very many rows."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").cast("int").alias("quantity"))
    return ranks(lines, "quantity", out={"rank": "quantity_rank", "dense_rank": "quantity_dense_rank",
                                         "percent_rank": "quantity_share"})


def q42_price_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in 100 tiles by price."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return tiles(orders, 100, ["o_totalprice", "o_orderkey"], out="tile").select("o_orderkey", "tile")


def q43_user_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the user's previous event, the type two events later, and the user's first and last type."""
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    near = neighbours(events, {"previous_id": ("event_id", -1), "later_type": ("event_type", 2)}, "event_id",
                      partition_by="user_id")
    return ends(near, {"first_type": ("event_type", "first"), "last_type": ("event_type", "last")}, "event_id",
                partition_by="user_id").drop("event_type")


def q44_moving_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cents of the last seven events, and errors among the three events on either side."""
    events = load(spark, sf_dir, "events").select(
        "event_id", F.round(F.col("value") * 100).cast("long").alias("cents"),
        (F.col("event_type") == "error").cast("long").alias("is_error"))
    summed = moving(events, {"cents_7": F.sum("cents"), "most_7": F.max("cents")}, "event_id", rows=(-6, 0))
    return moving(summed, {"errors_near": F.sum("is_error")}, "event_id", rows=(-3, 3)).select(
        "event_id", "cents_7", "most_7", "errors_near")


def q45_week_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order, the orders of the same priority in the seven days up to its own."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return moving_range(orders, {"n_week": F.count(F.lit(1)), "cents_week": F.sum("cents")}, "day", within=(-6, 0),
                        partition_by="o_orderpriority").select("o_orderkey", "n_week", "cents_week")


# ---------------------------------------------------------------- groupings and samples

def q46_event_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, distinct users and cents by type and day, by either, and in all."""
    events = load(spark, sf_dir, "events").select("event_type", F.to_date("ts").cast("string").alias("day"), "user_id",
                                                  F.round(F.col("value") * 100).cast("long").alias("cents"))
    return grouped_sets(events, ["event_type", "day"], cube_sets(["event_type", "day"]), distinct="user_id",
                        sums={"total_cents": "cents"}, distinct_out="n_users")


def q47_sample_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty events of each type."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type")
    return sample_rows(events, 50, "event_id", strata="event_type", seed=7)


def q48_orders_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hundred orders, drawn with chances in proportion to their price."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample_rows(orders, 200, "o_orderkey", weight="o_totalprice", seed=7).select("o_orderkey")


# ---------------------------------------------------------------- event time on streams

def _window_run(spark: SparkSession, sf_dir: str, name: str, keys: list[str], **window) -> DataFrame:
    """Events and cents of the closed windows of the events stream, an hour of lateness."""
    from linewise.streaming.event_time import instant, run_windows

    def timed(events: DataFrame) -> DataFrame:
        return events.select(instant(events, "ts").alias("at"), "event_type", "user_id",
                             F.round(F.col("value") * 100).cast("long").alias("cents"))

    out, _ = run_windows(spark, sf_dir, timed, "at", {"n_events": F.count(F.lit(1)), "total_cents": F.sum("cents")},
                         name=name, lateness="1 hour", keys=keys, file_glob="events.parquet", **window)
    return spark.read.parquet(out).select(F.unix_micros("window_start").alias("from_us"),
                                          F.unix_micros("window_end").alias("to_us"), *keys, "n_events", "total_cents")


def q49_daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling days per event type, from a watermarked stream."""
    return _window_run(spark, sf_dir, "stream-days", ["event_type"], size="1 day")


def q50_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of six hours, a new one every two hours, per event type, from a watermarked stream."""
    return _window_run(spark, sf_dir, "stream-slides", ["event_type"], size="6 hours", slide="2 hours")


def q51_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, four hours apart, from a watermarked stream."""
    return _window_run(spark, sf_dir, "stream-sessions", ["user_id"], gap="4 hours")


def q52_stream_user_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events in groups that a signup opens, numbered over a stream."""
    from linewise.streaming.event_time import read_groups, run_boundary_groups

    out = run_boundary_groups(spark, sf_dir, lambda events: events.select("event_id", "user_id", "event_type"),
                              F.col("event_type") == "signup", "event_id", partition_by="user_id",
                              name="stream-user-groups", file_glob="events.parquet")
    return read_groups(spark, out).select("event_id", "user_id", "group_id")


QUERIES = {
    "q01_boundary_group_totals": q01_boundary_group_totals,
    "q02_top_groups": q02_top_groups,
    "q03_top_groups_total": q03_top_groups_total,
    "q04_code_pair_score": q04_code_pair_score,
    "q05_score_total": q05_score_total,
    "q06_dependent_rule": q06_dependent_rule,
    "q07_udf_rule": q07_udf_rule,
    "q08_recode_default": q08_recode_default,
    "q09_half_common": q09_half_common,
    "q10_half_weight": q10_half_weight,
    "q11_except_twice": q11_except_twice,
    "q12_batch_common": q12_batch_common,
    "q12b_batch_common_count": q12b_batch_common_count,
    "q13_interval_containment": q13_interval_containment,
    "q14_overlap_label_counts": q14_overlap_label_counts,
    "q14b_udf_overlap_label_counts": q14b_udf_overlap_label_counts,
    "q15_user_type_spans": q15_user_type_spans,
    "q16_unpivot_totals": q16_unpivot_totals,
    "q17_fixed_width": q17_fixed_width,
    "q18_prefix_rename": q18_prefix_rename,
    "q19_text_scan_lines": q19_text_scan_lines,
    "q20_row_number_batches": q20_row_number_batches,
    "q21_filters": q21_filters,
    "q21b_pushed_filter": q21b_pushed_filter,
    "q22_unpivot_top_key": q22_unpivot_top_key,
    "q23_text_record_groups": q23_text_record_groups,
    "q24_text_records_linesep": q24_text_records_linesep,
    "q25_text_record_top3": q25_text_record_top3,
    "q26_recode_join": q26_recode_join,
    "q27_stream_score_totals": q27_stream_score_totals,
    "q28_layout_header": q28_layout_header,
    "q29_stream_overlap_label_counts": q29_stream_overlap_label_counts,
    "q30_event_group_ids": q30_event_group_ids,
    "q31_partitioned_sums": q31_partitioned_sums,
    "q32_text_code_pairs": q32_text_code_pairs,
    "q33_text_letter_batches": q33_text_letter_batches,
    "q34_text_interval_pairs": q34_text_interval_pairs,
    "q35_text_line_numbers": q35_text_line_numbers,
    "q36_error_reach": q36_error_reach,
    "q37_close_orders": q37_close_orders,
    "q38_orders_at_hand": q38_orders_at_hand,
    "q39_view_before_purchase": q39_view_before_purchase,
    "q40_error_after_signup": q40_error_after_signup,
    "q41_value_ranks": q41_value_ranks,
    "q41b_quantity_ranks": q41b_quantity_ranks,
    "q42_price_tiles": q42_price_tiles,
    "q43_user_neighbours": q43_user_neighbours,
    "q44_moving_cents": q44_moving_cents,
    "q45_week_of_orders": q45_week_of_orders,
    "q46_event_cube": q46_event_cube,
    "q47_sample_per_type": q47_sample_per_type,
    "q48_orders_by_price": q48_orders_by_price,
    "q49_daily_windows": q49_daily_windows,
    "q50_sliding_windows": q50_sliding_windows,
    "q51_user_sessions": q51_user_sessions,
    "q52_stream_user_groups": q52_stream_user_groups,
}
