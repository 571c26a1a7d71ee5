"""linewise: composable PySpark operators for line-oriented text and tables.

Column functions live in ``linewise.functions``, DataFrame operators in
``linewise.operators``, text sources in ``linewise.sources``, streaming runs in
``linewise.streaming`` and the query catalogue in ``linewise.plans``.
"""

from linewise.functions.intervals import either_contains, overlap_label, overlaps
from linewise.functions.parse import chars, char_at, delimited_ints, fixed_width, split_half
from linewise.functions.recode import recode
from linewise.functions.rules import decision_table
from linewise.functions.sets import common_by_difference, common_elements, without
from linewise.operators.asof_join import asof_join
from linewise.operators.group_sets import group_common_elements
from linewise.operators.grouping import cube_sets, grouped_sets, rollup_sets
from linewise.operators.interval_join import interval_join, overlap_counts
from linewise.operators.lookup import recode_join
from linewise.operators.ranking import ends, moving, moving_range, neighbours, ranks, tiles
from linewise.operators.reshape import unpivot_long, unpivot_totals
from linewise.operators.sampling import sample_rows
from linewise.operators.sequence import batch_rows, boundary_groups, row_number, running_sum
from linewise.operators.summary import count_per, grand_total, top_k, top_k_total, total_per
from linewise.sources.text import first_lines, read_first_lines, read_lines, read_records, record_groups

__all__ = [
    "asof_join", "cube_sets", "grouped_sets", "rollup_sets", "sample_rows", "batch_rows", "boundary_groups", "char_at", "chars", "common_by_difference",
    "common_elements", "count_per", "decision_table", "delimited_ints", "either_contains", "ends",
    "first_lines", "fixed_width", "grand_total", "group_common_elements", "interval_join", "moving",
    "moving_range", "neighbours", "overlap_counts", "overlap_label", "overlaps", "ranks",
    "read_first_lines", "read_lines", "read_records", "recode", "recode_join", "record_groups",
    "row_number", "running_sum", "split_half", "tiles", "top_k", "top_k_total", "total_per", "unpivot_long",
    "unpivot_totals", "without",
]
