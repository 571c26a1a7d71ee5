"""Ordered decision tables: the first matching rule wins (SQL CASE).

A rule table is a list of ``(condition, value)`` pairs.  Without a default an
unmatched row is null (and grand totals skip it); with a default it gets that
value.  Keeping the rules as Column expressions keeps them inside codegen,
where a Python UDF would cost a round trip per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_DEFAULT = object()


def _v(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def decision_table(rules: Sequence[tuple[Column, object]], default=_NO_DEFAULT) -> Column:
    if not rules:
        raise ValueError("a decision table needs at least one rule")
    cond, value = rules[0]
    out = F.when(cond, _v(value))
    for cond, value in rules[1:]:
        out = out.when(cond, _v(value))
    return out if default is _NO_DEFAULT else out.otherwise(_v(default))


def lookup_rules(c: Column | str, pairs: Sequence[tuple[object, object]], default=_NO_DEFAULT) -> Column:
    """Equality rules on one column, in the given order."""
    key = F.col(c) if isinstance(c, str) else c
    return decision_table([(key == F.lit(k), v) for k, v in pairs], default)


# --- the scoring rules of the code-pair game --------------------------------
# A move is worth 1, 2 or 3 points; a loss scores 0, a draw 3 and
# a win 6; the code positions 1, 2, 3 want a loss, a draw, a win.
SCORE = {"lose": 0, "draw": 3, "win": 6}
WANTED = ("lose", "draw", "win")
MOVES = 3


def match_points(mine: Column, theirs: Column) -> Column:
    """Outcome points of one round from the two move values (null if either is null).

    Each move beats the one before it in the circle 1, 2, 3, so how far my move
    is ahead (modulo 3) decides: 0 a draw, 1 a win, 2 a loss.
    """
    ahead = F.pmod(mine - theirs, F.lit(MOVES))
    return lookup_rules(ahead, [(0, SCORE["draw"]), (1, SCORE["win"]), (2, SCORE["lose"])])


def needed_result(code_points: Column) -> Column:
    return lookup_rules(code_points, list(enumerate(WANTED, 1)))


def result_points(needed: Column) -> Column:
    return lookup_rules(needed, list(SCORE.items()))


# The move (1, 2, 3) that gives the wanted result against the
# opponent's move.  A draw repeats the opponent's move.
REQUIRED_MOVE: tuple[tuple[str, int, int], ...] = (
    ("lose", 1, 3), ("lose", 2, 1), ("lose", 3, 2),
    ("win", 1, 2), ("win", 2, 3), ("win", 3, 1),
)


def required_move(needed: Column, theirs: Column) -> Column:
    """Move value that yields ``needed`` against ``theirs``; 0 when the table has no entry."""
    rules = [(needed == "draw", theirs)]
    rules += [((needed == result) & (theirs == opp), move) for result, opp, move in REQUIRED_MOVE]
    return decision_table(rules, default=0)
