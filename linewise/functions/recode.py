"""Dictionary recoding with a literal map.

A small dictionary becomes a map literal inside the plan (constant-folded, no
join).  For a dictionary that is itself a table see
``linewise.operators.lookup.recode_join``.
"""

from __future__ import annotations

import string
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letter weights a..z -> 1..26, A..Z -> 27..52.
LETTER_WEIGHTS: dict[str, int] = dict(zip(string.ascii_letters, range(1, 53)))


def map_literal(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode(c: Column | str, mapping: Mapping, default=None) -> Column:
    """``mapping[c]``; a missing or null key gives ``default`` (null if none)."""
    key = F.col(c) if isinstance(c, str) else c
    value = map_literal(mapping)[key]
    return value if default is None else F.coalesce(value, F.lit(default))


def letter_weight(c: Column | str) -> Column:
    """Weight of a single letter (see ``LETTER_WEIGHTS``); anything else is null."""
    return recode(c, LETTER_WEIGHTS)
