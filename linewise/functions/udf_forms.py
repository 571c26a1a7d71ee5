"""User-extension forms of two rule tables, as Arrow-batched pandas UDFs.

The native Column forms (``rules.required_move``, ``intervals.overlap_label``)
are what the library uses; these exist so a user can plug in Python logic and
check it against the native form.  They are vectorised over a whole Arrow
batch, never called per row, and return null where no rule decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from linewise.functions.rules import REQUIRED_MOVE


@F.pandas_udf(IntegerType())
def required_move_udf(needed: pd.Series, theirs: pd.Series) -> pd.Series:
    """Table lookup per batch; like the CASE form, 0 where the table has no entry."""
    table = {(result, opp): move for result, opp, move in REQUIRED_MOVE}
    keys = pd.MultiIndex.from_arrays([needed, theirs])
    looked_up = pd.Series(pd.Series(table).reindex(keys).to_numpy(), index=needed.index, dtype="float64")
    out = looked_up.fillna(0).where(needed != "draw", theirs)
    # A result outside draw / win / lose (including null) scores 0.
    other = ~needed.isin(["draw", "win", "lose"])
    out[other] = 0
    return out.astype("Int32")


@F.pandas_udf(StringType())
def overlap_label_udf(v1: pd.Series, v2: pd.Series, v3: pd.Series, v4: pd.Series) -> pd.Series:
    known = v1.notna() & v2.notna() & v3.notna() & v4.notna()
    disjoint = (v3 > v2) | (v4 < v1)
    out = pd.Series(np.where(disjoint, "disjoint", "overlap"), index=v1.index, dtype="object")
    out[~known] = None
    return out
