"""Positional and delimited parsing of string columns.

Everything here is a Column expression, so it runs inside whole-stage codegen
and works the same on batch and streaming frames.  Out-of-range positions and
malformed numbers give null instead of raising (ANSI mode is on in Spark 4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chars(c: Column | str) -> Column:
    """The characters of a string as ``array<string>``; ``''`` gives ``['']``."""
    return F.split(_c(c), "")


def keep_chars(c: Column | str, char_class: str) -> Column:
    """Remove every character outside ``char_class`` (a regex class body, e.g. ``A-Za-z``)."""
    return F.regexp_replace(_c(c), f"[^{char_class}]", "")


def char_at(c: Column | str, pos: int) -> Column:
    """Character at 0-based ``pos``; null when the string is shorter."""
    return F.get(chars(c), pos)


def chars_at(c: Column | str, positions: Sequence[int], prefix: str = "c") -> list[Column]:
    """One column per position, named ``{prefix}{pos}``."""
    arr = chars(c)
    return [F.get(arr, p).alias(f"{prefix}{p}") for p in positions]


def fixed_width(df: DataFrame, c: str, positions: Sequence[int], *, prefix: str = "list",
                keep: Sequence[str] = ()) -> DataFrame:
    """Fixed-position layout to columns in one projection (``list1, list5, ...``)."""
    return df.select(*[F.col(k) for k in keep], *chars_at(c, positions, prefix))


def split_half(c: Column | str) -> tuple[Column, Column]:
    """First and second half of a string; an odd middle character goes to the second half."""
    s = _c(c)
    half = (F.length(s) / 2).cast("int")
    return F.substring(s, F.lit(1), half), F.substr(s, half + 1)


def delimited_ints(c: Column | str, separators: str = "[-,]") -> Column:
    """``'2-4,6-8'`` -> ``[2, 4, 6, 8]``; a piece that is not an integer gives null."""
    pieces = F.split(_c(c), separators)
    return F.transform(pieces, lambda x: F.trim(x).try_cast("int"))


def ints_at(arr: Column | str, n: int, prefix: str = "val") -> list[Column]:
    """The first ``n`` items as ``{prefix}1 .. {prefix}n`` (null past the end)."""
    a = _c(arr)
    return [F.get(a, i).alias(f"{prefix}{i + 1}") for i in range(n)]


def to_int(c: Column | str) -> Column:
    """Integer from text; blank or malformed text gives null."""
    return F.trim(_c(c)).try_cast("int")
