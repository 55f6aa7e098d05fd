"""Small building blocks of the name functions: folds of patterns, trimming, title case."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(c: Column, rules: Iterable[tuple[str, str]], flags: str = "(?U)") -> Column:
    """All replacements in order; null stays null. One chain of built-in expressions, no Python."""
    return functools.reduce(lambda x, r: F.regexp_replace(x, flags + r[0], r[1]), rules, c)


def title(c: Column | str) -> Column:
    """A capital after everything that is no letter, the rest small (``o'neil 2nd`` gives ``O'Neil 2Nd``)."""
    return F.array_join(F.transform(F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(0)), F.initcap), "")


def words(c: Column | str) -> Column:
    """The words between blanks; an empty or null text has none (an empty array)."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), r"(?U)\s+"), lambda w: w != "")


def squeeze(c: Column | str) -> Column:
    return F.array_join(words(c), " ")
