"""Column functions on arrays; the order of first occurrence is kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import stripped


def distinct_ci(c: Column) -> Column:
    """Drops blanks and, without regard to case, repetitions; the first spelling stays."""
    clean = F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != "")
    lower = F.transform(clean, lambda x: F.lower(x))
    return F.filter(clean, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def union_ci(*cols: Column) -> Column:
    return distinct_ci(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in cols]))


def bigrams(c: Column) -> Column:
    """Distinct pairs of neighbouring characters; a single character stands for itself."""
    n = F.length(c)
    return F.when(n > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(c, i, F.lit(2))))).when(n == 1, F.array(c)).otherwise(F.array().cast("array<string>"))


def reasons(*pairs: tuple[str, Column]) -> Column:
    """Array of the names whose condition holds."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))


def split_people(c: Column) -> Column:
    """Names from one text with separators, without repetitions."""
    return F.array_distinct(F.filter(F.transform(F.split(c, r"[,;|·]"), stripped), lambda x: x != ""))
