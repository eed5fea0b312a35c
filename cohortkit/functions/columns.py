"""Expressions for names, dates, bins and one-hot groups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortkit import domain


def normal_name(name: str) -> str:
    """Lower-case, trimmed, blanks to ``_``, no colons."""
    return re.sub(r"\s+", "_", name.lower().strip()).replace(":", "")


def quoted(name: str) -> Column:
    """A column whose name may hold dots or colons."""
    return F.col("`" + name.replace("`", "``") + "`")


def number(column: Column | str) -> Column:
    """Double, or null where the text is no number; NaN is null too."""
    value = F.col(column) if isinstance(column, str) else column
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def number_sql(name: str) -> str:
    """``number`` as SQL text, which is quicker to build for tables with very many columns."""
    safe = name.replace("`", "``")
    return f"nanvl(try_cast(`{safe}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def text_sql(text: str) -> str:
    """A string literal in SQL text, whatever characters it holds."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def registry_timestamp(column: Column | str) -> Column:
    """Parse ``YYYY-MM-DD`` (month and day may lack the zero); anything else is null."""
    text = F.col(column) if isinstance(column, str) else column
    shaped = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text)
    return F.try_to_timestamp(shaped, F.lit("yyyy-M-d"))


def family(feature: Column | str) -> Column:
    """Genotypic for SNP names, otherwise phenotypic."""
    name = F.col(feature) if isinstance(feature, str) else feature
    return F.when(name.startswith(domain.SNP_PREFIX), "Genotypic (SNP)").otherwise("Phenotypic")


def bin_code(column: Column | str, edges: Sequence[float]) -> Column:
    """0-based left-closed bin; the last bin has no upper end; below the first edge is null."""
    value = F.col(column) if isinstance(column, str) else column
    code = F.when(value >= edges[-1], len(edges) - 1)
    for i in range(len(edges) - 2, -1, -1):
        code = code.when(value >= edges[i], i)
    return F.when(~F.isnan(value), code)


def one_hot_code(columns: Sequence[str], first: int = 1, present: Sequence[str] | None = None) -> Column:
    """Code of a one-hot group; the last matching column wins; no match is null."""
    codes = [
        F.when(quoted(c) == 1, F.lit(i + first))
        for i, c in enumerate(columns)
        if present is None or c in present
    ]
    return F.coalesce(*reversed(codes)) if codes else F.lit(None).cast("int")


def bucket_of(value: Column | str, bounds: Column | str, size: int) -> Column:
    """How many of the ``size`` ascending ``bounds`` lie below ``value`` (binary search)."""
    value = F.col(value) if isinstance(value, str) else value
    bounds = F.col(bounds) if isinstance(bounds, str) else bounds
    steps = [1 << p for p in range(max(size, 1).bit_length() - 1, -1, -1)]

    def halve(found, step):
        return F.when(F.get(bounds, found + step - 1) < value, found + step).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; nulls do not count; 0 rather than null."""
    return F.count(F.when(condition, 1))
