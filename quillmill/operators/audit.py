"""Audits of extraction and cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.arrays import reasons


def preservation(raw: Column, cleaned: Column, sectioned: Column) -> Column:
    """CRITICAL, WARNING, SOURCE_SHORT or OK from what is left of the source."""
    kept = F.when(raw > 0, cleaned / raw).otherwise(0.0)
    part = F.when(cleaned > 0, sectioned / cleaned)
    return F.when((kept < 0.35) | (part < 0.35), "CRITICAL").when((kept < 0.6) | (part < 0.6), "WARNING").when(raw < 3000, "SOURCE_SHORT").otherwise("OK")


def preservation_reasons(raw: Column, cleaned: Column, sectioned: Column) -> Column:
    """Every reason against what cleaning and sectioning kept; :func:`preservation` is the gravest of them."""
    kept = F.when(raw > 0, cleaned / raw).otherwise(0.0)
    part = F.when(cleaned > 0, sectioned / cleaned)
    return reasons(
        ("SOURCE_TEXT_SHORT", raw < 3000), ("CRITICAL_CLEANED_LOSS", kept < 0.35), ("WARNING_CLEANED_LOSS", (kept >= 0.35) & (kept < 0.6)),
        ("CRITICAL_SECTION_LOSS", part < 0.35), ("WARNING_SECTION_LOSS", (part >= 0.35) & (part < 0.6)),
    )


def gravest(reason_list: Column) -> Column:
    """CRITICAL, WARNING, SOURCE_SHORT or OK by the prefixes of the reasons."""
    has = lambda p: F.exists(reason_list, lambda x: x.startswith(p))
    return F.when(has("CRITICAL"), "CRITICAL").when(has("WARNING"), "WARNING").when(has("SOURCE"), "SOURCE_SHORT").otherwise("OK")


def recovered_status(chars: Column) -> Column:
    """What recognition brought back: RECOVERED, PARTIAL or STILL_LOW."""
    return F.when(chars >= 3000, "RECOVERED").when(chars >= 1000, "PARTIAL").otherwise("STILL_LOW")


def removed_blocks(before: Column, after: Column, least: int = 300) -> Column:
    """Array of ``start, size, text`` of the stretches of ``before`` that ``after`` lacks, the largest first; on Arrow batches, for one document at a time.

    Texts are compared line by line, so the work is that of their lines, not of their letters.
    """
    import pandas as pd
    from pyspark.sql import types as T
    from pyspark.sql.functions import pandas_udf

    block = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("text", T.StringType())])

    @pandas_udf(T.ArrayType(block))
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        def one(x, y):
            if x is None or y is None:
                return None
            mine, other = x.splitlines(keepends=True), y.splitlines(keepends=True)
            at = [0]
            for line in mine:
                at.append(at[-1] + len(line))
            gone = [(at[i], at[j] - at[i], x[at[i] : at[j]]) for op, i, j, _, _ in SequenceMatcher(None, mine, other, autojunk=False).get_opcodes() if op in ("delete", "replace")]
            return sorted((g for g in gone if g[1] >= least), key=lambda g: (-g[1], g[0]))

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=object)

    return run(before, after)


def risk_signals(pages: Column, raw: Column, cleaned: Column, korean: Column, repeated: Column) -> Column:
    """What speaks against an extraction: ``raw`` characters extracted, ``cleaned`` ones kept, lines removed as repeated."""
    per, raw_per = cleaned / pages, F.coalesce(raw, F.lit(0)) / pages
    many = pages >= 5
    return reasons(
        ("VERY_LOW_TEXT", cleaned < 3000), ("VERY_LOW_PER_PAGE", many & (per < 250)), ("LOW_PER_PAGE", many & (per >= 250) & (per < 500)), ("LOW_RAW_PER_PAGE", many & (raw_per < 350)),
        ("REPEATED", repeated >= 80), ("VERY_SHORT", (raw >= 1000) & (raw < 3000)), ("LITTLE_KOREAN", korean < 0.05),
    )


def risk(signals: Column) -> Column:
    """OCR_CANDIDATE, REVIEW, CHECK or OK by the severe signals; the others are only reported."""
    n = F.size(F.array_intersect(signals, F.array(*map(F.lit, ("VERY_LOW_TEXT", "VERY_LOW_PER_PAGE", "LOW_RAW_PER_PAGE", "VERY_SHORT")))))
    return F.when(F.array_contains(signals, "VERY_LOW_PER_PAGE") & (n >= 2), "OCR_CANDIDATE").when(n >= 2, "REVIEW").when(n == 1, "CHECK").otherwise("OK")
