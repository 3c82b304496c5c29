"""Repeated lines of documents, counted over many rows of a document; see ``functions.cleaning`` for what is done inside one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lines_of(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"\r\n?|[\u2028\u2029\u0085]", "\n"), "\n")


def squeezed(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[ \t\u00a0]+", " "))


def repeated_lines(df: DataFrame, key: str, text: str, least: int = 4, longest: int = 80) -> DataFrame:
    """Short lines that a document repeats: ``key, line, n``."""
    t = df.where(F.col(text).isNotNull()).select(key, F.explode(lines_of(F.col(text))).alias("raw"))
    t = t.select(key, squeezed(F.col("raw")).alias("line")).where(f"line <> '' and length(line) <= {longest}")
    return t.groupBy(key, "line").agg(F.count("*").alias("n")).where(f"n >= {least}")


def removed_lines(df: DataFrame, key: str, text: str, least: int = 4, longest: int = 80) -> DataFrame:
    """Per document ``key, repeated, chars, solid, hangul``: lines that cleaning removes (short repeated ones, page numbers) and what they held."""
    t = df.where(F.col(text).isNotNull()).select(key, F.explode(lines_of(F.col(text))).alias("raw"))
    t = t.select(key, squeezed(F.col("raw")).alias("line"), F.length("raw").alias("size")).where(f"line <> '' and length(line) <= {longest}")
    t = t.groupBy(key, "line").agg(F.count("*").alias("n"), F.sum(F.col("size") + 1).alias("chars"))
    t = t.where((F.col("n") >= least) | F.col("line").rlike("^-? ?[0-9]{1,4} ?-?$"))
    solid = F.regexp_replace("line", " ", "")
    hangul = F.length(F.regexp_replace(solid, "[^가-힣]", ""))
    return t.groupBy(key).agg(F.sum("n").alias("repeated"), F.sum("chars").alias("chars"), F.sum(F.col("n") * F.length(solid)).alias("solid"), F.sum(F.col("n") * hangul).alias("hangul"))


def quality_status(chars: Column, found: Column, ratio: Column) -> Column:
    return F.when(chars < 1000, "LOW_TEXT").when(chars < 3000, "VERY_SHORT").when(found == 0, "SECTION_FAILED").when(found < 2, "LOW_SECTION_DETECTION").when(ratio < 0.35, "REVIEW").otherwise("OK")
