"""Merging, correcting and checking of metadata records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.arrays import reasons
from quillmill.functions.text import first_nonempty, nonempty

DOC_TYPES = {"article": "journal_article", "paper": "journal_article", "phd_thesis": "doctoral_thesis", "dissertation": "doctoral_thesis", "masters_thesis": "master_thesis", "research_report": "report"}


def confidence(c: Column) -> Column:
    """HIGH, MEDIUM or LOW; a prefix of the source is dropped, anything else is LOW."""
    t = F.regexp_replace(F.upper(F.trim(c)), "^AI_", "")
    return F.when(t.isin("HIGH", "MEDIUM", "LOW"), t).otherwise("LOW")


def doc_type(c: Column, aliases: dict[str, str] = DOC_TYPES) -> Column:
    t = F.lower(F.trim(c))
    out = F.coalesce(nonempty(t), F.lit("unknown"))
    for a, b in aliases.items():
        out = F.when(t == a, b).otherwise(out)
    return out


def precedence_merge(base: DataFrame, sources: list[tuple[str, DataFrame]], key: str, fields: list[str]) -> DataFrame:
    """Each field from the first of base and sources that has it; ``merged_from`` names the first source with the key."""
    out, seen = base, []
    for name, src in sources:
        renamed = src.select(key, *[F.col(f).alias(f"{f}__{name}") for f in fields], F.lit(True).alias(f"has__{name}"))
        out = out.join(renamed, key, "left")
        seen.append(name)
    cols = [c for c in base.columns if c not in fields]
    merged = [first_nonempty(F.col(f), *[F.col(f"{f}__{n}") for n in seen]).alias(f) for f in fields]
    origin = F.coalesce(*[F.when(F.col(f"has__{n}"), F.lit(n)) for n in seen], F.lit("UNRESOLVED")).alias("merged_from")
    return out.select(*cols, *merged, origin)


def corrected(df: DataFrame, fixes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Values of ``fixes`` in place of the table's, where it has the key and a value."""
    f = fixes.select(key, *[F.col(x).alias(f"{x}__fix") for x in fields])
    j = df.join(f, key, "left")
    return j.select(*[F.coalesce(F.col(f"{c}__fix"), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def upsert(df: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return df.join(new.select(key), key, "left_anti").unionByName(new)


def canonical_record(base: DataFrame, found: DataFrame, key: str = "paper_id", source: str = "VERIFIED") -> DataFrame:
    """One clean record a row of ``base``: each field from ``found`` where it has a value, else from ``base``, in the record's form."""
    from quillmill.functions import text
    from quillmill.functions.arrays import distinct_ci

    fields = ["title", "authors", "year", "journal", "institution", "department", "document_type", "doi"]
    m = found.select(key, *[F.col(f).alias(f"{f}__f") for f in fields], F.col("metadata_confidence").alias("c__f"), F.col("evidence").alias("e__f"))
    d = base.join(m, key, "left")
    pick = lambda f: text.first_nonempty(F.col(f"{f}__f"), F.col(f))
    authors = F.when(F.size(distinct_ci(F.col("authors__f"))) > 0, F.col("authors__f")).otherwise(F.col("authors"))
    year = text.year_found(F.coalesce(F.col("year__f"), F.col("year")).cast("string"))
    clean = lambda c: text.null_words(text.squeeze(c))
    return d.select(
        key, text.polish_title(pick("title")).alias("title"), distinct_ci(authors).alias("authors"), year.alias("year"),
        *[clean(pick(f)).alias(f) for f in ("journal", "institution", "department")],
        doc_type(pick("document_type")).alias("document_type"), text.doi_normal(pick("doi")).alias("doi"), clean(F.col("kci_id")).alias("kci_id"),
        "source_filename", "text_file", "sha256", "page_count", "text_chars",
        confidence(F.col("c__f")).alias("metadata_confidence"), F.lit(source).alias("metadata_source"), clean(F.col("e__f")).alias("evidence"),
    )


def source_of(*candidates: tuple[str, Column]) -> Column:
    """Struct ``source, value`` of the first candidate that is there and not blank; NULLs if none is."""
    out = F.struct(F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("value"))
    for name, c in reversed(candidates):
        out = F.when(nonempty(c).isNotNull(), F.struct(F.lit(name).alias("source"), c.alias("value"))).otherwise(out)
    return out


def matched(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows of both sides joined, keys the right side lacks, keys the left side lacks)."""
    a, b = left.select(key).where(F.col(key).isNotNull()).distinct(), right.select(key).where(F.col(key).isNotNull()).distinct()
    return left.join(right, key), a.join(b, key, "left_anti"), b.join(a, key, "left_anti")


def review_reasons() -> Column:
    return reasons(("TITLE_MISSING", nonempty(F.col("title")).isNull()), ("AUTHORS_MISSING", F.coalesce(F.size("authors"), F.lit(0)) <= 0), ("YEAR_MISSING", F.col("year").isNull()), ("DOC_TYPE_UNKNOWN", F.coalesce(F.col("document_type"), F.lit("unknown")) == "unknown"), ("LOW_CONFIDENCE", confidence(F.col("metadata_confidence")) == "LOW"))


def eligible_reasons(types=("journal_article", "master_thesis", "doctoral_thesis"), least_chars: int = 3000) -> Column:
    """All reasons against a record; an empty array admits it."""
    return reasons(("TYPE", ~F.coalesce(F.col("document_type"), F.lit("unknown")).isin(*types)), ("SHORT", F.coalesce(F.col("text_chars"), F.lit(0)) < least_chars), ("NO_TITLE", nonempty(F.col("title")).isNull()))
