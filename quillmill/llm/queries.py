"""The queries of problems 1 to 10, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import authors, bpe, canonical, leaks, overlaps, publications, scans, splits, subjects, survivors
from quillmill.session import ship_package, table

Query = Callable[[SparkSession, str], DataFrame]


def _on(*names: str):
    def deco(f) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(*[table(spark, sf_dir, n) for n in names])

        return run

    return deco


@_on("papers_verified")
def p1_groups(papers):
    return publications.groups(papers)


@_on("documents")
def p8_roundtrip(docs):
    ids = bpe.encoded(docs)
    back = ids.select("doc_id", F.size("ids").alias("n"), bpe.decoded(F.col("ids")).alias("back"))
    same = back.join(docs.select("doc_id", "text"), "doc_id").withColumn("same", F.col("back").eqNullSafe(F.col("text")))
    return same.groupBy("same").agg(F.count("*").alias("docs"), F.sum(F.greatest("n", F.lit(0))).alias("tokens"))


@_on("papers_verified", "author_registry")
def p7_assignment(papers, registry):
    return splits.assign(splits.connected(papers, registry))


@_on("paper_split")
def p7_ledger(split):
    return splits.current(split)


def queries() -> dict[str, Query]:
    return {
        "p1_found": _on("papers_verified")(publications.found),
        "p1_groups": p1_groups,
        "p2_found": _on("paper_sections", "papers_verified")(scans.noise),
        "p2_repaired": _on("paper_sections", "papers_verified")(scans.repaired),
        "p3_found": _on("papers_verified")(canonical.found),
        "p3_canonical": _on("papers_verified")(canonical.canonical_fields),
        "p4_found": _on("papers_verified", "author_registry")(authors.found),
        "p4_entities": _on("papers_verified", "author_registry")(authors.resolve),
        "p5_found": _on("paper_sections", "paper_split")(overlaps.found),
        "p5_report": _on("paper_sections", "paper_split")(overlaps.report),
        "p6_found": _on("papers_verified")(survivors.found),
        "p6_survivors": _on("papers_verified")(survivors.survivors),
        "p6_consensus": _on("papers_verified")(survivors.nearest),
        "p7_found": _on("papers_verified", "paper_split", "author_registry")(splits.found),
        "p7_assignment": p7_assignment,
        "p7_ledger": p7_ledger,
        "p8_ids": _on("documents")(bpe.encoded),
        "p8_roundtrip": p8_roundtrip,
        "p8_token_counts": _on("documents")(bpe.token_counts),
        "p9_found": _on("documents", "eval_items")(leaks.leaks),
        "p9_report": _on("documents", "eval_items")(leaks.leak_report),
        "p10_found": _on("documents", "subject_labels", "subject_areas")(subjects.found),
        "p10_composition": _on("documents", "subject_labels", "subject_areas")(subjects.composition),
    }


SQL = {
    "p7_ledger": """
        WITH last AS (SELECT paper_id, split FROM (
            SELECT paper_id, split, row_number() OVER (PARTITION BY paper_id ORDER BY _ord DESC) AS r
            FROM paper_split WHERE paper_id IS NOT NULL) t WHERE r = 1)
        SELECT paper_id, CASE
            WHEN regexp_matches(lower(trim(split)), '^tr(ai?n(ing)?)?$') THEN 'train'
            WHEN regexp_matches(lower(trim(split)), '^(val(id(ation)?)?|dev)$') THEN 'validation'
            WHEN regexp_matches(lower(trim(split)), '^test(ing)?$|^eval(uation)?$') THEN 'test' END AS split
        FROM last""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
