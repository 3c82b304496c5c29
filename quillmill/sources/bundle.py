"""Hand-off of results: summaries as documents, and a bundle of tables with a manifest."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("quillmill")


def write_summary(df: DataFrame, folder: str, name: str) -> None:
    """A one-row table as one JSON document."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}.json")


def read_summary(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{folder}/{name}.json")


def write_bundle(spark: SparkSession, folder: str, parts: dict[str, DataFrame | None], readme: str) -> DataFrame:
    """Writes each part below ``folder`` with a README and a manifest ``part, rows, state``, which is returned; missing parts are noted and warned of."""
    rows = []
    for name, df in parts.items():
        if df is None:
            log.warning("part %s is missing", name)
            rows.append((name, None, "MISSING"))
            continue
        at = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(at)
        rows.append((name, spark.read.parquet(at).count(), "OK"))
        log.info("part %s written", name)
    manifest = spark.createDataFrame(rows, "part string, rows long, state string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    spark.createDataFrame([(readme,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/README")
    return manifest.select("part", F.col("rows"), "state")
