"""JSON and CSV sources and sinks with the failure modes of a curation pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, malformed: str = "fail", missing: str = "fail") -> DataFrame:
    """One object a line.  ``malformed``: ``fail``, ``drop`` or ``keep`` (in ``_corrupt_record``); ``missing``: ``fail`` or ``empty``."""
    if missing == "empty" and not exists(spark, path):
        return spark.createDataFrame([], schema)
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}[malformed]
    if malformed == "keep" and "_corrupt_record" not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("mode", mode).json(path)


def line_errors(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Counts of scanned, blank and malformed lines."""
    t = spark.read.text(path).withColumn("j", F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return t.agg(F.count("*").alias("scanned"), F.count_if(F.trim("value") == "").alias("blank"), F.count_if((F.trim("value") != "") & F.col("j._bad").isNotNull()).alias("malformed"))


def bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file, line, value`` of malformed lines, blank ones aside; lines are counted from 1 within their file."""
    parsed = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("n", "value"))
    t = t.where(F.trim("value") != "").withColumn("j", F.from_json("value", parsed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return t.where("j._bad is not null").select("file", (F.col("n") + 1).alias("line"), "value")


def read_json(spark: SparkSession, path: str, schema: T.StructType, wrappers=("records", "items", "papers", "results", "data")) -> DataFrame:
    """Records of whole JSON documents: an array of them, an object that holds the array under a wrapper's name, or a single one."""
    inner = T.ArrayType(schema)
    t = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    one = F.from_json("value", T.StructType([*[T.StructField(w, inner) for w in wrappers if w not in schema.fieldNames()], *schema.fields]))
    held = F.coalesce(F.when(F.ltrim("value").startswith("["), F.from_json("value", inner)), *[one[w] for w in wrappers if w not in schema.fieldNames()], F.array(F.from_json("value", schema)))
    return t.select(F.explode(held).alias("r")).select("r.*")


def write_json_array(df: DataFrame, path: str, most: int) -> None:
    """All rows as one JSON array in one document; raises if there are more than ``most``, as one document must fit one task."""
    n = df.limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} rows for one JSON document")
    df.agg(F.to_json(F.collect_list(F.struct(*df.columns)), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def flatten_records(df: DataFrame, wrappers=("records", "items", "papers", "results", "data")) -> DataFrame:
    """Rows from the first array column with a wrapper's name, else the rows themselves."""
    arrays = {f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    for w in wrappers:
        if w in arrays:
            return df.select(F.explode(w).alias("r")).select("r.*")
    return df


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; a byte order mark before it is dropped."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_csv(df: DataFrame, path: str, columns: list[str], separator: str = " | ", mark: str = "\ufeff") -> None:
    """Given columns in order, a byte order mark before the first name; arrays are joined into one field."""
    kinds = dict(df.dtypes)
    out = [(F.array_join(c, separator) if kinds[c].startswith("array") else F.col(c)).alias(mark * (i == 0) + c) for i, c in enumerate(columns)]
    df.select(*out).write.mode("overwrite").option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def write_documents(df: DataFrame, path: str, key: str, buckets: int = 256) -> None:
    """One JSON document a key, in a bounded number of folders by the key's hash; fetch one with :func:`read_documents` and a filter on ``bucket_``."""
    df.withColumn("bucket_", bucket(F.col(key), buckets)).repartition(buckets, "bucket_").write.mode("overwrite").partitionBy("bucket_").json(path)


def bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema + ", bucket_ int").json(path)


def overwrite_with_backup(df: DataFrame, path: str) -> str:
    """Moves what stands at ``path`` aside, writes ``df`` there, and returns where the old table is now."""
    import time

    spark = df.sparkSession
    kept = f"{path.rstrip('/')}.backup-{time.time_ns()}"
    rows = f"{path.rstrip('/')}.new-{time.time_ns()}"
    df.write.json(rows)
    hp = spark._jvm.org.apache.hadoop.fs.Path
    fs = hp(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hp(path)) and not fs.rename(hp(path), hp(kept)):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(hp(rows), hp(path)):
        raise OSError(f"could not put the new table to {path}")
    return kept


def write_snapshot(df: DataFrame, path: str, order: list) -> None:
    """A sorted snapshot in JSON and CSV, replaced as a whole."""
    df = df.sort(*order)
    df.write.mode("overwrite").json(f"{path}/json")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/json")


def side_split(df: DataFrame, review) -> tuple[DataFrame, DataFrame]:
    """(main, review): rows whose condition is not true, and the rest."""
    r = F.coalesce(review, F.lit(False))
    return df.where(~r), df.where(r)
