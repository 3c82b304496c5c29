"""Binary documents and whole texts; extraction itself is a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Gives the page texts of one binary document.
Extractor = Callable[[bytes], list[str]]


def plain_pages(content: bytes) -> list[str]:
    """Stand-in where no PDF library is installed: form feeds part the pages of a text file."""
    return content.decode("utf-8", "replace").split("\f")


def documents(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """``name, sha256, size, content`` of the files of a folder."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return b.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), "content")


def listing(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """``name, sha256, size`` of the files of a folder, sorted by name, case aside."""
    return documents(spark, folder, pattern).drop("content").orderBy(F.lower("name"), "name")


def write_texts(df: DataFrame, folder: str, key: str, text: str, suffix: str = ".txt") -> None:
    """One file a row, named by its key, written by the tasks into a folder that all machines share."""
    jconf = folder.removeprefix("file://")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.makedirs(jconf, exist_ok=True)
        for b in batches:
            for k, t in zip(b.key, b.text):
                at = os.path.join(jconf, f"{k}{suffix}")
                with open(at + ".part", "w", encoding="utf-8", newline="") as f:
                    f.write(t)
                os.replace(at + ".part", at)  # a repeated task writes the same file again
            yield b[["key"]].iloc[:0]

    df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(run, "key string").count()


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``key, text`` of the text files of a folder; bytes that are no UTF-8 are replaced."""
    d = documents(spark, folder, pattern)
    return d.select(F.regexp_replace("name", r"\.[^.]+$", "").alias("key"), F.decode("content", "utf-8").alias("text"))


def pages(docs: DataFrame, extract: Extractor = plain_pages, most: int | None = None) -> DataFrame:
    """``name, page, text, status, error``: OK, or OPEN_ERROR with the message and no text; at most ``most`` pages of each where given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name, content in zip(b.name, b.content):
                try:
                    out.extend((name, i, t, "OK", None) for i, t in enumerate(extract(bytes(content))[:most], 1))
                except Exception as e:
                    out.append((name, 0, None, "OPEN_ERROR", repr(e)))
            yield pd.DataFrame(out, columns=["name", "page", "text", "status", "error"])

    return docs.select("name", "content").mapInPandas(run, "name string, page int, text string, status string, error string")


def recovered(page_table: DataFrame, recognise: Callable[[str, int], str], least: int = 150, all_pages: bool = False) -> DataFrame:
    """Pages whose text is short are recognised anew; the longer text stays. Only such pages reach the plug-in, or all if asked.

    ``mode``: DIRECT, OCR or OCR_FAILED, then with the ``error``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            new, how, why = [], [], []
            for name, page, text in zip(b.name, b.page, b.text):
                error = None
                try:
                    got = recognise(name, int(page))
                    mode = "OCR" if len(got) > len(text or "") else "DIRECT"
                    text = got if mode == "OCR" else text
                except Exception as e:
                    mode, error = "OCR_FAILED", repr(e)
                new.append(text)
                how.append(mode)
                why.append(error)
            yield b.assign(text=new, mode=how, error=why)

    short = F.lit(True) if all_pages else F.coalesce(F.length("text"), F.lit(0)) < least
    schema = "name string, page int, text string, mode string, error string"
    redone = page_table.where(short).select("name", "page", "text").mapInPandas(run, schema)
    return page_table.where(~short).select("name", "page", "text", F.lit("DIRECT").alias("mode"), F.lit(None).cast("string").alias("error")).unionByName(redone)


def enriched(df: DataFrame, enrich: Callable[[dict], dict], done: DataFrame, key: str, schema: str, retries: int = 3, wait: float = 2.0) -> DataFrame:
    """Rows that are not yet in ``done``, passed through a plug-in (a language model, a service), each tried ``retries`` times.

    The columns of ``schema`` and ``error``: NULL, or the last message of a row that failed;
    only rows without an error belong into ``done``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                error = None
                for attempt in range(1, retries + 1):
                    try:
                        rows.append({key: r[key], "error": None} | enrich(r))
                        break
                    except Exception as e:
                        error = repr(e)
                        time.sleep(wait * attempt * (attempt < retries))
                else:
                    rows.append({key: r[key], "error": error})
            yield pd.DataFrame(rows, columns=names)

    names = [*T._parse_datatype_string(schema).fieldNames(), "error"]
    return df.join(done.select(key), key, "left_anti").mapInPandas(run, schema + ", error string")
