"""The harvest: a feed read page by page with resumption tokens, in parallel over date ranges, with repeated requests.

The feed is a protocol: over the network it is an HTTP client, offline a folder.  Each
date range is one task, which follows its tokens to the end; a failed request is
repeated with growing pauses, and a task that fails is run again by Spark, so a range
comes out whole or not at all.
"""

from __future__ import annotations

import time
import urllib.parse
import urllib.request
from collections.abc import Iterator
from typing import Protocol
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.sources.oai import local


class Feed(Protocol):
    """``ranges``: what is harvested in parallel; ``page``: the records of one page and the token of the next, or None."""

    def ranges(self) -> list[str]: ...

    def page(self, within: str, token: str | None) -> tuple[list[str], str | None]: ...


class HarvestError(RuntimeError):
    """An error that the feed itself reports; asking again doesn't help."""


class HttpFeed:
    """OAI-PMH over HTTP.  ``ranges`` are pairs ``from/until``; the format must be one that the feed lists."""

    def __init__(self, url: str, prefix: str, ranges: list[str], timeout: float = 90.0) -> None:
        self.url, self.prefix, self._ranges, self.timeout = url, prefix, ranges, timeout

    def ranges(self) -> list[str]:
        return self._ranges

    def _ask(self, **params: str) -> ElementTree.Element:
        with urllib.request.urlopen(f"{self.url}?{urllib.parse.urlencode(params)}", timeout=self.timeout) as r:
            return answered(r.read())

    def formats(self) -> list[str]:
        return [e.text or "" for e in self._ask(verb="ListMetadataFormats").iter() if local(e.tag) == "metadataPrefix"]

    def check(self) -> None:
        if self.prefix not in (known := self.formats()):
            raise HarvestError(f"the feed has no format {self.prefix}, but {known}")

    def page(self, within: str, token: str | None) -> tuple[list[str], str | None]:
        begin, _, end = within.partition("/")
        asked = {"resumptionToken": token} if token else {"metadataPrefix": self.prefix, "from": begin, "until": end}
        return records_of(self._ask(verb="ListRecords", **asked))


def answered(body: bytes) -> ElementTree.Element:
    """The root of an answer; raises if it is an error of the protocol."""
    root = ElementTree.fromstring(body)
    for e in root.iter():
        if local(e.tag) == "error" and e.attrib.get("code") != "noRecordsMatch":
            raise HarvestError(f"{e.attrib.get('code')}: {e.text}")
    return root


def records_of(root: ElementTree.Element) -> tuple[list[str], str | None]:
    rows = [ElementTree.tostring(e, encoding="unicode") for e in root.iter() if local(e.tag) == "record"]
    token = next((e.text for e in root.iter() if local(e.tag) == "resumptionToken"), None)
    return rows, (token or "").strip() or None


class FolderFeed:
    """A feed kept as Parquet files of ``within, page, xml`` (see :func:`write_feed`); every ``fails_every``-th request fails once, for tests.

    A request reads only the row groups that may hold its page, which their statistics tell.
    """

    def __init__(self, folder: str, fails_every: int = 0) -> None:
        self.folder, self.fails_every, self.asked = folder.removeprefix("file://"), fails_every, 0
        self._groups: list[tuple] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_groups": None}

    def _index(self) -> list[tuple]:
        """``(least within, most, least page, most, file, row group)`` of all row groups; without bounds where a file has none."""
        if self._groups is None:
            import pyarrow.dataset as ds

            self._groups = []
            for f in ds.dataset(self.folder, format="parquet", exclude_invalid_files=True).get_fragments():
                for g in f.row_groups:
                    w, p = (g.statistics or {}).get("within"), (g.statistics or {}).get("page")
                    self._groups.append((w and w["min"], w and w["max"], p and p["min"], p and p["max"], f, g.id))
        return self._groups

    def ranges(self) -> list[str]:
        out: set[str] = set()
        for w0, w1, _, _, f, g in self._index():
            out |= {w0} if w0 is not None and w0 == w1 else set(f.subset(row_group_ids=[g]).to_table(columns=["within"]).column(0).to_pylist())
        return sorted(out)

    def page(self, within: str, token: str | None) -> tuple[list[str], str | None]:
        import pyarrow.dataset as ds

        self.asked += 1
        if self.fails_every and self.asked % self.fails_every == 0:
            raise OSError("no answer")
        n = int(token or 0)
        rows: list[str] = []
        for w0, w1, p0, p1, f, g in self._index():
            if (w0 is None or w0 <= within <= w1) and (p0 is None or p0 <= n <= p1):
                rows += f.subset(row_group_ids=[g]).to_table(columns=["xml"], filter=(ds.field("within") == within) & (ds.field("page") == n)).column("xml").to_pylist()
        return rows, str(n + 1) if rows else None


def write_feed(pages: DataFrame, folder: str) -> None:
    """Writes the table of :func:`paged` sorted, neighbours together, and in small row groups, so that a page is read without the rest."""
    from quillmill.session import spread

    spread(pages, "within", F.floor(F.col("page") / 16)).sortWithinPartitions("within", "page").write.option("compression", "zstd").option("parquet.block.size", 1 << 18).option("parquet.block.size.row.check.max", 500).parquet(folder)
    pages.sparkSession._jvm.System.gc()  # for the files that were shuffled


def patient(ask, retries: int, wait: float):
    """The answer of ``ask``, repeated after pauses of ``wait``, ``2 * wait`` ... seconds; errors of the protocol are not repeated."""
    for attempt in range(1, retries + 1):
        try:
            return ask()
        except HarvestError:
            raise
        except Exception:
            if attempt == retries:
                raise
            time.sleep(wait * attempt)


def harvested(spark: SparkSession, feed: Feed, retries: int = 5, wait: float = 2.0) -> DataFrame:
    """``within, page, xml`` of all records of a feed; each range is one task."""
    ranges = feed.ranges()
    schema = T.StructType([T.StructField("within", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("xml", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for within in b.within:
                token, n = None, 0
                while True:
                    rows, token = patient(lambda: feed.page(within, token), retries, wait)  # noqa: B023
                    if rows:
                        yield pd.DataFrame({"within": within, "page": n, "xml": rows})
                    n += 1
                    if token is None:
                        break

    todo = spark.createDataFrame([(r,) for r in ranges], "within string").repartition(max(1, len(ranges)), "within")
    return todo.mapInPandas(run, schema)


def paged(records: DataFrame, starts: list[str], size: int) -> DataFrame:
    """``within, page, xml`` from ``xml, datestamp``: ranges by date and about ``size`` records a page, as :class:`FolderFeed` serves them."""
    within = F.lit(starts[0])
    for s in starts[1:]:
        within = F.when(F.coalesce("datestamp", F.lit("")) >= s, s).otherwise(within)
    d = records.withColumn("within", within)
    n = d.groupBy("within").agg(F.ceil(F.count("*") / size).cast("int").alias("pages"))
    return d.join(F.broadcast(n), "within").select("within", F.pmod(F.xxhash64("xml"), F.col("pages")).cast("int").alias("page"), "xml")
