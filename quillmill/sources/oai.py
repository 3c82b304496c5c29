"""Harvested records: XML of the harvest protocol, and a resumable page source."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Columns of a record; the two lists are arrays.
HEADER = ("identifier", "datestamp", "set_spec", "deleted", "metadata_type")
BODY = ("article_id", "title", "title_en", "abstract", "abstract_en", "category", "journal", "publisher", "publication_year", "publication_date", "language", "uci", "doi", "citation_count", "open_access", "format", "landing_url")
LISTS = ("authors", "keywords")
RECORD = T.StructType([*[T.StructField(n, T.StringType()) for n in (*HEADER, *BODY)], *[T.StructField(n, T.ArrayType(T.StringType())) for n in LISTS]])
# Elements of the two formats whose last text is a column's value.
KCI = {
    "article-id": "article_id", "article-categories": "category", "journal-name": "journal", "publisher-name": "publisher", "pub-year": "publication_year", "pub-date": "publication_date",
    "language": "language", "uci": "uci", "doi": "doi", "citation-count": "citation_count", "orte-open-yn": "open_access", "open-access": "open_access", "format": "format",
}
DC = {"publisher": "publisher", "date": "publication_date", "format": "format", "language": "language", "rights": "open_access"}
_DOI = re.compile(r"10\.\d{4,9}/[^\s<>\"]+")
_YEAR = re.compile(r"(?<!\w)(?:19|20)\d{2}(?!\w)")
_ARTICLE = re.compile(r"artiId=(ART\d+)", re.I)


def local(tag: str) -> str:
    """Name of an element without its namespace."""
    return tag.rpartition("}")[2] if tag[0] == "{" else tag


def _text(e) -> str:
    return " ".join(("".join(e.itertext()) if len(e) else e.text or "").split())


class _Languages:
    """A title or abstract by the language its elements name; unnamed ones fill the gaps in order."""

    def __init__(self) -> None:
        self.named: dict[str, str] = {}
        self.rest: list[str] = []

    def add(self, e, text: str) -> None:
        lang = e.attrib.get("lang", "").lower()
        if lang in ("original", "english"):
            self.named[lang] = text
        else:
            self.rest.append(text)

    def pair(self, second: bool) -> tuple[str | None, str | None]:
        own, other = self.named.get("original"), self.named.get("english")
        if own is None and self.rest:
            own = self.rest[0]
            if second and len(self.rest) > 1:
                other = self.rest[1]
        return own, other


def _unique(values: list[str]) -> list[str]:
    return list({v.lower(): v for v in reversed(values)}.values())[::-1]


def parsed(xml: str) -> dict:
    """One record from its XML, in one walk; broken XML gives a record of unknown format without an identifier."""
    out: dict = dict.fromkeys((*HEADER, *BODY))
    out.update(deleted="N", metadata_type="unknown", authors=[], keywords=[])
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return out
    title, abstract = _Languages(), _Languages()
    for e in root.iter():
        name = local(e.tag)
        if name == "header":
            if e.attrib.get("status", "").lower() == "deleted":
                out["deleted"] = "Y"
            for h in e:
                column = {"identifier": "identifier", "datestamp": "datestamp", "setSpec": "set_spec"}.get(local(h.tag))
                if column and out[column] is None:
                    out[column] = _text(h) or None
            continue
        if name in ("oai_kci", "dc"):
            if out["metadata_type"] == "unknown":  # the first in document order
                out["metadata_type"] = "oai_kci" if name == "oai_kci" else "oai_dc"
            continue
        if name == "articleInfo" and e.attrib.get("article-id"):
            out["article_id"] = e.attrib["article-id"]
        dc = out["metadata_type"] == "oai_dc"
        text = _text(e) if len(e) == 0 or name in ("article-title", "abstract", "title", "description") else ""
        if not text or out["metadata_type"] == "unknown":
            continue
        if name == ("title" if dc else "article-title"):
            title.add(e, text)
        elif name == ("description" if dc else "abstract"):
            abstract.add(e, text)
        elif dc and name == "creator":
            out["authors"] += [x for x in (" ".join(y.split()) for y in re.split("[;|]", text)) if x]
        elif dc and name == "subject":
            out["keywords"].append(text)
            out["category"] = out["category"] or text
        elif not dc and name in ("name", "author"):
            out["authors"].append(text)
        elif not dc and name in ("keyword", "kwd"):
            out["keywords"].append(text)
        elif name == "url":
            if text.startswith("http"):
                out["landing_url"] = text
        else:
            column = (DC if dc else KCI).get(name)
            if column:
                out[column] = text
    out["title"], out["title_en"] = title.pair(dc := out["metadata_type"] == "oai_dc")
    out["abstract"], out["abstract_en"] = abstract.pair(dc)
    if dc and out["publication_date"]:
        y = _YEAR.search(out["publication_date"])
        out["publication_year"] = y.group() if y else None
    if out["landing_url"] and (m := _ARTICLE.search(out["landing_url"])):
        out["article_id"] = m.group(1)
    if not out["doi"] and "10." in xml and (m := _DOI.search(" ".join(root.itertext()))):
        out["doi"] = m.group().rstrip(".,;)")
    out["authors"], out["keywords"] = _unique(out["authors"]), _unique(out["keywords"])
    return out


def parse_records(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Header and bibliographic fields of one record a row, each record parsed once; namespaces are ignored.

    Formats are told by the first of their root elements.  NULL and broken XML give a
    record of format ``unknown``; see :func:`kept_records`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [(f.name, pa.list_(pa.string()) if f.name in LISTS else pa.string()) for f in RECORD]
        for b in batches:
            rows = [parsed(x or "") for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in kinds], names=[n for n, _ in kinds])

    return df.select(xml).mapInArrow(run, RECORD)


def kept_records(records: DataFrame) -> DataFrame:
    """Records that are neither deleted nor of unknown format."""
    return records.where("deleted = 'N' and metadata_type <> 'unknown'")


def tags(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Distinct names of elements."""
    names = F.regexp_extract_all(xml, F.lit(r"<(?:[\w.-]+:)?([A-Za-z][\w.-]*)"), 1)
    return df.select(F.explode(F.array_distinct(names)).alias("tag")).distinct()


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _tag(name: str, c: Column, attr: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{attr}>"), _escaped(c), F.lit(f"</{name}>"))


def _tags(name: str, c: Column) -> Column:
    """An element for each entry of an array."""
    every = F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: _tag(name, x))
    return F.array_join(every, "")


def _record(body: Column, keep: tuple[str, ...]) -> list[Column]:
    deleted = F.col("deleted") == "Y"
    head = F.concat(F.when(deleted, F.lit('<header status="deleted">')).otherwise(F.lit("<header>")), _tag("identifier", F.col("identifier")), _tag("datestamp", F.col("datestamp")), _tag("setSpec", F.col("set_spec")), F.lit("</header>"))
    return [F.concat(F.lit("<record>"), head, F.when(deleted, F.lit("")).otherwise(F.concat(F.lit("<metadata>"), body, F.lit("</metadata>"))), F.lit("</record>")).alias("xml"), *[F.col(k) for k in keep]]


def to_xml(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as protocol XML in the harvest's own format, one a row in ``xml`` (for exchange, and for tests of the parser)."""
    one = {"article-id": "article_id", "doi": "doi", "article-categories": "category", "journal-name": "journal", "publisher-name": "publisher", "pub-year": "publication_year", "pub-date": "publication_date", "language": "language", "uci": "uci", "citation-count": "citation_count", "open-access": "open_access"}
    body = F.concat(
        F.lit("<oai_kci>"), *[_tag(t, F.col(n)) for t, n in one.items()],
        _tag("article-title", F.col("title"), ' lang="original"'), _tag("article-title", F.col("title_en"), ' lang="english"'),
        _tag("abstract", F.col("abstract"), ' lang="original"'), _tag("abstract", F.col("abstract_en"), ' lang="english"'),
        F.lit("<author-group>"), _tags("author", F.col("authors")), F.lit("</author-group><keyword-group>"), _tags("keyword", F.col("keywords")), F.lit("</keyword-group></oai_kci>"),
    )
    return df.select(*_record(body, keep))


def to_dublin_core(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records as protocol XML in Dublin Core with namespaces."""
    creators = F.array_join(F.filter(F.coalesce("authors", F.array().cast("array<string>")), lambda x: x.isNotNull()), "; ")
    body = F.concat(
        F.lit('<oai_dc:dc xmlns:oai_dc="urn:oai_dc" xmlns:dc="urn:dc">'), _tag("dc:title", F.col("title")), _tag("dc:title", F.col("title_en"), ' lang="english"'), _tag("dc:creator", creators),
        _tags("dc:subject", F.col("keywords")), _tag("dc:description", F.col("abstract"), ' lang="original"'), _tag("dc:publisher", F.col("publisher")), _tag("dc:date", F.col("publication_date")), F.lit("</oai_dc:dc>"),
    )
    return df.select(*_record(body, keep))


class Page(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class PageFeed(DataSource):
    """``quillmill_pages``: a folder of page files ``00000.xmls`` (one record a line) as a stream.

    The offset is the number of pages read, so a cut at the batch limit falls between
    pages and loses no record.  Network feeds subclass :class:`PageReader`.
    """

    @classmethod
    def name(cls) -> str:
        return "quillmill_pages"

    def schema(self) -> str:
        return "page int, xml string"

    def streamReader(self, schema):
        return PageReader(self.options)


def page_files(folder: str) -> list[str]:
    """Page files of a folder of any file system that the session knows, sorted by name."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return sorted(x for x in os.listdir(folder) if x.endswith(".xmls"))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().getName() for f in found if f.getPath().getName().endswith(".xmls"))


class PageReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.folder = options["path"]
        self.most = int(options.get("maxPagesPerTrigger", 1000))
        self.read_to = 0

    def initialOffset(self) -> dict:
        return {"pages": 0}

    def latestOffset(self) -> dict:
        there = len(page_files(self.folder))
        self.read_to = min(there, self.read_to + self.most)
        return {"pages": self.read_to}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.read_to = max(self.read_to, end["pages"])
        return [Page(os.path.join(self.folder, f"{i:05d}.xmls")) for i in range(start["pages"], end["pages"])]

    def read(self, partition: Page) -> Iterator[tuple]:
        n = int(os.path.basename(partition.path).split(".")[0])
        with open(partition.path, encoding="utf-8") as f:
            for line in f:
                if line.strip():
                    yield (n, json.loads(line) if line.startswith('"') else line.rstrip("\n"))
