"""Queries that send tables through sinks and sources and back, and through the harvest protocol."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.plans.registry import QUERIES, SQL
from quillmill.session import shared_dir, ship_package, table
from quillmill.sources import bundle, files, harvest, jsonl, oai

c = F.col


def trip(*tables: str, sql: str | None = None):
    """Registers a query that also gets a fresh folder in the shared one."""

    def deco(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return f(*[table(spark, sf_dir, n) for n in tables], f"{shared_dir(spark)}/quillmill-{f.__name__}-{uuid.uuid4().hex}")

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return deco


_PAPER = "SELECT _ord, paper_id, title, array_to_string(authors, '|') AS authors, year, page_count FROM papers_verified"


def _paper(d: DataFrame) -> DataFrame:
    return d.select("_ord", "paper_id", "title", F.array_join("authors", "|").alias("authors"), "year", "page_count")


def _plain(p: DataFrame) -> DataFrame:
    return p.drop("verified_at")


@trip("papers_verified", sql=_PAPER)
def jsonl_strict(p, at):
    """Written as lines of JSON and read again, any bad line fails."""
    jsonl.write_jsonl(_plain(p), at)
    return _paper(jsonl.read_jsonl(p.sparkSession, at, _plain(p).schema))


@trip("papers_verified", sql=_PAPER)
def jsonl_dropping(p, at):
    """Bad lines among the good ones are dropped, blank ones skipped."""
    good = _plain(p).select(F.to_json(F.struct("*")).alias("value"))
    good.union(p.sparkSession.createDataFrame([("",), ('{"_ord": 1, "title": ',), ("nonsense",)], "value string")).write.text(at)
    return _paper(jsonl.read_jsonl(p.sparkSession, at, _plain(p).schema, malformed="drop").where("_ord is not null"))


@trip("papers_verified", sql="SELECT count(*) + 3 AS scanned, 1 AS blank, 2 AS malformed FROM papers_verified")
def jsonl_counts(p, at):
    """Lines scanned, blank and malformed."""
    good = _plain(p).select(F.to_json(F.struct("*")).alias("value"))
    good.union(p.sparkSession.createDataFrame([("",), ('{"_ord": 1, "title": ',), ("nonsense",)], "value string")).write.text(at)
    return jsonl.line_errors(p.sparkSession, at, _plain(p).schema).select("scanned", "blank", "malformed")


@trip("papers_verified", sql="SELECT * FROM (VALUES (2, '{\"a\": '), (4, 'x')) t(line, value)")
def jsonl_bad_lines(p, at):
    """Malformed lines of a file with their numbers."""
    p.sparkSession.createDataFrame([('{"a": 1}\n{"a": \n\nx\n{"a": 2}\n',)], "value string").coalesce(1).write.text(at)
    return jsonl.bad_lines(p.sparkSession, at, T.StructType([T.StructField("a", T.IntegerType())])).select("line", "value")


@trip("papers_verified", sql="SELECT 0 AS n")
def jsonl_missing(p, at):
    """A missing file is an empty table."""
    return jsonl.read_jsonl(p.sparkSession, f"{at}/none", _plain(p).schema, missing="empty").agg(F.count("*").cast("int").alias("n"))


@trip("papers_verified", sql=_PAPER)
def jsonl_appended(p, at):
    """Two batches appended to one log."""
    even = F.col("_ord") % 2 == 0
    jsonl.write_jsonl(_plain(p).where(even), at)
    jsonl.write_jsonl(_plain(p).where(~even), at, append=True)
    return _paper(jsonl.read_jsonl(p.sparkSession, at, _plain(p).schema))


@trip("subject_areas", sql="SELECT subject_code, name_ko, name_en FROM subject_areas")
def json_array(a, at):
    """A whole array in one JSON document, and back."""
    jsonl.write_json_array(a, at, most=10_000)
    return jsonl.read_json(a.sparkSession, at, a.schema).select("subject_code", "name_ko", "name_en")


@trip("subject_areas", sql="SELECT subject_code, name_ko, name_en FROM subject_areas")
def json_wrapped(a, at):
    """Records under a wrapper's key in one JSON document."""
    wrapped = a.select(F.to_json(F.struct(F.collect_list(F.struct(*a.columns)).over(_all()).alias("items"))).alias("value")).limit(1)
    wrapped.coalesce(1).write.text(at)
    return jsonl.read_json(a.sparkSession, at, a.schema).select("subject_code", "name_ko", "name_en")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))  # a fixed table of a dozen rows


@trip("papers_verified", sql="SELECT paper_id, coalesce(array_to_string(authors, ' | '), '') AS authors, CAST(year AS VARCHAR) AS year FROM papers_verified")
def csv_export(p, at):
    """Fixed columns with arrays joined, byte order mark first, and back."""
    jsonl.write_csv(p, at, ["paper_id", "authors", "year"])
    return jsonl.read_csv(p.sparkSession, at).select("paper_id", F.coalesce("authors", F.lit("")).alias("authors"), "year")


@trip("paper_sections", sql="SELECT section_id, section, content FROM paper_sections")
def document_store(s, at):
    """One JSON document a key, in buckets of a bounded number of files, fetched by key."""
    jsonl.write_documents(s.select("section_id", "section", "content"), at, "section_id", buckets=16)
    return jsonl.read_documents(s.sparkSession, at, "section_id bigint, section string, content string").drop("bucket_")


@trip("paper_sections", sql="SELECT section_id, content FROM paper_sections WHERE content <> ''")
def text_store(s, at):
    """One text a key and back; bad bytes are replaced, not fatal."""
    t = s.where("content <> ''").select("section_id", "content")
    files.write_texts(t, at, "section_id", "content")
    return files.read_texts(s.sparkSession, at).select(c("key").cast("bigint").alias("section_id"), c("text").alias("content"))


@trip("papers_verified", sql="SELECT count(*) FILTER (WHERE NOT r) AS main, count(*) FILTER (WHERE r) AS review FROM (SELECT coalesce(title IS NULL OR trim(title) = '', false) AS r FROM papers_verified) t")
def side_output(p, at):
    """Main and review table of one pass, written apart."""
    main, review = jsonl.side_split(_plain(p), c("title").isNull() | (F.trim("title") == ""))
    jsonl.write_jsonl(main, f"{at}/main")
    jsonl.write_jsonl(review, f"{at}/review")
    read = lambda n: jsonl.read_jsonl(p.sparkSession, f"{at}/{n}", _plain(p).schema)
    return read("main").agg(F.count("*").alias("main")).crossJoin(F.broadcast(read("review").agg(F.count("*").alias("review"))))  # one row each


@trip("subject_areas", sql="SELECT subject_code, name_en, 'old' AS state FROM subject_areas UNION ALL SELECT subject_code, upper(name_en), 'new' FROM subject_areas")
def backup_overwrite(a, at):
    """A table is copied before it is overwritten."""
    spark = a.sparkSession
    jsonl.write_jsonl(a.select("subject_code", "name_en"), at)
    kept = jsonl.overwrite_with_backup(a.select("subject_code", F.upper("name_en").alias("name_en")), at)
    read = lambda x, s: spark.read.schema("subject_code string, name_en string").json(x).withColumn("state", F.lit(s))
    return read(kept, "old").union(read(at, "new"))


@trip("subject_areas", sql="SELECT subject_code, name_en FROM subject_areas")
def sorted_snapshot(a, at):
    """A sorted snapshot, replaced as a whole by each batch."""
    jsonl.write_snapshot(a.select("subject_code", "name_en").limit(3), at, [c("subject_code")])
    jsonl.write_snapshot(a.select("subject_code", "name_en"), at, [c("subject_code")])
    return jsonl.read_snapshot(a.sparkSession, at, "subject_code string, name_en string")


@trip("paper_sections", sql="SELECT 'summary' AS name, (SELECT count(*) FROM paper_sections) AS sections, (SELECT count(DISTINCT paper_id) FROM paper_sections) AS papers")
def summary_document(s, at):
    """The one-row summary as a JSON document, and back."""
    bundle.write_summary(s.agg(F.count("*").alias("sections"), F.count_distinct("paper_id").alias("papers")), at, "summary")
    return bundle.read_summary(s.sparkSession, at, "summary", "sections bigint, papers bigint").select(F.lit("summary").alias("name"), "sections", "papers")


@trip("subject_areas", "eval_items", sql="SELECT 'subject_areas' AS part, count(*) AS rows, 'OK' AS state FROM subject_areas UNION ALL SELECT 'eval_items', count(*), 'OK' FROM eval_items UNION ALL SELECT 'absent', NULL, 'MISSING'")
def handoff_bundle(a, e, at):
    """Tables and a manifest in one folder; a part that is missing is named, not fatal."""
    return bundle.write_bundle(a.sparkSession, at, {"subject_areas": a, "eval_items": e, "absent": None}, "What this bundle holds.")


@trip("papers_verified", sql="SELECT DISTINCT source_filename AS name FROM papers_verified WHERE source_filename IS NOT NULL AND length(source_filename) BETWEEN 1 AND 60 AND regexp_full_match(source_filename, '[A-Za-z0-9_.-]+') ORDER BY lower(source_filename), source_filename LIMIT 40")
def folder_listing(p, at):
    """Files of a folder by name, case aside, with their hashes; here the first forty ASCII names of the table."""
    names = p.select(c("source_filename").alias("name")).distinct().where(c("name").rlike("^[A-Za-z0-9_.-]{1,60}$")).orderBy(F.lower("name"), "name").limit(40)
    files.write_texts(names.withColumn("t", c("name")), at, "name", "t", suffix="")
    return files.listing(p.sparkSession, at, "*").select("name")


@trip("paper_sections", sql="""SELECT paper_id, count(*) AS pages, CAST(sum(length(content)) AS BIGINT) AS chars FROM (SELECT paper_id, content FROM paper_sections WHERE paper_id IS NOT NULL AND content IS NOT NULL AND NOT contains(content, chr(12))) t GROUP BY 1""")
def page_scan(s, at):
    """Pages of binary documents (form feeds part them in the stand-in), read by the plug-in."""
    t = s.where("paper_id is not null and content is not null and not contains(content, '\f')")
    whole = t.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_no", "section_id", "content"))), lambda x: x["content"]), "\f").alias("t"))
    docs = whole.select(c("paper_id").alias("name"), F.encode("t", "utf-8").alias("content"))
    return files.pages(docs).groupBy(c("name").alias("paper_id")).agg(F.count("*").alias("pages"), F.sum(F.length("text")).cast("bigint").alias("chars"))


@trip("paper_sections", sql="""SELECT section_id, CASE WHEN length(content) >= 150 THEN 'DIRECT' WHEN content IS NULL THEN 'OCR' WHEN length(content) < 20 THEN 'OCR' ELSE 'DIRECT' END AS mode FROM paper_sections""")
def page_recovery(s, at):
    """Short pages are recognised anew and the longer text stays; the stand-in gives twenty letters a page."""
    d = s.select(c("section_id").cast("string").alias("name"), F.lit(1).alias("page"), c("content").alias("text"))
    return files.recovered(d, lambda name, page: "x" * 20).select(c("name").cast("bigint").alias("section_id"), "mode")


@trip("paper_sections", sql="SELECT section_id, length(content) AS n FROM paper_sections WHERE section_id % 3 <> 0 AND content IS NOT NULL")
def resumed_enrichment(s, at):
    """Rows not done yet go through a plug-in with retries; failures keep their error and do not count as done."""
    d = s.select("section_id", "content")
    done = s.where("section_id % 3 = 0").select("section_id")
    got = files.enriched(d, lambda r: {"n": len(r["content"])}, done, "section_id", "section_id bigint, n int", retries=2, wait=0)
    return got.where("error is null").select("section_id", c("n").cast("bigint").alias("n"))


# ---- harvest

_LIVE = "FROM kci_oai_all WHERE identifier <> '' AND deleted <> 'Y'"
_COLS = ["article_id", "title", "title_en", "abstract", "abstract_en", "category", "journal", "publisher", "publication_year", "publication_date", "language", "uci", "doi", "citation_count", "open_access"]


@trip("kci_oai_all", sql=f"SELECT identifier, nullif(trim(datestamp), '') AS datestamp, {', '.join(f'''nullif(trim({x}), '') AS {x}''' for x in _COLS)}, array_to_string([trim(a) FOR a IN authors IF trim(a) <> ''], '|') AS authors {_LIVE}")
def xml_full_record(k, at):
    """All fields of records in the harvest's own format, through its XML; deleted ones are dropped."""
    got = oai.parse_records(oai.to_xml(k.where("identifier <> ''")))
    return oai.kept_records(got).select("identifier", "datestamp", *_COLS, F.array_join("authors", "|").alias("authors"))


@trip("kci_oai_all", sql=f"SELECT identifier, nullif(trim(title), '') AS title, nullif(trim(title_en), '') AS title_en, nullif(trim(keywords[1]), '') AS category, nullif(regexp_extract(publication_date, '([0-9]{{4}})', 1), '') AS publication_year, array_to_string([trim(a) FOR a IN authors IF trim(a) <> ''], '|') AS authors {_LIVE}")
def xml_dublin_core(k, at):
    """Records in Dublin Core: creators split, subjects as keywords, the first one as category, the year from the date."""
    got = oai.kept_records(oai.parse_records(oai.to_dublin_core(k.where("identifier <> '' and deleted <> 'Y'"))))
    return got.select("identifier", "title", "title_en", "category", "publication_year", F.array_join("authors", "|").alias("authors"))


@trip("kci_oai_all", sql="SELECT identifier FROM kci_oai_all WHERE identifier <> ''")
def token_harvest(k, at):
    """The feed page by page with resumption tokens, failing requests repeated, in parallel date ranges."""
    pages = harvest.paged(oai.to_xml(k.where("identifier <> ''"), keep=("datestamp",)), ["0000", "2015", "2020", "2023"], 500)
    harvest.write_feed(pages, f"{at}/feed")
    got = harvest.harvested(k.sparkSession, harvest.FolderFeed(f"{at}/feed", fails_every=7), retries=5, wait=0)
    return oai.parse_records(got.select("xml")).select("identifier")


@trip("kci_oai_all", sql="SELECT * FROM (VALUES ('abstract'), ('article-id'), ('article-title'), ('author'), ('author-group'), ('citation-count'), ('doi'), ('journal-name'), ('keyword'), ('keyword-group'), ('language'), ('open-access'), ('pub-date'), ('pub-year'), ('publisher-name'), ('uci'), ('article-categories'), ('header'), ('identifier'), ('datestamp'), ('setSpec'), ('metadata'), ('oai_kci'), ('record')) t(tag)")
def tag_probe(k, at):
    """Distinct tags of the feed."""
    return oai.tags(oai.to_xml(k.where("identifier <> ''")))
