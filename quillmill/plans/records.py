"""Queries on metadata records: relevance, duplicates, joins, audits, summaries, with the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import arrays, text
from quillmill.operators import audit, dataset, dedupe, identify, lines, metadata, relevance
from quillmill.plans.documents import _lines, _squeeze
from quillmill.plans.registry import query

c = F.col
_KEY = "regexp_replace(lower(title), '[^0-9a-z가-힣]', '', 'g')"
_DOI = r"nullif(regexp_replace(regexp_replace(lower(trim(doi)), '^(https?://(dx\.)?doi\.org/|doi: ?)', ''), '[.,;)]+$', ''), '')"

# ---- relevance

_TEXT = "concat_ws(' ', title, title_en, abstract, abstract_en, array_to_string(keywords, ' '), category)"


def _terms(x: str, terms) -> str:
    return "[t FOR t IN [" + ", ".join(f"CASE WHEN {f'''regexp_matches({x}, '(?i)(^|[^A-Za-z]){t}([^A-Za-z]|$)')''' if t in ('sme', 'smes') else f'''contains(lower({x}), '{t.lower()}')'''} THEN '{t}' END" for t in terms) + "] IF t IS NOT NULL]"


def _labels(x: str) -> str:
    return "[t FOR t IN [" + ", ".join(f"CASE WHEN regexp_matches({x}, '(?i){p}') THEN '{n}' END" for n, p in relevance.HARVEST_LABELS) + "] IF t IS NOT NULL]"


_HARVEST = f"""WITH x AS (SELECT _ord, publication_year, {_TEXT} AS b, concat_ws(' ', title, title_en) AS h FROM kci_oai_all),
    m AS (SELECT _ord, publication_year, {_terms('b', relevance.HARVEST_REQUIRED)} AS sme, {_labels('b')} AS tech, {_terms('b', relevance.HARVEST_PERFORMANCE)} AS perf, {_terms('h', relevance.HARVEST_REQUIRED)} AS hs, {_labels('h')} AS ht, {_terms('h', relevance.HARVEST_PERFORMANCE)} AS hp FROM x),
    r AS (SELECT _ord, publication_year, sme, tech, perf, CASE WHEN len(sme) > 0 THEN 5 ELSE 0 END + CASE WHEN len(tech) > 0 THEN 5 ELSE 0 END + CASE WHEN len(perf) > 0 THEN 2 ELSE 0 END + CASE WHEN len(hs) > 0 THEN 4 ELSE 0 END + CASE WHEN len(ht) > 0 THEN 4 ELSE 0 END + CASE WHEN len(hp) > 0 THEN 2 ELSE 0 END AS score,
        CASE WHEN len(sme) > 0 AND len(tech) > 0 AND len(perf) > 0 THEN 'core' WHEN len(sme) > 0 AND len(tech) > 0 THEN 'high' ELSE 'reject' END AS relevance FROM m)"""


@query("kci_oai_all", sql=_HARVEST + " SELECT _ord, score, relevance, array_to_string(sme, '|') AS sme, array_to_string(tech, '|') AS tech, array_to_string(perf, '|') AS perf FROM r")
def harvest_relevance(k):
    d = relevance.harvest_relevance(k)
    return d.select("_ord", c("relevance_score").alias("score"), "relevance", *[F.array_join(f"{n}_matches", "|").alias(a) for n, a in (("sme", "sme"), ("tech", "tech"), ("performance", "perf"))])


@query("kci_oai_all", sql=_HARVEST + " SELECT count(*) FILTER (WHERE len(sme) > 0) AS sme, count(*) FILTER (WHERE len(tech) > 0) AS tech, count(*) FILTER (WHERE len(sme) > 0 AND len(tech) > 0) AS both_ FROM r")
def relevance_counts(k):
    d = relevance.harvest_relevance(k)
    sme, tech = F.size("sme_matches") > 0, F.size("tech_matches") > 0
    return d.agg(F.count_if(sme).alias("sme"), F.count_if(tech).alias("tech"), F.count_if(sme & tech).alias("both_"))


@query("kci_oai_all", sql=_HARVEST + " SELECT _ord, score FROM r WHERE relevance <> 'reject' ORDER BY score DESC, publication_year DESC NULLS LAST, _ord LIMIT 30")
def snapshot_order(k):
    d = relevance.harvest_relevance(k).where("relevance <> 'reject'")
    return d.orderBy(F.desc("relevance_score"), c("publication_year").desc_nulls_last(), "_ord").limit(30).select("_ord", c("relevance_score").alias("score"))


def _first(x: str, p: str) -> str:
    # a pattern with a boundary captures what stands inside it
    return f"regexp_extract({x}, '(?i){p}', 1)" if p.startswith("(?:^|") else f"regexp_extract({x}, '(?i)({p})', 1)"


_CORE = [p for t in relevance.DEFAULT.core for p in t.patterns]


@query("kci_oai_all", sql=f"""SELECT _ord, array_to_string([x FOR x, i IN l IF list_position([lower(y) FOR y IN l], lower(x)) = i], '|') AS matches FROM (SELECT _ord, [trim(m) FOR m IN [{', '.join(_first('b', p) for p in _CORE)}] IF trim(m) <> ''] AS l FROM (SELECT _ord, {_TEXT} AS b FROM kci_oai_all) x) t""")
def relevance_matches(k):
    body = F.concat_ws(" ", "title", "title_en", "abstract", "abstract_en", F.array_join("keywords", " "), "category")
    return k.select("_ord", F.array_join(arrays.union_ci(*[relevance.matches(body, t) for t in relevance.DEFAULT.core]), "|").alias("matches"))


# ---- duplicates


@query("papers_verified", sql=f"""WITH d AS (SELECT DISTINCT {_DOI} AS k, paper_id AS m FROM papers_verified WHERE regexp_matches(doi, '10[.][0-9]{{4,5}}/.') AND paper_id IS NOT NULL), t AS (SELECT DISTINCT {_KEY} AS k, paper_id AS m FROM papers_verified WHERE length({_KEY}) >= 10 AND paper_id IS NOT NULL),
    p AS (SELECT a.m AS a, b.m AS b, 0 AS prio FROM d a JOIN d b ON a.k = b.k AND a.m < b.m UNION ALL SELECT a.m, b.m, 1 FROM t a JOIN t b ON a.k = b.k AND a.m < b.m)
    SELECT a, b, CASE min(prio) WHEN 0 THEN 'DOI' ELSE 'TITLE' END AS reason, CAST(min(prio) AS INTEGER) AS prio FROM p GROUP BY 1, 2 ORDER BY prio, a, b""")
def duplicate_pairs(p):
    k = text.title_key(c("title"))
    p = p.where("paper_id is not null")
    by_doi = dedupe.key_pairs(p.where(c("doi").rlike("10[.][0-9]{4,5}/.")), text.doi_normal(c("doi")), "paper_id", "DOI")
    return dedupe.first_reason_pairs(by_doi, dedupe.key_pairs(p.where(F.length(k) >= 10), k, "paper_id", "TITLE")).orderBy("prio", "a", "b")


@query("papers_verified", sql=f"""WITH t AS (SELECT DISTINCT {_KEY} AS k, paper_id AS m FROM papers_verified WHERE length({_KEY}) >= 10 AND paper_id IS NOT NULL), p AS (SELECT a.m AS a, b.m AS b FROM t a JOIN t b ON a.k = b.k AND a.m < b.m)
    SELECT count(DISTINCT id) AS papers, (SELECT count(*) FROM p) AS pairs FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) u""")
def paired_papers(p):
    k = text.title_key(c("title"))
    pairs = dedupe.key_pairs(p.where(F.length(k) >= 10).where("paper_id is not null"), k, "paper_id", "TITLE")
    return pairs.select(F.explode(F.array("a", "b")).alias("id"), F.xxhash64("a", "b").alias("pair")).agg(F.count_distinct("id").alias("papers"), F.count_distinct("pair").alias("pairs"))


@query("papers_verified")
def fuzzy_title_pairs(p):
    d = p.where("paper_id is not null and year between 1980 and 2026").select("paper_id", text.title_key(c("title")).alias("t"), "year", F.explode_outer("authors").alias("author"))
    return dedupe.fuzzy_pairs(d.where(F.length("t") >= 10), "paper_id", "t", "year", "author")


@query("kci_oai_all")
def accepted_harvest(k):
    """One pass in order of arrival, which takes a record if neither its id nor its title was taken; the SQL would be a loop."""
    key = F.coalesce(F.concat(F.lit("a"), F.nullif("article_id", F.lit(""))), F.concat(F.lit("i"), F.nullif("identifier", F.lit(""))), F.concat(F.lit("t"), text.title_key(c("title"))))
    return dedupe.first_accepted(k.select("_ord", "identifier", "article_id", "title"), key, text.title_key(c("title"))).select("_ord", "identifier")


@query("papers_verified", sql="""SELECT source_filename, sha256, printf('paper_%04d', row_number() OVER (ORDER BY lower(source_filename), source_filename)) AS paper_id FROM (SELECT sha256, min(source_filename) AS source_filename FROM papers_verified WHERE sha256 IS NOT NULL AND source_filename IS NOT NULL GROUP BY 1) t""")
def surrogate_ids(p):
    files = p.where("sha256 is not null and source_filename is not null").groupBy("sha256").agg(F.min("source_filename").alias("source_filename"))
    return dedupe.numbered(files, "source_filename").select("source_filename", "sha256", "paper_id")


@query("papers_verified", sql="SELECT sha256, _ord, paper_id FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY _ord) AS r FROM papers_verified WHERE sha256 IS NOT NULL) t WHERE r = 1")
def first_of_hash(p):
    return dedupe.keep_first(p.where("sha256 is not null").select("sha256", "_ord", "paper_id"), ["sha256"])


_MAP = f"(SELECT member AS duplicate_id, first_member AS kept_id FROM (SELECT DISTINCT paper_id AS member, min(paper_id) OVER (PARTITION BY k) AS first_member FROM (SELECT paper_id, {_KEY} AS k FROM papers_verified WHERE length({_KEY}) >= 10 AND paper_id IS NOT NULL) t) u WHERE member <> first_member)"


@query("papers_verified", sql=f"WITH m AS {_MAP} SELECT p._ord, p.paper_id, CASE WHEN m.duplicate_id IS NULL THEN 'KEPT' ELSE 'DUPLICATE' END AS state, m.kept_id FROM papers_verified p LEFT JOIN (SELECT DISTINCT * FROM m) m ON p.paper_id = m.duplicate_id")
def exclusion_map(p):
    k = text.title_key(c("title"))
    m = dedupe.key_groups(p.where((F.length(k) >= 10) & c("paper_id").isNotNull()), k, "paper_id", "TITLE").where("member <> first_member")
    kept, gone = dedupe.excluded(p.select("_ord", "paper_id"), m.select(c("member").alias("duplicate_id"), c("first_member").alias("kept_id")), "paper_id")
    return kept.select("_ord", "paper_id", F.lit("KEPT").alias("state"), F.lit(None).cast("string").alias("kept_id")).union(gone.select("_ord", "paper_id", F.lit("DUPLICATE"), "kept_id"))


@query("papers_verified", "kci_oai_all", sql=f"""SELECT {_KEY} AS k, array_to_string(authors, '|') AS who, min(src) AS first_source FROM (SELECT title, authors, 0 AS src FROM papers_verified UNION ALL SELECT title, authors, 1 AS src FROM kci_oai_all) t WHERE {_KEY} <> '' GROUP BY 1, 2""")
def union_signature(p, k):
    u = p.select("title", "authors", F.lit(0).alias("src")).unionByName(k.select("title", "authors", F.lit(1).alias("src")))
    u = u.select(text.title_key(c("title")).alias("k"), F.array_join("authors", "|").alias("who"), "src").where("k <> ''")
    return u.groupBy("k", "who").agg(F.min("src").alias("first_source"))


@query("papers_verified", sql="WITH e AS (SELECT DISTINCT paper_id, unnest(authors) AS a FROM papers_verified WHERE paper_id IS NOT NULL), d AS (SELECT DISTINCT doi, paper_id FROM papers_verified WHERE doi <> '' AND paper_id IS NOT NULL) SELECT x.paper_id AS a, y.paper_id AS b, EXISTS (SELECT 1 FROM e e1 JOIN e e2 ON e1.a = e2.a WHERE e1.paper_id = x.paper_id AND e2.paper_id = y.paper_id) AS overlap FROM d x JOIN d y ON x.doi = y.doi AND x.paper_id < y.paper_id GROUP BY 1, 2")
def author_overlap(p):
    one = p.where("paper_id is not null").groupBy("paper_id").agg(F.array_distinct(F.flatten(F.collect_set(F.coalesce("authors", F.array().cast("array<string>"))))).alias("au"))
    pairs = dedupe.key_pairs(p.where("doi <> '' and paper_id is not null"), c("doi"), "paper_id", "DOI").select("a", "b")
    j = pairs.join(one.select(c("paper_id").alias("a"), c("au").alias("x")), "a").join(one.select(c("paper_id").alias("b"), c("au").alias("y")), "b")
    return j.select("a", "b", F.arrays_overlap("x", "y").alias("overlap")).withColumn("overlap", F.coalesce("overlap", F.lit(False)))


# ---- records and joins

_LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY _ord DESC) AS r FROM papers_verified WHERE paper_id IS NOT NULL) t WHERE r = 1)"


@query("papers_verified", sql=rf"""SELECT paper_id, regexp_replace(regexp_replace(regexp_replace({_squeeze('title')}, ' ?: ?', ': ', 'g'), '\( ', '(', 'g'), ' \)', ')', 'g') AS title, CASE WHEN year BETWEEN 1900 AND 2030 THEN year END AS year,
    CASE WHEN trim(j) <> '' AND lower(trim(j)) NOT IN ('null', 'none', 'unknown', 'n/a', '없음', '-') THEN trim(j) END AS journal, {_DOI} AS doi,
    CASE WHEN regexp_replace(upper(trim(metadata_confidence)), '^AI_', '') IN ('HIGH', 'MEDIUM', 'LOW') THEN regexp_replace(upper(trim(metadata_confidence)), '^AI_', '') ELSE 'LOW' END AS metadata_confidence
    FROM (SELECT *, {_squeeze('journal')} AS j FROM (SELECT * REPLACE (CASE WHEN trim(title) <> '' THEN title END AS title, CASE WHEN trim(journal) <> '' THEN journal END AS journal, CASE WHEN trim(doi) <> '' THEN doi END AS doi) FROM {_LAST}) a) b""")
def canonical_records(p):
    last = dedupe.keep_last(p.where("paper_id is not null"), ["paper_id"])
    got = metadata.canonical_record(last, last.select("paper_id", "title", "authors", "year", "journal", "institution", "department", "document_type", "doi", "metadata_confidence", "evidence"))
    return got.select("paper_id", "title", "year", "journal", "doi", "metadata_confidence")


@query("papers_verified", sql="SELECT CASE lower(trim(document_type)) WHEN 'article' THEN 'journal_article' WHEN 'paper' THEN 'journal_article' WHEN 'phd_thesis' THEN 'doctoral_thesis' WHEN 'dissertation' THEN 'doctoral_thesis' WHEN 'masters_thesis' THEN 'master_thesis' WHEN 'research_report' THEN 'report' ELSE coalesce(nullif(lower(trim(document_type)), ''), 'unknown') END AS type, count(*) AS n FROM papers_verified GROUP BY 1")
def document_type_aliases(p):
    return p.groupBy(metadata.doc_type(c("document_type")).alias("type")).agg(F.count("*").alias("n"))


@query("papers_verified", "paper_sections", sql="""SELECT 'no_sections' AS side, paper_id FROM (SELECT DISTINCT paper_id FROM papers_verified WHERE paper_id IS NOT NULL AND paper_id NOT IN (SELECT paper_id FROM paper_sections WHERE paper_id IS NOT NULL)) a
    UNION ALL SELECT 'no_record', paper_id FROM (SELECT DISTINCT paper_id FROM paper_sections WHERE paper_id IS NOT NULL AND paper_id NOT IN (SELECT paper_id FROM papers_verified WHERE paper_id IS NOT NULL)) b""")
def missing_sides(p, s):
    _, no_sections, no_record = metadata.matched(p, s, "paper_id")
    return no_sections.select(F.lit("no_sections").alias("side"), "paper_id").union(no_record.select(F.lit("no_record"), "paper_id"))


@query("kci_oai_all", sql="SELECT _ord, identifier, datestamp, title, doi FROM kci_oai_all WHERE deleted <> 'Y'")
def record_merge(k):
    """Header and body of a record as structs, merged into one."""
    d = k.where("deleted <> 'Y'").select("_ord", F.struct("identifier", "datestamp").alias("header"), F.struct("title", "doi").alias("body"))
    return d.select("_ord", "header.*", "body.*")


@query("paper_sections", sql="SELECT section_id, section, content FROM paper_sections")
def json_documents(s):
    """Documents as JSON text and back, every letter kept."""
    t = s.select("section_id", F.to_json(F.struct("section", "content"), {"ignoreNullFields": "false"}).alias("j"))
    return t.withColumn("d", F.from_json("j", "section string, content string")).select("section_id", "d.section", "d.content")


# ---- audits and summaries


@query("paper_sections", sql=rf"WITH l AS ({_lines('paper_sections', 'paper_id', 'content')}), q AS (SELECT paper_id, trim(regexp_replace(raw, '[ \t\x{{a0}}]+', ' ', 'g')) AS line FROM l WHERE paper_id IS NOT NULL) SELECT paper_id, line, count(*) AS n FROM q WHERE line <> '' AND length(line) <= 80 GROUP BY 1, 2 HAVING count(*) >= 2")
def repeated_lines(s):
    return lines.repeated_lines(s.where("paper_id is not null"), "paper_id", "content", least=2)


_KEPT = """WITH s AS (SELECT paper_id, sum(length(content)) AS cleaned, sum(CASE WHEN section <> 'front_matter' THEN length(content) ELSE 0 END) AS sectioned FROM paper_sections WHERE content <> '' GROUP BY 1),
    j AS (SELECT p.paper_id, p.text_chars AS raw, s.cleaned, s.sectioned FROM (SELECT DISTINCT paper_id, text_chars FROM papers_verified) p JOIN s ON p.paper_id = s.paper_id),
    r AS (SELECT paper_id, raw, CASE WHEN raw > 0 THEN cleaned * 1.0::DOUBLE / raw ELSE 0 END AS kept, CASE WHEN cleaned > 0 THEN sectioned * 1.0::DOUBLE / cleaned END AS part FROM j),
    x AS (SELECT paper_id, kept, part, concat_ws('|', CASE WHEN raw < 3000 THEN 'SOURCE_TEXT_SHORT' END, CASE WHEN kept < 0.35 THEN 'CRITICAL_CLEANED_LOSS' END, CASE WHEN kept >= 0.35 AND kept < 0.6 THEN 'WARNING_CLEANED_LOSS' END, CASE WHEN part < 0.35 THEN 'CRITICAL_SECTION_LOSS' END, CASE WHEN part >= 0.35 AND part < 0.6 THEN 'WARNING_SECTION_LOSS' END) AS reasons FROM r),
    y AS (SELECT *, CASE WHEN contains(reasons, 'CRITICAL') THEN 'CRITICAL' WHEN contains(reasons, 'WARNING') THEN 'WARNING' WHEN contains(reasons, 'SOURCE') THEN 'SOURCE_SHORT' ELSE 'OK' END AS status FROM x)"""


def _kept(p, s):
    k = s.where("content <> ''").groupBy("paper_id").agg(F.sum(F.length("content")).alias("cleaned"), F.sum(F.when(c("section") != "front_matter", F.length("content")).otherwise(0)).alias("sectioned"))
    j = p.select("paper_id", "text_chars").distinct().join(k, "paper_id")
    j = j.withColumn("reasons", audit.preservation_reasons(c("text_chars"), c("cleaned"), c("sectioned")))
    return j.withColumn("status", audit.gravest(c("reasons"))).withColumn("kept", F.when(c("text_chars") > 0, c("cleaned") / c("text_chars")).otherwise(0.0)).withColumn("part", c("sectioned") / c("cleaned"))


@query("papers_verified", "paper_sections", sql=_KEPT + " SELECT paper_id, reasons, status FROM y")
def preservation_reasons(p, s):
    return _kept(p, s).select("paper_id", F.array_join("reasons", "|").alias("reasons"), "status")


@query("papers_verified", "paper_sections", sql=_KEPT + " SELECT paper_id, status FROM y WHERE status IN ('CRITICAL', 'WARNING') ORDER BY kept, part, paper_id LIMIT 20")
def suspicious_order(p, s):
    return _kept(p, s).where(c("status").isin("CRITICAL", "WARNING")).orderBy("kept", "part", "paper_id").limit(20).select("paper_id", "status")


_RISK = rf"""WITH l AS ({_lines('paper_sections', 'paper_id', 'content')}), q AS (SELECT paper_id, trim(regexp_replace(raw, '[ \t\x{{a0}}]+', ' ', 'g')) AS line, length(raw) AS size FROM l),
    g AS (SELECT paper_id, line, count(*) AS n FROM q WHERE line <> '' AND length(line) <= 80 GROUP BY 1, 2), r AS (SELECT paper_id, sum(n) AS repeated FROM g WHERE n >= 4 GROUP BY 1),
    k AS (SELECT paper_id, sum(length(content)) AS cleaned, sum(length(regexp_replace(content, '[^가-힣]', '', 'g'))) AS ko, sum(length(regexp_replace(content, '[ \t\n\r]', '', 'g'))) AS solid FROM paper_sections WHERE content IS NOT NULL GROUP BY 1),
    j AS (SELECT p.paper_id, p.page_count, k.cleaned, coalesce(r.repeated, 0) AS repeated, CASE WHEN k.solid > 0 THEN k.ko * 1.0::DOUBLE / k.solid ELSE 0 END AS korean, CASE WHEN p.text_chars < 1000 THEN 'LOW_TEXT' WHEN p.text_chars < 3000 THEN 'VERY_SHORT' ELSE 'OK' END AS status
        FROM (SELECT DISTINCT paper_id, page_count, text_chars FROM papers_verified) p JOIN k ON p.paper_id = k.paper_id LEFT JOIN r ON p.paper_id = r.paper_id),
    s AS (SELECT *, CAST(cleaned < 3000 AS INTEGER) + CAST(coalesce(page_count > 0 AND cleaned * 1.0::DOUBLE / page_count < 500, false) AS INTEGER) + CAST(repeated >= 80 AS INTEGER) + CAST(coalesce(status = 'VERY_SHORT', false) AS INTEGER) AS n,
        concat_ws('|', CASE WHEN cleaned < 3000 THEN 'LOW_CLEANED_TEXT' END, CASE WHEN page_count > 0 AND cleaned * 1.0::DOUBLE / page_count < 500 THEN 'LOW_TEXT_PER_PAGE' END, CASE WHEN repeated >= 80 THEN 'HIGH_REPEATED_LINES' END, CASE WHEN korean < 0.15 THEN 'LOW_KOREAN_RATIO' END, CASE WHEN status = 'VERY_SHORT' THEN 'PREPROCESS_VERY_SHORT' END) AS signals FROM j),
    v AS (SELECT *, CASE WHEN n >= 3 THEN 'HIGH_RISK' WHEN n = 2 THEN 'REVIEW' WHEN n = 1 THEN 'CHECK' ELSE 'OK' END AS risk, CASE WHEN page_count > 0 THEN cleaned * 1.0::DOUBLE / page_count END AS per_page FROM s)"""


def _risk(p, s):
    solid = F.regexp_replace("content", r"[ \t\n\r]", "")
    k = s.where("content is not null").groupBy("paper_id").agg(F.sum(F.length("content")).alias("cleaned"), F.sum(F.length(F.regexp_replace("content", "[^가-힣]", ""))).alias("ko"), F.sum(F.length(solid)).alias("solid"))
    r = lines.repeated_lines(s, "paper_id", "content").groupBy("paper_id").agg(F.sum("n").alias("repeated"))
    j = p.select("paper_id", "page_count", "text_chars").distinct().join(k, "paper_id").join(r, "paper_id", "left").na.fill(0, ["repeated"])
    status = F.when(c("text_chars") < 1000, "LOW_TEXT").when(c("text_chars") < 3000, "VERY_SHORT").otherwise("OK")
    j = j.withColumn("signals", identify.extraction_signals(c("cleaned"), c("page_count"), c("repeated"), text.safe_ratio(c("ko"), c("solid")), status))
    return j.withColumn("risk", identify.extraction_risk(c("signals"))).withColumn("per_page", F.when(c("page_count") > 0, c("cleaned") / c("page_count")))


@query("papers_verified", "paper_sections", sql=_RISK + " SELECT paper_id, signals, risk FROM v")
def extraction_signals(p, s):
    return _risk(p, s).select("paper_id", F.array_join("signals", "|").alias("signals"), "risk")


@query("papers_verified", "paper_sections", sql=_RISK + " SELECT paper_id, risk FROM v WHERE risk <> 'OK' ORDER BY CASE risk WHEN 'HIGH_RISK' THEN 0 WHEN 'REVIEW' THEN 1 ELSE 2 END, coalesce(per_page, 999999), paper_id LIMIT 50")
def risk_order(p, s):
    rank = F.when(c("risk") == "HIGH_RISK", 0).when(c("risk") == "REVIEW", 1).otherwise(2)
    return _risk(p, s).where("risk <> 'OK'").orderBy(rank, F.coalesce("per_page", F.lit(999999.0)), "paper_id").limit(50).select("paper_id", "risk")


@query("paper_sections", sql="SELECT paper_id, count(*) AS pages, CAST(sum(length(content)) AS BIGINT) AS chars, count(*) FILTER (WHERE length(content) >= 150) AS direct, count(*) FILTER (WHERE length(content) BETWEEN 1 AND 149) AS short, count(*) FILTER (WHERE content = '' OR content IS NULL) AS failed FROM paper_sections GROUP BY 1")
def page_sums(s):
    n = F.length("content")
    return s.groupBy("paper_id").agg(F.count("*").alias("pages"), F.sum(n).cast("bigint").alias("chars"), F.count_if(n >= 150).alias("direct"), F.count_if(n.between(1, 149)).alias("short"), F.count_if((c("content") == "") | c("content").isNull()).alias("failed"))


@query("paper_sections", sql="SELECT kind, array_to_string(list_sort(list(section_id)), ',') AS ids FROM (SELECT section_id, CASE WHEN content IS NULL OR trim(content) = '' THEN 'empty' WHEN length(content) < 150 THEN 'too_short' END AS kind FROM paper_sections) t WHERE kind IS NOT NULL GROUP BY 1")
def audit_id_lists(s):
    kind = F.when(c("content").isNull() | (F.trim("content") == ""), "empty").when(F.length("content") < 150, "too_short")
    return s.select(kind.alias("kind"), "section_id").where("kind is not null").groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("section_id")), ",").alias("ids"))


@query("paper_sections", sql="SELECT (SELECT count(*) FROM paper_sections) AS sections, (SELECT string_agg(section || '=' || n, ',' ORDER BY section) FROM (SELECT section, count(*) AS n FROM paper_sections WHERE section IS NOT NULL GROUP BY 1) a) AS by_section, (SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM (SELECT coalesce(text_source, '') AS s, count(*) AS n FROM paper_sections GROUP BY 1) b) AS by_source")
def nested_summary(s):
    """One row: a count and two maps of counts."""

    def counts(col, name):
        g = s.groupBy(col.alias("k")).agg(F.count("*").alias("n")).where("k is not null")
        return g.agg(F.array_join(F.array_sort(F.collect_list(F.concat("k", F.lit("="), c("n").cast("string")))), ",").alias(name))

    one = s.agg(F.count("*").alias("sections"))
    return one.crossJoin(F.broadcast(counts(c("section"), "by_section"))).crossJoin(F.broadcast(counts(F.coalesce("text_source", F.lit("")), "by_source")))  # one row each


@query("papers_verified", sql="SELECT CASE WHEN metadata_confidence IN ('HIGH', 'MEDIUM', 'LOW') THEN metadata_confidence ELSE 'OTHER' END AS confidence, count(*) AS n, round(avg(text_chars), 2) AS mean FROM papers_verified GROUP BY 1")
def confidence_other(p):
    k = F.when(c("metadata_confidence").isin("HIGH", "MEDIUM", "LOW"), c("metadata_confidence")).otherwise("OTHER")
    return p.groupBy(k.alias("confidence")).agg(F.count("*").alias("n"), F.round(F.avg("text_chars"), 2).alias("mean"))


# ---- samples and splits

_SIX = "('introduction', 'literature_review', 'methodology', 'results', 'discussion', 'conclusion')"


@query("paper_sections", sql=f"SELECT section_id, paper_id, section FROM paper_sections WHERE section IN {_SIX} AND trim(content) <> ''")
def usable_sections(s):
    return dataset.usable_sections(s).select("section_id", "paper_id", "section")


@query("paper_split", sql="SELECT paper_id, arg_max(split, _ord) AS split FROM paper_split WHERE paper_id IS NOT NULL AND split IS NOT NULL GROUP BY 1 ORDER BY 1")
def split_ledger(s):
    return dedupe.keep_last(s.where("paper_id is not null and split is not null"), ["paper_id"]).select("paper_id", "split").orderBy("paper_id")


@query("papers_verified", sql="SELECT split, count(*) AS n FROM (SELECT DISTINCT paper_id, CASE WHEN ('0x' || substr(md5('42:' || paper_id), 1, 8))::BIGINT < 644245094 THEN 'validation' ELSE 'train' END AS split FROM papers_verified WHERE paper_id IS NOT NULL) t GROUP BY 1")
def split_union(p):
    d = p.where("paper_id is not null").select("paper_id", dataset.hashed_split(c("paper_id")).alias("split")).distinct()
    return d.where("split = 'train'").unionAll(d.where("split = 'validation'")).groupBy("split").agg(F.count("*").alias("n"))
