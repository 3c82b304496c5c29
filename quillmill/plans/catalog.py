"""All queries on the reference's operators, with the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.functions.udfs import nfkc
from quillmill.operators import audit, dataset, dedupe, lines, metadata, relevance
from quillmill.plans import documents, files, records  # noqa: F401 - they register their queries
from quillmill.plans.registry import QUERIES as _QUERIES
from quillmill.plans.registry import SQL as _SQL
from quillmill.plans.registry import Query, query
from quillmill.session import shared_dir, table
from quillmill.sources import oai


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


c = F.col

# ---- text functions


@query("documents", sql="SELECT sha256(text) AS fingerprint, count(*) AS copies, min(doc_id) AS representative FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(docs):
    return dedupe.duplicate_groups(docs, F.sha2("text", 256), "doc_id")


@query("paper_sections", sql=f"SELECT section_id, {documents._squeeze('content')} AS content FROM paper_sections")
def whitespace_normalize(s):
    return s.select("section_id", text.squeeze(c("content")).alias("content"))


@query("papers_verified", sql="SELECT DISTINCT paper_id, regexp_replace(lower(title), '[^0-9a-z가-힣]', '', 'g') AS title_key FROM papers_verified WHERE title IS NOT NULL")
def title_key(p):
    return p.where("title is not null").select("paper_id", text.title_key(c("title")).alias("title_key")).distinct()


@query("papers_verified")
def title_key_folded(p):
    return p.where("title is not null").select("paper_id", text.title_key(nfkc("title")).alias("title_key")).distinct()


_DOI = r"nullif(regexp_replace(regexp_replace(lower(trim(doi)), '^(https?://(dx\.)?doi\.org/|doi: ?)', ''), '[.,;)]+$', ''), '')"


@query("papers_verified", sql=f"SELECT _ord, {_DOI} AS doi FROM papers_verified")
def doi_normalize(p):
    return p.select("_ord", text.doi_normal(c("doi")).alias("doi"))


@query("papers_verified", sql=r"""SELECT _ord, nullif(regexp_replace(regexp_extract(lower(doi), '10\.[0-9]{4,9}/[^ "<>]+', 0), '[.,;)]+$', ''), '') AS doi FROM papers_verified""")
def doi_extract(p):
    return p.select("_ord", text.doi_found(c("doi")).alias("doi"))


@query("kci_oai_all", sql="""SELECT _ord, CASE WHEN y BETWEEN 1900 AND 2030 THEN y END AS year FROM (
    SELECT _ord, CAST(nullif(regexp_extract(publication_year, '((19|20)[0-9]{2})', 1), '') AS INTEGER) AS y FROM kci_oai_all) t""")
def year_extract(k):
    return k.select("_ord", text.year_found(c("publication_year")).alias("year"))


@query("papers_verified", sql=rf"""SELECT _ord, regexp_replace(regexp_replace(regexp_replace({documents._squeeze('title')}, ' ?: ?', ': ', 'g'), '\( ', '(', 'g'), ' \)', ')', 'g') AS title FROM papers_verified""")
def title_polish(p):
    return p.select("_ord", text.polish_title(c("title")).alias("title"))


@query("papers_verified", sql="SELECT _ord, CASE WHEN trim(doi) <> '' AND lower(trim(doi)) NOT IN ('null', 'none', 'unknown', 'n/a', '없음', '-') THEN trim(doi) END AS doi FROM papers_verified")
def null_literals(p):
    return p.select("_ord", text.null_words(c("doi")).alias("doi"))


@query("documents", sql=r"""SELECT doc_id, CASE WHEN length(s) > 0 THEN length(regexp_replace(s, '[^가-힣]', '', 'g')) * 1.0::DOUBLE / length(s) ELSE 0.0::DOUBLE END AS ratio
    FROM (SELECT doc_id, regexp_replace(text, '[ \t\n\r]', '', 'g') AS s FROM documents WHERE text IS NOT NULL) t""")
def script_ratio(d):
    return d.where("text is not null").select("doc_id", text.hangul_ratio(c("text")).alias("ratio"))


@query("papers_verified", sql=r"""SELECT _ord, CASE WHEN length(t) >= 8 AND NOT regexp_matches(t, '^[A-Za-z0-9 ().-]+$') THEN t END AS candidate FROM (
    SELECT _ord, trim(regexp_replace(regexp_replace(regexp_replace(source_filename, '(?i)\.(pdf|hwp|docx?)$', ''), '_20[0-9]{12,}$', ''), '_', ' ', 'g')) AS t FROM papers_verified) x""")
def filename_title(p):
    return p.select("_ord", text.file_title(c("source_filename")).alias("candidate"))


@query("paper_sections", sql=r"""SELECT section_id, count(*) AS sentences, sum(length(s)) AS chars FROM (
    SELECT section_id, unnest(string_split(regexp_replace(content, '([.!?。！？])[ \t\n\r]+', '\1' || chr(1), 'g'), chr(1))) AS s FROM paper_sections WHERE content IS NOT NULL) t
    WHERE trim(s) <> '' GROUP BY 1""")
def sentence_split(s):
    t = s.where("content is not null").select("section_id", F.explode(text.sentences(c("content"))).alias("s"))
    return t.groupBy("section_id").agg(F.count("*").alias("sentences"), F.sum(F.length("s")).cast("bigint").alias("chars"))


# ---- keeping one record of several


@query("kci_oai_all", sql="""SELECT identifier, _ord, datestamp, title FROM (SELECT *, row_number() OVER (PARTITION BY coalesce('a' || nullif(article_id, ''), 'd' || lower(nullif(doi, '')), 'i' || nullif(identifier, ''), 't' || lower(replace(coalesce(title, ''), ' ', ''))) ORDER BY _ord) AS r FROM kci_oai_all) t WHERE r = 1""")
def first_wins_dedupe(k):
    key = F.coalesce(F.concat(F.lit("a"), F.nullif("article_id", F.lit(""))), F.concat(F.lit("d"), F.lower(F.nullif("doi", F.lit("")))), F.concat(F.lit("i"), F.nullif("identifier", F.lit(""))), F.concat(F.lit("t"), F.lower(F.replace(F.coalesce("title", F.lit("")), F.lit(" "), F.lit("")))))
    return dedupe.keep_first(k.select("identifier", "_ord", "datestamp", "title", key.alias("k_")), ["k_"]).drop("k_")


@query("kci_oai_all", sql="SELECT identifier, datestamp, deleted, title FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY _ord DESC) AS r FROM kci_oai_all) t WHERE r = 1")
def keep_last_compaction(k):
    return dedupe.keep_last(k.select("identifier", "datestamp", "deleted", "title", "_ord"), ["identifier"]).drop("_ord")


@query("papers_verified", sql=f"""WITH m AS (SELECT DISTINCT {_DOI} AS k, paper_id AS member FROM papers_verified WHERE regexp_matches(doi, '10[.][0-9]{{4,5}}/.')),
    g AS (SELECT k, min(member) AS first_member, count(*) AS n FROM m GROUP BY k HAVING count(*) > 1)
    SELECT m.member, g.first_member, m.k AS key, g.n, 'DOI' AS reason FROM m JOIN g ON m.k = g.k""")
def doi_groups(p):
    return dedupe.key_groups(p.where(c("doi").rlike("10[.][0-9]{4,5}/.")), text.doi_normal(c("doi")), "paper_id", "DOI")


_TITLE_KEY = "regexp_replace(lower(title), '[^0-9a-z가-힣]', '', 'g')"


@query("papers_verified", sql=f"""WITH m AS (SELECT DISTINCT {_TITLE_KEY} AS k, paper_id AS member FROM papers_verified WHERE length({_TITLE_KEY}) >= 10),
    g AS (SELECT k, min(member) AS first_member, count(*) AS n FROM m GROUP BY k HAVING count(*) > 1)
    SELECT m.member, g.first_member, m.k AS key, g.n, 'TITLE' AS reason FROM m JOIN g ON m.k = g.k""")
def title_groups(p):
    k = text.title_key(c("title"))
    return dedupe.key_groups(p.where(F.length(k) >= 10), k, "paper_id", "TITLE")


@query("papers_verified")
def duplicate_candidates(p):
    k = text.title_key(c("title"))
    return dedupe.first_reason(dedupe.key_groups(p.where(c("doi").rlike("10[.][0-9]{4,5}/.")), text.doi_normal(c("doi")), "paper_id", "DOI"), dedupe.key_groups(p.where(F.length(k) >= 10), k, "paper_id", "TITLE"))


# ---- relevance

_T = [relevance.DEFAULT.required, *relevance.DEFAULT.core, *relevance.DEFAULT.extra]
_PAT = {t.tag: t.pattern for t in _T}
_HEAD = documents._squeeze("concat_ws(' ', title, title_en, array_to_string(keywords, ' '))")
_BODY = documents._squeeze("concat_ws(' ', title, title_en, abstract, abstract_en, category, array_to_string(keywords, ' '))")
_SCORE = " + ".join(f"CASE WHEN regexp_matches(h, '{_PAT[t.tag]}') THEN {t.in_title} WHEN regexp_matches(b, '{_PAT[t.tag]}') THEN {t.elsewhere} ELSE 0 END" for t in _T)
_REL = f"""WITH x AS (SELECT *, {_HEAD} AS h, {_BODY} AS b FROM kci_oai_all),
    y AS (SELECT *, {_SCORE} AS score, CASE WHEN regexp_matches(b, '{_PAT['PERFORMANCE']}') THEN 'core' ELSE 'high' END AS tier,
        concat_ws('|', {", ".join(f"CASE WHEN regexp_matches(b, '{_PAT[t.tag]}') THEN '{t.tag}' END" for t in relevance.DEFAULT.core)}) AS tech
        FROM x WHERE regexp_matches(b, '{_PAT['SME']}') AND ({" OR ".join(f"regexp_matches(b, '{_PAT[t.tag]}')" for t in relevance.DEFAULT.core)})) """


@query("kci_oai_all", sql=_REL + "SELECT _ord, score, tier, tech FROM y")
def relevance_score(k):
    return relevance.scored(k).select("_ord", "score", "tier", F.array_join("tech_types", "|").alias("tech"))


@query("kci_oai_all", sql=_REL + "SELECT _ord, identifier, score, tier FROM y ORDER BY CASE WHEN tier = 'core' THEN 0 ELSE 1 END, score DESC, coalesce(regexp_extract(publication_year, '([0-9]{4})', 1), '') DESC, _ord LIMIT 50")
def relevance_rank(k):
    d = relevance.scored(k)
    return d.orderBy(*relevance.ranked(d)).limit(50).select("_ord", "identifier", "score", "tier")


@query("kci_oai_all", sql=_REL + "SELECT tier, count(*) AS n, count(*) FILTER (WHERE open_access = 'Y') AS open_access, count(*) FILTER (WHERE tech LIKE '%AI%') AS ai FROM y GROUP BY tier")
def tier_counts(k):
    d = relevance.scored(k)
    return d.groupBy("tier").agg(F.count("*").alias("n"), F.count_if(c("open_access") == "Y").alias("open_access"), F.count_if(F.array_contains("tech_types", "AI")).alias("ai"))


# ---- lines and sections

_LINES = r"SELECT doc_id, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS raw FROM documents WHERE text IS NOT NULL"


@query("papers_verified", "paper_sections", sql="""WITH s AS (SELECT paper_id, CAST(sum(length(content)) AS BIGINT) AS kept, count(DISTINCT section) AS found FROM paper_sections WHERE content <> '' GROUP BY 1),
    p AS (SELECT DISTINCT paper_id, text_chars FROM papers_verified)
    SELECT p.paper_id, CASE WHEN text_chars < 1000 THEN 'LOW_TEXT' WHEN text_chars < 3000 THEN 'VERY_SHORT' WHEN coalesce(found, 0) = 0 THEN 'SECTION_FAILED'
        WHEN coalesce(found, 0) < 2 THEN 'LOW_SECTION_DETECTION' WHEN CASE WHEN text_chars > 0 THEN coalesce(kept, 0) * 1.0::DOUBLE / text_chars ELSE 0 END < 0.35 THEN 'REVIEW' ELSE 'OK' END AS status
    FROM p LEFT JOIN s ON p.paper_id = s.paper_id""")
def quality_status(p, s):
    k = s.where("content <> ''").groupBy("paper_id").agg(F.sum(F.length("content")).alias("kept"), F.count_distinct("section").alias("found"))
    j = p.select("paper_id", "text_chars").distinct().join(k, "paper_id", "left")
    return j.select("paper_id", lines.quality_status(c("text_chars"), F.coalesce("found", F.lit(0)), text.safe_ratio(F.coalesce("kept", F.lit(0)), c("text_chars"))).alias("status"))


@query("papers_verified", "paper_sections", sql="""WITH s AS (SELECT paper_id, sum(length(content)) AS cleaned, sum(CASE WHEN section <> 'front_matter' THEN length(content) ELSE 0 END) AS sectioned FROM paper_sections WHERE content <> '' GROUP BY 1),
    j AS (SELECT p.paper_id, p.text_chars AS raw, s.cleaned, s.sectioned FROM (SELECT DISTINCT paper_id, text_chars FROM papers_verified) p JOIN s ON p.paper_id = s.paper_id),
    r AS (SELECT paper_id, raw, CASE WHEN raw > 0 THEN cleaned * 1.0::DOUBLE / raw ELSE 0 END AS kept, CASE WHEN cleaned > 0 THEN sectioned * 1.0::DOUBLE / cleaned END AS part FROM j)
    SELECT paper_id, CASE WHEN kept < 0.35 OR part < 0.35 THEN 'CRITICAL' WHEN kept < 0.6 OR part < 0.6 THEN 'WARNING' WHEN raw < 3000 THEN 'SOURCE_SHORT' ELSE 'OK' END AS status FROM r""")
def preservation_audit(p, s):
    k = s.where("content <> ''").groupBy("paper_id").agg(F.sum(F.length("content")).alias("cleaned"), F.sum(F.when(c("section") != "front_matter", F.length("content")).otherwise(0)).alias("sectioned"))
    return p.select("paper_id", "text_chars").distinct().join(k, "paper_id").select("paper_id", audit.preservation(c("text_chars"), c("cleaned"), c("sectioned")).alias("status"))


@query("papers_verified", "paper_sections")
def extraction_risk(p, s):
    solid = F.regexp_replace("content", r"[ \t\n\r]", "")
    k = s.groupBy("paper_id").agg(*[F.coalesce(F.sum(F.length(x)), F.lit(0)).alias(n) for n, x in (("all", c("content")), ("all_solid", solid), ("all_hangul", F.regexp_replace(solid, "[^가-힣]", "")))])
    r = lines.removed_lines(s, "paper_id", "content")
    j = p.select("paper_id", "page_count", "text_chars").distinct().join(k, "paper_id").join(r, "paper_id", "left").na.fill(0, ["repeated", "chars", "solid", "hangul"])
    korean = text.safe_ratio(c("all_hangul") - c("hangul"), c("all_solid") - c("solid"))
    j = j.withColumn("signals", audit.risk_signals(c("page_count"), c("text_chars"), F.greatest(c("all") - c("chars"), F.lit(0)), korean, c("repeated")))
    return j.select("paper_id", F.array_join("signals", "|").alias("signals"), audit.risk(c("signals")).alias("status"))


# ---- metadata


@query("papers_verified", sql="SELECT CASE WHEN regexp_replace(upper(trim(metadata_confidence)), '^AI_', '') IN ('HIGH', 'MEDIUM', 'LOW') THEN regexp_replace(upper(trim(metadata_confidence)), '^AI_', '') ELSE 'LOW' END AS confidence, count(*) AS n FROM papers_verified GROUP BY 1")
def confidence_histogram(p):
    return p.groupBy(metadata.confidence(c("metadata_confidence")).alias("confidence")).agg(F.count("*").alias("n"))


@query("papers_verified", sql="SELECT document_type, count(*) AS n, count(*) FILTER (WHERE title IS NULL OR trim(title) = '') AS no_title, count(*) FILTER (WHERE year IS NULL) AS no_year, min(text_chars) AS least, max(text_chars) AS most FROM papers_verified GROUP BY 1")
def status_histogram(p):
    return p.groupBy("document_type").agg(F.count("*").alias("n"), F.count_if(text.nonempty(c("title")).isNull()).alias("no_title"), F.count_if(c("year").isNull()).alias("no_year"), F.min("text_chars").alias("least"), F.max("text_chars").alias("most"))


_LAST_KCI = "(SELECT article_id, title, doi FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY _ord DESC) AS r FROM kci_oai_all WHERE article_id <> '') t WHERE r = 1)"


@query("papers_verified", "kci_oai_all", sql=f"""SELECT p.paper_id, coalesce(nullif(trim(p.title), ''), nullif(trim(k.title), '')) AS has_title, coalesce(nullif(trim(p.doi), ''), nullif(trim(k.doi), '')) AS has_doi, CASE WHEN k.article_id IS NOT NULL THEN 'kci' ELSE 'UNRESOLVED' END AS merged_from
    FROM (SELECT DISTINCT paper_id, title, doi, kci_id FROM papers_verified) p LEFT JOIN {_LAST_KCI} k ON p.kci_id = k.article_id""")
def metadata_merge(p, k):
    last = dedupe.keep_last(k.where("article_id <> ''").select(c("article_id").alias("kci_id"), "title", "doi", "_ord"), ["kci_id"])
    base = p.select("paper_id", "title", "doi", "kci_id").distinct()
    m = metadata.precedence_merge(base, [("kci", last)], "kci_id", ["title", "doi"])
    return m.select("paper_id", F.trim("title").alias("has_title"), F.trim("doi").alias("has_doi"), "merged_from")


@query("papers_verified", "kci_oai_all", sql=f"""WITH a AS (SELECT DISTINCT p.paper_id, {_TITLE_KEY.replace('title', 'p.title')} AS x, {_TITLE_KEY.replace('title', 'k.title')} AS y FROM papers_verified p JOIN {_LAST_KCI} k ON p.kci_id = k.article_id WHERE p.title <> '' AND k.title <> '')
    SELECT paper_id, count(*) AS n, sum(CASE WHEN x = y THEN 1 ELSE 0 END) AS same FROM a GROUP BY paper_id""")
def title_check(p, k):
    last = dedupe.keep_last(k.where("article_id <> ''").select(c("article_id").alias("kci_id"), c("title").alias("k_title"), "_ord"), ["kci_id"])
    j = p.where("title <> ''").join(last.where("k_title <> ''"), "kci_id").select("paper_id", text.title_key(c("title")).alias("x"), text.title_key(c("k_title")).alias("y")).distinct()
    return j.groupBy("paper_id").agg(F.count("*").alias("n"), F.sum((c("x") == c("y")).cast("int")).alias("same"))


@query("papers_verified", "kci_oai_all")
def bigram_best_match(p, k):
    index = k.where("article_id <> '' and title <> ''").select("article_id", text.title_key(c("title")).alias("u"), "_ord")
    own = p.where("title <> ''").select("paper_id", text.title_key(c("title")).alias("t")).distinct()
    return dedupe.best_match(own, "paper_id", "t", index, "article_id", "u", "_ord")


@query("papers_verified", sql="""SELECT _ord, concat_ws('|', CASE WHEN title IS NULL OR trim(title) = '' THEN 'TITLE_MISSING' END, CASE WHEN coalesce(len(authors), 0) = 0 THEN 'AUTHORS_MISSING' END,
    CASE WHEN year IS NULL THEN 'YEAR_MISSING' END, CASE WHEN coalesce(document_type, 'unknown') = 'unknown' THEN 'DOC_TYPE_UNKNOWN' END,
    CASE WHEN metadata_confidence IS NULL OR metadata_confidence NOT IN ('HIGH', 'MEDIUM') THEN 'LOW_CONFIDENCE' END) AS reasons FROM papers_verified""")
def review_reasons(p):
    return p.select("_ord", F.array_join(metadata.review_reasons(), "|").alias("reasons"))


@query("papers_verified", sql="""SELECT _ord, concat_ws('|', CASE WHEN coalesce(document_type, 'unknown') NOT IN ('journal_article', 'master_thesis', 'doctoral_thesis') THEN 'TYPE' END,
    CASE WHEN coalesce(text_chars, 0) < 3000 THEN 'SHORT' END, CASE WHEN title IS NULL OR trim(title) = '' THEN 'NO_TITLE' END) AS reasons FROM papers_verified""")
def training_eligibility(p):
    return p.select("_ord", F.array_join(metadata.eligible_reasons(), "|").alias("reasons"))


@query("papers_verified", "paper_sections", sql="SELECT DISTINCT paper_id FROM papers_verified WHERE paper_id NOT IN (SELECT paper_id FROM paper_sections WHERE paper_id IS NOT NULL)")
def anti_resume(p, s):
    return p.select("paper_id").distinct().join(s.select("paper_id").where("paper_id is not null").distinct(), "paper_id", "left_anti")


@query("customer", "nation", sql="SELECT c.c_custkey, CASE WHEN c.c_custkey % 7 = 0 THEN n.n_name ELSE c.c_name END AS c_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def corrections_update(cu, n):
    fixes = cu.where("c_custkey % 7 = 0").join(F.broadcast(n), c("c_nationkey") == c("n_nationkey")).select("c_custkey", c("n_name").alias("c_name"))
    return metadata.corrected(cu.select("c_custkey", "c_name"), fixes, "c_custkey", ["c_name"])


@query("orders", sql="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0 UNION ALL SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderkey % 11 = 0")
def upsert(o):
    o = o.select("o_orderkey", "o_orderstatus")
    return metadata.upsert(o, o.where("o_orderkey % 11 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")), "o_orderkey")


@query("kci_oai_all", sql="SELECT k AS keyword, count(*) AS n FROM (SELECT unnest(keywords) AS k FROM kci_oai_all) t WHERE k <> '' GROUP BY 1 ORDER BY n DESC, keyword LIMIT 100")
def term_frequency(k):
    t = k.select(F.explode("keywords").alias("keyword")).where("keyword <> ''")
    return t.groupBy("keyword").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "keyword").limit(100)


# ---- harvest, samples, splits


@query("kci_oai_all", sql="SELECT identifier, nullif(trim(datestamp), '') AS datestamp, deleted, CASE WHEN deleted = 'Y' THEN NULL ELSE nullif(trim(title), '') END AS title, CASE WHEN deleted = 'Y' THEN NULL ELSE nullif(trim(doi), '') END AS doi FROM kci_oai_all WHERE identifier <> ''")
def xml_record_parse(k):
    got = oai.parse_records(oai.to_xml(k.where("identifier <> ''")))
    return got.select("identifier", "datestamp", "deleted", "title", "doi")


@query("kci_oai_all", sql="SELECT deleted, metadata_type, count(*) AS n, count(DISTINCT identifier) AS identifiers FROM kci_oai_all GROUP BY 1, 2")
def feed_statistics(k):
    return k.groupBy("deleted", "metadata_type").agg(F.count("*").alias("n"), F.count_distinct("identifier").alias("identifiers"))


@query("documents")
def pack_samples(d):
    return dataset.samples(d, "doc_id", "text")


@query("papers_verified", "paper_sections")
def section_samples(p, s):
    whole = s.where("content <> ''").groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_no", "section_id", "content"))), lambda x: x["content"]), "\n").alias("content"))
    good = s.where("content <> '' and section in ('introduction', 'literature_review', 'methodology', 'results', 'discussion', 'conclusion')")
    return dataset.section_samples(good, whole, "paper_id", "content", least=300, goal=1000, most=1500)


@query("papers_verified", sql="SELECT DISTINCT paper_id, CASE WHEN ('0x' || substr(md5('42:' || paper_id), 1, 8))::BIGINT < 644245094 THEN 'validation' ELSE 'train' END AS split FROM papers_verified WHERE paper_id IS NOT NULL")
def group_split(p):
    return p.where("paper_id is not null").select("paper_id", dataset.hashed_split(c("paper_id")).alias("split")).distinct()


@query("paper_split", sql="SELECT DISTINCT a.paper_id FROM paper_split a JOIN paper_split b ON a.paper_id = b.paper_id WHERE regexp_matches(lower(trim(a.split)), '^tr') AND regexp_matches(lower(trim(b.split)), '^(val|dev)')")
def leakage_check(p):
    low = F.lower(F.trim("split"))
    return dataset.leaked(p.where(low.rlike("^tr")), p.where(low.rlike("^(val|dev)")), "paper_id")


@query("papers_verified", "paper_split", sql="SELECT (SELECT count(*) FROM (SELECT paper_id FROM papers_verified INTERSECT SELECT paper_id FROM paper_split) a) AS both_, (SELECT count(*) FROM (SELECT paper_id FROM papers_verified EXCEPT SELECT paper_id FROM paper_split) b) AS unsplit")
def id_overlap(p, s):
    a, b = p.select("paper_id"), s.select("paper_id")
    both = a.intersect(b).agg(F.count("*").alias("both_"))
    return both.crossJoin(F.broadcast(a.subtract(b).agg(F.count("*").alias("unsplit"))))  # one row each


@query("paper_sections", sql="SELECT count(*) AS sections, count(DISTINCT paper_id) AS papers, min(length(content)) AS least, max(length(content)) AS most, sum(length(content)) * 1.0::DOUBLE / count(content) AS mean, count(*) FILTER (WHERE content = '') AS empty FROM paper_sections")
def summary_report(s):
    n = F.length("content")
    return s.agg(F.count("*").alias("sections"), F.count_distinct("paper_id").alias("papers"), F.min(n).alias("least"), F.max(n).alias("most"), (F.sum(n) / F.count("content")).alias("mean"), F.count_if(c("content") == "").alias("empty"))


@query("paper_sections", sql="""SELECT paper_id, string_agg('===== PAGE ' || r || ' =====' || chr(10) || chr(10) || content, chr(10) || chr(10) ORDER BY r) AS text
    FROM (SELECT paper_id, content, row_number() OVER (PARTITION BY paper_id ORDER BY section_no, section_id) AS r FROM paper_sections WHERE paper_id IS NOT NULL AND content IS NOT NULL) t GROUP BY 1""")
def page_marks(s):
    g = s.where("paper_id is not null and content is not null").groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("section_no", "section_id", "content"))).alias("l"))
    return g.select("paper_id", text.page_joined(F.transform("l", lambda x: x["content"])).alias("text"))


@query("papers_verified", sql="SELECT DISTINCT paper_id, CASE WHEN text_chars >= 3000 THEN 'RECOVERED' WHEN text_chars >= 1000 THEN 'PARTIAL' ELSE 'STILL_LOW' END AS status, page_count, CASE WHEN page_count > 0 THEN text_chars * 1.0::DOUBLE / page_count ELSE 0.0::DOUBLE END AS per_page FROM papers_verified")
def low_text_status(p):
    return p.select("paper_id", audit.recovered_status(c("text_chars")).alias("status"), "page_count", text.safe_ratio(c("text_chars"), c("page_count")).alias("per_page")).distinct()


@query("papers_verified", sql="SELECT sha256, count(*) AS copies, min(source_filename) AS representative FROM papers_verified WHERE sha256 IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def file_duplicates(p):
    return dedupe.duplicate_groups(p, c("sha256"), "source_filename").select(c("fingerprint").alias("sha256"), "copies", "representative")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The harvest as a stream of files into a log, compacted to the last state of each identifier."""
    import uuid

    from quillmill.streaming.ingest import compacted, ingest

    path = f"{sf_dir}/kci_oai_all.parquet"
    schema = spark.read.parquet(path).schema
    at = f"{shared_dir(spark)}/quillmill-ingest-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    files = spark.readStream.schema(schema)
    files = files.parquet(path) if folder else files.option("pathGlobFilter", "kci_oai_all.parquet").parquet(sf_dir)
    ingest(files, f"{at}/log", f"{at}/checkpoint")
    return compacted(spark, f"{at}/log", ["identifier"], "_ord").select("identifier", "datestamp", "deleted", "title")


_QUERIES["stream_ingest"] = stream_ingest
_SQL["stream_ingest"] = _SQL["keep_last_compaction"]
