"""Queries on texts: cleaning, lines, sections, identification, with the SQL they are checked against."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quillmill.functions import arrays, cleaning, text
from quillmill.functions.udfs import cut_long
from quillmill.operators import identify, metadata
from quillmill.plans.registry import query

c = F.col
# white space of any kind, for DuckDB
_SP = r"[ \t\n\r\x0b\f\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NL = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SP}+|{_SP}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SP}+', ' ', 'g'))"


# ---- cleaning


@query("documents", sql=f"SELECT doc_id, {_squeeze('text')} AS text FROM documents")
def unicode_squeeze(d):
    return d.select("doc_id", text.squeeze(c("text")).alias("text"))


_INLINE = _strip(r"regexp_replace(text, '[ \t]+', ' ', 'g')")
_NO_MARKS = r"regexp_replace(text, '(?i)={3,}\s*PAGE\s+[0-9]+\s*={3,}', ' ', 'g')"


@query("documents", sql=f"SELECT doc_id, {_INLINE} AS text FROM documents")
def inline_squeeze(d):
    return d.select("doc_id", text.inline_squeeze(c("text")).alias("text"))


_LIGHT = rf"regexp_replace(regexp_replace(regexp_replace(text, '{_NL}', chr(10), 'g'), '[ \t]+(\n)|[ \t]+$', '\1', 'g'), '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')"


@query("paper_sections", sql=f"SELECT section_id, {_strip(_LIGHT.replace('text', 'content'))} AS content FROM paper_sections")
def light_clean(s):
    return s.select("section_id", text.light_clean(c("content")).alias("content"))


@query("documents", sql=f"SELECT doc_id, CAST(length(coalesce({_squeeze(_NO_MARKS)}, '')) AS INTEGER) AS chars FROM documents")
def comparable_length(d):
    return d.select("doc_id", F.length(text.for_count(c("text"))).alias("chars"))


@query("documents")
def normalize_text(d):
    return d.select("doc_id", cleaning.normalise(c("text")).alias("text"))


# lines as an ordered list, one row a line, for DuckDB; lines are parted as Python does and the last empty one is dropped
def _lines(table: str, key: str, col: str) -> str:
    x = f"regexp_replace({col}, '{_NL}', chr(10), 'g')"
    return f"SELECT {key}, unnest(string_split(regexp_replace({x}, '\\n$', ''), chr(10))) AS raw, generate_subscripts(string_split(regexp_replace({x}, '\\n$', ''), chr(10)), 1) AS pos FROM {table} WHERE {col} IS NOT NULL AND {col} <> ''"


_LAYOUT = rf"""WITH l AS ({_lines('documents', 'doc_id', r"regexp_replace(replace(text, chr(65279), ''), '(?m)^===== PAGE \d+ =====\s*$', '', 'g')")}),
    r AS (SELECT doc_id, pos, regexp_replace(raw, '{_SP}+$', '') AS line FROM l),
    k AS (SELECT *, lag(line, 1, '') OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM r)
    SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce({_strip('a.t')}, '') END AS text FROM documents d LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t FROM k WHERE line <> '' OR before <> '' GROUP BY 1) a ON d.doc_id = a.doc_id"""


@query("documents", sql=_LAYOUT)
def normalize_layout(d):
    return d.select("doc_id", cleaning.normalise(c("text"), nfkc=False).alias("text"))


_FURNITURE = rf"""WITH l AS ({_lines('documents', 'doc_id', 'text')}), q AS (SELECT doc_id, pos, raw, {_squeeze('raw')} AS k FROM l),
    n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM q),
    f AS (SELECT *, (k <> '' AND length(k) <= 80 AND n >= 2) AS again, (k <> '' AND regexp_full_match(k, '-?\s*\d{{1,4}}\s*-?')) AS lone FROM n)
    SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(g.t, '') END AS text, CASE WHEN d.text IS NOT NULL THEN coalesce(g.gone, 0) ELSE 0 END AS removed
    FROM documents d LEFT JOIN (SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT again AND NOT lone) AS t, CAST(count(*) FILTER (WHERE again OR lone) AS INTEGER) AS gone FROM f GROUP BY 1) g ON d.doc_id = g.doc_id"""


@query("documents", sql=_FURNITURE)
def remove_repeated_lines(d):
    f = cleaning.drop_furniture(c("text"), often=2)
    return d.select("doc_id", f.alias("f")).select("doc_id", "f.text", "f.removed")


# the section that a line opens, for DuckDB: as it stands, then without its number
def _ladder(x: str) -> str:
    arms = []
    for name, words in cleaning.SECTION_WORDS.items():
        arms.append(f"WHEN (length({x}) <= {cleaning.PART} AND regexp_matches({x}, '(?i){'|'.join(words)}')) OR ({' OR '.join(f'''regexp_full_match({x}, '(?i){w}')''' for w in words)}) THEN '{name}'")
    return f"CASE {' '.join(arms)} END"


def _section_of(x: str) -> str:
    whole = _squeeze(x)
    bare = rf"regexp_replace({whole}, '(?i){cleaning.HEADING_NUMBER}', '')"
    trimmed = lambda v: f"trim({v}, ' .:-–—')"
    return f"CASE WHEN length({whole}) BETWEEN 1 AND {cleaning.WHOLE} AND regexp_matches({whole}, '(?i){'|'.join(w for ws in cleaning.SECTION_WORDS.values() for w in ws)}') THEN coalesce({_ladder(trimmed(whole))}, {_ladder(trimmed(bare))}) END"


_REPAIRED = rf"""WITH l AS ({_lines('documents', 'doc_id', 'text')}), q AS (SELECT doc_id, pos, raw, {_strip('raw')} AS x FROM l),
    h AS (SELECT *, (x <> '' AND (length(x) <= 2 OR raw LIKE '%' || chr(9) || '%' OR {_section_of('x')} IS NOT NULL)) AS alone FROM q),
    p AS (SELECT *, lag(x, 1, '') OVER w AS px, lag(alone, 1, true) OVER w AS pa FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    o AS (SELECT *, CASE WHEN x = '' OR alone OR pa OR px = '' OR regexp_matches(px, '[.!?。！？]$') THEN 1 ELSE 0 END AS opens FROM p),
    g AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS seg FROM o),
    s AS (SELECT doc_id, seg, string_agg(x, ' ' ORDER BY pos) AS line FROM g GROUP BY 1, 2),
    b AS (SELECT *, lag(line, 1, '') OVER (PARTITION BY doc_id ORDER BY seg) AS before FROM s)"""


@query("documents", sql=_REPAIRED + rf" SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce({_strip('a.t')}, '') END AS text FROM documents d LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY seg) AS t FROM b WHERE line <> '' OR before <> '' GROUP BY 1) a ON d.doc_id = a.doc_id")
def line_repair(d):
    return d.select("doc_id", cleaning.repair_lines(c("text")).alias("text"))


_SECTIONED = rf"""WITH l AS ({_lines('documents', 'doc_id', 'text')}), h AS (SELECT doc_id, pos, raw, {_section_of('raw')} AS head FROM l),
    g AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY pos) AS sec FROM h),
    s AS (SELECT doc_id, sec, coalesce(max(head), 'front_matter') AS section, {_strip("max(CASE WHEN head IS NOT NULL THEN raw END)")} AS title, {_strip("string_agg(CASE WHEN head IS NULL THEN raw END, chr(10) ORDER BY pos)")} AS content FROM g GROUP BY 1, 2)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sec) AS INTEGER) AS section_no, section, title, content FROM s WHERE content <> ''"""


@query("documents", sql=_SECTIONED)
def sectionize(d):
    s = d.where("text is not null").select("doc_id", F.posexplode(cleaning.split_sections(c("text"))).alias("n", "s"))
    return s.select("doc_id", (c("n") + 1).alias("section_no"), "s.*")


@query("documents", sql=f"WITH x AS ({_SECTIONED}) SELECT doc_id, string_agg(DISTINCT section, ',' ORDER BY section) AS sections FROM x WHERE section <> 'front_matter' GROUP BY 1")
def section_sets(d):
    s = d.where("text is not null").select("doc_id", F.array_sort(F.array_distinct(F.transform(cleaning.split_sections(c("text")), lambda x: x["section"]))).alias("s"))
    return s.select("doc_id", F.array_join(F.array_remove("s", "front_matter"), ",").alias("sections")).where("sections <> ''")


# ---- functions on text


def _doi(x: str, form: str) -> str:
    p, tail = text.DOI_FORMS[form]
    p, group = (p.replace(r"(?<=doi\.org/)", r"doi\.org/("), 1) if "(?<=" in p else (p, 0)
    p = p + ")" if group else p
    return f"nullif(regexp_replace(regexp_extract({x}, '{p}', {group}), '[{''.join(chr(92) + t for t in tail)}]+$', ''), '')"


@query("papers_verified", sql=f"SELECT _ord, {', '.join(f'''{_doi('doi', n)} AS {n}''' for n in text.DOI_FORMS)} FROM papers_verified")
def doi_forms(p):
    return p.select("_ord", *[text.doi_by(c("doi"), n).alias(n) for n in text.DOI_FORMS])


@query("papers_verified", sql=r"""SELECT _ord, array_to_string(list_sort(list_distinct([upper(x) FOR x IN regexp_extract_all(concat_ws(' ', kci_id, evidence, source_filename), '(^|[^\p{L}\p{N}_])((?i)ART[0-9]{6,})\b', 2)])), ',') AS ids FROM papers_verified""")
def kci_id_extract(p):
    return p.select("_ord", F.array_join(text.kci_ids(F.concat_ws(" ", "kci_id", "evidence", "source_filename")), ",").alias("ids"))


_YEARS = r"SELECT doc_id, CAST(y AS INTEGER) AS y, pos FROM (SELECT doc_id, unnest(ys) AS y, generate_subscripts(ys, 1) AS pos FROM (SELECT doc_id, regexp_extract_all(regexp_replace(substr(text, 1, 15000), '[0-9]+', ' \0 ', 'g'), ' ((19|20)[0-9]{2}) ', 1) AS ys FROM documents) t) u WHERE CAST(y AS INTEGER) BETWEEN 1980 AND 2030"


@query("documents", sql=f"SELECT doc_id, y AS year, count(*) AS n FROM ({_YEARS}) t GROUP BY 1, 2")
def year_candidates(d):
    return d.select("doc_id", F.explode(text.years(text.head(c("text"), 15000))).alias("year")).groupBy("doc_id", "year").agg(F.count("*").alias("n"))


@query("documents", sql=f"SELECT doc_id, y AS year FROM (SELECT doc_id, y, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(pos)) AS r FROM ({_YEARS}) t GROUP BY 1, 2) z WHERE r = 1")
def head_year(d):
    return d.select("doc_id", text.commonest(text.years(text.head(c("text"), 15000))).alias("year")).where("year is not null")


@query("kci_oai_all", sql=r"SELECT _ord, CASE WHEN y BETWEEN 1980 AND 2030 THEN y END AS year FROM (SELECT _ord, CAST(nullif(regexp_extract(publication_date, '(^|[^0-9])((19|20)[0-9]{2})($|[^0-9])', 2), '') AS INTEGER) AS y FROM kci_oai_all) t")
def bounded_year(k):
    y = F.regexp_extract("publication_date", "(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1)
    return k.select("_ord", F.when(y.cast("int").between(1980, 2030), y.cast("int")).alias("year"))


@query("documents", sql="SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || ' ...' ELSE text END AS text FROM documents")
def previews(d):
    return d.select("doc_id", text.preview(c("text"), 500).alias("text"))


@query("paper_sections", sql=r"SELECT section_id, nullif(regexp_extract('The answer is:' || chr(10) || '```json' || chr(10) || to_json({'section': section, 'n': section_no}) || chr(10) || '```', '(?s)\{.*\}', 0), '') AS found, section, section_no AS n FROM paper_sections")
def json_in_text(s):
    inside = F.to_json(F.struct("section", c("section_no").alias("n")), {"ignoreNullFields": "false"})
    t = s.select("section_id", text.json_object(F.concat(F.lit("The answer is:\n```json\n"), inside, F.lit("\n```"))).alias("found"))
    return t.withColumn("j", F.from_json("found", "section string, n int")).select("section_id", "found", "j.section", "j.n")


@query("papers_verified", sql=r"SELECT _ord, array_to_string(list_distinct_first, '|') AS people FROM (SELECT _ord, [x FOR x, i IN l IF list_position(l, x) = i] AS list_distinct_first FROM (SELECT _ord, [trim(x) FOR x IN regexp_split_to_array(array_to_string(authors, '; '), '[,;|·]') IF trim(x) <> ''] AS l FROM papers_verified) t) u")
def author_split(p):
    return p.select("_ord", F.array_join(arrays.split_people(F.array_join("authors", "; ")), "|").alias("people"))


@query("kci_oai_all", sql="SELECT _ord, array_to_string(list_sort(list_distinct(keywords)), '|') AS keywords FROM kci_oai_all")
def sorted_keywords(k):
    return k.select("_ord", F.array_join(F.array_sort(F.array_distinct("keywords")), "|").alias("keywords"))


@query("kci_oai_all", sql="SELECT _ord, array_to_string([x FOR x, i IN l IF list_position([lower(y) FOR y IN l], lower(x)) = i], ' | ') AS keywords FROM (SELECT _ord, [trim(x) FOR x IN coalesce(keywords, []) IF trim(x) <> ''] AS l FROM kci_oai_all) t")
def ordered_ci_distinct(k):
    return k.select("_ord", F.array_join(arrays.distinct_ci(F.coalesce("keywords", F.array().cast("array<string>"))), " | ").alias("keywords"))


@query("kci_oai_all", sql="SELECT _ord, array_to_string([x FOR x, i IN l IF list_position([lower(y) FOR y IN l], lower(x)) = i], ' | ') AS merged FROM (SELECT _ord, [trim(x) FOR x IN list_concat(coalesce(keywords, []), coalesce(authors, [])) IF trim(x) <> ''] AS l FROM kci_oai_all) t")
def ordered_union(k):
    return k.select("_ord", F.array_join(arrays.union_ci(c("keywords"), c("authors")), " | ").alias("merged"))


@query("kci_oai_all", sql="SELECT _ord, CASE WHEN length(t) > 1 THEN len(list_distinct([substr(t, i, 2) FOR i IN range(1, length(t))])) WHEN length(t) = 1 THEN 1 ELSE 0 END::INTEGER AS n FROM (SELECT _ord, regexp_replace(lower(title), '[^0-9a-z가-힣]', '', 'g') AS t FROM kci_oai_all WHERE title IS NOT NULL) x")
def bigram_sets(k):
    return k.where("title is not null").select("_ord", F.size(arrays.bigrams(text.title_key(c("title")))).alias("n"))


# ---- identification

_IN = lambda x, words: " + ".join(f"CAST(contains({x}, '{w}') AS INTEGER)" for w in words)
_COMPACT = r"regexp_replace(text, '\s+', '', 'g')"


@query("documents", sql=rf"""SELECT doc_id, ({_IN(_INLINE, identify.LICENCE)}) >= 2 AS licence, regexp_matches({_INLINE}, '목\s*차') OR (contains(upper({_INLINE}), 'CONTENTS') AND length({_INLINE}) < 10000) AS contents,
    CASE WHEN contains({_COMPACT}, '국문요약') OR contains({_COMPACT}, '국문초록') THEN 'KOREAN_ABSTRACT' WHEN regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])ABSTRACT([^\p{{L}}\p{{N}}_]|$)') THEN 'ENGLISH_ABSTRACT' END AS abstract,
    {" + ".join(f"CAST(regexp_matches(text, '{p}') AS INTEGER)" for p in identify.THESIS)} AS thesis,
    CASE WHEN contains({_COMPACT}, '박사학위논문') THEN 'DOCTORAL' WHEN contains({_COMPACT}, '석사학위논문') THEN 'MASTER' END AS degree FROM documents WHERE text IS NOT NULL""")
def page_predicates(d):
    t = c("text")
    return d.where("text is not null").select("doc_id", identify.licence_page(t).alias("licence"), identify.contents_page(t).alias("contents"), identify.abstract_type(t).alias("abstract"), identify.thesis_score(t).alias("thesis"), identify.degree(t).alias("degree"))


@query("documents", sql=r"""SELECT doc_id, CASE WHEN regexp_matches(h, '박사\s*학위\s*논문') THEN 'doctoral_thesis' WHEN regexp_matches(h, '석사\s*학위\s*논문') THEN 'master_thesis' WHEN contains(h, '학위논문') AND contains(h, '대학원') THEN 'thesis'
    WHEN regexp_matches(h, '연구보고서|정책보고서|정책연구|연구 보고서') THEN 'report' WHEN regexp_matches(h, '(?i)Abstract|초록|국문초록|국문요약|Keywords|주제어') THEN 'journal_article' ELSE 'unknown' END AS type FROM (SELECT doc_id, substr(text, 1, 20000) AS h FROM documents) t""")
def document_types(d):
    return d.select("doc_id", identify.document_type(c("text")).alias("type"))


_BADLINE = lambda x: rf"(length({x}) NOT BETWEEN 4 AND 180 OR ({_IN(f'lower({x})', tuple(w.lower() for w in identify.NO_TITLE))}) > 0 OR regexp_matches({x}, '^\d{{4}}\s*년') OR length(regexp_replace({x}, '[^가-힣A-Za-z]', '', 'g')) < 3)"


@query("paper_sections", sql=rf"WITH l AS ({_lines('paper_sections', 'section_id', 'content')}) SELECT section_id, count(*) AS lines, count(*) FILTER (WHERE {_BADLINE(_strip('raw'))}) AS no_titles FROM l GROUP BY 1")
def no_title_lines(s):
    t = s.where("content <> ''").select("section_id", F.explode(F.split(F.regexp_replace(F.regexp_replace("content", text.NEWLINE, "\n"), r"\n\z", ""), "\n")).alias("x"))
    return t.groupBy("section_id").agg(F.count("*").alias("lines"), F.count_if(identify.no_title_line(c("x"))).alias("no_titles"))


@query("papers_verified", sql=rf"SELECT _ord, length(t) >= 8 AND ({_IN('lower(t)', identify.TOOLS)}) = 0 AND NOT contains(t, chr(92)) AND NOT ends_with(lower(t), '.docx') AS ok FROM (SELECT _ord, {_INLINE.replace('text', 'title')} AS t FROM papers_verified) x")
def property_titles(p):
    return p.select("_ord", identify.tool_free_title(c("title")).alias("ok"))


_SCORE = rf"""CASE WHEN length(title) BETWEEN 15 AND 120 THEN 4 WHEN length(title) BETWEEN 8 AND 180 THEN 2 ELSE 0 END + {_IN('lower(title)', tuple(w.lower() for w in identify.TITLE_WORDS))} + CAST(contains(title, ':') AS INTEGER)
    + CASE WHEN length(regexp_replace(title, '[^가-힣]', '', 'g')) >= 5 THEN 2 ELSE 0 END - CASE WHEN length(regexp_replace(title, '[^A-Za-z]', '', 'g')) > 3 * length(regexp_replace(title, '[^가-힣]', '', 'g')) THEN 1 ELSE 0 END - 10 * ({_IN('title', identify.BAD_WORDS)})"""


@query("papers_verified", sql=f"SELECT _ord, {_SCORE} AS score FROM papers_verified")
def title_scores(p):
    return p.select("_ord", identify.title_score(c("title")).alias("score"))


# candidates in the order in which they are taken: single lines, pairs, triples
_GRAMS = rf"""WITH l0 AS ({_lines('paper_sections', 'section_id', 'content')}), l1 AS (SELECT section_id, pos, {_squeeze('raw')} AS t FROM l0),
    l AS (SELECT section_id, t, row_number() OVER (PARTITION BY section_id ORDER BY pos) AS i FROM l1 WHERE t <> ''),
    b AS (SELECT section_id, i, t, NOT {_BADLINE('t')} AS ok FROM l WHERE i <= 40),
    w AS (SELECT *, lead(t, 1) OVER v AS t2, lead(ok, 1) OVER v AS ok2, lead(t, 2) OVER v AS t3, lead(ok, 2) OVER v AS ok3 FROM b WINDOW v AS (PARTITION BY section_id ORDER BY i)),
    g AS (SELECT section_id, 1 AS size, i, t AS title FROM w WHERE ok AND length(t) <= 180
        UNION ALL SELECT section_id, 2, i, t || ' ' || t2 FROM w WHERE ok AND ok2 AND i <= 30 AND length(t || ' ' || t2) <= 220
        UNION ALL SELECT section_id, 3, i, t || ' ' || t2 || ' ' || t3 FROM w WHERE ok AND ok2 AND ok3 AND i <= 20 AND length(t || ' ' || t2 || ' ' || t3) <= 250),
    u AS (SELECT *, row_number() OVER (PARTITION BY section_id, lower(regexp_replace(title, '\s+', '', 'g')) ORDER BY size, i) AS d FROM g),
    n AS (SELECT section_id, title, row_number() OVER (PARTITION BY section_id ORDER BY size, i) AS pos FROM u WHERE d = 1),
    top AS (SELECT * FROM n WHERE pos <= 20)"""


@query("paper_sections", sql=_GRAMS + " SELECT section_id, CAST(pos AS INTEGER) AS pos, title FROM top")
def title_candidates(s):
    t = s.where("content <> ''").select("section_id", F.posexplode(identify.title_candidates(c("content"))).alias("p", "title"))
    return t.select("section_id", (c("p") + 1).alias("pos"), "title")


@query("paper_sections", sql=_GRAMS + rf""", p AS (SELECT s.paper_id, s.section_id AS page, top.pos, top.title, {_SCORE.replace('title', 'top.title')} AS score FROM top JOIN paper_sections s ON s.section_id = top.section_id WHERE s.paper_id IS NOT NULL),
    q AS (SELECT *, row_number() OVER (PARTITION BY paper_id, lower(regexp_replace(title, '\s+', '', 'g')) ORDER BY score DESC, page, pos) AS d FROM p),
    r AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY score DESC, page, length(title) DESC, pos) AS rank FROM q WHERE d = 1)
    SELECT paper_id, CAST(rank AS INTEGER) AS rank, title, score, page FROM r WHERE rank <= 10""")
def best_titles(s):
    return identify.best_titles(s.where("paper_id is not null and content <> ''"), "paper_id", "section_id", "content")


@query("paper_sections")
def identify_documents(s):
    return identify.identified(s.where("paper_id is not null").withColumn("page", c("section_no")), "paper_id", "page", "content")


_HEADINGS = rf"WITH l AS ({_lines('paper_sections', 'section_id', 'content')}), x AS (SELECT section_id, pos, {_strip('raw')} AS t FROM l), h AS (SELECT * FROM x WHERE t <> '' AND length(t) <= 100 AND NOT regexp_matches(t, '^[\d\s\-–—·.]+$') AND regexp_matches(t, '(?i){'|'.join(f'(?:{p})' for p in identify.HEADING_FORMS)}'))"


@query("paper_sections", sql=_HEADINGS + " SELECT section_id, count(*) AS n, min(t) AS least FROM h GROUP BY 1")
def heading_candidates(s):
    t = s.where("content <> ''").select("section_id", F.explode(F.filter(F.split("content", text.NEWLINE), identify.heading_candidate)).alias("t"))
    return t.select("section_id", text.stripped(c("t")).alias("t")).groupBy("section_id").agg(F.count("*").alias("n"), F.min("t").alias("least"))


@query("paper_sections", sql=_HEADINGS + " SELECT t AS heading, count(*) AS n FROM h GROUP BY 1 ORDER BY n DESC, min(section_id * 100000 + pos), heading LIMIT 100")
def common_headings(s):
    t = s.where("content <> ''").select("section_id", F.posexplode(F.split("content", text.NEWLINE)).alias("pos", "t")).where(identify.heading_candidate(c("t")))
    t = t.select(text.stripped(c("t")).alias("heading"), (c("section_id") * 100000 + c("pos") + 1).alias("at"))
    return t.groupBy("heading").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy(F.desc("n"), "first", "heading").limit(100).select("heading", "n")


@query("paper_sections", sql=_HEADINGS + ", r AS (SELECT *, row_number() OVER (PARTITION BY section_id ORDER BY pos) AS i FROM (SELECT section_id, t, min(pos) AS pos FROM h GROUP BY 1, 2) z) SELECT section_id, string_agg(t, ' | ' ORDER BY pos) AS headings FROM r WHERE i <= 40 GROUP BY 1")
def heading_slices(s):
    h = F.slice(F.array_distinct(F.transform(F.filter(F.split("content", text.NEWLINE), identify.heading_candidate), text.stripped)), 1, 40)
    return s.where("content <> ''").select("section_id", h.alias("h")).where(F.size("h") > 0).select("section_id", F.array_join("h", " | ").alias("headings"))


@query("papers_verified", "paper_sections", sql=r"""WITH t AS (SELECT paper_id, string_agg(content, chr(10) ORDER BY section_no, section_id) AS whole FROM paper_sections WHERE content <> '' AND paper_id IS NOT NULL GROUP BY 1),
    k AS (SELECT p._ord, regexp_replace(lower(p.title), '[^0-9a-z가-힣]', '', 'g') AS k, regexp_replace(lower(substr(t.whole, 1, 30000)), '[^0-9a-z가-힣]', '', 'g') AS w FROM papers_verified p JOIN t ON p.paper_id = t.paper_id)
    SELECT _ord, coalesce(length(k) >= 8 AND contains(w, k), false) AS present FROM k""")
def title_in_text(p, s):
    whole = s.where("content <> '' and paper_id is not null").groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("section_no", "section_id", "content"))).alias("l"))
    whole = whole.select("paper_id", F.array_join(F.transform("l", lambda x: x["content"]), "\n").alias("whole"))
    return p.join(whole, "paper_id").select("_ord", identify.title_present(c("title"), c("whole")).alias("present"))


@query("papers_verified", "kci_oai_all", "paper_sections")
def title_resolution(p, k, s):
    from quillmill.operators import dedupe

    whole = s.where("content <> '' and paper_id is not null").groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("section_no", "section_id", "content"))).alias("l"))
    whole = whole.select("paper_id", F.array_join(F.transform("l", lambda x: x["content"]), "\n").alias("whole"))
    d = p.select("paper_id", "title", "source_filename").distinct().withColumn("file_title", text.file_title(c("source_filename")))
    index = k.where("title <> '' and article_id <> ''").select("article_id", text.title_key(c("title")).alias("u"), c("title").alias("index_title"), "_ord")
    m = dedupe.best_match(d.select("paper_id", text.title_key(c("title")).alias("t")).dropDuplicates(["paper_id"]), "paper_id", "t", index, "article_id", "u", "_ord")
    m = m.join(dedupe.keep_first(index.select("article_id", "index_title", "_ord"), ["article_id"]).drop("_ord"), "article_id")
    j = d.join(m, "paper_id", "left").join(whole, "paper_id", "left")
    r = identify.title_resolution(c("index_title"), c("similarity"), c("file_title"), c("title"), F.coalesce("whole", F.lit("")))
    return j.select("paper_id", r.alias("r")).select("paper_id", "r.*").distinct()


@query("papers_verified", sql="""SELECT _ord, CASE WHEN b >= 3000 THEN 'RECOVERABLE' WHEN b >= 500 THEN 'PARTIAL_TEXT_AVAILABLE' WHEN page_count > 0 AND 4 >= greatest(1, floor(page_count * 0.5)) THEN 'LIKELY_SCANNED' WHEN b = 0 THEN 'NO_TEXT_LAYER' ELSE 'VERY_LOW_TEXT' END AS diagnosis
    FROM (SELECT _ord, page_count, greatest(coalesce(text_chars, 0) // 2, coalesce(text_chars, 0) - 900, 0) AS b FROM papers_verified) t""")
def low_text_diagnosis(p):
    n = F.coalesce("text_chars", F.lit(0))
    return p.select("_ord", identify.low_text_diagnosis([F.floor(n / 2), n - 900, F.lit(0)], c("page_count"), F.lit(4)).alias("diagnosis"))


@query("papers_verified", sql="SELECT _ord, CASE WHEN sha256 IS NULL THEN 'OPEN_ERROR' WHEN document_type = 'report' THEN 'ENCRYPTED' WHEN coalesce(page_count, 0) = 0 THEN 'EMPTY_PDF' WHEN coalesce(text_chars, 0) = 0 THEN 'NO_TEXT' WHEN text_chars < 500 THEN 'VERY_LOW_TEXT' ELSE 'OK' END AS status FROM papers_verified")
def file_statuses(p):
    return p.select("_ord", identify.file_status(c("page_count"), c("text_chars"), F.coalesce(c("document_type") == "report", F.lit(False)), c("sha256").isNull()).alias("status"))


@query("papers_verified", "kci_oai_all", sql="""WITH k AS (SELECT article_id, abstract FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY _ord DESC) AS r FROM kci_oai_all WHERE article_id <> '') t WHERE r = 1)
    SELECT p._ord, CASE WHEN trim(k.abstract) <> '' THEN 'ABSTRACT' WHEN trim(p.evidence) <> '' THEN 'EVIDENCE' WHEN trim(p.title) <> '' THEN 'TITLE' END AS source, CASE WHEN trim(k.abstract) <> '' THEN k.abstract WHEN trim(p.evidence) <> '' THEN p.evidence WHEN trim(p.title) <> '' THEN p.title END AS value FROM papers_verified p LEFT JOIN k ON p.kci_id = k.article_id""")
def text_source(p, k):
    from quillmill.operators import dedupe

    last = dedupe.keep_last(k.where("article_id <> ''").select(c("article_id").alias("kci_id"), "abstract", "_ord"), ["kci_id"]).drop("_ord")
    return p.join(last, "kci_id", "left").select("_ord", metadata.source_of(("ABSTRACT", c("abstract")), ("EVIDENCE", c("evidence")), ("TITLE", c("title"))).alias("s")).select("_ord", "s.*")


@query("documents", sql="SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents WHERE text IS NOT NULL")
def cut_sentences(d):
    """Pieces of whole texts as over-long sentences are cut; put together again without blanks they have the text's letters."""

    @pandas_udf("int")
    def kept(t: pd.Series) -> pd.Series:
        return t.map(lambda x: len(x) if "".join("".join(cut_long(x)).split()) == "".join(x.split()) else -1)

    return d.where("text is not null").select("doc_id", kept("text").alias("chars"))
