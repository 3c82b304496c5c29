"""What kind of document a text is, and its title: predicates on pages and lines, candidates, scores, resolution."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from quillmill.functions.arrays import reasons
from quillmill.functions.text import NEWLINE, SPACE, head, inline_squeeze, safe_ratio, squeeze, stripped, title_key
from quillmill.operators.dedupe import bigram_similarity

# Phrases of licence pages, of theses, of lines that are no titles, of titles, and of tools in titles.
LICENCE = ("저작자표시-비영리-변경금지", "이용허락규약", "저작권법에 따른 이용자의 권리", "귀하는 원저작자를 표시하여야 합니다", "영리 목적으로 이용할 수 없습니다", "변경금지")
THESIS = (r"박사\s*학위\s*논문", r"석사\s*학위\s*논문", "박사학위논문", "석사학위논문", r"학위논문으로\s*제출", "대학원", "지도교수")
NO_TITLE = ("저작자표시", "비영리", "변경금지", "이용자는", "이용허락", "저작권", "Disclaimer", "대학원", "지도교수", "학위논문", "논문으로 제출", "국문요약", "국문초록", "Abstract", "목 차", "목차")
TITLE_WORDS = ("영향", "분석", "연구", "효과", "관계", "중소기업", "인공지능", "AI", "디지털", "성과", "효율성", "정책", "도입", "활용")
BAD_WORDS = ("대학교", "대학원", "지도교수", "학위논문", "제출함", "저작자표시", "국문요약", "목차")
TOOLS = ("microsoft word", "hwp", "한글", "untitled", "document", "acrobat", "pdf")
HEADING_FORMS = (
    r"^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+[.\s]", r"^[IVX]{1,8}[.\s]", r"^\d{1,2}\s*[.)]\s*\S+", r"^제\s*\d+\s*장", r"^\d+\s*장", r"^[가-힣]\s*[.)]\s*\S+",
    r"^(?:서\s*론|연구\s*배경|이론적\s*배경|이론적\s*고찰|선행\s*연구|문헌\s*연구|문헌\s*고찰|관련\s*연구|연구\s*방법|연구\s*설계|연구\s*모형|분석\s*방법|연구\s*결과|분석\s*결과|실증\s*분석|논\s*의|고\s*찰|결\s*론|결론\s*및.*|요약\s*및\s*결론|참고\s*문헌|References)$",
)


def _hits(c: Column, words: tuple[str, ...]) -> Column:
    return sum((F.contains(c, F.lit(w)).cast("int") for w in words), F.lit(0))


def _compact(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def licence_page(c: Column, least: int = 2) -> Column:
    return _hits(inline_squeeze(c), LICENCE) >= least


def contents_page(c: Column) -> Column:
    t = inline_squeeze(c)
    return t.rlike(r"목\s*차") | (F.contains(F.upper(t), F.lit("CONTENTS")) & (F.length(t) < 10000))


def abstract_type(c: Column) -> Column:
    """KOREAN_ABSTRACT, ENGLISH_ABSTRACT or NULL."""
    t = _compact(c)
    korean = F.contains(t, F.lit("국문요약")) | F.contains(t, F.lit("국문초록"))
    return F.when(korean, "KOREAN_ABSTRACT").when(c.rlike(r"(?i)(^|[^\p{L}\p{N}_])ABSTRACT([^\p{L}\p{N}_]|$)"), "ENGLISH_ABSTRACT")


def thesis_score(c: Column) -> Column:
    return sum((c.rlike(p).cast("int") for p in THESIS), F.lit(0))


def thesis_or_other(c: Column) -> Column:
    return F.when(thesis_score(c) >= 2, "THESIS").otherwise("JOURNAL_OR_OTHER")


def degree(c: Column) -> Column:
    t = _compact(c)
    return F.when(F.contains(t, F.lit("박사학위논문")), "DOCTORAL").when(F.contains(t, F.lit("석사학위논문")), "MASTER")


def document_type(c: Column, chars: int = 20_000) -> Column:
    """Type by the first phrase, in order of precedence, of the text's head."""
    h = head(c, chars)
    return (
        F.when(h.rlike(r"박사\s*학위\s*논문"), "doctoral_thesis")
        .when(h.rlike(r"석사\s*학위\s*논문"), "master_thesis")
        .when(F.contains(h, F.lit("학위논문")) & F.contains(h, F.lit("대학원")), "thesis")
        .when(h.rlike("연구보고서|정책보고서|정책연구|연구 보고서"), "report")
        .when(h.rlike("(?i)Abstract|초록|국문초록|국문요약|Keywords|주제어"), "journal_article")
        .otherwise("unknown")
    )


def no_title_line(c: Column) -> Column:
    """Whether a line can't be a title: blank, too short or long, a stop phrase, a date, hardly any letters."""
    t = stripped(c)
    low = F.lower(t)
    stop = _hits(low, tuple(w.lower() for w in NO_TITLE)) > 0
    letters = F.length(F.regexp_replace(t, "[^가-힣A-Za-z]", ""))
    return ~F.length(t).between(4, 180) | stop | t.rlike(r"^\d{4}\s*년") | (letters < 3)


def tool_free_title(c: Column) -> Column:
    """Whether the title in a file's properties was set by a person."""
    t = inline_squeeze(c)
    low = F.lower(t)
    return (F.length(t) >= 8) & (_hits(low, TOOLS) == 0) & ~F.contains(t, F.lit("\\")) & ~low.endswith(".docx")


def heading_candidate(c: Column) -> Column:
    """Whether a line looks like a heading of some form."""
    t = stripped(c)
    return (t != "") & (F.length(t) <= 100) & ~t.rlike(r"^[\d\s\-–—·.]+$") & t.rlike("(?i)" + "|".join(f"(?:{p})" for p in HEADING_FORMS))


def title_score(c: Column) -> Column:
    """Points of a title candidate for its length, words, colon and script."""
    n, low = F.length(c), F.lower(c)
    korean, english = F.length(F.regexp_replace(c, "[^가-힣]", "")), F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    band = F.when(n.between(15, 120), 4).when(n.between(8, 180), 2).otherwise(0)
    words = _hits(low, tuple(w.lower() for w in TITLE_WORDS))
    return band + words + F.contains(c, F.lit(":")).cast("int") + F.when(korean >= 5, 2).otherwise(0) - (english > korean * 3).cast("int") - 10 * _hits(c, BAD_WORDS)


_STOP = tuple(w.lower() for w in NO_TITLE)
_ENDS = re.compile(NEWLINE)
_SPACES = re.compile(f"{SPACE}+")


def _may_be_title(x: str) -> bool:
    low = x.lower()
    return 4 <= len(x) <= 180 and not any(w in low for w in _STOP) and not re.match(r"\d{4}\s*년", x) and len(re.findall("[가-힣A-Za-z]", x)) >= 3


def page_titles(page: str, most: int = 20) -> list[str]:
    """Title candidates of a page: its lines, then pairs, then triples of neighbouring lines; each but once, the first ``most``."""
    lines = [x for x in (_SPACES.sub(" ", y).strip(" ") for y in _ENDS.split(page)) if x][:40]
    good = [_may_be_title(x) for x in lines]
    out: dict[str, str] = {}
    for size, starts, longest in ((1, 40, 180), (2, 30, 220), (3, 20, 250)):
        for i in range(min(len(lines) - size + 1, starts)):
            x = " ".join(lines[i : i + size])
            if all(good[i : i + size]) and len(x) <= longest:
                out.setdefault("".join(x.split()).lower(), x)
    return list(out.values())[:most]


@pandas_udf(T.ArrayType(T.StringType()))
def title_candidates(pages: pd.Series) -> pd.Series:
    """Array of :func:`page_titles`; NULL gives NULL. One Arrow pass, as every candidate needs its neighbours' verdicts."""
    return pages.map(lambda x: None if x is None else page_titles(x))


def best_titles(pages: DataFrame, key: str, page: str, text: str, most: int = 10) -> DataFrame:
    """``key, rank, title, score, page``: the best candidates of each document.

    Of candidates that are equal but for blanks and case the best one stays, of equally
    good ones the first; then by score, page and length.
    """
    t = pages.where(F.col(text).isNotNull()).select(key, F.col(page).alias("page"), F.posexplode(title_candidates(F.col(text))).alias("pos", "title"))
    t = t.withColumn("score", title_score(F.col("title"))).withColumn("same", F.lower(_compact(F.col("title"))))
    t = t.groupBy(key, "same").agg(F.max_by(F.struct("title", "score", "page", "pos"), F.struct("score", -F.col("page"), -F.col("pos"))).alias("b")).select(key, "b.*")
    w = Window.partitionBy(key).orderBy(F.desc("score"), "page", F.desc(F.length("title")), "pos")
    return t.withColumn("rank", F.row_number().over(w)).where(f"rank <= {most}").select(key, "rank", "title", "score", "page")


def identified(pages: DataFrame, key: str, page: str, text: str, first: int = 15) -> DataFrame:
    """One row a document: title, type, degree, abstract, DOI, status; licence and contents pages give no title."""
    from quillmill.functions.text import doi_by

    p = pages.where(F.col(page) <= first)
    whole = p.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(text, F.lit("")).alias("t")))).alias("l"))
    whole = whole.select(key, F.array_join(F.transform("l", lambda x: x["t"]), "\n").alias("whole"), F.array_join(F.transform(F.slice("l", 1, 10), lambda x: x["t"]), "\n").alias("front"))
    best = best_titles(p.where(~(licence_page(F.col(text)) | contents_page(F.col(text)))), key, page, text).where("rank = 1").select(key, "title", "score")
    w = F.col("whole")
    status = F.when(stripped(w) == "", "NEEDS_OCR_OR_REVIEW").when(F.col("title").isNotNull(), "AUTO_IDENTIFIED").otherwise("NEEDS_REVIEW")
    return whole.join(best, key, "left").select(key, "title", "score", thesis_or_other(F.col("front")).alias("kind"), degree(w).alias("degree"), abstract_type(w).alias("abstract"), doi_by(w, "identify").alias("doi"), status.alias("status"))


def title_present(title: Column, text: Column, chars: int = 30_000) -> Column:
    """Whether a title's letters stand in the head of a text."""
    k = title_key(title)
    return F.coalesce((F.length(k) >= 8) & F.contains(title_key(head(text, chars)), k), F.lit(False))


def title_resolution(index_title: Column, index_score: Column, file_title: Column, property_title: Column, text: Column) -> Column:
    """Struct ``title, source, confidence, score`` by the first rule that holds, surest first; REVIEW if none does."""
    in_text = lambda c: title_present(c, text)
    both = bigram_similarity(title_key(file_title), title_key(property_title))
    long = lambda c: F.length(title_key(c)) >= 12

    def as_(title, source, confidence, score):
        return F.struct(title.cast("string").alias("title"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence"), score.cast("double").alias("score"))

    return (
        F.when((index_score >= 0.92) & in_text(index_title), as_(index_title, "INDEX", "HIGH", index_score))
        .when((both >= 0.92) & in_text(file_title), as_(file_title, "FILENAME_AND_PROPERTIES", "HIGH", both))
        .when(long(file_title) & in_text(file_title), as_(file_title, "FILENAME", "HIGH", F.lit(0.95)))
        .when(long(property_title) & in_text(property_title), as_(property_title, "PROPERTIES", "HIGH", F.lit(0.93)))
        .when((index_score >= 0.82) & in_text(index_title), as_(index_title, "INDEX", "MEDIUM", index_score))
        .otherwise(as_(F.lit(None), None, "REVIEW", F.lit(0.0)))
    )


def low_text_diagnosis(modes: list[Column], pages: Column, image_pages: Column) -> Column:
    """What can be had from a file of little text, from the characters by each way of extraction."""
    best = F.greatest(*modes)
    scanned = (pages > 0) & (image_pages >= F.greatest(F.lit(1), F.floor(pages * 0.5)))
    return F.when(best >= 3000, "RECOVERABLE").when(best >= 500, "PARTIAL_TEXT_AVAILABLE").when(scanned, "LIKELY_SCANNED").when(best == 0, "NO_TEXT_LAYER").otherwise("VERY_LOW_TEXT")


def file_status(pages: Column, chars: Column, encrypted: Column, failed: Column) -> Column:
    """Status of an inspected file, first trouble first."""
    return F.when(failed, "OPEN_ERROR").when(encrypted, "ENCRYPTED").when(F.coalesce(pages, F.lit(0)) == 0, "EMPTY_PDF").when(F.coalesce(chars, F.lit(0)) == 0, "NO_TEXT").when(chars < 500, "VERY_LOW_TEXT").otherwise("OK")


def extraction_signals(cleaned: Column, pages: Column, repeated: Column, korean: Column, status: Column) -> Column:
    """Signals of the older audit of extractions."""
    return reasons(("LOW_CLEANED_TEXT", cleaned < 3000), ("LOW_TEXT_PER_PAGE", (pages > 0) & (safe_ratio(cleaned, pages) < 500)), ("HIGH_REPEATED_LINES", repeated >= 80), ("LOW_KOREAN_RATIO", korean < 0.15), ("PREPROCESS_VERY_SHORT", status == "VERY_SHORT"))


def extraction_risk(signals: Column) -> Column:
    """HIGH_RISK, REVIEW, CHECK or OK by the number of signals; a low Korean share alone counts for nothing."""
    n = F.size(F.array_remove(signals, "LOW_KOREAN_RATIO"))
    return F.when(n >= 3, "HIGH_RISK").when(n == 2, "REVIEW").when(n == 1, "CHECK").otherwise("OK")
