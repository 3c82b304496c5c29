"""Cleaning of extracted text that keeps the text: normalisation, repeated lines, line repair, sections.

Each step is one pass over Arrow batches; a document is never cut into rows, so nothing
is shuffled and its order is kept.  Work is proportional to the length of the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# What headings of sections contain, in order of precedence.
SECTION_WORDS = {
    "abstract": (r"국문\s*초록", r"초\s*록", "abstract"),
    "introduction": (r"서\s*론", "시작하며", "들어가며", "머리말", r"논의의\s*배경", r"연구의\s*배경", r"연구\s*배경", r"연구의\s*필요성", r"연구\s*필요성", r"연구의\s*목적", r"연구\s*목적", "introduction"),
    "literature_review": (r"이론적\s*배경", r"이론적\s*고찰", r"문헌\s*연구", r"문헌\s*고찰", r"선행\s*연구", r"관련\s*연구", r"선행연구의\s*검토", r"literature\s*review", r"theoretical\s*background"),
    "methodology": (r"연구\s*방법", r"연구\s*방법론", r"연구\s*설계", r"연구\s*모형", r"연구모형의\s*제시", r"연구\s*모델", r"연구\s*가설", r"가설\s*설정", r"자료\s*수집", r"분석\s*방법", r"연구\s*대상", r"측정\s*도구", r"변수의\s*정의", r"research\s*method", "methodology", "methods"),
    "results": (r"연구\s*결과", r"분석\s*결과", "분석결과", r"실증\s*분석", r"실증\s*결과", r"가설\s*검증", r"검증\s*결과", r"정량적\s*연구", r"정성적\s*연구", "results", r"empirical\s*analysis"),
    "discussion": (r"논\s*의", r"고\s*찰", r"종합\s*논의", "discussion"),
    "conclusion": (r"결\s*론", r"결론\s*및\s*제언", r"결론\s*및\s*시사점", r"결론\s*및\s*정책적\s*시사점", r"요약\s*및\s*결론", r"결론\s*및\s*향후\s*연구", r"결론\s*및\s*향후\s*과제", r"정책적\s*시사점", "conclusion", "conclusions"),
    "references": (r"참고\s*문헌", "references", "bibliography"),
}
# Numbers before a heading.
HEADING_NUMBER = r"^\s*(?:제\s*\d+\s*장|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+|[IVX]{1,8}|\d{1,2})\s*[.\-:)]?\s*"
#: Letters of a line that may be a heading by its whole, and by what it contains.
WHOLE, PART = 120, 60
SHORT, OFTEN = 80, 4

_NUMBER = re.compile(HEADING_NUMBER, re.I)
_ANY = re.compile("|".join(w for words in SECTION_WORDS.values() for w in words), re.I)
_SECTIONS = [(name, re.compile("|".join(words), re.I)) for name, words in SECTION_WORDS.items()]
_PAGE = re.compile(r"(?m)^===== PAGE \d+ =====\s*$")
_LONE = re.compile(r"-?\s*\d{1,4}\s*-?")
_ENDED = re.compile(r"[.!?。！？]\s*$")


def normalised(text: str, nfkc: bool = True) -> str:
    """Compatibility forms folded, marks of pages and byte order dropped, line ends trimmed, one blank line at most in a row."""
    if nfkc:
        text = unicodedata.normalize("NFKC", text)
    text = _PAGE.sub("", text.replace("﻿", "").replace("\x00", ""))
    out: list[str] = []
    for line in text.splitlines():
        line = line.rstrip()
        if line or out and out[-1]:
            out.append(line)
    return "\n".join(out).strip()


def furniture_free(text: str, short: int = SHORT, often: int = OFTEN) -> tuple[str, int, list[str]]:
    """(text without short lines that it repeats and without lone page numbers, lines removed, the repeated ones sorted)."""
    lines = text.splitlines()
    keys = [" ".join(x.split()) for x in lines]
    times = Counter(k for k in keys if k and len(k) <= short)
    repeated = {k for k, n in times.items() if n >= often}
    kept = [x for x, k in zip(lines, keys) if k not in repeated and not (k and _LONE.fullmatch(k))]
    return "\n".join(kept), len(lines) - len(kept), sorted(repeated)


def section_of(line: str) -> str | None:
    """Section that a line opens: as it stands first, then without its number; long lines open none."""
    value = " ".join(line.split())
    if not value or len(value) > WHOLE or not _ANY.search(value):
        return None
    for x in (value, _NUMBER.sub("", value).strip()):
        x = x.strip(" .:-–—")
        for name, words in _SECTIONS:
            # what a short line contains is enough, a longer one must be the heading as a whole
            if words.search(x) if len(x) <= PART else any(re.fullmatch(w, x, re.I) for w in SECTION_WORDS[name]):
                return name
    return None


def line_repaired(text: str) -> str:
    """Lines joined up to the end of a sentence; headings, very short lines and lines with tabs stay alone."""
    out: list[str] = []
    joined: list[str] = []

    def flush() -> None:
        if joined:
            out.append(" ".join(joined))
            joined.clear()

    for line in text.splitlines():
        x = line.strip()
        if not x:
            flush()
            if out and out[-1]:
                out.append("")
        elif len(x) <= 2 or "\t" in line or section_of(x):
            flush()
            out.append(x)
        else:
            if joined and _ENDED.search(joined[-1]):
                flush()
            joined.append(x)
    flush()
    return "\n".join(out).strip()


def sectioned(text: str) -> list[tuple[str, str | None, str]]:
    """(section, heading, content) from each heading to the next; what precedes the first is front matter, empty ones are dropped."""
    out: list[tuple[str, str | None, str]] = []
    name, title, held = "front_matter", None, []
    for line in [*text.splitlines(), None]:
        opens = section_of(line) if line is not None else "end"
        if opens is None:
            held.append(line)
            continue
        content = "\n".join(held).strip()
        if content:
            out.append((name, title, content))
        name, title, held = opens, (line or "").strip(), []
    return out


def _texts(f, kind):
    @pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else f(x))

    return run


def normalise(c: Column, nfkc: bool = True) -> Column:
    """Column of :func:`normalised`; NULL stays NULL."""
    return _texts(lambda x: normalised(x, nfkc), T.StringType())(c)


def repair_lines(c: Column) -> Column:
    return _texts(line_repaired, T.StringType())(c)


def heading_of(c: Column) -> Column:
    return _texts(section_of, T.StringType())(c)


SECTION = T.StructType([T.StructField(n, T.StringType()) for n in ("section", "title", "content")])


def split_sections(c: Column) -> Column:
    """Array of ``section, title, content``; NULL stays NULL, an empty text gives the empty array."""
    return _texts(sectioned, T.ArrayType(SECTION))(c)


def drop_furniture(c: Column, short: int = SHORT, often: int = OFTEN) -> Column:
    """Struct ``text, removed, repeated`` of :func:`furniture_free`."""
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.IntegerType()), T.StructField("repeated", T.ArrayType(T.StringType()))])

    @pandas_udf(kind)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, 0, None) if x is None else furniture_free(x, short, often) for x in s], columns=["text", "removed", "repeated"])

    return run(c)
