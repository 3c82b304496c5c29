"""Column functions on text: whitespace, titles, DOIs, years, scripts, sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\r\x0b\f\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Ends of lines, as text is cut into lines.
NEWLINE = r"\r\n|[\n\r\x0b\f\x1c-\x1e\u0085\u2028\u2029]"
PAGE_MARK = r"={3,}\s*PAGE\s+[0-9]+\s*={3,}"
# How the stages find a DOI in text, and what they cut from its end.
DOI_FORMS = {
    "harvest": (r"10\.[0-9]{4,9}/[^\s<>\"]+", ".,;)"),
    "identify": (r"10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+", ".,;:)]}>"),
    "resolve": (r"\b10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]*[A-Za-z0-9_]", ".,;)"),
    "resolver_link": (r"(?<=doi\.org/)10\.[^\s]+", ".,;)"),
}


def squeeze(c: Column) -> Column:
    """Runs of any white space become one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def stripped(c: Column) -> Column:
    """White space of any kind cut from both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def inline_squeeze(c: Column) -> Column:
    """NULs dropped, runs of blanks and tabs become one blank, none at the ends; line ends stay."""
    return stripped(F.regexp_replace(F.regexp_replace(c, "\u0000", ""), "[ \t]+", " "))


def light_clean(c: Column) -> Column:
    """Extracted text: NULs and blanks at line ends dropped, at most two blank lines in a row."""
    t = F.regexp_replace(F.regexp_replace(c, "\u0000", ""), NEWLINE, "\n")
    t = F.regexp_replace(t, r"[ \t]+(?=\n)|[ \t]+$", "")
    return stripped(F.regexp_replace(t, r"\n{4,}", "\n\n\n"))


def for_count(c: Column) -> Column:
    """Text as its length is compared: without page marks, white space squeezed; NULL gives the empty text."""
    return F.coalesce(squeeze(F.regexp_replace(c, f"(?i){PAGE_MARK}", " ")), F.lit(""))


def unix_lines(c: Column) -> Column:
    """Line ends as line feeds, none at the ends."""
    return stripped(F.regexp_replace(c, r"\r\n?", "\n"))


def doi_by(c: Column, form: str) -> Column:
    """The first DOI of a text in one of the DOI_FORMS; NULL for none."""
    pattern, tail = DOI_FORMS[form]
    found = F.regexp_extract(c, pattern, 0)
    return F.nullif(F.regexp_replace(found, "[" + "".join("\\" + x for x in tail) + "]+$", ""), F.lit(""))


def kci_ids(c: Column) -> Column:
    """Sorted distinct article ids in a text, in upper case."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"(?i)(?<![\p{L}\p{N}_])ART[0-9]{6,}(?![\p{L}\p{N}_])"), 0), lambda x: F.upper(x))))


def article_of_url(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "artiId=(ART[0-9]+)", 1), F.lit(""))


def years(c: Column, low: int = 1980, high: int = 2030) -> Column:
    """All four-figure years of a text that stand alone and lie in the range, in order."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])"), 1), lambda y: y.cast("int"))
    return F.filter(found, lambda y: y.between(low, high))


def commonest(c: Column) -> Column:
    """The commonest element of an array, of equally common ones the first; NULL for an empty one."""
    kinds = F.array_distinct(c)
    counted = F.transform(kinds, lambda x, i: F.struct(F.size(F.filter(c, lambda y: y == x)).alias("n"), (-i).alias("first"), x.alias("x")))
    return F.array_max(counted)["x"]


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def nonempty(c: Column) -> Column:
    """NULL for the empty and the blank text."""
    return F.when(F.trim(c) != "", c)


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[nonempty(c) for c in cols])


def null_words(c: Column, words=("null", "none", "unknown", "n/a", "없음", "-")) -> Column:
    """NULL where a literal stands for a missing value."""
    t = F.trim(c)
    return F.when((t != "") & ~F.lower(t).isin(*words), t)


def title_key(c: Column) -> Column:
    """Letters and figures of a title in lower case, to compare by."""
    return F.regexp_replace(F.lower(c), "[^0-9a-z가-힣]", "")


def polish_title(c: Column) -> Column:
    """One line, single blanks, ``: `` after a colon, no blanks inside brackets."""
    t = squeeze(c)
    t = F.regexp_replace(t, r" ?: ?", ": ")
    return F.regexp_replace(F.regexp_replace(t, r"\( ", "("), r" \)", ")")


def doi_normal(c: Column) -> Column:
    """Lower-case DOI without resolver, prefix and trailing punctuation; NULL if nothing is left."""
    t = F.regexp_replace(F.lower(F.trim(c)), r"^(https?://(dx\.)?doi\.org/|doi: ?)", "")
    return F.nullif(F.regexp_replace(t, r"[.,;)]+$", ""), F.lit(""))


def doi_found(c: Column) -> Column:
    """The first DOI inside a text, or NULL."""
    t = F.regexp_extract(F.lower(c), r"10\.[0-9]{4,9}/[^ \"<>]+", 0)
    return F.nullif(F.regexp_replace(t, r"[.,;)]+$", ""), F.lit(""))


def year_found(c: Column, low: int = 1900, high: int = 2030) -> Column:
    """The first four-figure year of the 20th or 21st century in a text, if it lies in the range."""
    y = F.regexp_extract(c, "((19|20)[0-9]{2})", 1)
    y = F.when(y != "", y.cast("int"))
    return F.when(y.between(low, high), y)


def hangul_ratio(c: Column) -> Column:
    """Hangul syllables among the characters that are no white space; 0 for none."""
    solid = F.regexp_replace(c, r"[ \t\n\r]", "")
    return F.when(F.length(solid) > 0, F.length(F.regexp_replace(solid, "[^가-힣]", "")) / F.length(solid)).otherwise(F.lit(0.0))


def safe_ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def sentences(c: Column) -> Column:
    """Array of sentences; an end mark and white space after it part them."""
    marked = F.regexp_replace(c, r"([.!?。！？])[ \t\n\r]+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: F.trim(s) != "")


def file_title(c: Column) -> Column:
    """A title candidate from a file name; NULL for names that are codes or too short."""
    t = F.regexp_replace(c, r"(?i)\.(pdf|hwp|docx?)$", "")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"_20[0-9]{12,}$", ""), "_", " "))
    return F.when((F.length(t) >= 8) & ~t.rlike(r"^[A-Za-z0-9 ().-]+$"), t)


def preview(c: Column, limit: int) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(" ..."))).otherwise(c)


def page_joined(pages: Column) -> Column:
    """Pages (array of texts) in one text, each under its marker."""
    return F.array_join(F.transform(pages, lambda p, i: F.concat(F.lit("===== PAGE "), (i + 1).cast("string"), F.lit(" =====\n\n"), p)), "\n\n")


def json_object(c: Column) -> Column:
    """The text from the first brace to the last, as language models wrap it in prose and fences."""
    return F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))
