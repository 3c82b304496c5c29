"""Topical relevance: lexicons of patterns, scores, tiers and ranking."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.arrays import distinct_ci
from quillmill.functions.text import squeeze


#: Boundaries of words, and of Latin letters only, in a form that every engine reads alike.
_W, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)"
_L, _R = r"(?:^|[^A-Za-z])", r"(?:[^A-Za-z]|$)"


def _word(p: str) -> str:
    return f"{_W}({p}){_E}"


def _letters(p: str) -> str:
    return f"{_L}({p}){_R}"


@dataclass(frozen=True)
class Topic:
    """A tag with alternatives of a pattern, and its points in titles and elsewhere."""

    tag: str
    patterns: tuple[str, ...]
    in_title: int
    elsewhere: int

    @property
    def pattern(self) -> str:
        return "(?i)" + "|".join(f"(?:{p})" for p in self.patterns)


@dataclass(frozen=True)
class Profile:
    """``required`` must occur, and one of ``core``; the rest only adds points."""

    required: Topic
    core: tuple[Topic, ...]
    extra: tuple[Topic, ...] = ()
    decisive: str = "PERFORMANCE"
    texts: tuple[str, ...] = field(default=("title", "title_en", "abstract", "abstract_en", "category"))


# Expressions of the topics and their points.
DEFAULT = Profile(
    required=Topic("SME", (
        r"중소\s*기업", r"중소\s*제조\s*기업", r"중소\s*제조업", r"중소\s*벤처", "중소기업청", "중소벤처기업부", "소상공인", r"벤처\s*기업",
        _word(r"small\s+and\s+medium(?:[-\s]+sized)?\s+enterprises?"), _word("SMEs?"),
    ), 5, 2),
    core=(
        Topic("AI", (
            r"인공\s*지능", _letters("AI"), r"생성형\s*AI", r"생성형\s*인공\s*지능", r"generative\s+AI", r"artificial\s+intelligence",
            r"머신\s*러닝", r"machine\s+learning", r"딥\s*러닝", r"deep\s+learning",
        ), 8, 5),
        Topic("DX", (r"디지털\s*전환", r"digital\s+transformation", _letters("DX")), 7, 4),
        Topic("SMART_FACTORY", (r"스마트\s*공장", r"스마트\s*팩토리", r"스마트\s*제조", _word(r"smart\s+factor(?:y|ies)"), _word(r"smart\s+manufacturing"), r"제조\s*AI"), 6, 4),
        Topic("DATA_INTELLIGENCE", (r"빅\s*데이터", _word(r"big\s+data"), r"데이터\s*기반", r"data[-\s]*driven", "지능화", "지능형"), 4, 2),
    ),
    extra=(
        Topic("SUPPORT", (
            r"디지털\s*기술", "디지털화", r"정보\s*기술", "정보화", "자동화", "클라우드", _word("cloud"), _letters("ICT"),
            r"산업\s*4\.?0", r"4차\s*산업", r"사물\s*인터넷", _word("IoT"),
        ), 2, 1),
        Topic("PERFORMANCE", (
            r"경영\s*성과", r"기업\s*성과", r"사업\s*성과", r"재무\s*성과", r"비재무\s*성과", "생산성", r"업무\s*효율", r"운영\s*효율",
            "매출", "매출액", "수익성", r"영업\s*이익", "경쟁력", r"혁신\s*성과", r"혁신\s*역량", r"기업\s*성장", r"성장\s*성과",
            r"고용\s*성과", r"고용\s*증가", r"수출\s*성과", r"수출\s*경쟁력",
            _word("performance"), _word("productivity"), _word("profitability"), _word("competitiveness"), _word(r"innovation\s+performance"), _word(r"business\s+performance"), _word(r"firm\s+performance"),
        ), 5, 3),
    ),
)

# Terms and labelled patterns of the harvest's own, simpler relevance.
HARVEST_REQUIRED = (
    "중소기업", "중소 기업", "중소벤처기업", "중소벤처", "중소 제조기업", "중소 제조업", "중소 제조", "중소사업자", "중소 사업자", "소상공인", "벤처기업", "벤처 기업", "스타트업",
    "small and medium enterprise", "small and medium enterprises", "small and medium-sized enterprise", "small and medium-sized enterprises", "sme", "smes",
)
HARVEST_LABELS = (
    ("AI", _letters("AI")), ("인공지능", "인공지능"), ("생성형AI", r"생성형\s*AI"), ("Artificial Intelligence", _word(r"artificial\s+intelligence")), ("AI전환", r"AI\s*전환"), ("AX", _letters("AX")),
    ("디지털전환", r"디지털\s*전환"), ("Digital Transformation", _word(r"digital\s+transformation")), ("DX", _letters("DX")), ("스마트공장", r"스마트\s*공장"), ("스마트팩토리", r"스마트\s*팩토리"),
    ("Smart Factory", _word(r"smart\s+factor(?:y|ies)")), ("스마트제조", r"스마트\s*제조"), ("Smart Manufacturing", _word(r"smart\s+manufacturing")), ("제조AI", r"제조\s*AI"),
    ("머신러닝", r"머신\s*러닝"), ("Machine Learning", _word(r"machine\s+learning")), ("딥러닝", r"딥\s*러닝"), ("Deep Learning", _word(r"deep\s+learning")), ("자동화", "자동화"), ("지능화", "지능화"), ("디지털기술", r"디지털\s*기술"),
)
HARVEST_PERFORMANCE = (
    "경영성과", "기업성과", "재무성과", "비재무성과", "생산성", "업무효율", "업무 효율", "효율성", "매출", "매출액", "수익", "수익성", "영업이익", "비용절감", "비용 절감", "경쟁력", "혁신성과", "혁신 성과", "혁신역량", "혁신 역량",
    "기업성장", "기업 성장", "성장성", "고용", "수출", "시장성과", "기술성과", "performance", "productivity", "profitability", "competitiveness", "innovation", "growth",
)


def terms_in(text: Column, terms: tuple[str, ...]) -> Column:
    """The terms that a text contains, in the list's order; abbreviations only where no Latin letter is beside them."""
    low = F.lower(text)
    hits = [F.when(text.rlike(f"(?i){_letters(t)}") if t in ("sme", "smes") else F.contains(low, F.lit(t.lower())), F.lit(t)) for t in terms]
    return F.array_compact(F.array(*hits))


def labels_in(text: Column, labels=HARVEST_LABELS) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?i){p}"), F.lit(n)) for n, p in labels]))


def harvest_relevance(df: DataFrame) -> DataFrame:
    """All rows with ``relevance`` (core, high, reject), ``relevance_score`` and the terms met, by the harvest's rules."""
    body = F.concat_ws(" ", "title", "title_en", "abstract", "abstract_en", F.array_join("keywords", " "), "category")
    title = F.concat_ws(" ", "title", "title_en")
    d = df.withColumn("sme_matches", terms_in(body, HARVEST_REQUIRED)).withColumn("tech_matches", labels_in(body)).withColumn("performance_matches", terms_in(body, HARVEST_PERFORMANCE))
    has = lambda c: F.size(c) > 0
    sme, tech, perf = has("sme_matches"), has("tech_matches"), has("performance_matches")
    points = [(sme, 5), (tech, 5), (perf, 2), (has(terms_in(title, HARVEST_REQUIRED)), 4), (has(labels_in(title)), 4), (has(terms_in(title, HARVEST_PERFORMANCE)), 2)]
    score = sum((F.when(c, n).otherwise(0) for c, n in points), F.lit(0))
    return d.withColumn("relevance_score", score).withColumn("relevance", F.when(sme & tech & perf, "core").when(sme & tech, "high").otherwise("reject"))


def scored(df: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Rows that match the profile, with ``score``, ``tier`` and ``tech_types``; one narrow regex pass a topic."""
    head = squeeze(F.concat_ws(" ", "title", "title_en", F.array_join("keywords", " ")))
    body = squeeze(F.concat_ws(" ", *profile.texts, F.array_join("keywords", " ")))

    def points(t: Topic) -> Column:
        return F.when(F.col("head_").rlike(t.pattern), t.in_title).when(F.col("body_").rlike(t.pattern), t.elsewhere).otherwise(0)

    d = df.withColumn("head_", head).withColumn("body_", body)
    d = d.where(F.col("body_").rlike(profile.required.pattern) & F.col("body_").rlike("(?i)" + "|".join(t.pattern.removeprefix("(?i)") for t in profile.core)))
    topics = (profile.required, *profile.core, *profile.extra)
    d = d.withColumn("score", sum((points(t) for t in topics), F.lit(0)))
    tags = F.array_compact(F.array(*[F.when(F.col("body_").rlike(t.pattern), F.lit(t.tag)) for t in profile.core]))
    decisive = next(t for t in topics if t.tag == profile.decisive)
    d = d.withColumn("tier", F.when(F.col("body_").rlike(decisive.pattern), "core").otherwise("high"))
    return d.withColumn("tech_types", tags).drop("head_", "body_")


def matches(text: Column, topic: Topic) -> Column:
    """The first match of each alternative, without repetitions."""
    # a pattern with a boundary captures what stands inside it
    return distinct_ci(F.array(*[F.regexp_extract(text, f"(?i){p}" if _captures(p) else f"(?i)({p})", 1) for p in topic.patterns]))


def _captures(p: str) -> bool:
    return p.startswith((_W, _L))


def ranked(df: DataFrame) -> list[Column]:
    """Order of the result: tier, score, year, arrival."""
    year = F.regexp_extract("publication_year", "([0-9]{4})", 1)
    return [F.when(F.col("tier") == "core", 0).otherwise(1), F.desc("score"), F.coalesce(year, F.lit("")).desc(), F.asc("_ord")]
