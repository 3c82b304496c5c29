"""Problem 10: subject areas of each document.

A lexicon of words and phrases per area is fitted on the labelled rows.  Labelling
functions read it in different ways (phrases, single words, density, spread over the
text, headings, addresses, source) and vote on every pair of document and area.  A
latent model learns how accurate each function is from the vote patterns of all
documents, without labels; areas are assigned from its posterior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.canonical import canonical_text
from quillmill.session import broadcast_if_small, materialise, occupied, ship_package

#: The lexicon is fitted on at most so many labelled rows (the smallest document ids).
LABELLED = 50_000
#: Documents in which a term must occur, its least purity and strength. All terms that pass are kept: the labelled rows bound them.
LEAST_DOCS, PURITY, STRENGTH = 3, 0.3, 3.0
MOST_AREAS = 2
FUNCTIONS = ("phrases", "words", "density", "spread", "heading", "address", "source")
# Korean particles and English function words that carry no subject.
PARTICLES = sorted("으로는 에서는 으로 에서 까지 보다 에는 이나 라는 하는 을 를 이 가 은 는 의 에 도 와 과 로 만".split(), key=len, reverse=True)
STOP = frozenset("a an and as at be been by for from had has have in into is it its of on or our out so than that the their them they this to was we were when where which while with".split())
_SENT = re.compile(r"(?<=[.!?。])\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_ADDRESS = re.compile(r"(?:https?://|www\.|[\w.]+@)([\w.-]+)")


class Stems(dict):
    """Word to (stem, whether a particle was cut off), remembered."""

    def __missing__(self, w: str) -> tuple[str, bool]:
        got = (w, False)
        if "가" <= w[-1] <= "힣":
            for p in PARTICLES:
                if w.endswith(p) and len(w) - len(p) >= 2:
                    got = (w[: -len(p)], True)
                    break
        if len(self) > 500_000:
            self.clear()
        self[w] = got
        return got


def sentences(text: str) -> list[str]:
    return [s for s in _SENT.split(canonical_text(text) or "") if s.strip()]


def terms(sentence: str, stems: Stems) -> list[str]:
    """Stems, and pairs of stems that stand together without a particle between them."""
    out, prev = [], None
    for w in _WORD.findall(sentence.lower()):
        b, cut = stems[w]
        if b in STOP:
            prev = None
            continue
        out.append(b)
        if prev:
            out.append(f"{prev} {b}")
        prev = None if cut else b
    return out


def _labelled_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stems = Stems()
    n: Counter = Counter()
    for b in batches:
        for text, areas in zip(b.text, b.areas):
            found = {t for s in sentences(text) for t in terms(s, stems)}
            for a in [*areas, ""]:
                n.update((t, a) for t in found)
                n["", a] += 1
    yield pd.DataFrame([(t, a, c) for (t, a), c in n.items()], columns=["term", "area", "n"])


def lexicon(docs: DataFrame, labels: DataFrame, areas: DataFrame) -> dict[str, tuple[str, float]]:
    """Term to (area, strength), from the labelled documents and the areas' own names and descriptions."""
    codes = [r.subject_code for r in areas.select("subject_code").where("subject_code is not null").distinct().orderBy("subject_code").collect()]
    lab = labels.where(F.col("subject_code").isin(codes)).select("doc_id", "subject_code").distinct().orderBy("doc_id", "subject_code").limit(LABELLED)
    per = lab.groupBy("doc_id").agg(F.collect_set("subject_code").alias("areas"))
    held = docs.where("text is not null and text <> ''").select("doc_id", "text").join(broadcast_if_small(per), "doc_id")
    counts = held.select("text", "areas").mapInPandas(_labelled_terms, "term string, area string, n long").groupBy("term", "area").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "terms")
    size = {r.area: r.n for r in counts.where("term = ''").collect()}
    total = size.get("", 0)
    out: dict[str, tuple[str, float]] = {}
    if total:
        whole = counts.where("area = '' and term <> ''").select("term", F.col("n").alias("docs")).where(f"docs >= {LEAST_DOCS}")
        base = F.create_map(*[F.lit(x) for a, s in size.items() if a for x in (a, s / total)])
        z = counts.where("area <> '' and term <> ''").join(whole, "term").withColumn("p", base[F.col("area")])
        z = z.withColumn("z", (F.col("n") - F.col("docs") * F.col("p")) / F.sqrt(F.col("docs") * F.col("p") * (1 - F.least("p", F.lit(0.99)))))
        z = z.where((F.col("z") > STRENGTH) & (F.col("n") / F.col("docs") > PURITY))
        best = Window.partitionBy("term").orderBy(F.desc("z"), "area")
        z = z.withColumn("r", F.row_number().over(best)).where("r = 1")
        out = {r.term: (r.area, float(r.z)) for r in z.select("term", "area", "z").collect()}
    # the areas' own words, where no label says otherwise
    stems = Stems()
    seen: dict[str, set[str]] = {}
    for r in areas.collect():
        for t in {t for c in ("name_ko", "name_en", "description") if r[c] for t in terms(r[c].replace("·", " "), stems)}:
            seen.setdefault(t, set()).add(r.subject_code)
    for t, where in seen.items():
        if len(where) == 1 and t not in out and len(t) > 1:
            out[t] = (next(iter(where)), STRENGTH)
    return out


def _voter(lex: dict[str, tuple[str, float]]):
    heads = {t.split(" ")[0] for t in lex if " " in t}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stems = Stems()
        for b in batches:
            out = []
            for did, text, source in zip(b.doc_id, b.text, b.source):
                out.extend((did, source, *v) for v in votes(text, lex, heads, stems))
            yield pd.DataFrame(out, columns=["doc_id", "source", "area", "hits", "sents", *FUNCTIONS[:6]])

    return run


def votes(text: str, lex: dict[str, tuple[str, float]], heads: set[str], stems: Stems) -> list[tuple]:
    """Votes (-1, 0, 1) of the text's functions for each area that any sentence touches."""
    ss = sentences(text)
    n = len(ss)
    body, phrase, word, where, head = Counter(), Counter(), Counter(), {}, set()
    for at, s in enumerate(ss):
        score: dict[str, float] = {}
        kinds: set[tuple[str, bool]] = set()
        prev = None
        for w in _WORD.findall(s.lower()):
            t, cut = stems[w]
            if t in STOP:
                prev = None
                continue
            hit = lex.get(t)
            if hit:
                score[hit[0]] = score.get(hit[0], 0.0) + hit[1]
                kinds.add((hit[0], False))
            if prev in heads:
                hit = lex.get(f"{prev} {t}")
                if hit:
                    score[hit[0]] = score.get(hit[0], 0.0) + 1.5 * hit[1]
                    kinds.add((hit[0], True))
            prev = None if cut else t
        if not score:
            continue
        a = max(score, key=lambda x: (score[x], x))
        body[a] += 1
        where.setdefault(a, set()).add(3 * at // n)
        if (a, True) in kinds:
            phrase[a] += 1
        if (a, False) in kinds:
            word[a] += 1
        if not s.rstrip().endswith((".", "!", "?", "。")) and len(s) < 60:
            head.add(a)
    address = set()
    if "@" in text or "www" in text or "http" in text:
        for m in _ADDRESS.finditer(text.lower()):
            address |= {lex[t][0] for t in re.split(r"[.-]", m.group(1)) if t in lex}
    top = max(body.values(), default=0)
    few = 1 if n <= 2 else 2
    out = []
    for a, c in body.items():
        share, ratio = c / n, c / top
        grade = lambda x: 1 if x >= few else -1 if x == 0 or n > 3 else 0
        density = 1 if share >= 0.2 and ratio >= 0.3 and c >= few else -1 if share < 0.12 or ratio < 0.2 or c < few else 0
        spread = 1 if len(where[a]) > 1 or n <= 3 and c >= few else -1 if c < few else 0
        out.append((a, c, n, grade(phrase[a]), grade(word[a]), density, spread, 1 if a in head and c >= few else 0, 1 if a in address else 0))
    return out


def accuracy_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 60) -> dict[tuple[int, ...], float]:
    """Posterior of each vote pattern: EM for a latent label and functions that are independent given it."""
    k = len(FUNCTIONS)
    p = {v: 0.9 if sum(v) > 0 else 0.1 for v, _ in patterns}
    for _ in range(rounds):
        on = sum(n * p[v] for v, n in patterns) + 1.0
        off = sum(n * (1 - p[v]) for v, n in patterns) + 1.0
        tables = []
        for i in range(k):
            t = {}
            for y in (-1, 0, 1):
                good = sum(n * p[v] for v, n in patterns if v[i] == y)
                bad = sum(n * (1 - p[v]) for v, n in patterns if v[i] == y)
                t[y] = math.log((good + 0.5) / (on + 0.5)) - math.log((bad + 0.5) / (off + 0.5))
            # an abstention says nothing, and no function may speak against its own vote
            tables.append({-1: min(t[-1], 0.0), 0: 0.0, 1: max(t[1], 0.0)})
        prior = math.log(on / off)
        new = {v: 1 / (1 + math.exp(-max(-30.0, min(30.0, prior + sum(tables[i][v[i]] for i in range(k)))))) for v, _ in patterns}
        if max((abs(new[v] - p[v]) for v in new), default=0) < 1e-6:
            p = new
            break
        p = new
    return p


def scored(docs: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """``doc_id, subject_code, posterior, hits, sents`` for every document and area with any evidence."""
    ship_package(docs.sparkSession)
    lex = lexicon(docs, labels, areas)
    held = docs.sparkSession.sparkContext.broadcast(lex)  # terms of at most LABELLED documents
    schema = T.StructType([docs.schema["doc_id"], T.StructField("source", T.StringType()), T.StructField("area", T.StringType()), T.StructField("hits", T.IntegerType()), T.StructField("sents", T.IntegerType()), *[T.StructField(f, T.IntegerType()) for f in FUNCTIONS[:6]]])
    text = occupied(docs.where("text is not null and trim(text) <> ''").select("doc_id", "text", "source"), "doc_id")

    def run(batches):
        return _voter(held.value)(batches)

    v = materialise(text.mapInPandas(run, schema), "votes")
    # the source speaks where one area is far more common in it than elsewhere
    strong = v.where("density = 1")
    by = strong.groupBy("source", "area").agg(F.count("*").alias("n"))
    of = by.groupBy("source").agg(F.sum("n").alias("of"))
    overall = by.groupBy("area").agg(F.sum("n").alias("all_"))
    whole = by.agg(F.sum("n").alias("total"))
    says = by.join(of, "source").join(overall, "area").crossJoin(F.broadcast(whole)).where("source is not null and of >= 20 and n / of > 2.5 * all_ / total").select("source", "area", F.lit(1).alias("said"))
    v = v.join(says, ["source", "area"], "left").withColumn("source_vote", F.coalesce("said", F.lit(0)))
    cols = [*FUNCTIONS[:6], "source_vote"]
    patterns = [(tuple(r[c] for c in cols), r["n"]) for r in v.groupBy(*cols).agg(F.count("*").alias("n")).collect()]  # at most 3 ** 7 rows
    post = accuracy_model(patterns)
    spark = docs.sparkSession
    table = spark.createDataFrame([(*k, p) for k, p in post.items()], T.StructType([*[T.StructField(c, T.IntegerType()) for c in cols], T.StructField("posterior", T.DoubleType())]))
    return v.join(F.broadcast(table), cols).select("doc_id", F.col("area").alias("subject_code"), "posterior", "hits", "sents")


def assigned(docs: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """At most two areas a document, those of the highest posterior; ties go to the area with more sentences, then by code.

    NULL, empty and blank texts and documents on no area in particular have no row.
    """
    s = scored(docs, labels, areas).where("posterior >= 0.5")
    w = Window.partitionBy("doc_id").orderBy(F.desc("posterior"), F.desc("hits"), "subject_code")
    return s.withColumn("r", F.row_number().over(w)).where(f"r <= {MOST_AREAS}").drop("r")


def found(docs: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    return assigned(docs, labels, areas).select("doc_id", "subject_code").distinct()


def composition(docs: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """Documents per subject area, split evenly between the areas of a document."""
    a = assigned(docs, labels, areas)
    share = a.join(a.groupBy("doc_id").agg(F.count("*").alias("k")), "doc_id")
    return share.groupBy("subject_code").agg(F.count("*").alias("docs"), F.sum(1 / F.col("k")).alias("weight"))
