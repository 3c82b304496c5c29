"""Problem 4: variant spellings of names typed by people.

Noisy-channel attribution.  Registered names and every full spelling met in the
data are candidate canonical forms; their frequencies are the prior.  A spelling
meets the candidates with which it shares a blocking key (inside its institution
where that is known), the channel model of :mod:`names` scores the pairs, and the
spelling is attached to the maximum of the posterior or stays a name of its own.
All joins run on pre-aggregated distinct spellings; nothing goes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm import names
from quillmill.llm.components import hash_to_min
from quillmill.session import discard, materialise, ship_package, spread

#: Chance that a further person of the institution has a name this near; see ``_attach``.
NOVEL = 0.0075
#: Shape of the gamma distribution about its model that the rate of an error has; see ``_attach``.
SHAPE = 1
#: Likelihoods from here on are systematic variants, below they are typing errors.
SYSTEMATIC = 0.01
#: Papers with an institution that a name needs, and the share of them in one institution, for that to be its home.
LEAST_PAPERS, AT_HOME = 3, 0.95
#: Units that are part of another institution.
UNIT_SUFFIX = r"\s+(산학협력단|연구처)$"


def entries(papers: DataFrame) -> DataFrame:
    """One row per distinct paper, author position and spelling: ``paper_id, author_no, raw, inst``.

    Repeated papers give one set of rows; NULL arrays and NULL or blank entries give none.
    """
    return (
        papers.select("paper_id", "authors", F.regexp_replace("institution", UNIT_SUFFIX, "").alias("inst"))
        .select("paper_id", F.posexplode("authors").alias("p0", "raw"), F.expr("nullif(trim(inst), '')").alias("inst"))
        .where("raw is not null and trim(raw) <> ''")
        .select("paper_id", (F.col("p0") + 1).cast("int").alias("author_no"), "raw", "inst")
        .distinct()
    )


def _located(e: DataFrame, registry: DataFrame, forms: DataFrame) -> DataFrame:
    """Gives papers without an institution that of their authors, if those who have one agree.

    An author's institution is the registered one for an exact registered form, or
    that of nearly all papers (AT_HOME) on which the same full name stands.
    """
    r = registry.where("entity_type = 'person' and institution is not null")
    exact = r.select(F.col("name").alias("raw"), "institution").union(r.select("name_en", "institution")).distinct()
    full = forms.where("kind = 'ko' or kind = 'la' and text like '% %' and text not like '%=%'").select("raw", F.substring_index("text", "(", 1).alias("name"))
    named = materialise(e.join(full, "raw").select("paper_id", "inst", "name").distinct(), "named")
    at = named.where("inst is not null").groupBy("name", "inst").agg(F.count("*").alias("n"))
    home = at.groupBy("name").agg(F.max_by("inst", F.struct("n", "inst")).alias("institution"), F.max("n").alias("most"), F.sum("n").alias("of")).where(f"most >= {LEAST_PAPERS} and most >= {AT_HOME} * of")
    lost = e.where("inst is null")
    told = lost.join(exact, "raw").select("paper_id", "institution").union(named.where("inst is null").join(home, "name").select("paper_id", "institution"))
    seen = told.groupBy("paper_id").agg(F.max("institution").alias("inst2"), F.count_distinct("institution").alias("n"))
    return e.join(seen.where("n = 1").drop("n"), "paper_id", "left").select("paper_id", "author_no", "raw", F.coalesce("inst", "inst2").alias("inst"))


def _formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        f = [names.parse(x) for x in b.raw]
        b["kind"] = [x.kind for x in f]
        b["text"] = [_text(x) for x in f]
        yield b


def _text(f: names.Form) -> str:
    alt = f"({_text(f.alt[0])})" if f.alt else ""
    if f.kind == "la":
        return " ".join(x for x in f.parts).replace(" ,", ",") + alt
    return f.text + alt


def _form(text: str, kind: str) -> names.Form:
    """The form back from its text."""
    alt: tuple = ()
    if text.endswith(")") and "(" in text:
        text, _, inner = text[:-1].partition("(")
        alt = (_form(inner, "org" if kind == "org" else "ko" if "가" <= inner[:1] <= "힣" else "la"),)
    if kind == "ko":
        return names.Form("ko", text, (text[:1], text[1:]), alt)
    if kind == "la":
        return names.Form("la", text, tuple(text.replace(",", " ,").split()), alt)
    if kind == "org":
        return names.Form("org", text, (text,) if "가" <= text[:1] <= "힣" else tuple(text.split()), alt)
    return names.Form("", "", (), alt)


def _variant_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for i, text, kind, inst in zip(b.vid, b.text, b.kind, b.inst):
            f = _form(text, kind)
            at = "" if kind == "org" or inst is None else inst
            rows.extend((i, f"{at}#{k}") for k in names.block_keys(f, False))
            rows.append((i, f"#X{text.split('(')[0]}"))
            if f.alt:
                rows.append((i, f"#X{_text(f.alt[0])}"))
        yield pd.DataFrame(rows, columns=["vid", "key"])


def _name_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for i, text, text2, kind, inst in zip(b.cid, b.text, b.text2, b.kind, b.inst):
            f = _form(text, kind)
            keys = names.block_keys(f)
            if text2 is not None:
                g = names.parse(text2)
                keys |= names.block_keys(g)
                rows.append((i, f"#X{_text(g)}"))
            rows.extend((i, f"#{k}") for k in keys)
            if kind != "org" and inst is not None:
                rows.extend((i, f"{inst}#{k}") for k in keys)
            rows.append((i, f"#X{text.split('(')[0]}"))
        yield pd.DataFrame(rows, columns=["cid", "key"])


def _scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for vt, vk, ct, ct2, ck in zip(b.v_text, b.v_kind, b.c_text, b.c_text2, b.c_kind):
            f, c = _form(vt, vk), _form(ct, ck)
            p = names.likelihood(f, c)
            if p < 1 and ct2 is not None:
                p = max(p, names.likelihood(f, names.parse(ct2)))
            out.append(p)
        b["lik"] = out
        yield b[b.lik > 0][["vid", "cid", "lik", "v_n", "c_n", "c_reg", "same", "located"]]


def _log_factorial(n):
    """ln n! by Stirling's series, which is right to 1e-4 from n = 1 on; 0 for n = 0."""
    n = n.cast("double")
    return F.when(n < 1, 0.0).otherwise(n * F.log(n) - n + 0.5 * F.log(2 * math.pi * n) + 1 / (12 * n) - 1 / (360 * n * n * n))


def _attach(lik, v_n, c_n, c_reg, same, located):
    """Log posterior (up to a constant) of ``v`` being a spelling of ``c``.

    The rate of an error is known by its order of magnitude only, so its count has a
    negative binomial distribution.  A Poisson count of the very rate would rule out any
    error on enough papers: its logarithm falls with their number, that of ``novel`` does not.
    """
    prior = F.log(c_n + F.when(c_reg, 1.0).otherwise(0.25))
    typo_rate = lik * (c_n + F.when(c_reg, 1.0).otherwise(0.0))
    n = F.ceil(v_n / 2.0)
    ways = _log_factorial(n + SHAPE - 1) - _log_factorial(n) - _log_factorial(F.lit(SHAPE - 1))
    count = ways + n * F.log(typo_rate / (SHAPE + typo_rate)) - SHAPE * F.log(1 + typo_rate / SHAPE)
    novel = F.log(F.lit(NOVEL) / (n + 1))
    allowed = same | (lik >= SYSTEMATIC) | (count > novel)
    return F.when(allowed, F.log(lik) + prior)


def resolve(papers: DataFrame, registry: DataFrame) -> DataFrame:
    """Author entries with the entity they refer to.

    ``paper_id, author_no, raw, inst, entity, author_id``; ``author_id`` is the
    registered id or NULL, ``entity`` that id or a canonical form of its own.  Entries
    that are no names (digits only ...) have entity NULL.  An empty registry works:
    all entities are then unregistered.
    """
    spark = papers.sparkSession
    ship_package(spark)
    e = materialise(entries(papers), "written")
    forms = materialise(spread(e.select("raw").distinct(), "raw").mapInPandas(_formed, "raw string, kind string, text string"), "forms")
    e = materialise(_located(e, registry, forms), "entries")
    spell = e.groupBy("raw", "inst").agg(F.count("*").alias("n")).join(forms.where("kind <> ''"), "raw").select("raw", "inst", "n", "kind", "text")
    spell = materialise(spell, "spellings")
    var = spell.groupBy("text", "kind", F.when(F.col("kind") != "org", F.col("inst")).alias("inst")).agg(F.sum("n").alias("n"))
    var = materialise(var.withColumn("vid", F.xxhash64("text", "kind", F.coalesce("inst", F.lit("")))), "variants")

    reg = registry.where("name is not null and author_id is not null").select("author_id", "name", "name_en", F.col("institution").alias("inst")).dropDuplicates(["author_id"])
    reg = reg.withColumn("raw", F.col("name")).withColumn("n", F.lit(0).cast("long"))
    reg = reg.mapInPandas(_formed, "author_id string, name string, name_en string, inst string, raw string, n long, kind string, text string").where("kind <> ''")
    reg2 = reg.select("author_id", F.col("name_en").alias("raw"), F.lit(0).cast("long").alias("n")).where("raw is not null").mapInPandas(_formed, "author_id string, raw string, n long, kind string, text string").where("kind <> ''")
    registered_texts = reg.select("text", "author_id").union(reg2.select("text", "author_id")).distinct()
    seen = spell.join(registered_texts, "text").groupBy("author_id").agg(F.sum("n").alias("n"))
    known = reg.drop("n").join(seen, "author_id", "left").select(F.col("author_id").alias("cid"), "text", F.col("name_en").alias("text2"), "kind", "inst", F.coalesce("n", F.lit(0)).alias("n"), F.lit(True).alias("reg"))

    # own names: full spellings that are not registered; they may yet turn out to be errors
    bare = F.substring_index("text", "(", 1)
    own = var.join(registered_texts.select("text").distinct(), "text", "left_anti")
    own = own.where("not (kind = 'la' and (text like '=%' or text rlike ' =[a-z]+(,|$)' or text not like '% %'))")
    own = own.withColumn("text", bare).groupBy("text", "kind").agg(F.sum("n").alias("n"), F.max_by("inst", F.struct(F.col("inst").isNotNull(), "n", "inst")).alias("inst"))
    own = own.join(registered_texts.select("text").distinct(), "text", "left_anti")
    own = own.select(F.concat(F.lit("~"), "text").alias("cid"), "text", F.lit(None).cast("string").alias("text2"), "kind", "inst", "n", F.lit(False).alias("reg"))
    own = materialise(own, "own")
    cand = materialise(known.unionByName(own), "names")

    vkeys = spread(var.select("vid", "text", "kind", "inst"), "vid").mapInPandas(_variant_keys, "vid long, key string")
    ckeys = spread(cand.select("cid", "text", "text2", "kind", "inst"), "cid").mapInPandas(_name_keys, "cid string, key string").distinct()
    pairs = vkeys.join(ckeys, "key").select("vid", "cid").distinct()
    v = var.select("vid", F.col("text").alias("v_text"), F.col("kind").alias("v_kind"), F.col("inst").alias("v_inst"), F.col("n").alias("v_n"))
    c = cand.select("cid", F.col("text").alias("c_text"), F.col("text2").alias("c_text2"), F.col("kind").alias("c_kind"), F.col("inst").alias("c_inst"), F.col("n").alias("c_n"), F.col("reg").alias("c_reg"))
    full = pairs.join(v, "vid").join(c, "cid").select(
        "vid", "cid", "v_text", "v_kind", "c_text", "c_text2", "c_kind", "v_n", "c_n", "c_reg",
        (F.substring_index("v_text", "(", 1) == F.col("c_text")).alias("same"),
        F.coalesce(F.col("v_inst") == F.col("c_inst"), F.lit(False)).alias("located"),
    )
    scored = spread(full, "vid", "cid").mapInPandas(_scored, "vid long, cid string, lik double, v_n long, c_n long, c_reg boolean, same boolean, located boolean")
    scored = scored.withColumn("score", _attach(F.col("lik"), F.col("v_n"), F.col("c_n"), F.col("c_reg"), F.col("same"), F.col("located"))).where("score is not null")
    # an exact registered form is final; an own form yields to an admissible better one
    better = F.when(F.col("same") & ~F.col("c_reg"), F.lit(0)).otherwise(F.lit(1))
    w = Window.partitionBy("vid").orderBy(F.desc(F.expr("c_reg and lik >= 1")), F.desc(better), F.desc("score"), "cid")
    ranked = scored.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("score").over(w)).withColumn("next_better", F.lead(better).over(w))
    clear = (F.col("lik") >= 1) | F.col("next").isNull() | (F.col("next_better") == 0) | (F.col("score") - F.col("next") > math.log(1.5))
    best = materialise(ranked.where("r = 1").where(clear).select("vid", "cid"), "attached")

    # an own form that was attached elsewhere passes its spellings on, over any number of steps
    texts = own.select("cid", F.col("text"), "kind", "inst")
    hop = texts.withColumn("vid", F.xxhash64("text", "kind", F.coalesce("inst", F.lit("")))).join(best.withColumnRenamed("cid", "cid2"), "vid").where("cid2 <> cid").select("cid", "cid2")
    hop = materialise(hop, "hops")
    last = _ends(hop)
    twice = best.join(last, "cid", "left").select("vid", F.coalesce("end", "cid").alias("cid"))
    ids = var.join(twice, "vid", "left").select("text", "kind", "inst", F.coalesce("cid", F.concat(F.lit("~"), "text", F.lit("@"), F.coalesce("inst", F.lit("")))).alias("entity"))
    ids = ids.withColumnRenamed("text", "i_text").withColumnRenamed("kind", "i_kind").withColumnRenamed("inst", "i_inst")
    s = spell.withColumn("vi", F.when(F.col("kind") != "org", F.col("inst")))
    s = s.join(ids, (s.text == ids.i_text) & (s.kind == ids.i_kind) & s.vi.eqNullSafe(ids.i_inst)).select("raw", "inst", "entity")
    s = s.withColumnRenamed("raw", "s_raw").withColumnRenamed("inst", "s_inst")
    out = e.join(s, (e.raw == s.s_raw) & e.inst.eqNullSafe(s.s_inst), "left")
    return out.select("paper_id", "author_no", "raw", "inst", "entity", F.when(~F.col("entity").startswith("~"), F.col("entity")).alias("author_id"))


def _ends(hop: DataFrame) -> DataFrame:
    """``cid, end``: where each chain of steps ``cid, cid2`` (one a name) ends; a ring ends at its least name."""
    parts = materialise(hash_to_min(hop, "cid", "cid2"), "chains")
    root = parts.join(hop.select(F.col("cid").alias("node")), "node", "left_anti").select("component", F.col("node").alias("root"))
    return parts.join(root, "component", "left").select(F.col("node").alias("cid"), F.coalesce("root", "component").alias("end"))


def found(papers: DataFrame, registry: DataFrame) -> DataFrame:
    """Entries that refer to a registered author by another string than the registered ones."""
    got = resolve(papers, registry).where("author_id is not null")
    r = registry.select("author_id", "name", "name_en").dropDuplicates(["author_id"])
    out = got.join(r, "author_id").where("raw <> name and (name_en is null or raw <> name_en)")
    return out.select("paper_id", "author_no", "author_id").distinct()
