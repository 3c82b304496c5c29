"""Problem 7: splits that keep related records together.

Papers and author entities form a bipartite graph, publications that are held
twice add further edges; hash-to-min gives the components.  ``assign`` deals whole
components to splits by weighted rendezvous hashing; ``found`` reports the papers
that stray from the majority of their component today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm import authors, publications
from quillmill.llm.components import hash_to_min
from quillmill.session import materialise, scratch

PROPORTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def split_name(col: Column | str) -> Column:
    """``train``, ``validation`` or ``test`` from any of their spellings; NULL for anything else."""
    c = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    return F.when(c.rlike("^tr(ai?n(ing)?)?$"), "train").when(c.rlike("^(val(id(ation)?)?|dev)$"), "validation").when(c.rlike("^test(ing)?$|^eval(uation)?$"), "test")


def current(split: DataFrame) -> DataFrame:
    """``paper_id, split`` that holds today: of several rows the one with the highest ``_ord``."""
    last = split.where("paper_id is not null").groupBy("paper_id").agg(F.max_by("split", "_ord").alias("s"))
    return last.select("paper_id", split_name("s").alias("split"))


def connected(papers: DataFrame, registry: DataFrame) -> DataFrame:
    """``paper_id, component``: papers linked by an author or a common publication, over any number of steps."""
    with scratch() as made:
        # the tables of the names go before those of the publications are made
        with scratch() as of_names:
            who = materialise(authors.resolve(papers, registry).where("entity is not null").select("paper_id", "entity").distinct(), "who")
            of_names.remove(who)
        made.append(who)
        # a paper stands for its least author, so the graph has the authors as nodes, and only papers without any
        own = who.groupBy("paper_id").agg(F.min("entity").alias("least")).select("paper_id", F.concat(F.lit("q"), "least").alias("node"))
        every = papers.select("paper_id").where("paper_id is not null").distinct()
        node = materialise(every.join(own, "paper_id", "left").select("paper_id", F.coalesce("node", F.concat(F.lit("p"), "paper_id")).alias("node")), "nodes")
        by_author = who.join(node, "paper_id").select(F.col("node").alias("a"), F.concat(F.lit("q"), "entity").alias("b"))
        twins = publications.links(papers)
        twins = twins.join(node.select(F.col("paper_id").alias("a"), F.col("node").alias("x")), "a").join(node.select(F.col("paper_id").alias("b"), F.col("node").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        alone = node.select(F.col("node").alias("a"), F.col("node").alias("b"))
        got = hash_to_min(by_author.union(twins).union(alone))
        first = node.join(got, "node")
        named = materialise(first.select("paper_id", "component"), "members")
        made.remove(named)
    # a component is named by its least paper
    return named.join(named.groupBy("component").agg(F.min("paper_id").alias("least")), "component").select("paper_id", F.col("least").alias("component"))


def assign(parts: DataFrame, proportions: dict[str, float] | None = None, seed: int = 7) -> DataFrame:
    """``paper_id, component, split``: each component goes to the split with the best weighted rendezvous score.

    The score of a split is ``-weight / ln(u)`` with ``u`` hashed from component, split
    and seed, so a changed proportion moves no more components than it must.
    """
    p = proportions or PROPORTIONS
    scores = []
    for name, weight in p.items():
        u = (F.pmod(F.xxhash64(F.col("component"), F.lit(name), F.lit(seed)), F.lit(1 << 52)).cast("double") + 1) / float((1 << 52) + 2)
        scores.append(F.struct((-F.lit(float(weight)) / F.log(u)).alias("score"), F.lit(name).alias("name")))
    return parts.withColumn("split", F.greatest(*scores)["name"] if len(scores) > 1 else scores[0]["name"])


def strays(parts: DataFrame, now: DataFrame) -> DataFrame:
    """Papers whose split differs from that of most papers of their component, with both splits.

    Papers with a NULL split do not count and are none; without a strict majority a
    component has no strays.
    """
    both = parts.join(now.where("split is not null"), "paper_id")
    votes = both.groupBy("component", "split").agg(F.count("*").alias("n"))
    w = Window.partitionBy("component").orderBy(F.desc("n"), "split")
    top = votes.withColumn("r", F.row_number().over(w)).withColumn("runner", F.lead("n").over(w)).where("r = 1 and (runner is null or n > runner)")
    return both.join(top.select("component", F.col("split").alias("majority"), F.col("n").alias("votes")), "component").where("split <> majority")


def found(papers: DataFrame, split: DataFrame, registry: DataFrame) -> DataFrame:
    parts = materialise(connected(papers, registry), "parts")
    return strays(parts, current(split)).select("paper_id").distinct()
