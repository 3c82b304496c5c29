"""First and last of a key, duplicate groups, and pairs by key."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.arrays import bigrams
from quillmill.functions.udfs import sequence_ratio

#: Words of 64 bits in the bitmap of a text's bigrams, classes of bigrams by rarity, pairs that a task compares at once.
BITMAP, ORDER, MET = 8, 1 << 16, 1 << 20


def _pick(df: DataFrame, keys: list[str], order: str, agg) -> DataFrame:
    # max_by combines before the shuffle, unlike a window
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(agg(F.struct(*rest), F.col(order)).alias("row_")).select(*keys, "row_.*").select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: str = "_ord") -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: list[str], order: str = "_ord") -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def first_accepted(df: DataFrame, key: Column, title: Column, order: str = "_ord") -> DataFrame:
    """The rows that one pass in ``order`` accepts, which takes a row if it has a title and neither its key nor its title is taken.

    Rounds, not a pass: a row that is the first left of its key and of its title is
    certain; then the rows it blocks go.  ``order`` must be unique.
    """
    from quillmill.session import materialise

    left = materialise(df.withColumn("k_", key).withColumn("t_", title).where("t_ is not null and t_ <> ''"), "left")
    out = None
    while not left.isEmpty():
        k = left.groupBy("k_").agg(F.min(order).alias("by_k"))
        t = left.groupBy("t_").agg(F.min(order).alias("by_t"))
        sure = materialise(left.join(k, "k_").join(t, "t_").where((F.col(order) == F.col("by_k")) & (F.col(order) == F.col("by_t"))).select(*left.columns), "accepted")
        out = sure if out is None else out.union(sure)
        left = materialise(left.join(sure.select("k_"), "k_", "left_anti").join(sure.select("t_"), "t_", "left_anti").select(*left.columns), "left")
    return (left if out is None else out).select(*df.columns)


def numbered(df: DataFrame, name: str, form: str = "paper_%04d") -> DataFrame:
    """Rows with ``paper_id`` from their rank by name, case aside; ranks come from sorted partitions, not from one task."""
    spark = df.sparkSession
    parts = df.withColumn("low_", F.lower(name)).repartitionByRange("low_", name).sortWithinPartitions("low_", name).withColumn("part_", F.spark_partition_id())
    from quillmill.session import materialise

    held = materialise(parts.withColumn("at_", F.monotonically_increasing_id()), "numbered")
    sizes = held.groupBy("part_").agg(F.count("*").alias("n_"), F.min("at_").alias("first_")).orderBy("part_").collect()  # one row a partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r.part_, before - r.first_))
        before += r.n_
    shift = spark.createDataFrame(offsets, "part_ int, shift_ long")
    return held.join(F.broadcast(shift), "part_").withColumn("paper_id", F.format_string(form, F.col("at_") + F.col("shift_") + 1)).drop("low_", "part_", "at_", "shift_")


def excluded(df: DataFrame, mapping: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows without those that ``mapping`` (``duplicate_id, kept_id``) names duplicates, the duplicates with the id kept for them).

    Raises if an id of the mapping is not in the table: a wrong map must not pass unnoticed.
    """
    ids = df.select(F.col(key).alias("id")).distinct()
    unknown = mapping.select(F.explode(F.array("duplicate_id", "kept_id")).alias("id")).distinct().join(ids, "id", "left_anti").limit(5).collect()
    if unknown:
        raise ValueError(f"ids of the mapping that the table lacks: {[r.id for r in unknown]}")
    m = mapping.select(F.col("duplicate_id").alias(key), "kept_id").distinct()
    return df.join(m, key, "left_anti"), df.join(m, key)


def duplicate_groups(df: DataFrame, fingerprint: Column, key: str) -> DataFrame:
    """Fingerprints held more than once: number of copies and the least key."""
    g = df.where(fingerprint.isNotNull()).groupBy(fingerprint.alias("fingerprint"))
    return g.agg(F.count("*").alias("copies"), F.min(key).alias("representative")).where("copies > 1")


def key_groups(df: DataFrame, key: Column, member: str, reason: str) -> DataFrame:
    """Members of keys that several of them share, each with the least member; one row a member, not a pair."""
    m = df.where(key.isNotNull()).select(key.alias("k"), F.col(member).alias("member")).distinct()
    g = m.groupBy("k").agg(F.min("member").alias("first_member"), F.count("*").alias("n")).where("n > 1")
    return m.join(g, "k").select("member", "first_member", F.col("k").alias("key"), "n", F.lit(reason).alias("reason"))


def key_pairs(df: DataFrame, key: Column, member: str, reason: str, most: int = 1000) -> DataFrame:
    """Pairs of members that share a key, the smaller first; in a group of more than ``most`` each member only meets the least one."""
    m = df.where(key.isNotNull()).select(key.alias("k"), F.col(member).alias("member")).distinct()
    g = m.groupBy("k").agg(F.min("member").alias("least"), F.count("*").alias("n")).where("n > 1")
    m = m.join(g, "k")
    small = m.where(f"n <= {most}")
    pairs = small.select("k", F.col("member").alias("a")).join(small.select("k", F.col("member").alias("b")), "k").where("a < b").select("a", "b")
    star = m.where(f"n > {most} and member <> least").select(F.col("least").alias("a"), F.col("member").alias("b"))
    return pairs.union(star).distinct().select(pair_key(F.col("a"), F.col("b")).alias("p")).select("p.*", F.lit(reason).alias("reason"))


def first_reason_pairs(*parts: DataFrame) -> DataFrame:
    """Union of pair tables in which an earlier table's reason for a pair hides later ones."""
    out = None
    for i, p in enumerate(parts):
        q = p.withColumn("prio", F.lit(i))
        out = q if out is None else out.unionByName(q)
    return out.groupBy("a", "b").agg(F.min_by("reason", "prio").alias("reason"), F.min("prio").alias("prio"))


def _grams(t: str) -> np.ndarray:
    """The distinct bigrams of a text, mixed; a single character stands for itself."""
    c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    g = np.unique(c[:-1] << np.uint64(21) | c[1:]) if len(c) > 1 else c
    g = (g ^ g >> np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15)
    return (g ^ g >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(ORDER, np.int64)
    for b in batches:
        for t in b.column(0).to_pylist():
            n[_grams(t) >> np.uint64(48)] += 1
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["k", "n"])


def _prefixes(often: np.ndarray, need: Callable[[int, int], int]):
    """A row for each of a text's rarest bigrams, all but so many that a text like it can't have only the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, within, side, ids = (b.column(c).to_pylist() for c in ("x", "within", "side", "id"))
            keys, at, rest = [], [], []
            for i, (x, w) in enumerate(zip(xs, within)):
                g = _grams(x)
                least = min(len(g), max(1, need(len(g), len(x))))
                bits = np.zeros(64 * BITMAP, bool)
                bits[g >> np.uint64(20) & np.uint64(64 * BITMAP - 1)] = True
                rest.append((len(g), least, np.packbits(bits).tobytes()))
                g = g[np.lexsort((g, often[g >> np.uint64(48)]))][: len(g) - least + 1]
                keys.append(g + np.uint64(w & 0xFFFFFFFFFFFFFFFF))
                at.append(np.full(len(g), i))
            if at:
                row = np.concatenate(at)
                cols = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.array(side, np.int32)[row]), pa.array(np.array(ids, np.int64)[row])]
                cols += [pa.array(np.array([r[k] for r in rest], np.int32)[row]) for k in (0, 1)] + [pa.array([r[2] for r in rest]).take(pa.array(row))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "side", "id", "n", "need", "bits"])

    return run


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id_0, id_1`` of the texts of one key whose bitmaps do not prove that they share too little."""
    t = pa.Table.from_batches(list(batches))
    if not t.num_rows:
        return
    side = t.column("side").to_numpy()
    cols = []
    for k in (0, 1):
        own = t.filter(pa.array(side == k))
        key = own.column("key").to_numpy()
        by = np.argsort(key, kind="stable")
        bits = np.frombuffer(b"".join(own.column("bits").to_pylist()), np.uint64).reshape(-1, BITMAP)
        cols.append([key[by], *(own.column(c).to_numpy()[by] for c in ("id", "n", "need")), bits[by]])
    (key, a, n0, need0, x), (other, b, n1, need1, y) = cols
    first = np.searchsorted(other, key, "left")
    count = np.searchsorted(other, key, "right") - first
    total = np.cumsum(count)
    half, i = BITMAP // 2, 0
    held: list[np.ndarray] = []
    while i < len(key):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + MET, "right")))
        c = count[i:j]
        p = np.repeat(np.arange(i, j), c)
        q = np.repeat(first[i:j] - (np.cumsum(c) - c), c) + np.arange(len(p))
        most = n0[p] + n1[q] - 2 * np.maximum(need0[p], need1[q])  # bigrams that one of them lacks
        for words in (slice(0, half), slice(0, BITMAP)):
            ok = np.bitwise_count(x[p, words] ^ y[q, words]).sum(axis=1, dtype=np.int32) <= most
            p, q, most = p[ok], q[ok], most[ok]
        if len(p):
            held.append(np.unique(np.stack((a[p], b[q])), axis=1))
        if held and (sum(h.shape[1] for h in held) > MET or j >= len(key)):
            out = np.unique(np.concatenate(held, axis=1), axis=1)
            held = []
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], names=["id_0", "id_1"])
        i = j
    if held:
        out = np.unique(np.concatenate(held, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], names=["id_0", "id_1"])


def alike(left: DataFrame, right: DataFrame, need: Callable[[int, int], int]) -> DataFrame:
    """``t, u, g1, g2``: texts of the two tables that may share ``need(bigrams, letters)`` of the bigrams of each, with these.

    The tables have a text and may have what the other's must equal.  A complete prefix
    filter: each text is looked up by its rarest bigrams only, all but so many that a text
    sharing the need can't have only the rest; rarity is counted in ORDER hashed classes,
    as any order is complete.  Pairs are left out whose bitmaps prove that they share too little.
    """
    from quillmill.session import materialise, occupied, ship_package, spread

    ship_package(left.sparkSession)
    sides = [d.select(F.col(d.columns[0]).alias("x"), (F.xxhash64(d.columns[1]) if len(d.columns) > 1 else F.lit(0)).cast("long").alias("within"), F.lit(i).alias("side")) for i, d in enumerate((left, right))]
    keys = materialise(sides[0].union(sides[1]).distinct().withColumn("id", F.xxhash64("x")), "texts")
    often = np.zeros(ORDER, np.int64)
    for r in occupied(keys.select("x"), "x").mapInArrow(_counted, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():  # at most ORDER rows
        often[r.k] = r.n
    rows = occupied(keys, "id").mapInArrow(_prefixes(often, need), "key long, side int, id long, n int, need int, bits binary")
    met = materialise(spread(rows, "key").mapInArrow(_meeting, "id_0 long, id_1 long").distinct(), "met")  # frees the files shuffled for it
    one = keys.dropDuplicates(["side", "id"])
    texts = [one.where(f"side = {i}").select(F.col("id").alias(f"id_{i}"), F.col("x").alias("tu"[i])) for i in (0, 1)]
    both = spread(met.join(texts[0], "id_0").join(texts[1], "id_1"), "id_0", "id_1")
    return both.select("t", "u", bigrams(F.col("t")).alias("g1"), bigrams(F.col("u")).alias("g2"))


def best_match(df: DataFrame, key: str, title: str, index: DataFrame, item: str, item_title: str, order: str, least: float = 0.82) -> DataFrame:
    """``key, item, similarity``: for each row the index entry with the most similar title, the first in ``order`` of equal ones, if ``least`` similar.

    Titles are compared as :func:`bigram_similarity` of their keys, equal ones by a join;
    the rest meet by :func:`alike`: of a title's bigrams its like has ``least``, or if one
    contains the other, all but those of the letters that may be missing.
    """
    a = df.select(F.col(key).alias("id"), F.col(title).alias("t")).where("t is not null and t <> ''").distinct()
    b = index.select(F.col(item).alias("item"), F.col(item_title).alias("u"), F.col(order).alias("o_")).where("u is not null and u <> ''")
    u = b.groupBy("u").agg(F.min_by("item", "o_").alias("item"), F.min("o_").alias("o_"))
    need = lambda n, m: min(math.ceil(least * n - 1e-9), n - math.floor((1 - least) * m + 1e-9))
    t = a.select("t").distinct()
    equal = t.join(u.select("u"), F.col("t") == F.col("u"), "left_semi")
    pairs = alike(t.exceptAll(equal), u.select("u"), need).withColumn("similarity", bigram_similarity(F.col("t"), F.col("u"), F.col("g1"), F.col("g2"))).where(F.col("similarity") >= least)
    pairs = pairs.select("t", "u", "similarity").union(equal.select("t", F.col("t").alias("u"), F.lit(1.0)))
    best = pairs.join(u, "u").groupBy("t").agg(F.max_by(F.struct("item", "similarity"), F.struct("similarity", -F.col("o_"))).alias("m"))
    return a.join(best, "t").select(F.col("id").alias(key), F.col("m.item").alias(item), "m.similarity")


def pair_key(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def first_reason(*parts: DataFrame) -> DataFrame:
    """Union of member tables in which an earlier table's finding on a member hides later ones."""
    out = parts[0].withColumn("prio", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("prio", F.lit(i)))
    rest = [c for c in out.columns if c not in ("member", "prio")]
    return out.groupBy("member").agg(F.min_by(F.struct(*rest), "prio").alias("r_")).select("member", "r_.*")


def bigram_similarity(a: Column, b: Column, x: Column | None = None, y: Column | None = None) -> Column:
    """1 for equal texts, length ratio if one contains the other (10 characters at least), else Jaccard of bigrams (``x``, ``y`` where known)."""
    x, y = bigrams(a) if x is None else x, bigrams(b) if y is None else y
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    inside = (F.contains(a, b) | F.contains(b, a)) & (short >= 10)
    both = F.size(F.array_intersect(x, y))
    jac = both / (F.size(x) + F.size(y) - both)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(inside, short / long).otherwise(jac)


def fuzzy_pairs(df: DataFrame, key: str, title: str, year: str, author: str, least: float = 0.92) -> DataFrame:
    """``id, id2, ratio``: rows of near-equal titles that share a year or an author (rows are exploded by author), the smaller id first.

    Titles of a year or an author meet by :func:`alike`.  Where M of S letters of two texts
    match, 2 M >= ``least`` S, in at most S - 2 M + 1 runs, a text of m letters lacks at most
    m + S - 3 M of its bigrams, and S >= m 2 / (2 - ``least``).  Each pair of titles is measured once.
    """
    lost = 1 - (3 * least / 2 - 1) * 2 / (2 - least)
    need = lambda n, m: n - math.floor(lost * m + 1e-9)
    d = df.select(F.col(key).alias("id"), F.col(title).alias("t"), F.col(year).alias("y"), F.col(author).alias("au")).where("t is not null and t <> ''").distinct()
    texts = d.select("t", F.concat(F.lit("y"), F.col("y").cast("string")).alias("by")).union(d.select("t", F.concat(F.lit("a"), "au"))).where("by is not null").distinct()
    pairs = alike(texts, texts, need).where("t <= u").select("t", "u").withColumn("ratio", F.when(F.col("t") == F.col("u"), 1.0).otherwise(sequence_ratio("t", "u"))).where(F.col("ratio") >= least)
    both = pairs.union(pairs.where("t < u").select("u", "t", "ratio"))
    out = None
    for by in ("y", "au"):
        a = d.where(f"{by} is not null").select("id", "t", F.col(by).alias("by")).distinct()
        b = a.select(F.col("id").alias("id2"), F.col("t").alias("u"), "by")
        p = a.join(both, "t").join(b, ["u", "by"]).where("id < id2").select("id", "id2", "ratio")
        out = p if out is None else out.union(p)
    return out.groupBy("id", "id2").agg(F.max("ratio").alias("ratio"))
