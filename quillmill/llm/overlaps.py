"""Problem 5: records of evaluation splits that occur again in training.

Section texts are normalised to letters and figures with the scanner's confusions
folded.  Winnowed fingerprints route every evaluation text to the training texts with
which it shares a fair part of them; evaluation texts are then dealt into shards, each
shard builds an Aho-Corasick automaton over the passages of its texts and scans the
training texts routed to it, and the matched intervals are merged into coverage per
record.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.canonical import canonical_text
from quillmill.llm.scans import VISUAL
from quillmill.llm.splits import current
from quillmill.session import broadcast_if_small, discard, materialise, occupied, ship_package, spread

#: Letters in a fingerprint, and window from which the least one is taken.
GRAM, WINDOW = 12, 28
#: Bits of a fingerprint that choose its place in the histogram of how common it is; this and HOT change the cost, not the result.
PLACES = 20
#: A fingerprint in more texts than this is met in several tasks.
HOT = 20_000
#: Words of 64 bits in the bitmap of a text's fingerprints.
BITMAP = 7
#: Letters in a passage of the automaton, and least run of them that counts.
PASSAGE, RUN = 8, 24
#: Share of the greater number of fingerprints that two texts must have in common, and of both texts that must be covered.
ROUTED, SHARED = 0.35, 0.62
#: Fingerprints of evaluation texts in a shard, and of training texts scanned by one task.
SHARD, SCANNED = 8_000, 150_000


def _fold_table() -> np.ndarray:
    """Code point to class; 0 drops it.  Scanner's doubles share a class, as do upper and lower case."""
    t = np.zeros(0x11000, dtype=np.uint32)
    same = {a: b for a, b in VISUAL if len(a) == len(b) == 1 and a.isalpha() and not a.isascii()}
    same.update({"o": "0", "l": "1", "i": "1", "s": "5", "g": "9", "c": "e", "b": "h", "!": "1", "이": "0", "시": "사"})
    for cp in range(0x80):
        c = chr(cp).lower()
        if c.isalnum() or c == "!":
            t[cp] = ord(same.get(c, c))
    for cp in range(0x80, 0x11000):
        c = chr(cp)
        if (cp < 0xD800 or cp >= 0xE000) and c.isalnum():
            low = c.lower()
            low = low if len(low) == 1 else c
            for _ in range(3):
                low = same.get(low, low)
            t[cp] = ord(low)
    return t


_TABLE: np.ndarray | None = None


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and figures of many texts, in classes that a scanner does not mix up: (class codes, length of each text)."""
    global _TABLE
    if _TABLE is None:
        _TABLE = _fold_table()
    texts = [canonical_text(t) for t in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], codes)
    keep = got != 0
    return got[keep], np.bincount(owner[keep], minlength=len(texts))


_B = np.uint64(0x100000001B3)


def fingerprints(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the winnowed fingerprints of many texts, in text order; a short text gives one for the whole."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    n = len(codes) - GRAM + 1
    who, what = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    if n > 0:
        level, size, power, parts = codes.astype(np.uint64) + np.uint64(1), 1, _B, []
        left = GRAM
        while left:  # hashes of 1, 2, 4 ... letters, joined to GRAM letters
            if left & 1:
                parts.append((size, power, level))
            left >>= 1
            if left:
                level = level[:-size] * power + level[size:]
                size, power = size * 2, np.uint64(int(power) ** 2 & (1 << 64) - 1)
        h, done = None, 0
        for size, power, level in reversed(parts):
            h = level[:n].copy() if h is None else h[:n] * power + level[done : done + n]
            done += size
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
        valid = owner[:n] == owner[GRAM - 1 :]
        h[~valid] = np.uint64(0xFFFFFFFFFFFFFFFF)
        low = _sliding(h, WINDOW, np.minimum)
        pad = np.concatenate((np.zeros(WINDOW - 1, np.uint64), low, np.zeros(max(0, n - len(low)), np.uint64)))
        # taken if it is the least of some window: then the greatest of the minima over it is its own
        take = (_sliding(pad, WINDOW, np.maximum)[:n] == h) & valid if len(low) else valid
        who, what = owner[:n][take], h[take]
    short = np.flatnonzero((lengths < GRAM) & (lengths > 0))
    if len(short):
        ends = np.cumsum(lengths)
        own = [_small(codes[ends[i] - lengths[i] : ends[i]]) for i in short]
        who, what = np.concatenate((who, short)), np.concatenate((what, np.array(own, dtype=np.uint64)))
    return who, what


def _small(codes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(codes.tobytes())


def _sliding(x: np.ndarray, window: int, op) -> np.ndarray:
    """Least or greatest of each window, by doubling."""
    if len(x) < window:
        return x[:0]
    m, size = x, 1
    while size * 2 <= window:
        m = op(m[:-size], m[size:])
        size *= 2
    extra = window - size
    return op(m[:-extra], m[extra:]) if extra else m


class Shard:
    """Automaton over the passages of some evaluation texts (strings of class codes)."""

    def __init__(self, texts: dict[int, str]) -> None:
        import ahocorasick

        self.length = {k: len(t) for k, t in texts.items()}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, t in texts.items():
            step = min(PASSAGE, max(1, len(t)))
            for i in range(0, len(t) - step + 1, step):
                where[t[i : i + step]].append((k, i))
            if len(t) % step:
                where[t[-step:]].append((k, len(t) - step))
        self.a = ahocorasick.Automaton()
        for w, at in where.items():
            by: dict[int, list[int]] = defaultdict(list)
            for k, i in at:
                by[k].append(i)
            self.a.add_word(w, (len(w), by if len(by) > 4 else at))
        if len(self.a):
            self.a.make_automaton()

    def coverage(self, text: str, wanted: set[int]) -> dict[int, tuple[float, float]]:
        """Of each wanted record, the share of it found in ``text`` and the share of ``text`` that it covers.

        Records with too few passages in ``text`` to reach SHARED are left out.
        """
        hits: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        if not len(self.a) or not text:
            return {}
        for end, (size, at) in self.a.iter(text):
            j = end - size + 1
            if isinstance(at, dict):
                for k in wanted if len(wanted) < len(at) else at.keys() & wanted:
                    if k in at:
                        hits[k].extend((i, j, size) for i in at[k])
                continue
            for k, i in at:
                if k in wanted:
                    hits[k].append((i, j, size))
        # a passage adds to a run its own letters and a gap of two passages at most
        return {k: self._merged(v, k, len(text)) for k, v in hits.items() if 3 * PASSAGE * len({h[0] for h in v}) >= SHARED * self.length[k]}

    def _merged(self, hits: list[tuple[int, int, int]], k: int, length: int) -> tuple[float, float]:
        """Passages that follow each other on both sides form runs; runs are merged into coverage."""
        hits.sort()
        runs: list[list[int]] = []
        open_: list[list[int]] = []
        for i, j, size in hits:
            best = None
            open_ = [r for r in open_ if i - r[1] <= 2 * PASSAGE]
            for r in open_:
                if i >= r[1] - size + 1 and i > r[4] and abs((j - i) - r[5]) <= 5 and j > r[3] - size:
                    if best is None or abs((j - i) - r[5]) < abs((j - i) - best[5]):
                        best = r
            if best is None:
                best = [i, i + size, j, j + size, i, j - i]
                runs.append(best)
                open_.append(best)
            else:
                best[1], best[3], best[4], best[5] = max(best[1], i + size), max(best[3], j + size), i, j - i
        least = min(RUN, self.length[k], length)
        good = [r for r in runs if r[1] - r[0] >= least]
        return _share([(r[0], r[1]) for r in good], self.length[k]), _share([(r[2], r[3]) for r in good], length)


def _share(spans: list[tuple[int, int]], length: int) -> float:
    total, hi = 0, 0
    for a, b in sorted(spans):
        a = max(a, hi)
        if b > a:
            total += b - a
            hi = b
    return min(1.0, total / max(length, 1))


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import xxhash

    for b in batches:
        codes, lengths = folded(b.content.tolist())
        flat = codes.astype("<u4").tobytes().decode("utf-32-le")
        ends = np.cumsum(lengths)
        texts = [flat[e - n : e] for e, n in zip(ends, lengths)]
        b = b.assign(text=texts, sig=np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64).view(np.int64))
        yield b[b.text != ""][["section_id", "role", "sig", "text"]]


def _of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, fingerprint) of each text's distinct fingerprints, and their number in each text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    who, what = fingerprints(codes, np.array([len(t) for t in texts], dtype=np.int64))
    both = np.unique(np.stack((who.astype(np.uint64), what)), axis=1)
    who = both[0].astype(np.int64)
    return who, both[1], np.bincount(who, minlength=len(texts))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << PLACES, dtype=np.int64)
    for b in batches:
        for at in range(0, b.num_rows, 500):
            _, what, _ = _of_texts(b.column(0).slice(at, 500).to_pylist())
            np.add.at(total, (what >> np.uint64(64 - PLACES)).astype(np.int64), 1)
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["place", "n"])


_ROUTE = "h long, section_id long, role int, n int, tasks int, " + ", ".join(f"b{i} long" for i in range(BITMAP))


def _prefixes(held):
    """Rows of each text's rarest fingerprints: all but so many that a partner, sharing ROUTED of them, can't share only the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.frombuffer(held.value, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = part.column(2).to_pylist()
                who, what, n = _of_texts(texts)
                ids, roles = part.column(0).to_numpy(), part.column(1).to_numpy()
                bits = np.zeros((len(texts), 64 * BITMAP), dtype=bool)
                bits[who, (what * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(64 * BITMAP)] = True
                words = np.packbits(bits, axis=1).view(np.int64)
                often = common[(what >> np.uint64(64 - PLACES)).astype(np.int64)]
                order = np.lexsort((what, often, who))
                starts = np.concatenate(([0], np.cumsum(n)))
                rank = np.arange(len(who)) - starts[who[order]]
                took = order[rank <= n[who[order]] - np.ceil(ROUTED * n[who[order]])]
                w = who[took]
                cols = [what[took].view(np.int64), ids[w], roles[w].astype(np.int32), n[w].astype(np.int32), (1 + often[took] // HOT).astype(np.int32), *(words[w, i] for i in range(BITMAP))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "section_id", "role", "n", "tasks", *(f"b{i}" for i in range(BITMAP))])

    return run


def routes(texts: DataFrame) -> DataFrame:
    """``t, e, t_n, e_n``: training and evaluation texts that may share ROUTED of the greater number of fingerprints, from ``section_id, role, text``.

    Complete, however common a fingerprint is: each text is looked up by its rarest
    fingerprints only, as many as leave too few others.  Of the pairs that meet, those
    are left out whose bitmaps prove that they share too little.  The order of rarity
    comes from a histogram of fixed size.
    """
    spark = texts.sparkSession
    counted = texts.select("text").mapInArrow(_places, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    common = np.zeros(1 << PLACES, dtype=np.int64)
    got = counted.toArrow()  # at most 2 ** PLACES rows
    common[got.column("place").to_numpy()] = got.column("n").to_numpy()
    rows = texts.select("section_id", "role", "text").mapInArrow(_prefixes(spark.sparkContext.broadcast(common.tobytes())), _ROUTE)
    t = rows.where("role = 0").withColumn("task", F.pmod(F.xxhash64("section_id"), F.col("tasks")))
    e = rows.where("role = 1").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    sides = [d.select("h", F.col("task").cast("int").alias("task"), *[F.col(c).alias(f"{k}_{c}") for c in ("section_id", "n", *(f"b{i}" for i in range(BITMAP)))]) for d, k in ((t, "t"), (e, "e"))]
    apart = sum((F.bit_count(F.col(f"t_b{i}").bitwiseXOR(F.col(f"e_b{i}"))) for i in range(BITMAP)), F.lit(0))
    most = (F.col("t_n") + F.col("e_n") - apart) / 2
    pairs = sides[0].join(sides[1], ["h", "task"]).where(most >= F.ceil(ROUTED * F.greatest("t_n", "e_n")))
    return pairs.select(F.col("t_section_id").alias("t"), F.col("e_section_id").alias("e"), "t_n", "e_n").distinct()


def _scan(key, evals: pd.DataFrame, trains: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(evals) and len(trains):
        shard = Shard(dict(zip(evals.e, evals.e_text)))
        for t, text, wanted in zip(trains.t, trains.t_text, trains.wanted):
            for e, (a, b) in shard.coverage(text, set(wanted)).items():
                out.append((t, e, a, b))
    return pd.DataFrame(out, columns=["t", "e", "covered", "covers"])


def overlaps(sections: DataFrame, split: DataFrame) -> DataFrame:
    """``train_id, eval_id, covered, covers``: evaluation and training sections that share most of their text.

    ``covered`` is the share of the evaluation text found in the training text, ``covers``
    the share of the latter.  NULL splits and sections without letters take no part;
    exact copies are compared once and listed each.
    """
    spark = sections.sparkSession
    ship_package(spark)
    roles = current(split).where("split is not null").select("paper_id", (F.col("split") != "train").cast("int").alias("role"))
    text = occupied(sections.where("content is not null and content <> ''").select("section_id", "paper_id", "content"), "section_id")
    text = text.join(broadcast_if_small(roles), "paper_id").select("section_id", "role", "content")
    s = materialise(text.mapInPandas(_texts, "section_id long, role int, sig long, text string"), "texts")
    ids = s.select("section_id", "role", "sig")
    first = materialise(ids.groupBy("sig", "role").agg(F.min("section_id").alias("rep")), "first")
    copies = materialise(ids.join(first, ["sig", "role"]).where("section_id <> rep").select("section_id", "rep"), "copies")
    one = s.join(copies.select("section_id"), "section_id", "left_anti").select("section_id", "role", "text")
    cand = materialise(routes(one), "routed")

    # shards of evaluation texts; a shard with many training texts is scanned by several tasks
    total = cand.groupBy("e").agg(F.first("e_n").alias("n")).agg(F.sum("n")).first()[0] or 0
    routed = cand.withColumn("shard", F.pmod(F.xxhash64("e"), F.lit(1 + total // SHARD)))
    scans = materialise(routed.groupBy("shard", "t").agg(F.collect_list("e").alias("wanted"), F.first("t_n").alias("size")), "scans")  # a list is no longer than its shard
    parts = materialise(scans.groupBy("shard").agg(F.ceil(F.sum("size") / SCANNED).cast("int").alias("parts")), "parts")
    wanted = cand.select(F.col("t").alias("section_id")).union(cand.select("e")).distinct()
    texts = materialise(s.select("section_id", "text").join(wanted, "section_id", "left_semi"), "wanted")
    discard(s)
    trains = scans.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("t"), F.col("parts"))).join(texts.select(F.col("section_id").alias("t"), F.col("text").alias("t_text")), "t").select(F.col("shard").alias("t_shard"), F.col("part").cast("long").alias("t_part"), "t", "t_text", "wanted")
    evals = routed.select("shard", "e").distinct().join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(texts.select(F.col("section_id").alias("e"), F.col("text").alias("e_text")), "e").select(F.col("shard").alias("e_shard"), F.col("part").cast("long").alias("e_part"), "e", "e_text")
    got = spread(evals, "e_shard", "e_part").groupBy("e_shard", "e_part").cogroup(spread(trains, "t_shard", "t_part").groupBy("t_shard", "t_part")).applyInPandas(_scan, "t long, e long, covered double, covers double")
    good = materialise(got.where(F.least("covered", "covers") >= SHARED), "covered")

    more = copies.union(first.select(F.col("rep").alias("section_id"), "rep"))
    good = good.join(more.select(F.col("rep").alias("t"), F.col("section_id").alias("train_id")), "t")
    good = good.join(more.select(F.col("rep").alias("e"), F.col("section_id").alias("eval_id")), "e")
    return good.select("train_id", "eval_id", "covered", "covers").distinct()


def found(sections: DataFrame, split: DataFrame) -> DataFrame:
    got = overlaps(sections, split)
    return got.select(F.least("train_id", "eval_id").alias("section_id_1"), F.greatest("train_id", "eval_id").alias("section_id_2")).distinct()


def report(sections: DataFrame, split: DataFrame, source: str = "text_source") -> DataFrame:
    """Overlapping pairs, evaluation and training records per evaluation split and source."""
    got = materialise(overlaps(sections, split), "overlaps")
    where = sections.select(F.col("section_id").alias("eval_id"), "paper_id", F.col(source).alias("source")).dropDuplicates(["eval_id"])
    named = got.join(where, "eval_id").join(current(split), "paper_id")
    return named.groupBy("split", "source").agg(F.count("*").alias("pairs"), F.count_distinct("eval_id").alias("eval_sections"), F.count_distinct("train_id").alias("train_sections"))
