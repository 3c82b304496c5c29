"""Problem 9: evaluation passages inside training text.

Spaced seeds: fixed masks pick some of the words of a short window, so a changed
word at an ignored position does not hide a match.  Hashes of the documents' windows
are joined with those of the evaluation items' windows; a bitmap of fixed size keeps
windows that no item has from being shuffled.  Where hits of one item gather on
neighbouring diagonals, the overlap is verified by character alignment that tolerates
substitutions, split words and layout.  Few items are held by every task, which then
finds and verifies their hits where the documents are, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.canonical import canonical_text
from quillmill.session import broadcast_if_small, materialise, occupied, ship_package, spread

MASKS = ("11011", "1100101", "1010011")
#: Words of an unbroken stretch that count as a leak.
STRETCH = 14
#: Share of a passage's letters that must be found, in order and close together.
COVER = 0.94
#: Share of the digits of its numbers that must be among it.
NUMBERS = 0.75
#: A sentence of fewer words is no passage.
LEAST_WORDS = 5
GRAM, SLACK = 3, 14
#: Words by which the diagonals of neighbouring hits differ at most.
NEAR = 4
#: Windows of a document that must hit an item before the overlap is verified; fewer where an item has a sentence of fewer windows.
LEAST_HITS = 3
#: Bits of a seed that choose its place in the bitmap of the items' seeds; this changes the cost, not the result.
PLACES = 24
#: Bytes of the items' texts that a task may hold; more items are joined in the cluster. This changes the cost, not the result.
HELD = 4 << 20
#: Places of a document's GRAMs in the table that rules pairs out, documents scanned together, letters of items compared at once; cost only.
SLOTS, SCANNED, LETTERS = 1 << 14, 100, 1 << 20
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")
_PAGE = re.compile(r"={3,}\s*PAGE\s*\d+\s*={3,}")


def words(text: str) -> list[str]:
    return _WORD.findall(_PAGE.sub(" ", canonical_text(text) or "").lower())


_word_hash: dict[str, int] = {}


def _hashes(ws: list[str]) -> np.ndarray:
    import xxhash

    known = _word_hash
    if len(known) > 1_000_000:
        known.clear()
    out = []
    for w in ws:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def seeds(h: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hash of each window of word hashes under a mask."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    for off, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ h[off : off + n]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(29)
    return out


class Passage:
    """Letters of an item and the ranges of them that count: whole sentences, and stretches of words."""

    def __init__(self, text: str) -> None:
        letters: list[str] = []
        spans: set[tuple[int, int]] = set()
        self.starts: list[int] = []
        ends: list[int] = []
        n = 0
        for sent in _SENTENCE.split(canonical_text(text) or ""):
            ws = words(sent)
            begin = n
            for w in ws:
                self.starts.append(n)
                letters.append(w)
                n += len(w)
                ends.append(n)
            if len(ws) >= LEAST_WORDS:
                spans.add((begin, n))
        for i in range(len(ends) - STRETCH + 1):
            spans.add((self.starts[i], ends[i + STRETCH - 1]))
        self.letters = "".join(letters)
        self.spans = np.array(sorted(spans), dtype=np.int64).reshape(-1, 2)
        self.grams = _grams(self.letters) if n >= GRAM else np.empty(0, np.uint64)
        self.numbers = np.array([(m.start(), m.end()) for m in re.finditer(r"\d+", self.letters)], dtype=np.int64).reshape(-1, 2)

    def cover(self, doc: str, diag: int) -> float:
        """Largest share of a range that stands in the letters of ``doc`` near a diagonal; 0 unless its numbers do as well.

        Wording repeats from text to text, figures do not: without them a range is only alike.
        """
        if len(doc) < GRAM or not len(self.grams) or not len(self.spans):
            return 0.0
        gd = _grams(doc)
        order = np.argsort(gd, kind="stable")
        lo, hi = np.searchsorted(gd, self.grams, "left", order), np.searchsorted(gd, self.grams, "right", order)
        c = hi - lo
        total = int(c.sum())
        if not total:
            return 0.0
        i = np.repeat(np.arange(len(self.grams)), c)
        j = order[np.repeat(lo - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(total)]
        i = i[np.abs(j - i - diag) <= SLACK]
        hit = np.zeros(len(self.letters) + 1, dtype=np.int64)
        for g in range(GRAM):
            hit[i + g] = 1
        before = np.concatenate(([0], np.cumsum(hit)))
        a, b = self.spans[:, 0], self.spans[:, 1]
        share = (before[b] - before[a]) / (b - a)
        if len(self.numbers):
            x, y = self.numbers[:, 0], self.numbers[:, 1]
            x2, y2 = np.maximum(x - 1, 0), np.minimum(y + 1, len(self.letters))
            digits = y - x
            # a figure counts with a neighbour on either side, so that it is no part of a longer one
            good = ((before[y] - before[x2] == y - x2) | (before[y2] - before[x] == y2 - x)) * digits
            g0, d0 = np.concatenate(([0], np.cumsum(good))), np.concatenate(([0], np.cumsum(digits)))
            p, q = np.searchsorted(x, a), np.searchsorted(y, b, "right")
            p = np.minimum(p, q)
            have, of = g0[q] - g0[p], d0[q] - d0[p]
            share = np.where(have >= NUMBERS * of, share, 0.0)
            share = np.where((of > 0) | (share >= 0.9), share, 0.0)
        return float(share.max())


def _grams(s: str) -> np.ndarray:
    x = np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    n = len(x) - GRAM + 1
    out = np.zeros(n, dtype=np.uint64)
    for g in range(GRAM):
        out = out * np.uint64(0x100000001B3) + x[g : g + n]
    return out


def least_hits(text: str) -> int:
    """Windows of the shortest mask in the shortest sentence that counts, but no more than LEAST_HITS."""
    spans = [n for n in (len(words(x)) for x in _SENTENCE.split(canonical_text(text) or "")) if n >= LEAST_WORDS]
    return max(1, min(LEAST_HITS, min(spans, default=STRETCH) - min(map(len, MASKS)) + 1))


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        parts = []
        for i, t in zip(b.item_id, b.item_text):
            h, least = _hashes(words(t)), least_hits(t)
            for k, m in enumerate(MASKS):
                s = seeds(h, m, k + 1)
                parts.append(pd.DataFrame({"seed": s.view(np.int64), "item_id": i, "ipos": np.arange(len(s)), "least": least}))
        if parts:
            yield pd.concat(parts)


def item_seeds(items: DataFrame) -> DataFrame:
    """``seed, item_id, ipos, least`` of all seeds of all items, however many items share one."""
    schema = T.StructType([T.StructField("seed", T.LongType()), items.schema["item_id"], *[T.StructField(c, T.IntegerType()) for c in ("ipos", "least")]])
    return materialise(items.mapInPandas(_item_seeds, schema), "seeds")


def _passed(tokens: list[list[str]], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed, document, position) of the windows whose place in the bitmap is taken."""
    h = _hashes([w for ws in tokens for w in ws])
    starts = np.cumsum([0] + [len(ws) for ws in tokens])
    got, where = [], []
    for k, m in enumerate(MASKS):
        s = seeds(h, m, k + 1)
        place = s >> np.uint64(64 - PLACES)
        ok = np.flatnonzero(bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
        got.append(s[ok])
        where.append(ok)
    seed, pos = np.concatenate(got), np.concatenate(where)
    doc = np.searchsorted(starts, pos, "right") - 1
    return seed, doc, pos - starts[doc]


def _windows(held, key: T.StructField):
    """Windows of documents whose place in the bitmap is taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, dtype=np.uint64)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                ids = b.column(0).slice(at, 500)
                seed, doc, pos = _passed([words(t) if t else [] for t in b.column(1).slice(at, 500).to_pylist()], bits)
                if len(seed):
                    yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), ids.take(pa.array(doc)), pa.array(pos.astype(np.int32))], names=["seed", "doc_id", "pos"])

    return run


class Items:
    """Seeds, letters and ranges of all items in flat arrays."""

    def __init__(self, ids: pa.Array, texts: list[str]) -> None:
        self.ids, self.texts = ids, texts
        self.least = np.array([least_hits(t) for t in texts])
        seed, item, ipos = [], [], []
        for i, t in enumerate(texts):
            h = _hashes(words(t))
            for k, m in enumerate(MASKS):
                s = seeds(h, m, k + 1)
                seed.append(s)
                item.append(np.full(len(s), i))
                ipos.append(np.arange(len(s)))
        every = np.concatenate(seed)
        by = np.argsort(every, kind="stable")
        self.item, self.ipos = np.concatenate(item)[by], np.concatenate(ipos)[by]
        self.seed, self.first, self.count = np.unique(every[by], return_index=True, return_counts=True)
        place = self.seed >> np.uint64(64 - PLACES)
        self.bits = np.zeros(1 << PLACES - 6, dtype=np.uint64)
        np.bitwise_or.at(self.bits, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        held = [Passage(t) for t in texts]
        # the slot of the gram at each letter; the last letters have none
        self.slot = np.concatenate([np.concatenate((p.grams % np.uint64(SLOTS), np.full(len(p.letters) - len(p.grams), SLOTS))).astype(np.int32) for p in held])
        self.letters, self.spans = np.array([len(p.letters) for p in held]), np.array([len(p.spans) for p in held])
        self.start, self.word0 = np.concatenate([np.array(p.starts, dtype=np.int64) for p in held]), np.cumsum([0] + [len(p.starts) for p in held])
        self.letter0, self.span0 = np.cumsum(self.letters) - self.letters, np.cumsum(self.spans) - self.spans
        self.span = np.concatenate([p.spans for p in held])
        self.numbers = np.array([len(p.numbers) for p in held])
        self.number0, self.number = np.cumsum(self.numbers) - self.numbers, np.concatenate([p.numbers for p in held])
        # of each range the numbers in it, as in Passage.cover, and their digits
        inside = [(np.searchsorted(p.numbers[:, 0], p.spans[:, 0]), np.searchsorted(p.numbers[:, 1], p.spans[:, 1], "right")) for p in held]
        self.inside = np.concatenate([np.stack((np.minimum(x, y), y), axis=1) for x, y in inside])
        total = [np.concatenate(([0], np.cumsum(p.numbers[:, 1] - p.numbers[:, 0]))) for p in held]
        self.digits = np.concatenate([t[y] - t[np.minimum(x, y)] for t, (x, y) in zip(total, inside)])

    def hits(self, tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, position, position in the item) of all equal windows, in this order."""
        seed, doc, pos = _passed(tokens, self.bits)
        j = np.minimum(np.searchsorted(self.seed, seed), len(self.seed) - 1)
        ok = self.seed[j] == seed
        j, doc, pos = j[ok], doc[ok], pos[ok]
        c = self.count[j]
        at = _ranges(self.first[j], c)
        doc, pos, item, ipos = np.repeat(doc, c), np.repeat(pos, c), self.item[at], self.ipos[at]
        by = np.lexsort((ipos, pos, item, doc))
        return doc[by], item[by], pos[by], ipos[by]

    def may_hold(self, letters: list[str], doc: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the document's grams, between two diagonals, can cover enough of a range of the item and of its numbers."""
        first, last = np.full((len(letters), SLOTS + 1), 1 << 30, dtype=np.int32), np.full((len(letters), SLOTS + 1), -1 << 30, dtype=np.int32)
        for d in np.unique(doc):
            if len(letters[d]) >= GRAM:
                at = (_grams(letters[d]) % np.uint64(SLOTS)).astype(np.int32)
                last[d, at] = np.arange(len(at))
                first[d, at[::-1]] = np.arange(len(at))[::-1]
        out = np.zeros(len(doc), dtype=bool)
        sums = np.cumsum(self.letters[item])
        for some in np.split(np.arange(len(doc)), np.searchsorted(sums, np.arange(LETTERS, sums[-1], LETTERS))):
            if not len(some):
                continue
            d, i = doc[some], item[some]
            n = self.letters[i]
            cell = np.repeat(d * (SLOTS + 1), n) + self.slot[_ranges(self.letter0[i], n)]
            at = _ranges(np.zeros_like(n), n)
            gram = (first.ravel()[cell] - at <= np.repeat(high[some] + SLACK, n)) & (last.ravel()[cell] - at >= np.repeat(low[some] - SLACK, n))
            hit = gram.copy()
            for g in range(1, GRAM):
                hit[g:] |= gram[:-g]
            before = np.concatenate(([0], np.cumsum(hit)))
            k = self.numbers[i]
            x, y = self.number[_ranges(self.number0[i], k)].T
            base, last = np.repeat(np.cumsum(n) - n, k), np.repeat(n, k)
            x2, y2 = np.maximum(x - 1, 0), np.minimum(y + 1, last)
            good = ((before[base + y] - before[base + x2] == y - x2) | (before[base + y2] - before[base + x] == y2 - x)) * (y - x)
            good = np.concatenate(([0], np.cumsum(good)))
            m = self.spans[i]
            at = _ranges(self.span0[i], m)
            (a, b), (p, q), of = self.span[at].T, self.inside[at].T, self.digits[at]
            base, number0 = np.repeat(np.cumsum(n) - n, m), np.repeat(np.cumsum(k) - k, m)
            enough = (before[base + b] - before[base + a] >= COVER * (b - a) - 1e-6) & (good[number0 + q] - good[number0 + p] >= NUMBERS * of)
            out[some[np.repeat(np.arange(len(some)), m)[enough]]] = True
        return out


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _scanned(held, key: T.StructField, item: T.StructField):
    """Documents with the items that they contain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Items = held.value
        for b in batches:
            for at in range(0, b.num_rows, SCANNED):
                tokens = [words(t) if t else [] for t in b.column(1).slice(at, SCANNED).to_pylist()]
                doc, item, pos, ipos = x.hits(tokens)
                if not len(doc):
                    continue
                same = np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])))
                pair = np.cumsum(same) - 1
                sizes = np.cumsum([0] + [len(ws) for ws in tokens])
                ends = np.cumsum([0] + [len(w) for ws in tokens for w in ws])
                # hits of a pair on neighbouring word diagonals, as _anchors has them, and the letter diagonals that they span
                by = np.lexsort((pos - ipos, pair))
                diag = (pos - ipos)[by]
                part = np.empty(len(by), dtype=np.int64)
                part[by] = np.cumsum(np.concatenate(([True], (pair[by][1:] != pair[by][:-1]) | (diag[1:] - diag[:-1] > NEAR)))) - 1
                by = np.lexsort((pos, part))
                new = np.concatenate(([True], part[by][1:] != part[by][:-1]))
                start = np.flatnonzero(new)
                new[1:] |= pos[by][1:] != pos[by][:-1]
                far = ((ends[sizes[doc] + pos] - ends[sizes[doc]]) - x.start[x.word0[item] + ipos])[by]
                low, high, one = np.minimum.reduceat(far, start), np.maximum.reduceat(far, start), by[start]
                ok = np.add.reduceat(new.astype(np.int64), start) >= x.least[item[one]]
                one = one[ok]
                if not len(one):
                    continue
                ok = x.may_hold(["".join(ws) for ws in tokens], doc[one], item[one], low[ok], high[ok])
                begin = np.append(np.flatnonzero(same), len(doc))
                got = []
                for k in np.unique(pair[one[ok]]):
                    s, e = begin[k], begin[k + 1]
                    if contains(tokens[doc[s]], x.texts[item[s]], pos[s:e], ipos[s:e], x.least[item[s]]):
                        got.append((doc[s], item[s]))
                if got:
                    d, i = zip(*got)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, SCANNED).take(pa.array(d)), x.ids.take(pa.array(i))], names=["doc_id", "item_id"])

    return run


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keeps pairs of which enough hits lie on neighbouring diagonals, with these hits."""
    for b in batches:
        keep = []
        for at, ip, least in zip(b["at"], b["ip"], b["least"]):
            keep.append(bool(_anchors(np.array(at), np.array(ip), least)))
        yield b[keep]


def _anchors(at: np.ndarray, ip: np.ndarray, least: int) -> list[int]:
    """Hits around which at least ``least`` windows of the document hit near one diagonal, in order of their position."""
    order = np.argsort(at, kind="stable")
    pos, diag = at[order], (at - ip)[order]
    lo, hi = np.searchsorted(pos, pos - 2 * STRETCH, "left"), np.searchsorted(pos, pos + 2 * STRETCH, "right")
    out = []
    for k, r in enumerate(order):
        near = pos[lo[k] : hi[k]][np.abs(diag[lo[k] : hi[k]] - diag[k]) <= NEAR]
        if len(near) >= least and len(np.unique(near)) >= least:
            out.append(int(r))
    return out


@lru_cache(5_000)
def passage(text: str) -> Passage:
    return Passage(text)


def contains(flat: list[str], item: str, at: np.ndarray, ip: np.ndarray, least: int) -> bool:
    """Whether an item's passage stands in the words ``flat`` of a text around the hits ``at`` (window of the text), ``ip`` (of the item)."""
    p = passage(item)
    tested = -1
    for r in _anchors(at, ip, least):
        if at[r] <= tested:
            continue
        lo, hi = max(0, int(at[r] - ip[r]) - 12), min(len(flat), int(at[r] - ip[r]) + len(p.starts) + 16)
        tested = at[r] + STRETCH // 2
        offset = sum(map(len, flat[lo : int(at[r])])) - p.starts[int(ip[r])]
        if p.cover("".join(flat[lo:hi]), offset) >= COVER:
            return True
    return False


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keep = [contains(words(t), i, np.array(at), np.array(ip), least) for t, i, at, ip, least in zip(b["text"], b["item_text"], b["at"], b["ip"], b["least"])]
        yield b[keep][["doc_id", "item_id"]]


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id`` of every document that holds a whole sentence or a long stretch of an item.

    NULL and empty texts on either side match nothing; repeated rows count once.
    """
    spark = docs.sparkSession
    ship_package(spark)
    one = items.where("item_text is not null and item_text <> '' and item_id is not null").select("item_id", "item_text").dropDuplicates(["item_id"])
    base = docs.where("text is not null and text <> '' and doc_id is not null").select("doc_id", "text")
    key, item = docs.schema["doc_id"], items.schema["item_id"]
    one = materialise(one, "items")
    if (one.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0) <= HELD:
        got = one.toArrow().combine_chunks()  # at most HELD bytes of texts
        texts = got.column("item_text").to_pylist()
        if not any(len(words(t)) >= min(map(len, MASKS)) for t in texts):
            return spark.createDataFrame([], T.StructType([key, item]))
        ids = pa.concat_arrays(got.column("item_id").chunks)
        return occupied(base, "doc_id").mapInArrow(_scanned(spark.sparkContext.broadcast(Items(ids, texts)), key, item), T.StructType([key, item])).distinct()
    sought = item_seeds(one)
    place = F.shiftrightunsigned("seed", 64 - PLACES)
    taken = sought.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - PLACES}) & 63 as int))")).alias("bits"))
    bits = np.zeros(1 << PLACES - 6, dtype=np.int64)
    got = taken.toArrow()  # at most 2 ** PLACES bits
    bits[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    rows = T.StructType([T.StructField("seed", T.LongType()), key, T.StructField("pos", T.IntegerType())])
    hits = occupied(base, "doc_id").mapInArrow(_windows(spark.sparkContext.broadcast(bits.tobytes()), key), rows).join(sought, "seed")
    hits = hits.groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_list(F.struct("pos", "ipos"))).alias("h"), F.first("least").alias("least")).where("size(h) >= least")
    pairs = hits.select("doc_id", "item_id", "h.pos", "h.ipos", "least").toDF("doc_id", "item_id", "at", "ip", "least")
    near = materialise(pairs.mapInPandas(_gathered, pairs.schema), "near")
    texts = base.join(broadcast_if_small(near.select("doc_id").distinct()), "doc_id", "left_semi")
    full = near.join(texts, "doc_id").join(one, "item_id").select("doc_id", "item_id", "text", "item_text", "at", "ip", "least")
    return spread(full, "doc_id", "item_id").mapInPandas(_verified, T.StructType([key, item])).distinct()


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per item: documents that contain it, and the sources they come from."""
    hit = leaks(docs, items)
    return hit.join(docs.select("doc_id", "source"), "doc_id").groupBy("item_id").agg(F.count_distinct("doc_id").alias("docs"), F.count_distinct("source").alias("sources"))
