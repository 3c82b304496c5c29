"""Problem 2: noise in text from scanned pages.

Word statistics of the whole corpus give a vocabulary (words above a fixed share of
all words, so its size is bounded) and how often one of its words follows another.
A Levenshtein automaton over jamo, run over a trie of the vocabulary, retrieves every
near word of all rare words; the differences that recur over many words and over a
share of those in which they could, always far rarer than what they replace, are the
scanner's confusions and join the classical ones.  The automaton with these as edges
retrieves what each word of a text may stand for, or what any other single edit makes
of it; a noisy channel ranks the readings by the words around it.  Each section is searched for
misread and broken words, running headers and page numbers, and rewritten as
continuous paragraphs.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.publications import prefix_edits, records, title_parts
from quillmill.session import materialise, occupied, ship_package, spread

#: Share of all words from which a word belongs to the vocabulary: at most 1 / FLOOR words do.
FLOOR = 1e-6
LEAST_COUNT = 4
#: A misread form is at least this much rarer than the word it stands for.
RARER = 14
#: Distinct words in which a difference must recur to count as a confusion.
RECURS = 6
#: They are at least this share of the frequent words that hold the letters meant; chance likenesses are fewer, in a corpus of any size.
SHARE = 0.2
#: An edit that is no known confusion is as unlikely as so many confusions.
OTHER = 3
#: Weight of a word's own share where the pair of words is not known.
BACK = 0.4
# Letters that scanners take for others (read -> meant).
VISUAL = (
    ("0|", "이"), ("사1", "시"), ("틀", "를"), ("힌", "한"), ("엿", "였"), ("엇", "었"), ("치", "지"), ("논", "는"), ("쑤", "수"),
    ("르", "로"), ("엄", "업"), ("퇴", "되"), ("시", "서"), ("샤", "사"), ("걸", "결"), ("익", "의"), ("내", "대"), ("괸", "관"), ("오", "온"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("5", "s"), ("9", "g"), ("8", "b"), ("6", "b"), ("b", "h"), ("c", "e"), ("m", "rn"), ("rn", "m"),
    ("d", "cl"), ("cl", "d"), ("ii", "u"), ("vv", "w"), ("l", "i"), ("|", "l"), ("li", "h"), ("tl", "ti"), ("fi", "h"), ("n", "ri"), ("ri", "n"),
)

PAGE_NUMBER = re.compile(r"^\s*(?:[-–—‐]\s*\d{1,4}\s*[-–—‐]|(?:p|pp|page|쪽)\.?\s*\d{1,4}|[<\[(〈]\s*\d{1,4}\s*[>\])〉]|\d{1,4}\s*/\s*\d{1,4}|\d{1,4}\s*쪽|\d{1,3})\s*$", re.I)
HEADER = re.compile(r"^\s*(?:[^.!?\[\]]{2,40}[^\d\s]\s*제\s*\d+\s*권(?:\s*제\s*\d+\s*호)?|[^.!?\[\]]{2,60},\s*Vol\.\s*\d+(?:,\s*(?:No|Issue)\.\s*\d+)?|\d{4}년?\s+\S+\s+(?:학술대회|학술발표회|컨퍼런스)(?:\s*(?:발표집|논문집|자료집))?|(?:Proceedings|Proc\.)\s[^.]{4,60}|\d{4}\s[^.]{3,40}(?:Conference|Proceedings|Symposium)[^.]{0,30})\s*$")
AUTHOR_TITLE = re.compile(r"^\s*[^/\d]{2,40}\S\s/\s\S[^/]{5,}$")
TABLE = re.compile(r"^\s*(?:\d+\.\d+%?|(?:\d{4}\s*){2,}|구분|평균|표준편차|Mean|S\.?D\.?|N)\s*$")
BULLET = re.compile(r"^\s*(?:[•·▪◦*○●■□]|\[\d+\]|\d+[.)]|[①-⑳]|[-–]\s)")
END = re.compile(r"[.!?。！？:;]['\"”’)\]]*\s*$")
HYPHEN = re.compile(r"(\w)[-‐­‑]\s*$")
_EDGE = ".,;:()[]{}“”‘’\"'?·•…<>"


def norm(token: str) -> str:
    """A word as it is counted: lower case, without punctuation around it, leading figures folded."""
    w = token.strip(_EDGE).rstrip("!")
    if w[:1].isdigit():
        m = re.match(r"^\d[\d.,]*%?(?=[^\d|]|$)", w)
        if m and (m.end() == len(w) or not w[m.end()].isascii()):
            w = "#" + w[m.end() :]
    return w.lower()


def clean_lines(text: str) -> list[str]:
    """Lines, without page numbers and recognisable headers."""
    return [x for x in text.replace("\r\n", "\n").replace("\r", "\n").split("\n") if not (len(x) < 24 and PAGE_NUMBER.match(x) or is_header(x))]


def is_header(line: str) -> bool:
    if not ("권" in line or "Vol" in line or "학술" in line or " / " in line or "Proc" in line or "Conf" in line or "Symp" in line or "컨퍼" in line):
        return False
    return bool(HEADER.match(line) or AUTHOR_TITLE.match(line) and not END.search(line) and len(line) < 90)


class _Counts:
    """Counts of words and of neighbours in a line, in arrays: a token is the number of its normalised word."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {"": 0}  # 0 also stands between lines
        self.raw: dict[str, int] = {"": 0}
        self.normal = [0]
        self.n = self.inner = np.zeros(0, np.int64)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, texts: Sequence[str | None]) -> None:
        raw, flat = self.raw, []
        for t in texts:
            if t:
                for line in clean_lines(t):
                    flat.extend(line.split())
                    flat.append("")
        if not flat:
            return
        for w in set(flat).difference(raw):
            raw[w] = len(self.normal)
            self.normal.append(self.words.setdefault(norm(w), len(self.words)))
        at = np.fromiter(map(raw.__getitem__, flat), np.int64, len(flat))
        gap = np.concatenate(([True], at == 0, [True]))
        ids = np.array(self.normal, np.int64)[at]
        size = len(self.words)
        inside = ~(gap[:-2] | gap[2:])
        self.n = _sum(self.n, np.bincount(ids, minlength=size))
        self.inner = _sum(self.inner, np.bincount(ids[inside], minlength=size))
        left, right = ids[:-1], ids[1:]
        both = (left > 0) & (right > 0)
        self.pairs.append(np.unique(left[both] << 32 | right[both], return_counts=True))

    def batch(self) -> pa.RecordBatch:
        names = list(self.words)
        keep = [i for i, w in enumerate(names) if w and w != "#"]
        words, n, inner = [names[i] for i in keep], self.n[keep], self.inner[keep]
        keys, at = np.unique(np.concatenate([k for k, _ in self.pairs]), return_inverse=True)
        m = np.bincount(at, np.concatenate([c for _, c in self.pairs])).astype(np.int64)
        every = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(words, pa.string()), every.take(pa.array(keys >> 32))]),
            pa.concat_arrays([pa.nulls(len(words), pa.string()), every.take(pa.array(keys & 0xFFFFFFFF))]),
            pa.array(np.concatenate([n, m])), pa.array(np.concatenate([inner, np.zeros(len(m), np.int64)])),
        ], names=["word", "following", "n", "n_in"])


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    b[: len(a)] += a
    return b


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = _Counts()
    for b in batches:
        c.add(b.column(0).to_pylist())
        if len(c.raw) > 400_000 or sum(len(k) for k, _ in c.pairs) > 4_000_000:
            yield c.batch()
            c = _Counts()
    if c.pairs:
        yield c.batch()


def word_counts(sections: DataFrame) -> DataFrame:
    """``word, following, n, n_in``: how often each word occurs, and how often inside a line; with ``following``, how often that word comes next in a line.

    Pairs of words below ``LEAST_COUNT`` are left out: they say no more than their words.
    """
    got = occupied(sections.select("section_id", "content"), "section_id").select("content").mapInArrow(_count, "word string, following string, n long, n_in long")
    return got.groupBy("word", "following").agg(F.sum("n").alias("n"), F.sum("n_in").alias("n_in")).where(f"following is null or n >= {LEAST_COUNT}")


class Trie:
    """Vocabulary trie over jamo, read from the front or from the back."""

    def __init__(self, words, back: bool = False) -> None:
        self.root: dict = {}
        for w in words:
            node = self.root
            x = unicodedata.normalize("NFD", w)
            for c in reversed(x) if back else x:
                node = node.setdefault(c, {})
            node[""] = w

    def confused(self, word: str, table: dict[str, list[tuple[str, str, int]]], most: int) -> dict[str, int]:
        """All words that ``word`` may stand for by at most ``most`` of the confusions in ``table``, with their least weight.

        The states of the automaton are a node and a place in the word; a confusion is one
        edge whatever its length, and takes whole letters of the word.
        """
        w = unicodedata.normalize("NFD", word)
        n = len(w)
        out: dict[str, int] = {}
        seen: dict[tuple[int, int, int], int] = {}
        stack = [(self.root, 0, 0, 0)]
        while stack:
            node, i, used, weight = stack.pop()
            if seen.get((id(node), i, used), weight + 1) <= weight:
                continue
            seen[id(node), i, used] = weight
            while True:
                if i == n:
                    if used and "" in node:
                        out[node[""]] = min(weight, out.get(node[""], weight))
                    break
                c = w[i]
                if used < most:
                    for a, b, k in table.get(c, ()):
                        j = i + len(a)
                        if w.startswith(a, i) and not (j < n and "\u11a8" <= w[j] <= "\u11ff"):
                            to = _walk(node, b, 0)
                            if to is not None:
                                stack.append((to, j, used + 1, weight + k))
                node = node.get(c)
                if node is None:
                    break
                i += 1
        return out

    def edited(self, x: str, start: int, wide: bool, out: dict[str, None]) -> None:
        """Words one edit from ``x``, the edit not before ``start``: a jamo more, less or other, if ``wide`` also one for two or two for one."""
        node = _walk(self.root, x[:start], 0)
        n = len(x)
        for j in range(start, n + 1):
            if node is None:
                return
            ends = []
            if j < n:
                ends.append((node, j + 1))
            for c, one in node.items():
                if not c:
                    continue
                ends.append((one, j))
                if j < n:
                    ends.append((one, j + 1))
                    if wide:
                        ends.extend((two, j + 1) for d, two in one.items() if d)
                        if j + 1 < n:
                            ends.append((one, j + 2))
            for at, k in ends:
                to = _walk(at, x, k)
                if to is not None and "" in to:
                    out[to[""]] = None
            node = node.get(x[j]) if j < n else None


def _walk(node: dict, x: str, i: int) -> dict | None:
    for c in x[i:] if i else x:
        node = node.get(c)
        if node is None:
            return None
    return node


class NearIndex:
    """The vocabulary as a trie and as one of its mirror: an edit leaves the half before or after it as it is, so only deep nodes branch."""

    def __init__(self, vocabulary) -> None:
        self.front, self.back = Trie(vocabulary), Trie(vocabulary, back=True)

    def near(self, word: str, wide: bool = False) -> list[str]:
        """All words within one edit of the jamo; ``wide`` counts two read as one and one read as two as an edit, too."""
        w = unicodedata.normalize("NFD", word)
        h = len(w) // 2
        out: dict[str, None] = {}
        self.front.edited(w, h, wide, out)
        # an edit that begins before h leaves all from h + 1 on
        self.back.edited(w[::-1], max(0, len(w) - h - 1), wide, out)
        to = _walk(self.front.root, w, 0)
        if to is not None and "" in to:
            out[to[""]] = None
        return list(out)


def _difference(read: str, meant: str) -> tuple[str, str] | None:
    """The letters that differ, at most two on each side; with the letter before them if one side has none."""
    i = 0
    while i < min(len(read), len(meant)) and read[i] == meant[i]:
        i += 1
    j = 0
    while j < min(len(read), len(meant)) - i and read[-1 - j] == meant[-1 - j]:
        j += 1
    if i and (i == len(read) - j or i == len(meant) - j):
        i -= 1
    a, b = read[i : len(read) - j], meant[i : len(meant) - j]
    return (a, b) if 0 < len(a) <= 2 and 0 < len(b) <= 2 and lettered(a) and b.isalpha() else None


def lettered(x: str) -> bool:
    """Whether ``x`` may be misread letters: no mark of punctuation or hyphenation in it."""
    return all(c.isalnum() or c in "|!" for c in x)


def confusions(counts: DataFrame, vocabulary: dict[str, int]) -> tuple[list[tuple[str, str, int]], dict[str, list[str]]]:
    """(read, meant, weight) of pairs learned from all rare words, and what each word of the vocabulary is near to.

    The pairs are differences of one edit that recur over many words, and over a share of all
    words in which they could occur, and are rare in each;
    those that recur only as words that another pair explains weigh 2, the others 1.
    The words are those of the vocabulary that one edit makes into a much more frequent one.
    Words that mostly stand at the ends of lines are halves of words, and left out.
    """
    spark = counts.sparkSession
    common = {w: n for w, n in vocabulary.items() if n >= RARER * LEAST_COUNT}
    held = spark.sparkContext.broadcast((common, min(vocabulary.values(), default=0)))  # at most 1 / FLOOR words

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common, least = held.value
        index = NearIndex(common)
        for b in batches:
            out = []
            for w, n in zip(b.word, b.n):
                if len(w) < 2 or not w[0].isalpha():
                    continue
                for v in index.near(w, wide=True):
                    if v != w and common[v] >= RARER * n:
                        d = _difference(w, v)
                        if d:
                            out.append((*d, w, v, n, common[v], n >= least))
            yield pd.DataFrame(out, columns=["read", "meant", "w", "v", "n", "m", "held"])

    rare = counts.where("length(word) >= 2 and word not like '#%' and 2 * n_in > n")
    got = materialise(spread(rare.select("word", "n"), "word").mapInPandas(pairs, "read string, meant string, w string, v string, n long, m long, held boolean"), "near")
    # pairs of letters: the alphabet bounds how many there can be
    holding = Counter(g for w in common for g in {w[i : i + k] for k in (1, 2) for i in range(len(w) - k + 1)})
    often = materialise(_recurring(got), "often")
    # a word that several pairs explain counts for the one that recurs most
    best = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("words"), "read", "meant", "v"))
    first = _recurring(got.join(F.broadcast(often.select("read", "meant", "words")), ["read", "meant"]).withColumn("best", best).where("best = 1").drop("words"))
    rows = [r for r in often.orderBy(F.desc("n"), "read", "meant").collect() if r.words >= SHARE * holding[r.meant]]
    alone = {(r.read, r.meant) for r in first.collect() if r.words >= SHARE * holding[r.meant]}
    near: dict[str, list[str]] = defaultdict(list)
    for r in got.where("held").select("w", "v").orderBy("w", "v").toLocalIterator():
        near[r.w].append(r.v)
    return [(r.read, r.meant, 1 if (r.read, r.meant) in alone else 2) for r in rows], dict(near)


def _recurring(got: DataFrame) -> DataFrame:
    agg = got.groupBy("read", "meant").agg(F.count_distinct("v").alias("words"), F.sum("n").alias("n"), F.sum("m").alias("m"))
    return agg.where(f"words >= {RECURS} and n >= 3 * {RECURS} and n * {RARER} < m")


def _by_jamo(pairs: Sequence[tuple[str, str, int]]) -> dict[str, list[tuple[str, str, int]]]:
    """Confusions in jamo by the first jamo that is read; of equal ones the first counts."""
    out: dict[str, list[tuple[str, str, int]]] = defaultdict(list)
    for (a, b), k in {(a, b): k for a, b, k in reversed(pairs)}.items():
        a, b = (unicodedata.normalize("NFD", x) for x in (a, b))
        out[a[0]].append((a, b, k))
    return dict(out)


def _chained(pairs: Sequence[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """``pairs`` and what two of them make of the same letters, one after the other."""
    after = defaultdict(list)
    for a, b, k in pairs:
        after[a].append((b, k))
    return [*pairs, *((a, c, k + m) for a, b, k in pairs for c, m in after[b] if c != a)]


class Reader:
    """Finds and repairs the traces of scanning in one section."""

    def __init__(self, vocabulary: dict[str, tuple[int, int]], pairs: list[tuple[str, str, int]], near: dict[str, list[str]] | None = None, following: dict[tuple[str, str], int] | None = None) -> None:
        self.v = vocabulary
        listed = [(a, b, 1) for a, b in VISUAL]
        self.listed, self.learned, self.chained = _by_jamo(listed), _by_jamo([*listed, *pairs]), _by_jamo(_chained([*listed, *pairs]))
        self.near = near or {}
        self.following = following or {}
        self.all = sum(n for n, _ in vocabulary.values()) or 1
        self.unseen = min((n for n, _ in vocabulary.values()), default=1)
        self.index = NearIndex([w for w in vocabulary if w[:1] != "#" or len(w) > 1])
        self.frequent = NearIndex([w for w, (n, _) in vocabulary.items() if n >= RARER * LEAST_COUNT])
        self.known: dict[str, tuple[dict[str, int], list[str]]] = {}
        self.fine: set[str] = set()

    def readings(self, w: str) -> tuple[dict[str, int], list[str]]:
        """Words that ``w`` may stand for: by confusions, with their weight, and by any other edit.

        Only words that are more frequent by ``RARER`` count.
        """
        got = self.known.get(w)
        if got is not None:
            return got
        got = ({}, [])
        mine = self.v.get(w, (0, 0))[0]
        if len(w) > 1 and w != "#":
            least = max(RARER * mine, LEAST_COUNT + 1)
            short = w.isascii() and len(w) <= 4
            # up to three misread places in one word, but only one in a short or established word
            by = self.index.front.confused(w, self.listed if short else self.learned if mine else self.chained, 1 if short or mine else 3)
            by = {y: k for y, k in by.items() if self.v[y][0] >= least}
            other: list[str] = []
            if not by and not short and lettered(w) and w[0].isalpha():
                near = self.near.get(w, ()) if mine else self.frequent.near(w, wide=True)
                other = [y for y in near if y != w and self.v[y][0] >= least and _difference(w, y)]
            got = (by, other)
        if len(self.known) > 300_000:
            self.known.clear()
        self.known[w] = got
        return got

    def meant(self, w: str, left: str = "", right: str = "") -> str | None:
        """The word that a misread one stands for between its neighbours, or None if it is read right.

        Readings are ranked by the noisy channel: their chance between the neighbours times
        the channel's.  A confusion needs no support by the neighbours; any other edit needs both, and neither may be a figure.
        """
        by, other = self.readings(w)
        if by:
            return max(by, key=lambda y: (self.chance(left, y, right) * RARER ** -by[y], self.v[y][0], y))
        if other and "#" not in (left, right):
            ok = [y for y in other if (left, y) in self.following and (y, right) in self.following]
            if ok:
                best = max(ok, key=lambda y: (self.chance(left, y, right), y))
                if self.chance(left, best, right) * RARER**-OTHER > self.chance(left, w, right, 1):
                    return best
        return None

    def chance(self, left: str, w: str, right: str, own: int = 0) -> float:
        """Chance of ``w`` after ``left`` and of ``right`` after ``w``, backed off to single words, without ``own`` occurrences."""
        n = max(self.v.get(w, (0, 0))[0] - own, self.unseen - 1, 1)
        p = BACK * n / self.all
        before = self.following.get((left, w), 0) - own
        if before > 0:
            p = before / self.v[left][0] if left in self.v else p
        after = self.following.get((w, right), 0) - own
        return p * (after / n if after > 0 else BACK * max(self.v.get(right, (0, 0))[0], 1) / self.all)

    def broken(self, a: str, b: str, marked: bool) -> bool:
        """Whether two tokens around a line end are the halves of one word."""
        x, y = norm(a), norm(b)
        if not x or not y:
            return False
        if marked:
            bare = norm(HYPHEN.sub(r"\1", a)) if HYPHEN.search(a) else x
            whole = norm(HYPHEN.sub(r"\1", a) + b)
            dashed = norm(a.rstrip("‐­‑-") + "-" + b)
            if self.v.get(dashed, (0, 0))[1] > self.v.get(whole, (0, 0))[1]:
                return False
            return bool(bare)
        if not (a[-1:].isalnum() and b[:1].isalnum()) or b[:1].isdigit() or a[-1:].isdigit() and b[:1].isascii():
            return False
        ab = norm(a + b)
        n = self.v.get(ab, (0, 0))[0]
        if not n:
            fixed = self.meant(ab)
            n = self.v.get(fixed, (0, 0))[0] if fixed else 0
        if n < LEAST_COUNT:
            return False
        apart = min(self.v.get(x, (0, 0))[1], self.v.get(y, (0, 0))[1])
        return apart < 0.2 * n

    def kinds(self, text: str) -> set[str]:
        out: set[str] = set()
        lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        kept: list[str] = []
        for x in lines:
            if x.strip():
                if len(x) < 24 and PAGE_NUMBER.match(x):
                    out.add("page_number")
                    continue
                if is_header(x):
                    out.add("header")
                    continue
            kept.append(x)
        body = [x for x in kept if x.strip()]
        skip = False
        for i, x in enumerate(body):
            ws = x.split()
            nxt = body[i + 1].split() if i + 1 < len(body) else []
            first = 1 if skip else 0
            skip = False
            if nxt and not TABLE.match(x) and not BULLET.match(body[i + 1]):
                marked = bool(HYPHEN.search(x)) and body[i + 1][:1].isalpha()
                if ("broken_word" not in out or "misread" not in out) and self.broken(ws[-1], nxt[0], marked):
                    out.add("broken_word")
                    skip = True
                    ws = [*ws[:-1], HYPHEN.sub(r"\1", ws[-1]) + nxt[0]]
            if "misread" not in out and not self.fine.issuperset(ws) and self._misread(ws, first, body[i - 1].split()[-1] if i else "", nxt[0] if nxt and not skip else ""):
                out.add("misread")
        return out

    def _misread(self, ws: list[str], first: int, left: str, right: str) -> bool:
        """Whether a word of a line from ``first`` on is misread; ``left`` and ``right`` are the words around the line."""
        fine = self.fine
        if len(fine) > 500_000:
            fine.clear()
        for j in range(first, len(ws)):
            w = ws[j]
            if w in fine:
                continue
            n = norm(w)
            by, other = self.readings(n)
            if by:
                return True
            if not other:
                fine.add(w)
            elif self.meant(n, norm(ws[j - 1] if j else left), norm(ws[j + 1] if j + 1 < len(ws) else right)):
                return True
        return False

    def repair(self, text: str, titles: Sequence[str] = ()) -> str:
        """Continuous paragraphs: furniture dropped, halves joined, misread words replaced, lines reflowed."""
        if titles:
            own = {x for x in candidate_lines(text) if any(is_title_line(x, t) for t in titles)}
            text = "\n".join(x for i, x in enumerate(re.split("\r\n|\r|\n", text)) if not i or x.strip() not in own)
        lines = [x.rstrip() for x in clean_lines(text)]
        paragraphs: list[list[str]] = []
        open_ = False
        for x in lines:
            if not x.strip():
                if paragraphs and paragraphs[-1] and END.search(paragraphs[-1][-1]):
                    open_ = False
                continue
            if not open_ or BULLET.match(x) or TABLE.match(x):
                paragraphs.append([])
            open_ = not TABLE.match(x)
            ws = x.split()
            p = paragraphs[-1]
            if p and self.broken(p[-1], ws[0], bool(HYPHEN.search(p[-1]))):
                p[-1] = HYPHEN.sub(r"\1", p[-1]) + ws[0]
                ws = ws[1:]
            p.extend(ws)
        return "\n\n".join(" ".join(map(self._fixed, p, ["", *p], [*p[1:], ""])) for p in paragraphs if p)

    def _fixed(self, w: str, left: str, right: str) -> str:
        if w in self.fine:
            return w
        n = norm(w)
        by, other = self.readings(n)
        m = self.meant(n, norm(left), norm(right)) if by or other else None
        if not by and not other:
            if len(self.fine) > 500_000:
                self.fine.clear()
            self.fine.add(w)
        if not m:
            return w
        low = w.lower()
        core = n.lstrip("#")
        at = low.find(core)
        if at < 0:
            return w
        new = m.lstrip("#")
        return w[:at] + (new.capitalize() if w[at].isupper() else new) + w[at + len(core) :]


def is_title_line(line: str, title: str) -> bool:
    """Whether a line is the (cut) title of the paper."""
    s = re.sub(r"[\W_]+", "", line.lower())
    if len(s) < 10 or END.search(line) or len(s) > 70:
        return False
    most = max(1, len(s) // 8)
    return prefix_edits(s, title, most) <= most


def candidate_lines(text: str) -> list[str]:
    """Lines that stand out of the text around them: alone between blank lines or furniture, or ended early."""
    lines = text.replace("\r", "\n").split("\n")
    width = max(map(len, lines))
    out = []
    for i, x in enumerate(lines):
        s = x.strip()
        if not i or not 10 <= len(s) <= 70 or s[-1] in ".!?" or END.search(s) or BULLET.match(s) or TABLE.match(s) or PAGE_NUMBER.match(s) or is_header(s):
            continue
        nxt = lines[i + 1] if i + 1 < len(lines) else ""
        if not lines[i - 1].strip() or not nxt.strip() or PAGE_NUMBER.match(nxt) or PAGE_NUMBER.match(lines[i - 1]) or len(s) + 1 + len(nxt.split()[0]) <= width:
            out.append(s)
    return out


def prepared(sections: DataFrame):
    """Broadcast vocabulary, confusions and frequent neighbours of a corpus: what :class:`Reader` needs."""
    spark = sections.sparkSession
    ship_package(spark)
    both = materialise(word_counts(sections), "words")
    counts = both.where("following is null")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most 1 / FLOOR words, and as many pairs of them
    frequent = both.where(F.col("n") >= max(LEAST_COUNT, total * FLOOR))
    vocabulary, following = {}, {}
    for r in frequent.toLocalIterator():
        if r.following is None:
            vocabulary[r.word] = (r.n, r.n_in)
        else:
            following[r.word, r.following] = r.n
    pairs, near = confusions(counts, {w: n for w, (n, _) in vocabulary.items()})
    return spark.sparkContext.broadcast((vocabulary, pairs, near, following))


def noise(sections: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """``section_id, noise_kind``: the kinds of scanning noise in each section.

    NULL and empty contents have none, repeated rows count once.  With ``papers`` a
    line that repeats the paper's title inside the text counts as a header, too.
    """
    held = prepared(sections)
    out_schema = T.StructType([sections.schema["section_id"], T.StructField("paper_id", T.StringType()), T.StructField("noise_kind", T.StringType()), T.StructField("line", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = Reader(*held.value)
        for b in batches:
            out = []
            for sid, pid, t in zip(b.section_id, b.paper_id, b.content):
                for k in r.kinds(t):
                    out.append((sid, None, k, None))
                if pid is not None and "\n" in t:
                    out.extend((sid, pid, "line", x) for x in candidate_lines(t))
            yield pd.DataFrame(out, columns=["section_id", "paper_id", "noise_kind", "line"])

    text = occupied(sections.where("content is not null and content <> ''").select("section_id", "paper_id", "content"), "section_id")
    got = materialise(text.mapInPandas(run, out_schema), "noise")
    kinds = got.where("noise_kind <> 'line'").select("section_id", "noise_kind")
    if papers is not None:
        titles = records(papers).select("paper_id", "title").where("title is not null")
        lines = got.where("noise_kind = 'line'").select("section_id", "paper_id", "line")

        def same(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                ok = [is_title_line(x, title_parts(t)[0]) for x, t in zip(b.line, b.title)]
                yield b[ok][["section_id"]].assign(noise_kind="header")

        kinds = kinds.union(lines.join(titles, "paper_id").select("section_id", "line", "title").mapInPandas(same, T.StructType([sections.schema["section_id"], T.StructField("noise_kind", T.StringType())])))
    return kinds.distinct()


def repaired(sections: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """``section_id, text``: each section as continuous paragraphs; NULL stays NULL, empty stays empty.

    With ``papers`` lines that repeat one of the paper's titles are dropped, too, where :func:`noise` reports them.
    """
    held = prepared(sections)
    base = sections.select("section_id", "paper_id", "content")
    if papers is None:
        base = base.withColumn("titles", F.lit(None).cast("array<string>"))
    else:
        titles = records(papers).where("title is not null").groupBy("paper_id").agg(F.collect_set("title").alias("titles"))
        base = base.join(titles, "paper_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = Reader(*held.value)
        for b in batches:
            out = [None if t is None else r.repair(t, () if ts is None else [title_parts(x)[0] for x in ts]) for t, ts in zip(b.content, b.titles)]
            yield pd.DataFrame({"section_id": b.section_id, "text": out})

    return base.select("section_id", "content", "titles").mapInPandas(run, T.StructType([sections.schema["section_id"], T.StructField("text", T.StringType())]))
