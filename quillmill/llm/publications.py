"""Problem 1: records of one publication that differ by small edits.

Order MinHash over occurrence-labelled character k-mers of the title gives sketches
that keep the order of the sampled k-mers, so they follow edit similarity.  Records
meet where one of their sketches or an identifier agrees; records that equal each
other are compared once, and a key that many records hold is split by the names of
their authors.  Keys are shuffled once, packed by batches; years and bitmaps of
k-mers rule pairs out before any title is shuffled.  Candidates are verified by banded
alignment of the titles, by author names, years and numbering.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm import names
from quillmill.llm.authors import UNIT_SUFFIX
from quillmill.llm.canonical import canonical_text
from quillmill.llm.components import hash_to_min
from quillmill.session import discard, materialise, occupied, ship_package, spread

K, TAKE, SKETCHES = 3, 5, 16
#: Words of 64 bits in the bitmap of a title's k-mers, which rules out pairs before they are aligned.
BITMAP = 6
#: A key that more records hold is split by their authors' names; see ``_sides``. This changes the cost, not the result.
HOT = 500
#: Keys that one task joins, at about 32 a record, and pairs that it holds at once; these change the cost, not the result.
KEYS, HELD = 1 << 20, 1 << 21
#: Pairs a record that are compared in one round, which bounds the disk in proportion to the records however many pairs meet.
ROUND = 4
#: Kinds of keys: of a sketch, of an equal title, of an identifier.
SKETCH, EQUAL, KNOWN = 0, 1, 2
#: Share of the shorter title that edits may touch.
MAX_EDITS = 0.15
LEAST_LETTERS = 10
#: Records that name nobody need equal titles of more letters than this.
LONG = 30
_SEEDS = np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
# What stands where a title is missing.
PLACEHOLDER = re.compile(r"^(?:untitled|paper|document\d*|제목\s*없음|무제|no title|unknown|n/?a|null|none|-+)$|^microsoft word\b|\.(?:pdf|hwpx?|docx?|txt|pptx?)$", re.I)
CUT = re.compile(r"(?:\.\s*){2,}$|…\s*$")
DOI = r"10\.\d{4,5}/[^\s]*[^\s.,;:)\]}>\"']"


def usable_year(y) -> bool:
    return y is not None and y == y and 1980 <= y <= 2026


@lru_cache(20_000)
def title_parts(title: str | None) -> tuple[str, str, str]:
    """(whole, main, numbers): letters and digits of the title, of its part before the subtitle, and its numbers in order.

    ('', '', '') for a missing title, a placeholder or a file name.
    """
    s = (canonical_text(title) or "").lower().strip()
    if len(re.sub(r"[\W_]+", "", s)) < LEAST_LETTERS and not re.search(r"\s", s) or PLACEHOLDER.search(s) and len(re.sub(r"[\W_]+", "", s)) < 30:
        return "", "", ""
    s = re.sub(r"^\s*(?:\[[^\]\d]{1,8}\]|\([^)\d]{1,8}\))\s*|\s*\([^)\d]{1,8}\)\s*$", "", s)
    s = CUT.sub("", s)
    m = re.match(r"^(.+?)\s*\(([^()]{12,}(?:\([^()]*\)[^()]*)?)\)?$", s)
    if m and not re.search(r"[:：]", m.group(1)):
        s = f"{m.group(2)}: {m.group(1)}"  # subtitle (title)
    main = re.split(r"[:：]|\s[-–—－]\s", s)[0]
    letters = lambda x: re.sub(r"[\W_]+", "", x)
    if len(letters(main)) < LEAST_LETTERS:
        main = s
    return letters(s), letters(main), " ".join(re.findall(r"\d+", s))


def order_minhash(titles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(Order MinHash sketches, bitmap of the k-mers), a row a string: of each hash the least TAKE labelled k-mers, in text order.

    A string with fewer k-mers is sketched by all of them.
    """
    out = np.zeros((len(titles), SKETCHES), dtype=np.uint64)
    bits = np.zeros((len(titles), BITMAP), dtype=np.int64)
    order = sorted(range(len(titles)), key=lambda i: len(titles[i]))
    at = 0
    while at < len(order):  # strings of like length, of bounded size together
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(titles[order[end]]) <= 1_000_000:
            end += 1
        out[order[at:end]], bits[order[at:end]] = _sketched([titles[i] for i in order[at:end]])
        at = end
    return out, bits


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(29)


def _sketched(titles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    width = max(TAKE, max(map(len, titles)) - K + 1)
    codes = np.zeros((len(titles), width + K - 1), dtype=np.uint64)
    for i, t in enumerate(titles):
        codes[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "replace"), dtype=np.uint32)
    gram = np.zeros((len(titles), width), dtype=np.uint64)
    for k in range(K):
        gram = gram * np.uint64(0x100000001B3) + codes[:, k : k + width]
    gram = _mixed(gram)
    there = np.arange(width)[None, :] < np.array([len(t) - K + 1 for t in titles])[:, None]
    flags = np.zeros((len(titles), 64 * BITMAP), dtype=bool)
    row, col = np.nonzero(there)
    flags[row, gram[row, col] % np.uint64(64 * BITMAP)] = True
    # label each k-mer with the number of equal ones before it
    by = np.argsort(gram, axis=1, kind="stable")
    run = np.take_along_axis(gram, by, 1)
    same = np.zeros(run.shape, dtype=bool)
    same[:, 1:] = run[:, 1:] == run[:, :-1]
    first = np.where(same, 0, np.arange(width)[None, :])
    label = np.arange(width)[None, :] - np.maximum.accumulate(first, axis=1)
    labels = np.empty_like(by)
    np.put_along_axis(labels, by, label, 1)
    base = np.where(there, _mixed(gram + labels.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), np.uint64(0))
    out = np.empty((len(titles), SKETCHES), dtype=np.uint64)
    for j, seed in enumerate(_SEEDS):
        h = np.where(there, (_mixed(base ^ seed) >> np.uint64(32)).astype(np.uint32), np.uint32(0xFFFFFFFF))
        least = np.sort(np.argpartition(h, TAKE - 1, axis=1)[:, :TAKE], axis=1)
        # strings shorter than TAKE k-mers are filled up with zeros
        picked = np.sort(np.where(np.take_along_axis(there, least, 1), least, width), axis=1)
        got = np.take_along_axis(np.pad(base, ((0, 0), (0, 1))), picked, 1)
        acc = np.full(len(titles), seed)
        for k in range(TAKE):
            acc = (acc ^ got[:, k]) * np.uint64(31) + np.uint64(k)
        out[:, j] = _mixed(acc)
    return out, np.packbits(flags, axis=1).view(np.int64)


@lru_cache(60_000)
def hash_str(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s)


def _named(authors) -> bool:
    return any(a and a.strip() for a in (authors if authors is not None else ()))


def _with_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the letters of the whole title and the bitmap of its k-mers."""
    for b in batches:
        whole = [title_parts(t)[0] for t in b.column("title").to_pylist()]
        at = [i for i, w in enumerate(whole) if w]
        bits = np.zeros((len(whole), BITMAP), np.int64)
        if at:
            bits[at] = order_minhash([whole[i] for i in at])[1]
        more = {"letters": pa.array([len(w) for w in whole], pa.int32()), **{f"b{k}": pa.array(bits[:, k]) for k in range(BITMAP)}}
        yield pa.RecordBatch.from_arrays([*b.columns, *more.values()], names=[*b.schema.names, *more])


def _keyed(parts: list[tuple[str, str, str]], authors: list, dois: list, kcis: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, kind): sketches of the title and of its main part where authors are named, the title itself, identifiers."""
    at = [i for i, p in enumerate(parts) if p[0] and _named(authors[i])]
    none = np.empty((0, SKETCHES), np.uint64)
    sk = order_minhash([parts[i][0] for i in at])[0] if at else none
    second = [i for i in at if parts[i][1] != parts[i][0]]
    sk2 = order_minhash([parts[i][1] for i in second])[0] if second else none
    equal = [i for i, p in enumerate(parts) if len(p[0]) > LONG]
    known = [(hash_str(f"{c}={x}"), i) for c, xs in (("doi", dois), ("kci_id", kcis)) for i, x in enumerate(xs) if x is not None]
    key = np.concatenate((sk.ravel(), sk2.ravel(), np.array([hash_str("=" + parts[i][0]) for i in equal] + [k for k, _ in known], dtype=np.uint64)))
    row = np.concatenate((np.repeat(np.array(at, dtype=int), SKETCHES), np.repeat(np.array(second, dtype=int), SKETCHES), np.array(equal + [i for _, i in known], dtype=int)))
    kind = np.concatenate((np.full(sk.size + sk2.size, SKETCH), np.full(len(equal), EQUAL), np.full(len(known), KNOWN)))
    _, one = np.unique(np.stack((key, row.astype(np.uint64))), axis=1, return_index=True)
    return key[one], row[one], kind[one]


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned numbers, byte by byte, which compresses well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplaned(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = raw.reshape(width, n).T
    return out.view("<u8").ravel()


def _packed(parts: int):
    """Keys of records, a row for each batch and part: see ``_pack``.

    A mark holds the kind, whether the record names nobody, and its usable year.
    Within a part, equal 4-byte keys of different keys only make further candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {c: b.column(c).to_pylist() for c in ("title", "authors", "year", "doi", "kci_id")}
            key, row, kind = _keyed([title_parts(t) for t in col["title"]], col["authors"], col["doi"], col["kci_id"])
            years = np.array([y - 1979 if usable_year(y) else 0 for y in col["year"]], dtype=np.uint64)
            nobody = np.array([not _named(w) for w in col["authors"]], dtype=np.uint64)
            nid = b.column("nid").to_numpy().astype(np.uint64)
            mark = kind.astype(np.uint64) << np.uint64(8) | nobody[row] << np.uint64(7) | years[row]
            part, low = (key % np.uint64(parts)).astype(np.int64), key >> np.uint64(32)
            by = np.lexsort((row, low, part))
            part, low, row, mark = part[by], low[by], row[by], mark[by]
            ends = np.flatnonzero(np.diff(part, append=-1)) + 1
            out = [(int(part[x]), *_pack(low[x:y], nid[row[x:y]], mark[x:y])) for x, y in zip(np.concatenate(([0], ends[:-1])), ends)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["part", "n", "base", "data"])

    return run


def _pack(key: np.ndarray, nid: np.ndarray, mark: np.ndarray) -> tuple[int, int, bytes]:
    """(number, base, data) of sorted 4-byte keys by their differences, records and marks."""
    base = nid.min()
    raw = _planes(np.diff(key, prepend=np.uint64(0)), 4) + _planes(nid - base, 8) + _planes(mark, 2)
    return len(key), int(base), pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(n: int, base: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=14 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(_unplaned(raw[: 4 * n], n, 4), dtype=np.uint64), _unplaned(raw[4 * n : 12 * n], n, 8) + np.uint64(base), _unplaned(raw[12 * n :], n, 2).astype(np.uint16)


def _years_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    p, q = (x & np.uint64(127)).astype(np.int16), (y & np.uint64(127)).astype(np.int16)
    return (p > 0) & (q > 0) & (np.abs(p - q) > 2)


def _merged(hot: int):
    """The keys that several records hold, a row a part, with the number of pairs that they make.

    Records that name authors and hold a key of more than ``hot`` are also returned as
    ``nid, key``, to be split by names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("part", "n", "base", "data"))):
                parts.setdefault(row[0], []).append(row[1:])
        for part in list(parts):
            key, nid, mark = (np.concatenate(x) for x in zip(*(_unpack(*x) for x in parts.pop(part))))
            by = np.lexsort((nid, key))
            key, nid, mark = key[by], nid[by], mark[by]
            count = _counts(key)
            key, nid, mark, count = (x[count > 1] for x in (key, nid, mark, count))
            if not len(key):
                continue
            n, base, data = _pack(key, nid, mark)
            many = np.flatnonzero((count > hot) & (mark & 128 == 0) & (mark >> 8 != EQUAL))
            pairs = sum(len(a) for a, _ in _pairs_of(key, nid, mark, hot, 0, 1))
            # 32 bits of a part's keys, told from those of other parts
            told = key[many] | np.uint64(part) << np.uint64(32)
            cols = [pa.array([n] + [None] * len(many), pa.int32()), pa.array([base] + [None] * len(many), pa.int64()), pa.array([data] + [None] * len(many), pa.binary()), pa.array([pairs] + [0] * len(many), pa.int64())]
            cols += [pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(x.view(np.int64))]) for x in (nid[many], told)]
            yield pa.RecordBatch.from_arrays(cols, names=["n", "base", "data", "pairs", "nid", "key"])

    return run


def _joined(hot: int, k: int, rounds: int):
    """Pairs ``a < b`` of records with a common key, in round ``k`` those of which ``a`` leaves that rest.

    Where more than ``hot`` hold the key, only pairs of which one names nobody.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("n", "base", "data"))):
                for a, b in _pairs_of(*_unpack(*row), hot, k, rounds):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def _counts(key: np.ndarray) -> np.ndarray:
    """How often each of the sorted keys is there."""
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    c = np.diff(start, append=len(key))
    return np.repeat(c, c)


def _pairs_of(key: np.ndarray, nid: np.ndarray, mark: np.ndarray, hot: int, k: int, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list[np.ndarray] = []
    n = 0
    nobody = mark & 128 > 0
    for i, j in _met(key, nobody, nid % np.uint64(rounds) == k, hot):
        kind = mark[i] >> 8
        ok = ~_years_apart(mark[i].astype(np.uint64), mark[j].astype(np.uint64)) & (nid[i] != nid[j])
        # two records of one title that both name authors meet by their sketches
        ok &= (kind != EQUAL) | nobody[i] | nobody[j]
        if ok.any():
            held.append(np.stack((nid[i[ok]], nid[j[ok]])))
            n += int(ok.sum())
        if n > HELD:
            yield _distinct(held)
            held, n = [], 0
    if held:
        yield _distinct(held)


def _met(key: np.ndarray, nobody: np.ndarray, now: np.ndarray, hot: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``i < j`` of one key, the first of which is ``now``, so many at a time as are soon held."""
    if not len(key):
        return
    end = np.searchsorted(key, key, "right")
    few = _counts(key) <= hot
    unnamed = np.flatnonzero(nobody)
    for sought, among in ((now & (few | nobody), np.arange(len(key))), (now & ~few & ~nobody, unnamed)):
        at = np.flatnonzero(sought)
        first = np.searchsorted(among, at, "right")
        count = np.searchsorted(among, end[at], "left") - first
        total = np.cumsum(count)
        x = 0
        while x < len(at):
            y = max(x + 1, int(np.searchsorted(total, (total[x - 1] if x else 0) + HELD, "right")))
            c = count[x:y]
            yield np.repeat(at[x:y], c), among[np.repeat(first[x:y] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
            x = y


def _distinct(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.concatenate(held, axis=1)
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[new], b[new]


def _sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys split by what two records that name authors need in common to be one publication: a key of an author's name."""
    for b in batches:
        rows, keys = [], []
        for i, (key, authors) in enumerate(zip(b.key, b.authors)):
            who = [a for a in (authors if authors is not None else ()) if a and a.strip()]
            side = {k for a in who for k in author_sides(a)}
            rows.extend([i] * len(side))
            keys.extend(hash_str(f"{key}|{k}") for k in side)
        yield b.iloc[rows].assign(key=np.array(keys, dtype=np.uint64).view(np.int64))[["nid", "key"]]


@lru_cache(20_000)
def author_sides(raw: str) -> frozenset[str]:
    """Keys of which every spelling that may be the same author (``share_author``) has one in common with this one."""
    f = names.parse(raw)
    return frozenset(k for x in (f, *f.alt) for k in _form_sides(x))


def _form_sides(f: names.Form) -> set[str]:
    out = {"=" + "|".join(f.parts)}
    if f.kind == "ko":
        s, g = f.parts
        whole = s + g
        out |= {"H" + whole[:i] + "_" + whole[i + 1 :] for i in range(len(whole))} | {"D" + x for x in names.deletions(whole)}
        for sur in names.readings(s, True):
            k = names.surname_key(sur)
            out.add("I" + k + "|" + names.initials(g).translate(names._INI))
            for x in names._skeletons(g):
                out |= {"S" + k + x} | _either_end("s", k + x)
        for x in names._spelled(s, g):
            out |= _either_end("r", x)
    elif f.kind == "la":
        pieces = next((x.split("-") for x in f.parts if "-" in x), [])
        for sur, given, ini in names.readings_of(f):
            k = names.surname_key(sur)
            if ini:
                out.add("I" + k + "|" + given.translate(names._INI))
                continue
            out |= {"S" + k + names.skeleton(given)} | _either_end("s", k + names.skeleton(given)) | _either_end("r", sur + given)
            if pieces:
                out.add("I" + k + "|" + "".join(x[:1] for x in pieces).translate(names._INI))
        for last, _, _ in names.western(f):
            out |= {"W" + x for x in names.deletions(last)}
    elif f.kind == "org":
        t = "".join(f.parts)
        out |= {"O" + t[i : i + 2] for i in range(len(t) - 1)} | {"O" + c for c in t if len(t) < 6}
        t = f.text.replace(" ", "")
        if "가" <= t[:1] <= "힣":
            out.add("~" + names.skeleton("".join(names.readings(c)[0] for c in t[:2] if "가" <= c <= "힣"))[:3])
        else:
            out |= {"~" + names.skeleton(t)[:k] for k in range(4)}
    return out


def _either_end(tag: str, s: str) -> set[str]:
    """Keys of both ends of a string, of which one edit leaves one as it is."""
    out = {f"{tag}<{s[:3]}", f"{tag}>{s[-3:]}"} if len(s) > 7 else set()
    if len(s) < 9:
        out |= {f"{tag}<{s[:1]}", f"{tag}>{s[-1:]}"}
    return out | {f"{tag}.{c}" for c in s if len(s) < 4}


def prefix_edits(short: str, long: str, most: int) -> int:
    """Least edits that turn ``short`` into a prefix of ``long``; ``most + 1`` if more.

    One machine word a row of the alignment (the band is the text's first ``len(short) + most`` letters).
    """
    m = len(short)
    if not m:
        return 0
    if m > len(long) + most:
        return most + 1
    at: dict[str, int] = {}
    for i, c in enumerate(short):
        at[c] = at.get(c, 0) | 1 << i
    mask, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best = m
    for c in long[: m + most]:
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = (ph << 1 | 1) & mask
        mh = mh << 1 & mask
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv
        if score < best:
            best = score
    return min(best, most + 1)


@lru_cache(8_000)
def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + K] for i in range(len(s) - K + 1))


def same_title(a: tuple[str, str, str], b: tuple[str, str, str]) -> bool:
    """Whether two titles agree up to small edits; one may be cut off. Numbering must agree."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    short, long = a[0], b[0]
    most = max(2, int(MAX_EDITS * len(short)))
    if a[2] != b[2]:
        # numbers may only be missing where the shorter title was cut before them
        na, nb = a[2].split(), b[2].split()
        if na != nb[: len(na)] or len(short) > 0.9 * len(long):
            return False
        where = 0
        for x in nb[: len(na) + 1]:
            where = long.find(x, where)
        if where < len(short) + 2:
            return False
    if short == long[: len(short)]:
        return True
    # an edit destroys at most K grams, so too many missing ones rule the pair out
    if len(_grams(short) - _grams(long)) > K * most:
        return False
    d = prefix_edits(short, long, most)
    if d <= most:
        return True
    # words written before the title
    return len(long) - len(short) <= 12 and prefix_edits(short[::-1], long[::-1], most) <= most


@lru_cache(60_000)
def _same_name(a: str, b: str) -> bool:
    f, g = names.parse(a), names.parse(b)
    return names.likelihood(f, g) > 0 or names.likelihood(g, f) > 0


def share_author(a, b) -> bool | None:
    """None where either side names nobody."""
    a = [x for x in (a if a is not None else ()) if x and x.strip()]
    b = [x for x in (b if b is not None else ()) if x and x.strip()]
    if not a or not b:
        return None
    org = [names.parse(x).kind == "org" for x in (*a, *b)]
    for x, ox in zip(a, org):
        for y, oy in zip(b, org[len(a) :]):
            if _same_name(x, y) or ox and oy and _same_org(x, y):
                return True
    return False


def _same_org(a: str, b: str) -> bool:
    """A body under its Hangul and its romanised name: the first syllables are told by sound."""
    f, g = names.parse(a), names.parse(b)
    ko, la = (f, g) if "가" <= f.text[:1] <= "힣" else (g, f)
    if not "가" <= ko.text[:1] <= "힣" or "가" <= la.text[:1] <= "힣":
        return False
    sound = names.skeleton("".join(names.readings(c)[0] for c in ko.text[:2] if "가" <= c <= "힣"))
    return names.skeleton(la.text.replace(" ", "")).startswith(sound[:3])


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keep = []
        for ta, tb, aa, ab, ya, yb, da, db, ka, kb in zip(b.title_1, b.title_2, b.authors_1, b.authors_2, b.year_1, b.year_2, b.doi_1, b.doi_2, b.kci_id_1, b.kci_id_2):
            by_id = bool(da and da == db or ka and ka == kb)
            keep.append(same_publication((ta, aa, ya, da), (tb, ab, yb, db), by_id))
        yield b[keep][["a", "b"]]


def same_publication(x, y, by_id: bool = False) -> bool:
    """Decide on two records ``(title, authors, year, doi)``; ``by_id``: they carry one identifier."""
    if x[3] and y[3] and x[3] != y[3]:
        return False
    if usable_year(x[2]) and usable_year(y[2]) and abs(x[2] - y[2]) > 2:
        return False
    a, b = title_parts(x[0]), title_parts(y[0])
    if a[0] and b[0]:
        if not same_title(a, b):
            return False
    elif not by_id:
        return False
    who = share_author(x[1], y[1])
    if who is None:
        return by_id or a[0] == b[0] and len(a[0]) > LONG
    return who


def records(papers: DataFrame) -> DataFrame:
    """One row per ``paper_id`` (the last to arrive), with usable DOI and institution."""
    cols = ["_ord", "title", "authors", "year", "doi", "kci_id", "institution", "metadata_confidence", "verified_at"]
    last = F.max_by(F.struct(*cols), F.struct("_ord", "verified_at")).alias("r_")
    one = papers.where("paper_id is not null").groupBy("paper_id").agg(last).select("paper_id", "r_.*")
    doi = F.nullif(F.regexp_extract(F.lower("doi"), DOI, 0), F.lit(""))
    return one.withColumn("doi", doi).withColumn("kci_id", F.expr("nullif(trim(kci_id), '')")).withColumn("inst", F.expr("nullif(trim(institution), '')")).withColumn("inst", F.regexp_replace("inst", UNIT_SUFFIX, ""))


SIDE = ["title", "authors", "year", "doi", "kci_id"]


def _held(r: DataFrame) -> DataFrame:
    """The records with a number ``nid``, the least id ``rep`` of those that equal them, and the bitmap of their title."""
    same = Window.partitionBy(*SIDE)
    every = spread(r.select("paper_id", *SIDE), *SIDE).withColumn("rep", F.min("paper_id").over(same)).withColumn("nid", F.monotonically_increasing_id())
    more = ", ".join(f"b{k} long" for k in range(BITMAP))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in every.schema.fields)
    return materialise(every.mapInArrow(_with_bits, f"{kinds}, letters int, {more}"), "held")


def _pairs(held: DataFrame, hot: int) -> Iterator[DataFrame]:
    """``a, b``: numbers of records, unequal ones, that hold a key in common and that years and bitmaps do not rule out; in rounds by ``a``."""
    one = held.where("paper_id = rep")
    n = one.count()
    tasks = max(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), held.sparkSession.sparkContext.defaultParallelism, n * 2 * SKETCHES // KEYS)
    parts = min(4 * tasks, 1 << 15)
    packed = occupied(one.select("nid", *SIDE), "nid").mapInArrow(_packed(parts), "part int, n int, base long, data binary")
    keys = materialise(packed.repartition(tasks, "part").mapInArrow(_merged(hot), "n int, base long, data binary, pairs long, nid long, key long"), "keys")
    tables, many, parted = [keys], keys.where("nid is not null"), None
    total = keys.agg(F.sum("pairs")).first()[0] or 0
    if not many.isEmpty():
        split = materialise(many.select("nid", "key").join(one.select("nid", "authors"), "nid").mapInPandas(_sides, "nid long, key long"), "split")
        tables.append(materialise(split.alias("x").join(split.alias("y"), "key").where("x.nid < y.nid").select(F.col("x.nid").alias("a"), F.col("y.nid").alias("b")).distinct(), "parted"))
        discard(split)
        parted = tables[1]
        total += parted.count()
    bits = [f"b{k}" for k in range(BITMAP)]
    side = [one.select(F.col("nid").alias(c), *[F.col(x).alias(f"{x}_{k}") for x in ("letters", *bits)]) for k, c in ((1, "a"), (2, "b"))]
    # k-mers of one title that the other lacks, as far as the bitmaps tell; the shorter title's count, see same_title
    lacks = [sum((F.bit_count(F.col(f"{x}_{k}").bitwiseAND(F.bitwise_not(f"{x}_{3 - k}"))) for x in bits), F.lit(0)) for k in (1, 2)]
    least = F.when(F.col("letters_1") < F.col("letters_2"), lacks[0]).when(F.col("letters_1") > F.col("letters_2"), lacks[1]).otherwise(F.least(*lacks))
    most = K * F.greatest(F.lit(2), F.floor(MAX_EDITS * F.least("letters_1", "letters_2")))
    rounds = max(1, -(-total // (ROUND * max(1, n))))
    for k in range(rounds):
        now = F.pmod(F.col("a"), F.lit(rounds)) == k
        pairs = keys.where("data is not null").select("n", "base", "data").mapInArrow(_joined(hot, k, rounds), "a long, b long")
        if parted is not None:
            pairs = pairs.union(parted.where(now))
        # partitioned by a alone, which serves the distinct rows and the join
        twice = pairs.repartition(tasks, "a").dropDuplicates(["a", "b"]).join(side[0].where(now), "a").repartition(tasks, "b").join(side[1], "b")
        yield materialise(twice.where((F.least("letters_1", "letters_2") == 0) | (least <= most)).select("a", "b"), "near")
    for t in tables:
        discard(t)


def candidates(r: DataFrame, hot: int = HOT) -> DataFrame:
    """``a, b``: pairs of ids of records that may be one publication, from ``paper_id, title, authors, year, doi, kci_id``.

    Records equal in all these fields only meet the least of them.  A key that more
    than ``hot`` records hold is split by the names of authors, of whom two records need
    one in common; records that name nobody meet all others that hold the key.
    """
    held = _held(r)
    id_ = [held.select(F.col("nid").alias(c), F.col("paper_id").alias(f"id_{c}")) for c in "ab"]
    pairs = reduce(DataFrame.union, _pairs(held, hot)).join(id_[0], "a").join(id_[1], "b")
    met = pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
    return met.union(held.where("paper_id <> rep").select(F.col("rep").alias("a"), F.col("paper_id").alias("b")))


def links(papers: DataFrame) -> DataFrame:
    """Verified pairs ``a < b`` of paper ids that directly hold the same publication."""
    ship_package(papers.sparkSession)
    held = _held(records(papers))
    one = held.where("paper_id = rep")
    sides = [one.select(F.col("nid").alias(c), F.col("paper_id").alias(f"id_{c}"), *[F.col(x).alias(f"{x}_{k}") for x in SIDE]) for k, c in ((1, "a"), (2, "b"))]
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    # records that equal each other are told from one of them
    copies = held.where("paper_id <> rep").select(F.col("rep").alias("a"), F.col("paper_id").alias("b"), *[F.col(x).alias(f"{x}_{k}") for k in (1, 2) for x in SIDE])
    out = [materialise(copies.mapInPandas(_verified, "a string, b string").select(*ends), "links")]
    for near in _pairs(held, HOT):
        full = spread(near.join(sides[0], "a"), "b").join(sides[1], "b").drop("a", "b").withColumnsRenamed({"id_a": "a", "id_b": "b"})
        out.append(materialise(full.mapInPandas(_verified, "a string, b string").select(*ends), "links"))
        discard(near)
    discard(held)
    return reduce(DataFrame.union, out)


def groups(papers: DataFrame) -> DataFrame:
    """``paper_id, group_id`` of the papers that share a publication with another; the group is named by its least id.

    NULL ids take no part, repeated rows count once, an empty table gives none.
    """
    return hash_to_min(links(papers)).select(F.col("node").alias("paper_id"), F.col("component").alias("group_id"))


def found(papers: DataFrame) -> DataFrame:
    """All pairs of different ids in a group, the smaller first."""
    g = materialise(groups(papers), "groups")
    a = g.select("group_id", F.col("paper_id").alias("paper_id_1"))
    b = g.select("group_id", F.col("paper_id").alias("paper_id_2"))
    return a.join(b, "group_id").where("paper_id_1 < paper_id_2").select("paper_id_1", "paper_id_2")
