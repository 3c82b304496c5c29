"""Problem 3: text that looks the same but consists of other characters.

A longest-match transducer runs once over each value.  Its mapping is built by
rule from the Unicode database (widths, compositions, spaces, invisibles) and
from a short look-alike list, and is checked for conflicts when it is compiled:
a source has one target, and no target contains a source.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

WIDTH, DECOMPOSED, INVISIBLE, SPACE, LOOKALIKE = 1, 2, 4, 8, 16

# Letters of other scripts that are drawn like Latin ones.
LOOKALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ү": "y", "г": "r", "п": "n", "к": "k",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    # Armenian, Cherokee and letter-like
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H",
    "ɡ": "g", "ɑ": "a", "ı": "i", "ⅼ": "l", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}


def _rules() -> dict[str, tuple[str, int]]:
    """The whole mapping, from rules; raises if two rules disagree."""
    out: dict[str, tuple[str, int]] = {}

    def put(src: str, dst: str, kind: int) -> None:
        if src == dst:
            return
        if src in out and out[src][0] != dst:
            raise ValueError(f"conflict at {src!r}: {out[src][0]!r} and {dst!r}")
        out[src] = (dst, kind)

    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000 or 0x20000 <= cp < 0x2F800 or 0x2FA20 <= cp < 0xE0000:  # surrogates; planes of ideographs without a mapping
            continue
        c = chr(cp)
        cat = unicodedata.category(c)
        if cat == "Cn":
            continue
        if cat in ("Zs", "Zl", "Zp") or cp == 0x85:
            put(c, " ", WIDTH if cp == 0x3000 else SPACE)
        elif cat == "Cf" or cp in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF:
            put(c, "", INVISIBLE)
        elif unicodedata.east_asian_width(c) in "FH" and unicodedata.decomposition(c).startswith(("<wide>", "<narrow>")):
            put(c, unicodedata.normalize("NFKC", c), WIDTH)
        else:
            parts = unicodedata.normalize("NFD", c)
            if parts != c and unicodedata.normalize("NFC", c) == c:
                put(parts, c, DECOMPOSED)
                # partly composed spellings, and marks in another order
                for cut in range(2, len(parts)):
                    head = unicodedata.normalize("NFC", parts[:cut])
                    if len(head) == 1:
                        put(head + parts[cut:], c, DECOMPOSED)
            elif parts != c and len(unicodedata.normalize("NFC", c)) == 1:
                put(c, unicodedata.normalize("NFC", c), LOOKALIKE)  # singletons: Angstrom, Kelvin ...
    for src, dst in LOOKALIKES.items():
        if src in out:
            raise ValueError(f"conflict at look-alike {src!r}")
        if dst in out or dst in LOOKALIKES:
            raise ValueError(f"look-alike target {dst!r} is itself a source")
    return out


class Transducer:
    """Compiled mapping. ``run`` gives the canonical value and the kinds met."""

    def __init__(self) -> None:
        self.rules = _rules()
        for src, (dst, _) in self.rules.items():
            if any(ch in self.rules for ch in dst):
                # composition of two steps: fold the target once, then it is final
                self.rules[src] = ("".join(self.rules.get(ch, (ch,))[0] for ch in dst), self.rules[src][1])
        self.heads: dict[str, int] = {}
        for src in self.rules:
            self.heads[src[0]] = max(self.heads.get(src[0], 0), len(src))
        # multi-character sources only count where a second character follows
        self.single = {s for s in self.rules if len(s) == 1}
        follow = {s[1] for s in self.rules if len(s) > 1}
        risky = "".join(sorted(self.single | follow | set(LOOKALIKES) | set(map(chr, range(0x1100, 0x1200)))))
        self.dirty = re.compile("[" + "".join(_span(risky)) + "]")
        self.letters = re.compile(r"[^\W\d_]+")

    def run(self, s: str) -> tuple[str, int]:
        if s.isascii() or not self.dirty.search(s):
            return s, 0
        out: list[str] = []
        kinds, i, n = 0, 0, len(s)
        rules, heads = self.rules, self.heads
        for m in self.dirty.finditer(s):
            at = m.start()
            if at < i:
                continue  # part of a longer match
            if at > i:
                out.append(s[i:at])
            c, i = s[at], at
            if out and (unicodedata.combining(c) or "\u1161" <= c <= "\u11ff"):
                # composes with what was written, whatever invisible stood between
                both = unicodedata.normalize("NFC", out[-1][-1] + c)
                if len(both) == 1:
                    out[-1] = out[-1][:-1] + both
                    kinds |= DECOMPOSED
                    i += 1
                    continue
            for size in range(min(heads.get(c, 0), n - i), 0, -1):
                hit = rules.get(s[i : i + size])
                if hit is not None:
                    if hit[0]:
                        out.append(hit[0])
                    kinds |= hit[1]
                    i += size
                    break
            else:
                out.append(c)
                i += 1
        out.append(s[i:])
        text = "".join(out)
        folded = self.letters.sub(_fold_word(text), text)
        if folded != text:
            kinds |= LOOKALIKE
        return folded, kinds


def _fold_word(text: str):
    def fold(m: re.Match) -> str:
        w = m.group()
        if not any(c in LOOKALIKES for c in w):
            return w
        latin = any(c.isascii() or "LATIN" in unicodedata.name(c, "") for c in w)
        foreign = [c for c in w if not c.isascii()]
        if latin:
            return "".join(LOOKALIKES.get(c, c) for c in w)
        if all(c in LOOKALIKES for c in foreign) and len(foreign) == len(w):
            greek = all("GREEK" in unicodedata.name(c, "") for c in w)
            end = m.end()
            if not greek or len(w) > 1 and w.isupper() or len(w) == 1 and w.isupper() and text[end : end + 1] == "." and text.replace(w, "", 1).strip(" .").isascii():
                return "".join(LOOKALIKES[c] for c in w)
            return w
        # beside letters of a third script only Cyrillic ones are meant as Latin
        return "".join(LOOKALIKES[c] if c in LOOKALIKES and "CYRILLIC" in unicodedata.name(c, "") else c for c in w)

    return fold


def _span(chars: str) -> list[str]:
    """Character-class ranges for sorted ``chars``."""
    out, i = [], 0
    while i < len(chars):
        j = i
        while j + 1 < len(chars) and ord(chars[j + 1]) == ord(chars[j]) + 1:
            j += 1
        a, b = (f"\\U{ord(chars[k]):08x}" for k in (i, j))
        out.append(a if i == j else f"{a}-{b}")
        i = j + 1
    return out


_made: Transducer | None = None


def transducer() -> Transducer:
    global _made
    if _made is None:
        _made = Transducer()
    return _made


def canonical_text(s: str | None) -> str | None:
    return None if s is None else transducer().run(s)[0]


@pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("kinds", T.IntegerType())]))
def _canonical_udf(values: pd.Series) -> pd.DataFrame:
    run = transducer().run
    got = [(None, 0) if v is None else run(v) for v in values]
    return pd.DataFrame(got, columns=["text", "kinds"])


def canonical(col: Column | str) -> Column:
    """Struct ``text, kinds`` of a string column. NULL stays NULL with kinds 0; the empty text stays empty."""
    return _canonical_udf(F.col(col) if isinstance(col, str) else col)


def canonical_fields(papers: DataFrame, key: str = "paper_id", text: str = "title", items: str = "authors") -> DataFrame:
    """Every distinct value of a text column and of an array column in canonical form.

    One row per key, field and position (``pos`` 0 for the text column, from 1 for
    array entries): ``value``, ``canonical_value``, ``kinds`` (0: it was canonical).
    NULL values and NULL or empty arrays give no row; repeated rows give one.
    """
    one = papers.select(F.col(key).alias("key_"), F.lit(text).alias("field_name"), F.lit(0).alias("pos"), F.col(text).alias("value"))
    many = papers.select(F.col(key).alias("key_"), F.lit(items).alias("field_name"), F.posexplode(items).alias("pos0", "value")).select("key_", "field_name", (F.col("pos0") + 1).alias("pos"), "value")
    values = one.unionByName(many).where("value is not null").distinct()
    got = values.withColumn("c_", canonical("value"))
    return got.select(F.col("key_").alias(key), "field_name", "pos", "value", F.col("c_.text").alias("canonical_value"), F.col("c_.kinds").alias("kinds"))


def found(papers: DataFrame) -> DataFrame:
    """Keys and fields with a value that was not in canonical form."""
    return canonical_fields(papers).where("kinds > 0").select("paper_id", "field_name").distinct()
