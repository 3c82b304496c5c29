"""Forms of personal and corporate names, and how likely one stands for another.

Pure functions, shared by the operators on authors.  A written form is parsed
into a :class:`Form`; ``block_keys`` gives hashes under which every usual variant
of one name meets, and ``likelihood`` is the noisy-channel term P(form | name).
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

from quillmill.llm.canonical import canonical_text

# Conventional spellings of surnames beside the regular ones.
SURNAMES = {
    "김": "kim gim", "이": "lee yi rhee i", "박": "park bak pak", "최": "choi choe", "정": "jung jeong chung",
    "강": "kang gang", "조": "cho jo", "윤": "yoon yun", "장": "jang chang", "임": "lim im rim yim",
    "한": "han", "오": "oh o", "서": "seo suh", "신": "shin sin", "권": "kwon gwon", "황": "hwang",
    "안": "ahn an", "송": "song", "류": "ryu yoo", "전": "jeon jun chun", "홍": "hong", "고": "ko go koh",
    "문": "moon mun", "양": "yang", "손": "son sohn", "배": "bae pae", "백": "baek paik", "허": "heo hur",
    "유": "yoo yu", "남": "nam", "심": "shim sim", "노": "noh no roh", "하": "ha", "곽": "kwak gwak",
    "성": "sung seong", "차": "cha", "주": "joo ju", "우": "woo u", "구": "koo gu ku", "민": "min",
    "나": "na ra", "지": "ji chi", "엄": "eom um", "원": "won", "천": "chun cheon", "방": "bang", "공": "kong gong",
    "현": "hyun hyeon", "함": "ham", "변": "byun byeon", "염": "yeom yum", "여": "yeo", "추": "choo chu", "도": "do",
    "소": "so", "석": "seok suk", "선": "sun seon", "설": "seol sul", "마": "ma", "길": "gil kil", "연": "yeon", "위": "wi",
    "표": "pyo", "명": "myung myeong", "기": "ki gi", "반": "ban", "왕": "wang", "금": "keum geum", "옥": "ok", "육": "yuk",
    "인": "in", "맹": "maeng", "제": "je", "모": "mo", "탁": "tak", "국": "kook", "은": "eun", "편": "pyun", "용": "yong",
}
# Short forms of given names.
NICKNAMES = {
    "ben": "benjamin", "greg": "gregory", "ed": "edward", "eddie": "edward", "gaby": "gabriella", "theo": "theodore", "ted": "theodore",
    "chris": "christopher", "jen": "jennifer", "jenny": "jennifer", "rob": "robert", "bob": "robert", "beth": "elizabeth",
    "liz": "elizabeth", "tom": "thomas", "sam": "samuel", "nate": "nathaniel", "nat": "nathaniel", "rick": "richard",
    "dick": "richard", "rich": "richard", "fred": "frederick", "becky": "rebecca", "becca": "rebecca", "debbie": "deborah", "deb": "deborah",
    "kate": "katherine", "kathy": "katherine", "katie": "katherine", "meg": "margaret", "maggie": "margaret", "peggy": "margaret",
    "pat": "patricia", "patty": "patricia", "sue": "susan", "susie": "susan", "vicky": "victoria", "vicki": "victoria", "tori": "victoria",
    "tony": "anthony", "alex": "alexander", "charlie": "charles", "chuck": "charles", "jim": "james", "jimmy": "james",
    "bill": "william", "will": "william", "mike": "michael", "dan": "daniel", "dave": "david", "steve": "stephen",
}
# Short forms of two given names.
OTHER_NAMES = {"ted": "edward"}
# What people add to a name.
HONORIFICS = ("기자", "교수", "박사", "외", "연구원", "편집부", "등", "씨", "님", "석사", "팀장", "대표")
LATIN_TITLES = r"^(?:dr|prof|professor|mr|mrs|ms)\.?\s+|[\s,]+(?:ph\.?\s*d\.?|m\.?d\.?|et al\.?|editorial (?:team|office)|eds?\.)\s*$"
CORPORATE = ("센터", "협회", "재단", "연구원", "팀", "학회", "위원회", "공사", "주식회사", "조합", "연구소", "대학교", "진흥원", "편집부")
CORPORATE_EN = frozenset("center centre association institute foundation team policy support contents promotion society council committee corporation company university fdn assn assoc inst ctr tm".split())
ORG_ABBREV = {"fdn": "foundation", "tm": "team", "inst": "institute", "ctr": "center", "centre": "center", "assn": "association", "assoc": "association", "univ": "university", "content": "contents", "tech": "technology", "dept": "department", "cntr": "center", "soc": "society"}

LEADS = "g kk n d tt r m b pp s ss  j jj ch k t p h".split(" ")
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split()
TAILS = " k k k n n n t l k m l l l p l m p p t t ng t t k t p t".split(" ")


class Form(NamedTuple):
    """``kind``: ko (Hangul person), la (Latin letters, person), org, or ''."""

    kind: str
    text: str  # cleaned spelling
    parts: tuple[str, ...]  # lower-case Latin tokens, or Hangul surname and given name
    alt: tuple  # forms written beside it in brackets


EMPTY = Form("", "", (), ())


def syllable(c: str) -> tuple[int, int, int]:
    k = ord(c) - 0xAC00
    return k // 588, k % 588 // 28, k % 28


@lru_cache(20_000)
def jamo(s: str) -> str:
    return unicodedata.normalize("NFD", s)


@lru_cache(5_000)
def readings(c: str, surname: bool = False) -> tuple[str, ...]:
    """Usual romanisations of one syllable, the most regular ones first."""
    if surname and c in SURNAMES:
        return tuple(SURNAMES[c].split())
    a, b, t = syllable(c)
    lead = {0: ("g", "k"), 3: ("d", "t"), 5: ("r", "l"), 7: ("b", "p"), 9: ("s",), 12: ("j", "ch"), 15: ("k",), 16: ("t",), 17: ("p",)}.get(a, (LEADS[a],))
    v = VOWELS[b]
    vowel = {"eo": ("eo", "u"), "yeo": ("yeo", "yu", "you"), "u": ("u", "oo") + (("woo",) if LEADS[a] == "" else ()), "yu": ("yu", "yoo"), "eu": ("eu", "u"), "ui": ("ui", "ee", "i"), "i": ("i", "ee"), "a": ("a", "ah") if LEADS[a] == "" and t == 0 else ("a",), "o": ("o", "oh") if LEADS[a] == "" and t == 0 else ("o",), "ya": ("ya",), "ye": ("ye",)}.get(v, (v,))
    tail = ("k", "g") if TAILS[t] == "k" else (TAILS[t],)
    return tuple(dict.fromkeys(x + y + z for x in lead for y in vowel for z in tail))


_FOLD = (("sh", "s"), ("ch", "j"), ("eo", "u"), ("oo", "u"), ("ou", "u"), ("ee", "i"), ("ah", "a"), ("oh", "o"), ("wu", "u"), ("eu", "u"), ("ui", "i"), ("ph", "p"))
_FOLD_ONE = str.maketrans("kptlc", "gbdrj")


@lru_cache(50_000)
def skeleton(letters: str) -> str:
    """Latin letters with the differences between romanisations folded away."""
    s = letters
    for a, b in _FOLD:
        s = s.replace(a, b)
    return s.translate(_FOLD_ONE)


_SURNAME_OF: dict[str, str] = {}
for _c, _v in SURNAMES.items():
    for _r in _v.split():
        _SURNAME_OF.setdefault(_r, _c)


@lru_cache(20_000)
def surname_key(letters: str) -> str:
    """One key for all spellings of a surname; spellings of two surnames share one."""
    return {"yoo": "yu", "yu": "yu", "ryu": "yu", "ra": "na", "na": "na", "lim": "im", "im": "im", "rim": "im", "yim": "im", "lee": "i", "yi": "i", "rhee": "i", "i": "i", "no": "no", "noh": "no", "roh": "no", "chung": "jung", "jung": "jung", "jeong": "jung", "jeon": "jun", "jun": "jun", "chun": "jun", "cheon": "jun", "park": "bag", "bak": "bag", "pak": "bag", "hur": "hu", "heo": "hu", "suh": "su", "seo": "su", "ko": "go", "go": "go", "koh": "go", "paik": "bag2", "baek": "bag2", "son": "son", "sohn": "son"}.get(letters) or skeleton(letters)


def edits(a: str, b: str, most: int) -> int:
    """Restricted Damerau distance in a band; ``most + 1`` when it is larger."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    before: list[int] = []
    prev = list(range(m + 1))
    for i in range(1, n + 1):
        lo, hi = max(1, i - most), min(m, i + most)
        row = [most + 1] * (m + 1)
        if lo == 1:
            row[0] = i
        x = a[i - 1]
        for j in range(lo, hi + 1):
            y = b[j - 1]
            d = min(prev[j - 1] + (x != y), prev[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row[j] = d
        if min(row[lo - 1 : hi + 1]) > most:
            return most + 1
        before, prev = prev, row
    return min(prev[m], most + 1)


_HANGUL = re.compile(r"^[가-힣\s·]+$")
_MARKS = re.compile(r"(?:[\s,]*(?:\d+\)?|[*†‡§¶)])+)+\s*$")
_PAREN = re.compile(r"^(.*\S)\s*\(([^()]+)\)?\s*$")
_PREFIX = re.compile(r"^\s*\((?:재|주|사|유)\)\s*|^\s*(?:재단법인|주식회사|사단법인|㈜)\s*")


@lru_cache(40_000)
def parse(raw: str | None) -> Form:
    """The form behind a written entry; decorations such as marks and titles are dropped."""
    s = canonical_text(raw) or ""
    s = unicodedata.normalize("NFKC", s).strip()
    s = _PREFIX.sub("", re.sub(r"\s+", " ", s))
    alt: tuple = ()
    m = _PAREN.match(s)
    if m and re.search(r"[^\W\d_]{2}", m.group(2)):
        alt = (parse(m.group(2)),)
        s = m.group(1)
    s = _MARKS.sub("", s).strip(" ,;·*")
    for _ in range(2):
        t = re.sub(LATIN_TITLES, "", s, flags=re.I).strip(" ,;")
        if " " in t and re.search("[가-힣]", t):
            head, _, last = t.rpartition(" ")
            if last in HONORIFICS:
                t = head
        s = t
    s = _MARKS.sub("", s).strip(" ,;·*")
    s = re.sub(r"^([a-z])([A-Z])(?=[a-z-])", lambda m: m.group(2) + m.group(1), s)  # two letters swapped
    if not s:
        return Form("", "", (), alt)
    if _HANGUL.match(s):
        words = s.split()
        flat = "".join(words)
        if len(flat) > 5 or any(flat.endswith(w) for w in CORPORATE) and len(flat) > 4:
            return Form("org", flat, (flat,), alt)
        if len(words) == 2 and len(words[1]) == 1 and len(words[0]) > 1:  # given name first
            flat = words[1] + words[0]
        return Form("ko", flat, (flat[0], flat[1:]), alt)
    if re.search("[가-힣]", s):
        flat = re.sub(r"[\W_]+", "", s).lower()
        return Form("org", flat, (flat,), alt)
    plain = "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
    words = re.findall(r"[^\W\d_]+", plain.lower())
    if words and words[0] == "the":
        words = words[1:]
    if len(words) > 1 and sum(ORG_ABBREV.get(w, w) in CORPORATE_EN for w in words) and max(map(len, words)) > 3 and len([w for w in words if len(w) > 1]) > 1 and "," not in s:
        full = tuple(ORG_ABBREV.get(w, w) for w in words)
        return Form("org", " ".join(full), full, alt)
    parts: list[str] = []
    spaced = re.sub(r"(?<=\w)\.(?=\s*-?\s*\w\b)", ". ", plain).replace("'", "").split()
    for at, w in enumerate(spaced):
        comma = w.endswith(",")
        bare = re.sub(r"[^\w-]|_|\d", "", w).strip("-")
        if not bare:
            continue
        if len(bare) == 2 and bare.isupper() and at == len(spaced) - 1 and at and not spaced[0].isupper():
            parts.append("=" + bare.lower())  # HD: two initials
        elif re.fullmatch(r"[A-Za-z]", bare) and re.search(r"\.", w) or len(bare) == 1:
            parts.append("=" + bare.lower())
        else:
            parts.append(bare.lower())
        if comma:
            parts.append(",")
    merged: list[str] = []
    for p in parts:
        if merged and p.startswith("=") and merged[-1].startswith("="):
            merged[-1] += p[1:]
        else:
            merged.append(p)
    return Form("la", plain, tuple(merged), alt)


def readings_of(form: Form) -> list[tuple[str, str, bool]]:
    """(surname, given, initials only) as a Latin form may be read, hyphens dropped."""
    if form.kind != "la":
        return []
    p = [x for x in form.parts if x != ","]
    comma = "," in form.parts[1:2]
    out = []
    if len(p) < 2:
        return []
    clean = [x.lstrip("=").replace("-", "") for x in p]
    ini = [x.startswith("=") for x in p]

    def add(sur: int, rest: list[int]) -> None:
        given = "".join(clean[i] for i in rest)
        if not ini[sur] and given:
            out.append((clean[sur], given, all(ini[i] for i in rest)))

    last = len(p) - 1
    add(0, list(range(1, last + 1)))
    if not comma:
        add(last, list(range(last)))
    return out


def western(form: Form) -> list[tuple[str, str, str]]:
    """(last, first, middle initial) readings; first may be one letter."""
    if form.kind != "la":
        return []
    p = [x for x in form.parts if x != ","]
    out = []
    if len(p) < 2:
        return []
    comma = "," in form.parts[1:2]

    def add(last: str, rest: list[str]) -> None:
        if last.startswith("=") or not rest:
            return
        letters: list[str] = []
        for r in rest:
            letters.extend(r[1:] if r.startswith("=") else [r])
        out.append((last.replace("-", ""), letters[0].replace("-", ""), letters[1][0] if len(letters) > 1 else ""))

    if not comma:
        add(p[-1], p[:-1])
    # without a comma the surname is not first where an initial stands before a full word
    if comma or not any(x.startswith("=") and not y.startswith("=") for x, y in zip(p[1:], p[2:])):
        add(p[0], p[1:])
    return out


def deletions(s: str) -> set[str]:
    return {s} | {s[:i] + s[i + 1 :] for i in range(len(s))}


def initials(given: str) -> str:
    """First letters of the given names as they are usually romanised (K rather than G, W for a bare u)."""
    return "".join({"g": "k"}.get(x, x) if (x := readings(c)[0][:1]) != "u" else "w" for c in given)


_INI = str.maketrans("kptlcu", "gbdrjw")


def block_keys(form: Form, name: bool = True) -> set[str]:
    """Keys of a form. ``name``: it is a possible canonical name, so it also offers the keys of its abbreviations."""
    out: set[str] = set()
    if form.kind == "ko":
        s, g = form.parts
        whole = s + g
        for i in range(len(whole)):
            out.add("H" + whole[:i] + "_" + whole[i + 1 :])
        out.add("H" + whole)
        # a syllable more or less
        out |= {"D" + x for x in deletions(whole)}
        if name:
            for sur in readings(s, True):
                k = surname_key(sur)
                given = skeleton("".join(readings(c)[0] for c in g))
                out |= {"S" + x for x in deletions(k + given)}
                for sk in _skeletons(g):
                    out.add("S" + k + sk)
                out.add("I" + k + "|" + initials(g).translate(_INI))
    elif form.kind == "la":
        for sur, given, ini in readings_of(form):
            k = surname_key(sur)
            if ini:
                out.add("I" + k + "|" + given.translate(_INI))
            else:
                out |= {"S" + x for x in deletions(k + skeleton(given))}
        for last, first, _ in western(form):
            out |= {"W" + x for x in deletions(last)}
    elif form.kind == "org":
        if re.search("[가-힣]", form.text):
            t = form.text
            out |= {"O" + t[: len(t) // 2], "O" + t[-(len(t) // 2 + 1) :], "O" + t[:3], "O" + t[1:4]}
            out |= {"O" + x for x in deletions(t[:6])}
        else:
            out |= {"O" + x for x in deletions(form.parts[0])}
            out.add("O" + "".join(form.parts[1:]))
    for a in form.alt:
        out |= block_keys(a, name)
    return out


@lru_cache(20_000)
def _skeletons(given: str) -> tuple[str, ...]:
    out = {""}
    for c in given:
        out = {a + b for a in out for b in {skeleton(r) for r in readings(c)}}
    return tuple(out)


@lru_cache(4_000)
def _spelled(sur: str, given: str) -> frozenset[str]:
    """All letters-only spellings (surname first) of a Hangul name."""
    out = set(readings(sur, True))
    for c in given:
        out = {a + b for a in out for b in readings(c)}
    return frozenset(out)


TYPO = 0.004  # one given typo, of the many there are
TYPO_LATIN = 0.008


def likelihood(form: Form, name: Form) -> float:
    """P(form is written | the name is meant), up to a constant; 0 if it can't be."""
    best = _likelihood(form, name)
    for a in form.alt:
        best = max(best, 0.9 * _likelihood(a, name))
    for b in name.alt:
        best = max(best, _likelihood(form, b))
        for a in form.alt:
            best = max(best, 0.9 * _likelihood(a, b))
    return best


def _likelihood(v: Form, c: Form) -> float:
    if v.kind == "ko" and c.kind == "ko":
        a, b = "".join(v.parts), "".join(c.parts)
        if a == b:
            return 1.0
        if len(a) == len(b):
            diff = [i for i in range(len(a)) if a[i] != b[i]]
            if len(diff) == 1:
                x, y = syllable(a[diff[0]]), syllable(b[diff[0]])
                n = sum(p != q for p, q in zip(x, y))
                return TYPO if n == 1 else TYPO / 50
        elif abs(len(a) - len(b)) == 1 and edits(a, b, 1) == 1:
            return TYPO / 20
        return 0.0
    if v.kind == "la" and c.kind == "ko":
        s, g = c.parts
        best = 0.0
        for sur, given, ini in readings_of(v):
            if ini:
                if sur in readings(s, True):
                    mine = initials(g)
                    if given == mine:
                        best = max(best, 0.5)
                    elif given.translate(_INI) == mine.translate(_INI):
                        best = max(best, 0.0101)
                elif surname_key(sur) in {surname_key(r) for r in readings(s, True)} and given == initials(g):
                    best = max(best, 0.0102)
                continue
            if sur + given in _spelled(s, g):
                best = max(best, 0.3)
                continue
            if best < TYPO_LATIN:
                sk = {surname_key(r) for r in readings(s, True)}
                mine = surname_key(sur) + skeleton(given)
                if surname_key(sur) in sk and skeleton(given) in _skeletons(g):
                    best = max(best, 0.05)
                elif any(edits(mine, k + x, 1) <= 1 for k in sk for x in _skeletons(g)):
                    best = max(best, TYPO_LATIN)
                elif any(edits(sur + given, r, 1) <= 1 for r in _spelled(s, g)):
                    best = max(best, TYPO_LATIN)
        return best
    if v.kind == "la" and c.kind == "la":
        if v.parts == c.parts:
            return 1.0
        best = 0.0
        wc = western(c)[:1]
        for last, first, mid in western(v):
            for cl, cf, cm in wc:
                d = edits(last, cl, 1)
                if d > 1 or d and len(cl) < 4:
                    continue
                p = 0.5 if d == 0 else TYPO_LATIN
                full = NICKNAMES.get(first, first)
                if first == cf:
                    pass
                elif len(first) == 1 and cf[:1] == first:
                    p *= 0.1
                elif full == cf or OTHER_NAMES.get(first) == cf:
                    p *= 0.2
                elif len(first) > 2 and edits(first, cf, 1) == 1:
                    p *= TYPO_LATIN
                else:
                    continue
                if mid and cm:
                    if mid != cm:
                        continue
                elif cm or mid:
                    p *= 0.3
                best = max(best, p)
        for sur, given, ini in readings_of(v):
            for cs, cg, ci in readings_of(c):
                if ci:
                    continue
                if ini:
                    pieces = [x.split("-") for x in c.parts if "-" in x]
                    if surname_key(sur) == surname_key(cs) and pieces and given == "".join(x[:1] for x in pieces[0]):
                        best = max(best, 0.5 if sur == cs else 0.03)
                    continue
                if surname_key(sur) == surname_key(cs) and skeleton(given) == skeleton(cg):
                    best = max(best, 0.3)
                elif edits(sur + given, cs + cg, 1) <= 1:
                    best = max(best, TYPO_LATIN)
        return best
    if v.kind == "org" and c.kind == "org":
        if v.text == c.text:
            return 1.0
        a, b = "".join(v.parts), "".join(c.parts)
        most = 2 if len(b) > 9 else 1
        d = edits(a, b, most)
        if d <= most:
            return TYPO_LATIN**d * 5
        for word in HONORIFICS:
            if a == b + word:
                return 0.2
        return 0.0
    return 0.0
