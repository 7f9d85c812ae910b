"""Names of gauging sites brought into a comparable form."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import regex as re

# Cyrillic letters and the Latin ones they are written with.
_CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "a b v g d e e zh z i i k l m n o p r s t u f h c ch sh sch _ y _ e yu ya".replace("_", "").split(" ")))
_MISSING = {"", "nan", "none", "null", "na", "n/a", "n.a.", "unknown", "missing", "-", "--", "?", "x", ".", "_", "not available", "-9999"}

# Words and short forms that tell sites of one place apart, and words that say nothing.
_QUALIFIERS = {
    "upper": "upper upr uppr up",
    "lower": "lower lwr low lr",
    "north": "north nth n nord norte",
    "south": "south sth s sud sur",
    "east": "east",
    "west": "west",
    "left": "left lft lt l",
    "right": "right rgt rt r",
    "above": "above abv abov a ab upstream us",
    "below": "below blw bel b downstream ds",
    "old": "old",
    "new": "new",
    "weir": "weir wr weirs",
    "bridge": "bridge br brg brdg bdg",
    "bank": "bank bk bnk",
    "dam": "dam dm",
    "gauge": "gauge gge gaug ga gag gaging",
    "ford": "ford fd frd",
    "ferry": "ferry fy fry fer",
    "mill": "mill ml",
    "lock": "lock",
}
_EMPTY = set("station stn sta gs g gauging site at the river rio r riv near nr".split())
_SHORT = {s: q for q, words in _QUALIFIERS.items() for s in words.split()}
_SITE_WORDS = ("bridge", "weir", "bank", "dam", "ford", "mill", "lock")


def latin(text: str) -> str:
    """Lower case in plain Latin letters; text that was decoded with the wrong table is put right first."""
    if "Ã" in text or "Â" in text:
        try:
            text = text.encode("latin-1").decode("utf-8")
        except UnicodeError:
            pass
    t = "".join(_CYRILLIC.get(c, c) for c in text.lower())
    t = t.replace("ø", "o").replace("ł", "l").replace("ß", "ss").replace("æ", "ae").replace("đ", "d")
    return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))


def fold(word: str) -> str:
    """Letters that spellings and alphabets exchange made one; doubled letters single."""
    w = word.translate(str.maketrans("wqyjc", "vkiik")).replace("x", "ks").replace("ph", "f")
    return re.sub(r"(.)\1+", r"\1", w)


_FOLDED = {fold(s): q for s, q in _SHORT.items()}
_FULL = {fold(q): q for q in _QUALIFIERS}


def _near(a: str, b: str) -> bool:
    """Whether one change (letter changed, added, dropped or two exchanged) makes a into b."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :])


@lru_cache(maxsize=200_000)
def site(name: str | None) -> tuple[str, tuple[str, ...], str]:
    """(own name, qualifiers in order of the alphabet, river named with it); empty where missing."""
    if name is None:
        return "", (), ""
    t = latin(name).strip()
    if t in _MISSING:
        return "", (), ""
    t = re.sub(r"\b([ab])/\s*(?=d|\w)", r" \1 ", t)  # a/ dam, b/ dam
    t = t.replace("_", " ")
    river = ""
    m = re.search(r"\s+(?:on|sur|am|an der|del|de|on the)\s+|\s+/\s+|\s+@\s+", t)
    if m:
        t, river = t[: m.start()], t[m.end() :]
    t = re.sub(r"\bg\.?\s?s\.", " ", t)
    words = [w for w in re.split(r"[^\p{L}\p{N}]+", t) if w]
    own, quals = [], []
    for k, w in enumerate(words):
        f = fold(w)
        if f in _FULL or (len(f) >= 2 and f in _FOLDED):
            quals.append(_FULL.get(f) or _FOLDED[f])
        elif len(w) == 1 and f in _FOLDED and len(words) > 1:
            # one letter stands for a qualifier only beside the word for a site
            if any(fold(x) in _FOLDED and _FOLDED[fold(x)] in _SITE_WORDS for x in words[k + 1 : k + 2]):
                quals.append(_FOLDED[f])
        elif w in _EMPTY:
            continue
        elif len(f) >= 4 and len(words) > 1 and (q := next((q for g, q in _FULL.items() if len(g) >= 4 and _near(f, g)), None)) and any(x is not w for x in words):
            quals.append(q)
        else:
            own.append(f)
    if not own and words:  # nothing but qualifiers: the longest word is the name
        own = [fold(max(words, key=len))]
    return "".join(own), tuple(sorted(set(quals))), water(river) if river else ""


@lru_cache(maxsize=100_000)
def water(name: str | None) -> str:
    """A river's own name, folded; empty where missing."""
    if name is None:
        return ""
    t = latin(name).strip()
    if t in _MISSING:
        return ""
    words = [w for w in re.split(r"[^\p{L}\p{N}]+", t) if w and w not in ("river", "rio", "r", "riv", "fluss", "riviere", "the", "fleuve", "fl", "rivière", "река", "reka", "river's")]
    return "".join(fold(w) for w in words)


def distance(a: str, b: str) -> int:
    """Edits (change, add, drop, exchange of neighbours) between two short words."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    before, last = None, list(range(lb + 1))
    for i in range(1, la + 1):
        row = [i] + [0] * lb
        ca = a[i - 1]
        for j in range(1, lb + 1):
            cb = b[j - 1]
            v = last[j - 1] + (ca != cb)
            if last[j] + 1 < v:
                v = last[j] + 1
            if row[j - 1] + 1 < v:
                v = row[j - 1] + 1
            if before is not None and j > 1 and ca == b[j - 2] and a[i - 2] == cb and before[j - 2] + 1 < v:
                v = before[j - 2] + 1
            row[j] = v
        before, last = last, row
    return last[lb]


@lru_cache(maxsize=1_000_000)
def alike(a: str, b: str) -> float:
    """Similarity 0..1 of two folded names; a name cut short counts as nearly the same."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if len(short) >= 4 and long.startswith(short):
        return max(0.9, 1 - (len(long) - len(short)) / len(long))
    if len(short) < 0.5 * len(long):
        return 0.0
    return max(0.0, 1 - distance(a, b) / len(long))
