"""Porter stemming (published algorithm with the common irregular-form extensions).

Runs once per Arrow batch; each worker remembers the stems it has computed, so a frequent word costs
one dictionary lookup.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from moodlens import lexicons

# Irregular forms.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix rules of steps 2, 3 and 4.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """``c`` and ``v`` per letter; y is a vowel after a consonant."""
    out = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_cvc(word: str) -> bool:
    s = _shape(word)
    if len(word) == 2:
        return s == "vc"
    return s[-3:] == "cvc" and word[-1] not in "wxy"


def _swap(word: str, rules) -> str:
    """Apply the first rule whose suffix matches, if the remaining stem has a measure above zero."""
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _plural(w: str) -> str:
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("sses"):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        stem = w[: -len(suffix)]
        if w.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _ends_cvc(stem) else stem
    return w


def _derived(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derived(w[:-2])
    if w.endswith("logi") and not w.endswith(tuple(s for s, _ in STEP2)):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _swap(w, STEP2)


def _suffix(w: str) -> str:
    for suffix in STEP4:
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if suffix == "ion" and not stem.endswith(("s", "t")):
                continue
            return stem if _measure(stem) > 1 else w
    return w


def _final(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _ends_cvc(stem)):
            w = stem
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


@lru_cache(maxsize=500_000)
def porter(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past(_plural(w))
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        w = w[:-1] + "i"
    return _final(_suffix(_swap(_derived(w), STEP3)))


def stem_words(tokens: Column | str) -> Column:
    """Stem an array of tokens; protected words stay as they are."""
    protected = frozenset(lexicons.PROTECTED_WORDS)

    @F.pandas_udf("array<string>")
    def stem(batch: pd.Series) -> pd.Series:
        return batch.map(lambda ts: None if ts is None else [t if t in protected else porter(t) for t in ts])

    return stem(tokens)
