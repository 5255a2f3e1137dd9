"""The published Snowball English (Porter2) stemming algorithm for one word.

A small per-word helper of ``functions.stem``: called once per distinct word
of a Python worker (inline plan) or of the corpus (vocabulary plan).
"""

from __future__ import annotations

# Fixed values of the published algorithm (vowels, doubles, valid li-endings,
# exceptional words, R1 prefixes, step suffix tables).
VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDING = frozenset("cdeghkmnrt")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
EXCEPTIONS_AFTER_1A = frozenset(
    ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"])
R1_PREFIXES = ("gener", "commun", "arsen")
STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"),
    ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
    ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate",
         "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")


def _is_vowel(w: str, i: int) -> bool:
    return w[i] in VOWELS


def _region_after_vc(w: str, start: int) -> int:
    for i in range(start + 1, len(w)):
        if not _is_vowel(w, i) and _is_vowel(w, i - 1):
            return i + 1
    return len(w)


def _short_syllable_at_end(w: str) -> bool:
    n = len(w)
    if n == 2:
        return _is_vowel(w, 0) and not _is_vowel(w, 1)
    if n >= 3:
        return (not _is_vowel(w, n - 3) and _is_vowel(w, n - 2)
                and not _is_vowel(w, n - 1) and w[n - 1] not in "wxY")
    return False


def _longest(w: str, suffixes) -> str | None:
    best = None
    for s in suffixes:
        if w.endswith(s) and (best is None or len(s) > len(best)):
            best = s
    return best


def stem(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    if w in EXCEPTIONS:
        return EXCEPTIONS[w]
    if w.startswith("'"):
        w = w[1:]
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = "".join("Y" if c == "y" and i > 0 and w[i - 1] in VOWELS else c
                for i, c in enumerate(w))
    r1 = next((len(p) for p in R1_PREFIXES if w.startswith(p)), None)
    if r1 is None:
        r1 = _region_after_vc(w, 0)
    r2 = _region_after_vc(w, r1) if r1 < len(w) else len(w)
    r2 = max(r2, r1)

    # step 0
    s = _longest(w, ("'s'", "'s", "'"))
    if s:
        w = w[: -len(s)]
    # step 1a
    s = _longest(w, ("sses", "ied", "ies", "us", "ss", "s"))
    if s == "sses":
        w = w[:-2]
    elif s in ("ied", "ies"):
        w = w[:-3] + ("i" if len(w) > 4 else "ie")
    elif s == "s":
        if any(c in VOWELS for c in w[:-2]):
            w = w[:-1]
    if w in EXCEPTIONS_AFTER_1A:
        return w
    # step 1b
    s = _longest(w, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if s in ("eed", "eedly"):
        if len(w) - len(s) >= r1:
            w = w[: -len(s)] + "ee"
    elif s:
        stem_part = w[: -len(s)]
        if any(c in VOWELS for c in stem_part):
            w = stem_part
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif w.endswith(DOUBLES):
                w = w[:-1]
            elif r1 >= len(w) and _short_syllable_at_end(w):
                w += "e"
    # step 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"
    # step 2
    s = _longest(w, [k for k, _ in STEP2])
    if s and len(w) - len(s) >= r1:
        rep = dict(STEP2)[s]
        if s == "ogi":
            if w[-4:-3] == "l":
                w = w[:-3] + rep
        elif s == "li":
            if len(w) >= 3 and w[-3] in LI_ENDING:
                w = w[:-2]
        else:
            w = w[: -len(s)] + rep
    # step 3
    s = _longest(w, [k for k, _ in STEP3])
    if s and len(w) - len(s) >= r1:
        if s == "ative":
            if len(w) - len(s) >= r2:
                w = w[:-5]
        else:
            w = w[: -len(s)] + dict(STEP3)[s]
    # step 4
    s = _longest(w, STEP4)
    if s and len(w) - len(s) >= r2:
        if s == "ion":
            if len(w) >= 4 and w[-4] in "st":
                w = w[:-3]
        else:
            w = w[: -len(s)]
    # step 5
    if w.endswith("e"):
        pos = len(w) - 1
        if pos >= r2 or (pos >= r1 and not _short_syllable_at_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and w[-2:-1] == "l":
            w = w[:-1]
    return w.replace("Y", "y")
