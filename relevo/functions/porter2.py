"""English Porter2 ("Snowball English") stemmer for one word.

Written from the published algorithm description. It is a small per-token helper: Spark code calls
it only on the distinct vocabulary (see ``relevo.operators.stemming``), never per row. This module
imports nothing from the package so it can be shipped to Python workers by value.
"""

from __future__ import annotations

# Fixed values of the algorithm (must not change for matching stems).
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
AFTER_STEP1A_INVARIANT = ("inning", "outing", "canning", "herring", "earring", "proceed",
                          "exceed", "succeed")
STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
         "ous", "ive", "ize", "ion", "al", "er", "ic")


def _is_vowel(ch: str) -> bool:
    return ch in VOWELS


def _regions(w: str) -> tuple[int, int]:
    def after_vc(start: int) -> int:
        for i in range(start + 1, len(w)):
            if not _is_vowel(w[i]) and _is_vowel(w[i - 1]):
                return i + 1
        return len(w)

    r1 = None
    for p in R1_PREFIXES:
        if w.startswith(p):
            r1 = len(p)
            break
    if r1 is None:
        r1 = after_vc(0)
    r2 = after_vc(r1) if r1 < len(w) else len(w)
    return r1, r2


def _short_syllable_at_end(w: str) -> bool:
    n = len(w)
    if n == 2:
        return _is_vowel(w[0]) and not _is_vowel(w[1])
    if n >= 3:
        return (not _is_vowel(w[-3]) and _is_vowel(w[-2]) and not _is_vowel(w[-1])
                and w[-1] not in "wxY")
    return False


def _is_short(w: str, r1: int) -> bool:
    return r1 >= len(w) and _short_syllable_at_end(w)


def _has_vowel(s: str) -> bool:
    return any(_is_vowel(c) for c in s)


def stem(word: str) -> str:
    """Stem one lower-case word."""
    if word is None:
        return None
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    w = word[1:] if word.startswith("'") else word
    if not w:
        return w
    # Mark consonant-y: initial y, or y after a vowel.
    chars = list(w)
    for i, c in enumerate(chars):
        if c == "y" and (i == 0 or chars[i - 1] in VOWELS):
            chars[i] = "Y"
    w = "".join(chars)
    r1, r2 = _regions(w)

    # Step 0: apostrophe endings.
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break

    # Step 1a.
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if _has_vowel(w[:-2]):
            w = w[:-1]

    if w in AFTER_STEP1A_INVARIANT:
        return w

    # Step 1b.
    for suf in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(suf):
            if suf in ("eed", "eedly"):
                if len(w) - len(suf) >= r1:
                    w = w[: -len(suf)] + "ee"
            else:
                stem_part = w[: -len(suf)]
                if _has_vowel(stem_part):
                    w = stem_part
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif _is_short(w, r1):
                        w += "e"
            break

    # Step 1c.
    if len(w) > 2 and w[-1] in "yY" and not _is_vowel(w[-2]):
        w = w[:-1] + "i"

    # Step 2.
    for suf, rep in STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if w[-4:-3] == "l":
                        w = w[:-3] + rep
                elif suf == "li":
                    if w[-3:-2] and w[-3] in LI_ENDINGS:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break

    # Step 3.
    for suf, rep in STEP3:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[: -len(suf)]
                else:
                    w = w[: -len(suf)] + rep
            break

    # Step 4.
    for suf in STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if w[-4:-3] in ("s", "t"):
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break

    # Step 5.
    if w.endswith("e"):
        base = w[:-1]
        if len(base) >= r2 or (len(base) >= r1 and not _short_syllable_at_end(base)):
            w = base
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and w[-2:-1] == "l":
            w = w[:-1]

    return w.replace("Y", "y")
