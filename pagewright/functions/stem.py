"""English (Porter2) stemming.

``stem_all`` works on a column of term arrays, one Arrow batch at a time. A Python worker remembers
the stems of the words it met last, so the usual cost per token is one lookup, and no join with a stemmed
vocabulary (with its hot keys) is needed.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from pagewright.functions.exprs import once

# Fixed values of the published algorithm.
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = [
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
]
LONG_PREFIXES = ["gener", "commun", "arsen"]
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism",
    "ate", "iti", "ous", "ive", "ize", "ion",
]
SHORT_SYLLABLE = re.compile("(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")
VOWEL = re.compile("[aeiouy]")
REGION = re.compile("[aeiouy][^aeiouy]")
CONSONANT_Y = re.compile("^y|(?<=[aeiou])y|(?<=[^aeiouy]y)y")
STEP_1B_ENDING = re.compile("(eedly|ingly|edly|eed|ing|ed)$")
STEP_2_ENDING, STEP_3_ENDING, STEP_4_ENDING = (
    re.compile(f"({'|'.join(endings)})$") for endings in (STEP_2, STEP_3, STEP_4)
)


def _region_after(word: str, start: int) -> int:
    found = REGION.search(word, start)
    return found.end() if found else len(word)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and VOWEL.search(word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    found = STEP_1B_ENDING.search(word)
    if not found:
        return word
    base, ending = word[: found.start()], found.group()
    if ending.startswith("eed"):
        return base + "ee" if len(base) >= r1 else word
    if not VOWEL.search(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")):
        return base[:-1]
    return base + "e" if len(base) <= r1 and SHORT_SYLLABLE.search(base) else base


def _replaced(word: str, pattern: re.Pattern, table: dict[str, str], r1: int, r2: int) -> str:
    found = pattern.search(word)
    if not found or found.start() < r1:
        return word
    base, ending = word[: found.start()], found.group()
    unmet = (
        (ending == "ogi" and not base.endswith("l"))
        or (ending == "li" and base[-1:] not in set("cdeghkmnrt"))
        or (ending == "ative" and len(base) < r2)
        or (ending == "ion" and not base.endswith(("s", "t")))
    )
    return word if unmet else base + table[ending]


def _final_letter(word: str, r1: int, r2: int) -> str:
    base = word[:-1]
    if word.endswith("e"):
        dropped = len(base) >= r2 or (len(base) >= r1 and not SHORT_SYLLABLE.search(base))
    else:
        dropped = word.endswith("ll") and len(base) >= r2
    return base if dropped else word


@lru_cache(maxsize=1 << 17)
def stem_word(term: str) -> str:
    if len(term) <= 2:
        return term
    if term in WHOLE_WORDS:
        return WHOLE_WORDS[term]
    word = CONSONANT_Y.sub("Y", term.removeprefix("'"))
    prefix = next((p for p in LONG_PREFIXES if word.startswith(p)), None)
    r1 = len(prefix) if prefix else _region_after(word, 0)
    r2 = _region_after(word, r1)
    word = _plural(re.sub("('s'|'s|')$", "", word))
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _past(word, r1)
    word = re.sub("(?<=.[^aeiouy])[yY]$", "i", word)
    word = _replaced(word, STEP_2_ENDING, STEP_2, r1, r2)
    word = _replaced(word, STEP_3_ENDING, STEP_3, r1, r2)
    word = _replaced(word, STEP_4_ENDING, dict.fromkeys(STEP_4, ""), r2, r2)
    return _final_letter(word, r1, r2).replace("Y", "y")


@F.pandas_udf(ArrayType(StringType()))
def _stem_arrays(terms: pd.Series) -> pd.Series:
    return terms.map(lambda words: [] if words is None else [stem_word(w) for w in words])


def stem_all(terms: Column) -> Column:
    """Porter2 stems of an array of words, in the same order; the rules apply to lower-case letters."""
    return once(_stem_arrays)(terms)
