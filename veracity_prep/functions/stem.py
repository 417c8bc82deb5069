"""Porter stemming (the published algorithm with the usual extensions for English) over token arrays.

The stemmer runs in an Arrow job without a shuffle: the tokens of a batch are dictionary-encoded, each distinct
word is stemmed once, and the codes are mapped back.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Tasks receive the functions of this module by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words with an irregular stem.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix rules of steps 2, 3 and 4 of the algorithm.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
    "biliti": "ble", "fulli": "ful", "logi": "log",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """``c`` for each consonant and ``v`` for each vowel; ``y`` after a consonant is a vowel."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    stem = word[: -len(suffix)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    return stem + "i" if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c" else word


def _derived(word: str) -> str:
    suffix = _longest(word, STEP2)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if suffix == "logi":
        return word[:-1] if _measure(word[:-3]) > 0 else word
    if _measure(stem) == 0:
        return word
    return _derived(stem + "al") if suffix == "alli" else stem + STEP2[suffix]


def _adjectival(word: str) -> str:
    suffix = _longest(word, STEP3)
    if suffix is None or _measure(word[: -len(suffix)]) == 0:
        return word
    return word[: -len(suffix)] + STEP3[suffix]


def _residual(word: str) -> str:
    suffix = _longest(word, STEP4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) <= 1 or (suffix == "ion" and not stem.endswith(("s", "t"))):
        return word
    return stem


def _final_e(word: str) -> str:
    if not word.endswith("e"):
        return word
    m = _measure(word[:-1])
    return word[:-1] if m > 1 or (m == 1 and not _short_end(word[:-1])) else word


def _final_l(word: str) -> str:
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem_word(word: str) -> str:
    """Stem of one word, in lower case."""
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derived, _adjectival, _residual, _final_e, _final_l):
        word = step(word)
    return word


def _map_distinct(tokens, fn):
    """Apply ``fn`` to each distinct string of an Arrow list array and keep the list structure."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    codes = tokens.flatten().dictionary_encode()
    words = pa.array([None if w is None else fn(w) for w in codes.dictionary.to_pylist()], pa.string())
    return pa.ListArray.from_arrays(offsets, words.take(codes.indices), mask=tokens.is_null())


def stem_tokens(tokens: Column) -> Column:
    """Stem every token of an array column."""

    def run(batch):
        return _map_distinct(batch, stem_word)

    return F.arrow_udf(run, ArrayType(StringType()))(tokens)
