"""Text functions as column expressions: accents, phonetic folding, name words."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Composed Latin letters and what is left of each without its marks."""
    pairs = [(chr(c), d[0]) for c in range(0xC0, 0x250) if len(d := unicodedata.normalize("NFD", chr(c))) > 1]
    pairs += [(chr(c), d[0]) for c in range(0x1E00, 0x1F00) if len(d := unicodedata.normalize("NFD", chr(c))) > 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(c: Column) -> Column:
    """Letters without their marks, composed or not; letters that aren't composed (ø, ß) stay."""
    return F.translate(F.regexp_replace(c, r"\p{M}+", ""), _ACCENTED, _PLAIN)


#: The ordered replacements of the phonetic fold.
FOLD = [("ph", "f"), ("y", "i"), ("w", "v"), ("z", "s"), ("k", "c"), ("ss", "s"), ("ll", "l"), ("rr", "r"), ("nn", "n"), ("tt", "t"), ("cc", "c"), ("pp", "p"), ("ff", "f"), ("mm", "m"), ("h", "")]


def phonetic_fold(word: Column) -> Column:
    """A spelling-tolerant key of a lower-case word."""
    for old, new in FOLD:
        word = F.replace(word, F.lit(old), F.lit(new))
    return word


def name_in_order(name: Column) -> Column:
    """"LAST, FIRST" as "FIRST LAST"; other names as they are."""
    return F.when(F.contains(name, F.lit(",")), F.concat(F.split_part(name, F.lit(","), F.lit(2)), F.lit(" "), F.split_part(name, F.lit(","), F.lit(1)))).otherwise(name)


def name_full(name: Column) -> Column:
    """The name in order, lower case, without accents; what isn't a letter is a blank."""
    return F.regexp_replace(strip_accents(F.lower(F.trim(name_in_order(name)))), "[^a-z]", " ")


def name_words(name: Column) -> Column:
    """The words of name_full."""
    return F.filter(F.split(name_full(name), r"\s+"), lambda w: F.length(w) > 0)


def snake_case(name: str) -> str:
    """A column name without accents, in snake_case."""
    plain = "".join(c for c in unicodedata.normalize("NFD", name) if not unicodedata.combining(c))
    words, last = [], ""
    for c in plain:
        if c.isalnum():
            if words and (last.isspace() or not last.isalnum() or (c.isupper() and last.islower())):
                words.append("_")
            words.append(c.lower())
        last = c
    return "".join(words).strip("_")
