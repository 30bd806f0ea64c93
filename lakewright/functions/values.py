"""Casts, dates, identifiers, keys, hashes and scrubbing as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for "no value" in text columns.
BLANK_DATES = ["00/00/0000", "0000-00-00", "00/00/00", "0000/00/00", "NULL", "null", ""]
BLANKS = ["NULL", "null", ""]


def rounded_int(c: Column, kind: str = "int") -> Column:
    """A numeric string to an integer, fractions rounded half away from zero; null if it is no number or out of range."""
    return F.round(c.try_cast("double")).try_cast(kind)


def clean_date(c: Column, as_of: Column, pattern: str = "d/M/yyyy", first: int = 1900, last: int = 2030) -> Column:
    """A day/month/year text to a date; sentinels, dates after as_of and years outside first..last are null."""
    day = F.try_to_date(F.when(~F.trim(c).isin(BLANK_DATES), F.trim(c)), pattern)
    return F.when((day <= as_of) & F.year(day).between(first, last), day)


def first_date(c: Column, patterns: list[str]) -> Column:
    """The first pattern that parses."""
    return F.coalesce(*[F.try_to_date(c, p) for p in patterns])


def clean_timestamp(c: Column, as_of: Column, pattern: str = "yyyyMMdd_HHmmss") -> Column:
    at = F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
    return F.when(at <= as_of, at)


def clean_time(c: Column) -> Column:
    """An H:mm text as HH:mm; else null."""
    return F.when(c.rlike(r"^([01]?\d|2[0-3]):[0-5]\d$"), F.lpad(c, 5, "0"))


def currency(c: Column) -> Column:
    """"1.234,56" to 1234.56."""
    return F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def measure(c: Column) -> Column:
    """The digits, commas and points of a text such as "1,65m", the comma being decimal."""
    return F.replace(F.array_join(F.regexp_extract_all(F.trim(c), F.lit("[0-9,.]"), F.lit(0)), ""), F.lit(","), F.lit(".")).try_cast("double")


def chart_number(c: Column, lowest: int = 1) -> Column:
    """Chart numbers: "520.124" is 520124, "123.0" is 123; what has other characters or is below `lowest` is null."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    number = F.when(text.rlike(r"^\d{1,3}(\.\d{3})+$|^\d+$"), F.replace(text, F.lit("."), F.lit(""))).try_cast("long")
    return F.when(number >= lowest, number)


def tax_id(c: Column) -> Column:
    """Eleven digits from any punctuation; shorter than nine digits or all the same digit is null."""
    digits = F.regexp_replace(c.cast("string"), "[^0-9]", "")
    # lpad would cut longer ones; DuckDB's does so too
    padded = F.lpad(digits, 11, "0")
    return F.when((F.length(digits) >= 9) & ~padded.rlike(r"^(\d)\1{10}$"), padded)


def clean_value(c: Column) -> Column:
    """Null for blank text and any spelling of none."""
    text = F.trim(c.cast("string"))
    return F.when(~F.upper(text).isin("", "NONE"), text)


def normalise_key(c: Column) -> Column:
    """Keys from different systems alike: trimmed, lower case, without ".0", leading zeros and midnight."""
    text = F.regexp_replace(F.lower(F.trim(c.cast("string"))), r"\.0$", "")
    text = F.when(text.rlike(r"^\d+$"), F.coalesce(F.nullif(F.regexp_replace(text, "^0+", ""), F.lit("")), F.lit("0"))).otherwise(text)
    return F.replace(text, F.lit(" 00:00:00"), F.lit(""))


def row_hash(columns: list[str]) -> Column:
    """MD5 of "name:value" in order of name; null values count as empty."""
    parts = [F.concat(F.lit(f"{c}:"), F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))) for c in sorted(columns)]
    return F.md5(F.concat_ws("|", *parts))


#: Patterns of personal data and what replaces them, in order.
SCRUB = [
    (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[EMAIL_REDACTED]"),
    (r"\+?\d{1,3}?[-.\s]?\(?\d{2,3}\)?[-.\s]?\d{4,5}[-.\s]?\d{4}", "[PHONE_REDACTED]"),
    (r"\b\d{3}\.\d{3}\.\d{3}-\d{2}\b", "[CPF_REDACTED]"),
    (r"\b\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}\b", "[CNPJ_REDACTED]"),
]


def scrub_pii(c: Column) -> Column:
    return reduce(lambda x, rule: F.regexp_replace(x, rule[0], rule[1]), SCRUB, c)


def mapped(c: Column, groups: dict[str, list[str]], otherwise: str | None = None) -> Column:
    """The canonical name of a spelling: one map lookup however long the lists are; the first group of a spelling wins."""
    pairs: dict[str, str] = {}
    for name, spellings in groups.items():
        for s in spellings:
            pairs.setdefault(s, name)
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), F.lit(otherwise))


def id_date(c: Column) -> Column:
    """The date in an identifier such as D2023.05.15_S1."""
    return F.try_to_date(F.regexp_extract(c, r"D(20\d{2}\.\d{2}\.\d{2})", 1), "yyyy.MM.dd")


def age_years(birth: Column, at: Column, digits: int = 2) -> Column:
    return F.round(F.datediff(at, birth) / 365.25, digits)


def bmi(weight: Column, height: Column) -> Column:
    return F.when((weight > 0) & (height > 0), F.round(weight / F.pow(height, F.lit(2)), 2))


def dose(c: Column) -> Column:
    """A dose text: points group thousands, the comma is decimal."""
    return currency(F.regexp_replace(c.cast("string"), "[^0-9,.]", ""))


def total_dose(days: Column, amount: Column, interval: Column) -> Column:
    return F.when(interval != 0, F.abs(days.cast("double") * amount * (F.lit(24.0) / interval)))


def drug_group(name: Column) -> Column:
    """The first word, upper case, hyphens as blanks; the second where the first is a single letter."""
    words = F.upper(F.replace(name, F.lit("-"), F.lit(" ")))
    first, second = (F.split_part(words, F.lit(" "), F.lit(i)) for i in (1, 2))
    return F.when(F.length(first) <= 1, second).otherwise(first)


def truncated_or_rounded_equal(a: Column, b: Column, digits: int = 1) -> Column:
    """Whether b equals a cut or rounded to `digits` places."""
    scale = 10**digits
    return (F.floor(a * scale) / scale == b) | (F.round(a, digits) == F.round(b, digits))
