"""Scalar functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_title(c: Column) -> Column:
    """Without the sign that marks words to be ignored in sorting, trimmed."""
    return F.trim(F.replace(c, F.lit("¬"), F.lit("")))


def parse_year(c: Column) -> Column:
    """The first year from 1800 to 2099, else null."""
    return F.regexp_extract(c, r"(1[89]\d\d|20\d\d)", 1).try_cast("int")


def parse_pages(c: Column) -> Column:
    """The largest number in an extent that has a letter, else null."""
    nums = F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), 1), lambda x: x.try_cast("bigint"))
    return F.when(c.rlike("[A-Za-z]"), F.array_max(nums))


def first_name(c: Column) -> Column:
    """Of 'Family, Given More (note)' the first given name up to a blank or hyphen; null without a comma."""
    bare = F.regexp_replace(c, r"\(.*?\)", "")
    given = F.trim(F.element_at(F.split(bare, ",", 2), 2))
    return F.when(F.instr(bare, ",") > 0, F.nullif(F.regexp_extract(given, r"^([^\s\-]+)", 1), F.lit("")))


def language_code(c: Column) -> Column:
    """X11: German and English by name to codes, anything else as it is, blank to null."""
    t = F.lower(F.trim(c))
    return F.when(t == "german", "de").when(t == "english", "en").when(t == "", None).otherwise(c)


def alpha_tier(c: Column) -> Column:
    """Red below 0, yellow below 0.667, ok above; null without a value."""
    return F.when(c < 0, "red").when(c < 0.667, "yellow").when(c.isNotNull(), "ok")


def tagged_answer(c: Column) -> tuple[Column, Column]:
    """(documents as JSON, answer) of '<data>[...]</data>answer'; without the opening and closing tag all is answer."""
    rx = r"(?s)^<data>(.*?)</data>(.*)$"
    has = c.rlike(rx)
    return F.when(has, F.regexp_extract(c, rx, 1)), F.when(has, F.regexp_extract(c, rx, 2)).otherwise(c)


def render_context(chunks: Column) -> Column:
    """Context of array<struct<rank, title, text>>: a header per chunk, chunks in order of rank, separated by a rule."""
    one = lambda x: F.concat(F.lit("["), x["rank"].cast("string"), F.lit("] "), F.coalesce(x["title"], F.lit("Untitled")), F.lit("\n"), x["text"])
    return F.array_join(F.transform(F.array_sort(chunks), one), "\n\n---\n\n")
