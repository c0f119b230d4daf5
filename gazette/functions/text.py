"""Text cleaning, measuring and vocabulary expressions (Column -> Column)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette import constants as C

# Unicode white space: \s in Unicode mode, and four separators it leaves out.
# A predefined class is several times faster than a list of ranges.
SPACE = r"\s\x1c-\x1f"
SPACE_RUN = f"(?U)[{SPACE}]+"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def collapse_space(text: Column) -> Column:
    """Every run of white space becomes one space; the ends are stripped."""
    return F.trim(F.regexp_replace(text, SPACE_RUN, " "))


def strip_space(text: Column) -> Column:
    """Strip Unicode white space at both ends, leaving the inside alone."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def normalize_text(text: Column) -> Column:
    return collapse_space(blank_if_null(text))


def normalize_title(title: Column) -> Column:
    """Collapsed title without characters outside letters, digits and - . , ! ?"""
    return F.regexp_replace(normalize_text(title), r"[^a-zA-Z0-9_ \-.,!?\p{L}\p{N}]+", "")


def char_count(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """White-space separated tokens of any text."""
    return F.regexp_count(text, F.lit(f"(?U)[^{SPACE}]+"))


def word_count_collapsed(text: Column) -> Column:
    """Tokens of text whose white space is already collapsed: spaces plus one."""
    return F.when(text == "", 0).otherwise(F.regexp_count(text, F.lit(" ")) + 1)


def contains_any(lowered: Column, words: list[str]) -> Column:
    return reduce(or_, [F.contains(lowered, F.lit(w)) for w in words])


def count_present(lowered: Column, words: list[str]) -> Column:
    """How many of the words occur as substrings, each counted once."""
    return reduce(Column.__add__, [F.contains(lowered, F.lit(w)).cast("int") for w in words])


def theme(lowered: Column) -> Column:
    """First theme, by priority, with a word that occurs in the lower-case text."""
    themes = iter(C.THEMES.items())
    name, words = next(themes)
    branch = F.when(contains_any(lowered, words), name)
    for name, words in themes:
        branch = branch.when(contains_any(lowered, words), name)
    return branch.otherwise(C.OTHER_THEME)


def theme_text(title: Column, body: Column) -> Column:
    return F.lower(F.concat(blank_if_null(title), F.lit(" "), blank_if_null(body)))


def keywords(text: Column) -> Column:
    """Runs of four or more unaccented letters, lower case, in an array."""
    return F.regexp_extract_all(F.lower(blank_if_null(text)), F.lit(C.KEYWORD_PATTERN), F.lit(0))


def quality_score(content_length: Column, words: Column, title: Column) -> Column:
    """Share of three passed tests: long enough, wordy enough, titled."""
    tests = [content_length > 100, words > 20, title.isNotNull()]
    return reduce(Column.__add__, [t.cast("int") for t in tests]) / F.lit(3.0)
