"""Column helpers on text: white space, words, numbers, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as in Unicode, for use inside a character class of Java or RE2.
WS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A maximal run of letters and digits of any script.
WORD = r"[\p{L}\p{N}]+"
#: A number with optional separators between digits.
NUMBER = r"[0-9]+(?:[.,][0-9]+)*"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (trim() knows spaces only)."""
    return F.regexp_replace(c, F.lit(rf"^[{WS}]+|[{WS}]+\z"), F.lit(""))


def trim_blanks(c: Column) -> Column:
    """Without spaces and tabs at both ends."""
    return F.regexp_replace(c, F.lit(r"^[ \t]+|[ \t]+\z"), F.lit(""))


def source_name(c: Column) -> Column:
    """A source in compared form; null where nothing is left of it."""
    base = F.regexp_replace(c, F.lit(r"(?s)^.*[/\\]"), F.lit(""))
    return F.nullif(F.lower(trim_blanks(base)), F.lit(""))


def words(c: Column) -> Column:
    """All words in order, lower-cased; of a null text none."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))


def number_set(c: Column) -> Column:
    """Sorted distinct numbers of a text, commas removed."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NUMBER), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))))


def or_true(c: Column) -> Column:
    """A missing flag counts as true."""
    return F.coalesce(c, F.lit(True))


#: Words that say nothing about whether an answer rests on its passage.
STOP_WORDS = (
    "a an the and or but if then than that this these those is are was were be been being am "
    "do does did doing have has had having will would shall should can could may might must to "
    "of in on at by for with from as into about it its they them their there which who whom "
    "what when where how why all any both each few more most other some such no nor not only own "
    "same so too very s t just also you your we our he she his her him i me my one two "
    "up out over under between during before after above below again further once here because while"
).split()


def content_words(c: Column) -> Column:
    """Sorted distinct content words: Latin letters with - and ', three or more, no stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[a-z][a-z\-']+"), F.lit(0))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS if len(w) > 2])
    return F.array_sort(F.array_except(F.filter(found, lambda w: F.length(w) > 2), stop))


def plain_numbers(c: Column) -> Column:
    """Sorted distinct numbers by value: 1,000 is 1000 and 3.0 is 3; what is no number is dropped.

    Values print as they do in Python up to 1e15; beyond, as whole numbers do in Spark.
    """
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NUMBER), F.lit(0))
    values = F.filter(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")), lambda v: v.isNotNull())
    shown = F.transform(values, lambda v: F.when((v == F.floor(v)) & (v < 9e18), v.cast("decimal(38,0)").cast("string")).otherwise(v.cast("string")))
    return F.array_sort(F.array_distinct(shown))


def opener(c: Column) -> Column:
    """The first two Latin words of a question, lower-cased; null if there is none."""
    first = F.slice(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z]+"), F.lit(0)), 1, 2)
    return F.nullif(F.lower(F.array_join(first, " ")), F.lit(""))


def stripped_length(c: Column) -> Column:
    """Code points of a text without white space at the ends."""
    return F.length(strip(F.coalesce(c, F.lit(""))))
