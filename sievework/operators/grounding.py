"""Mechanical check of answers against their passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import content_words, plain_numbers, source_name
from sievework.session import cut

#: Least overlap of the bands, novel words shown, bins of the histogram.
STRONG, MODERATE, SHOWN, BINS = 0.7, 0.5, 20, 10


def band(overlap: Column) -> Column:
    """strong, moderate or weak, by the overlap before rounding."""
    return F.when(overlap >= STRONG, "strong").when(overlap >= MODERATE, "moderate").otherwise("weak")


def checked(pairs: DataFrame, answer: str = "answer", passage: str = "passage") -> DataFrame:
    """Add word and number findings to pairs that hold their passage.

    An answer without content words overlaps wholly. ``overlap`` is raw, ``lexical_overlap`` has 3 places.
    """
    a, p = content_words(F.col(answer)), content_words(F.col(passage))
    an, pn = plain_numbers(F.col(answer)), plain_numbers(F.col(passage))
    wide = pairs.withColumns({"_a": a, "_p": p, "numbers_in_answer": an, "_n": pn})
    novel, new = F.array_except("_a", "_p"), F.array_except("numbers_in_answer", "_n")
    n = F.size("_a")
    overlap = F.when(n > 0, F.size(F.array_intersect("_a", "_p")) / n).otherwise(F.lit(1.0))
    found = wide.withColumns({
        "overlap": overlap, "answer_words": n, "matched_words": F.size(F.array_intersect("_a", "_p")), "novel_words": F.slice(F.array_sort(novel), 1, SHOWN), "novel_word_count": F.size(novel),
        "unsupported_numbers": F.array_sort(new), "has_unsupported_number": F.size(new) > 0,
    })
    return found.withColumns({"lexical_overlap": F.round("overlap", 3), "grounding_band": band(F.col("overlap"))}).drop("_a", "_p", "_n")


def checked_by_page(pairs: DataFrame, pages: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """The same findings, in numbers, for pairs whose passage is all text of their source and page.

    ``pairs`` has key, source, page (from 1) and answer; ``pages`` has source, page and text.
    Pages are compared word by word, so that a page with very many rows is never put together:
    ``key, passage_found, answer_words, matched_words, answer_numbers, matched_numbers``, and the
    small columns ``keep`` of the pair.
    """
    own = [F.col(c) for c in (key, *(keep or []))]
    place = [source_name(F.col("source")).alias("s"), F.col("page").alias("p")]
    terms = lambda t: F.explode(F.concat(F.transform(content_words(t), lambda w: F.concat(F.lit("w"), w)), F.transform(plain_numbers(t), lambda n: F.concat(F.lit("n"), n)), F.array(F.lit("page"))))
    have = pages.select(*place, terms(F.col("text")).alias("term")).filter("s is not null and p is not null").distinct().withColumn("there", F.lit(True))
    want = pairs.select(*own, *place, terms(F.col("answer")).alias("term"))
    joined = want.join(have, ["s", "p", "term"], "left")
    is_word, is_number, there = F.col("term").startswith("w"), F.col("term").startswith("n"), F.col("there").isNotNull()
    return joined.groupBy(*own).agg(
        F.bool_or((F.col("term") == "page") & there).alias("passage_found"),
        F.count_if(is_word).alias("answer_words"), F.count_if(is_word & there).alias("matched_words"), F.count_if(is_number).alias("answer_numbers"), F.count_if(is_number & there).alias("matched_numbers"),
    )


def checked_either(pairs: DataFrame, pages: DataFrame, key: str, passage: str = "chunk_text", keep: list[str] | None = None) -> DataFrame:
    """checked_by_page() for pairs that may hold their own passage: that one counts if it is not empty,
    else the text of their source and page, else nothing is found. ``passage_from`` says which: own, page or none."""
    own = F.coalesce(F.col(passage), F.lit("")) != ""
    columns = [key, *(keep or []), "passage_found", "answer_words", "matched_words", "answer_numbers", "matched_numbers"]
    held = checked(pairs.filter(own), "answer", passage).withColumns({
        "passage_found": F.lit(True), "answer_words": F.col("answer_words").cast("bigint"), "matched_words": F.col("matched_words").cast("bigint"),
        "answer_numbers": F.size("numbers_in_answer").cast("bigint"), "matched_numbers": (F.size("numbers_in_answer") - F.size("unsupported_numbers")).cast("bigint"),
    }).select(*columns, F.lit("own").alias("passage_from"))
    looked_up = checked_by_page(pairs.filter(~own), pages, key, keep).select(*columns, F.when(F.col("passage_found"), "page").otherwise("none").alias("passage_from"))
    return held.unionByName(looked_up)


def with_findings(found: DataFrame) -> DataFrame:
    """Add overlap, its 3 places, the band and whether a number is unsupported to counts of words and numbers."""
    raw = raw_overlap(F.col("matched_words"), F.col("answer_words"))
    return found.withColumns({"overlap": raw, "lexical_overlap": F.round(raw, 3), "grounding_band": band(raw), "has_unsupported_number": F.col("matched_numbers") < F.col("answer_numbers")})


def coverage(found: DataFrame) -> DataFrame:
    """Pairs analysed, and those whose passage is nowhere."""
    return found.agg(F.count_if("passage_found").alias("analysed"), F.count_if(~F.col("passage_found")).alias("not_matched"))


def raw_overlap(matched: Column, words: Column) -> Column:
    return F.when(words > 0, matched / words).otherwise(F.lit(1.0))


def summary(found: DataFrame) -> DataFrame:
    """One row: pairs, bands, pairs with unsupported numbers, and sums for the mean overlap."""
    return found.agg(
        F.count("*").alias("analysed"),
        *[F.count_if(F.col("grounding_band") == b).alias(b) for b in ("strong", "moderate", "weak")],
        F.count_if("has_unsupported_number").alias("with_unsupported_numbers"),
        F.sum(F.round(F.col("lexical_overlap") * 1000).cast("bigint")).alias("overlap_sum_1e3"),
        F.min(F.round(F.col("lexical_overlap") * 1000).cast("bigint")).alias("least_overlap_1e3"),
    )


def mean_overlap(found: DataFrame, by: str) -> DataFrame:
    """Pairs and mean overlap of every value of ``by``."""
    return found.groupBy(by).agg(F.count("*").alias("pairs"), F.round(F.avg("lexical_overlap"), 3).alias("mean_overlap"))


def histogram(found: DataFrame, value: str = "lexical_overlap", bins: int = BINS) -> DataFrame:
    """``bin, n`` for all bins of equal width from 0 to 1, empty ones too; 1 falls into the last."""
    at = F.least(F.floor(F.col(value) * bins), F.lit(bins - 1)).cast("int")
    counted = found.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    every = found.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(cut(counted)), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))  # at most ``bins`` rows


def judge_agreement(found: DataFrame, groundedness: Column) -> DataFrame:
    """How often the judge and the overlap say the same; ``found`` has lexical_overlap."""
    high, low = F.col("lexical_overlap") >= STRONG, F.col("lexical_overlap") < MODERATE
    clean = groundedness == 2
    return found.filter(groundedness.isNotNull()).agg(
        F.count("*").alias("judged"), F.count_if(clean == high).alias("agree"), F.count_if(clean & low).alias("clean_but_low"), F.count_if(~clean & high).alias("flagged_but_high")
    )
