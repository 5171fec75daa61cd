"""Lookups and navigation over the relations a dump was taken into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_paragraphs(paragraphs: DataFrame, page_id: int) -> DataFrame:
    return paragraphs.filter(F.col("page_id") == page_id).withColumn("text", F.coalesce("text", F.lit(""))).orderBy("section_no", "paragraph_no")


def page_sentences(sentences: DataFrame, page_id: int) -> DataFrame:
    return sentences.filter(F.col("page_id") == page_id).withColumn("text", F.coalesce("text", F.lit(""))).orderBy("section_no", "paragraph_no", "sentence_no")


def latest_content(pages: DataFrame, page_id: int) -> DataFrame:
    """The row of the page's greatest revision."""
    return pages.filter(F.col("page_id") == page_id).orderBy(F.desc("revision_id")).limit(1)


def intermediate_with_paragraphs(intermediate: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Expansion rows with their paragraphs, on all four keys; the paragraph's path and error come first."""
    keys = ["revision_id", "page_id", "section_no", "paragraph_no"]
    i, p = intermediate.alias("i"), paragraphs.alias("p")
    joined = i.join(p, keys, "inner")
    return joined.select(
        *keys, F.coalesce("p.toc", "i.toc").alias("toc"), "i.expansion_input", "i.expanded_wikitext", F.coalesce("p.text", F.lit("")).alias("text"), F.coalesce("p.parse_error", "i.parse_error").alias("parse_error")
    )


def neighbours(rows: DataFrame, page_id: int) -> DataFrame:
    """(previous, next) page of one page: one pass with two conditional aggregates."""
    key = F.col("page_id")
    return rows.agg(F.max(F.when(key < page_id, key)).alias("previous"), F.min(F.when(key > page_id, key)).alias("next"))


def bounds(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))


def probes(rows: DataFrame, points: list[int]) -> DataFrame:
    """(point, page_id): for each of a few points the least page at or after it, else the first page; one pass for all."""
    key = F.col("page_id")
    found = rows.agg(F.array(*[F.struct(F.lit(p).cast("long").alias("point"), F.coalesce(F.min(F.when(key >= p, key)), F.min(key)).alias("page_id")) for p in points]).alias("x"))
    return found.select(F.inline("x"))


def random_page(rows: DataFrame, seed: int) -> DataFrame:
    """(point, page_id) of a uniform point between the first and the last page."""
    import random

    ends = bounds(rows).first()
    return probes(rows, [random.Random(seed).randint(ends["first"], ends["last"])] if ends["first"] is not None else [0])


def run_stats(paragraphs: DataFrame) -> DataFrame:
    """Counts of expanded paragraphs: all, without and with errors, per run."""
    done = paragraphs.filter("NOT skipped_part")
    bad = F.col("parse_error").isNotNull()
    return done.agg(F.count("*").alias("total"), F.count(F.when(~bad, 1)).alias("succeeded"), F.count(F.when(bad, 1)).alias("failed"))


def article_error(failed: Column, expansions: Column) -> Column:
    """The error of an article from the numbers of its paragraphs with errors, and of those from expansion; null without any."""
    text = F.concat(F.lit("paragraph_errors="), failed.cast("string"), F.lit("; wtp_errors="), expansions.cast("string"))
    return F.when(failed > 0, text)


def failed_revisions(processed: DataFrame) -> DataFrame:
    return processed.filter("parse_error IS NOT NULL").select("revision_id", "page_id", "page_title", "parse_error").orderBy("revision_id")


def page_title(rows: DataFrame) -> DataFrame:
    """(page_id, title): the first title that isn't blank, in order of revision."""
    filled = rows.withColumn("t", F.nullif(F.trim("page_title"), F.lit("")))
    return filled.filter("t IS NOT NULL").groupBy("page_id").agg(F.min_by("t", "revision_id").alias("title"))
