"""All relations of a set of pages: sections, paragraphs, components, expansions, sentences and the processed text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.folders import cut, discard, shuffled
from .cleanup import visible_text
from .components import component_rows, restored, with_components
from .expand import expanded_text
from .hierarchy import decomposed, section_rows
from .sentences import sentence_rows
from .sinks import terminal_records
from .viewer import article_error

_ROW = "revision_id long, page_id long, page_title string"
RELATIONS = {
    "sections": f"{_ROW}, section_no int, toc string, raw_text string, text string",
    "paragraphs": f"{_ROW}, section_no int, paragraph_no int, toc string, raw_wikitext string, text string, skipped_part boolean, parse_error string",
    "components": "page_id long, type string, component_id string, component_text string",
    "intermediate": "revision_id long, page_id long, section_no int, paragraph_no int, toc string, expansion_input string, expanded_wikitext string, parse_error string",
    "sentences": f"{_ROW}, section_no int, paragraph_no int, sentence_no int, toc string, raw_text string, text string",
    "processed": f"{_ROW}, namespace int, text_process string, parse_error string",
    "checkpoint": "source_id string, revision_id long, page_id long, status string",
}
#: Texts that expansion leaves as they are: no braces, no elements or comments, none of the control characters that stand for something.
_PLAIN = r"[{}<\x00-\x08\x0B\x0C\x0E-\x1F]"


def bundle(pages: DataFrame, store: DataFrame, source: str, **options) -> dict[str, DataFrame]:
    """RELATIONS of ``pages`` (a row a revision), with templates of ``store`` (title, body); options are those of ``expand``.

    Components leave placeholders in the sections; paragraphs are cut from these, expanded, and shown as text; those of skipped
    parts are neither expanded nor cut into sentences. Two steps are written out of the plan: the pages taken apart, and
    their paragraphs, expanded, in a row a page. Only paragraphs with something to expand go through the rounds, and of the others
    only what changes is dealt to the pages. The relations read these two tables alone, so ``discard`` of them deletes these.
    """
    parts = decomposed(pages, with_components)
    light = ["revision_id", "page_id", "page_title", "namespace", "sections", "components", "paragraphs", "text_process"]
    parts = cut(parts.select(*light))
    ids = ["revision_id", "page_id"]
    each = parts.select(*ids, "page_title", F.posexplode_outer(F.expr("filter(paragraphs, p -> NOT p.skipped_part)")).alias("i", "p")).filter("i IS NOT NULL")
    each = each.select(F.struct(*ids, "i").alias("__k"), "page_title", F.col("p.text").alias("text"))
    plain = F.coalesce(~F.col("text").rlike(_PLAIN), F.lit(False))
    made = expanded_text(each.filter(~plain), store, "__k", "text", "page_title", **options).select("__k", "expanded", F.expr("nullif(text, expanded)").alias("shown"), "parse_error")
    same = visible_text(each.filter(plain), "text", "__shown").selectExpr("__k", "cast(NULL as string) AS expanded", "nullif(__shown, text) AS shown", "cast(NULL as string) AS parse_error")
    every = made.unionByName(same).select("__k.*", "expanded", "shown", "parse_error")
    # paragraphs that aren't skipped come first in a page: each finds its own by its place
    done = every.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("i", "expanded", "shown", "parse_error"))).alias("done"))
    done = done.select(F.col("revision_id").alias("__r"), F.col("page_id").alias("__p"), "done")
    here = parts.select(*ids, "page_title", "components", "paragraphs")
    joined = here.join(shuffled(done), here["revision_id"].eqNullSafe(done["__r"]) & here["page_id"].eqNullSafe(done["__p"]), "left").drop("__r", "__p")
    both = cut(joined)
    discard(made, keep=(parts,))
    one = "transform(array(get(done, i)), d -> struct(p.section_no AS section_no, p.paragraph_no AS paragraph_no, p.toc AS toc, p.text AS text, p.skipped_part AS skipped_part, coalesce(d.expanded, p.text) AS expanded_wikitext, coalesce(d.shown, d.expanded, p.text) AS shown, d.parse_error AS parse_error))[0]"
    both = both.withColumn("done", F.expr(f"transform(paragraphs, (p, i) -> {one})"))
    ready = lambda *fields: both.select(*ids, "page_title", F.explode_outer(F.expr(f"transform(done, p -> struct({', '.join(fields)}))")).alias("p")).filter("p IS NOT NULL").select(*ids, "page_title", "p.*")
    common = ["p.section_no AS section_no", "p.paragraph_no AS paragraph_no", "p.toc AS toc", "p.skipped_part AS skipped_part", "p.parse_error AS parse_error"]
    # the source of a paragraph comes from its own page's row: no join brings it back
    paragraphs = ready(*common, f"{restored('p.text')} AS raw_wikitext", "p.shown AS text")
    inputs = ready(*common, "p.text AS expansion_input", "p.expanded_wikitext AS expanded_wikitext").filter("NOT skipped_part")
    spoken = both.select(*ids, "page_title", F.expr("transform(done, p -> struct(p.section_no AS section_no, p.paragraph_no AS paragraph_no, p.toc AS toc, p.shown AS text, p.skipped_part AS skipped_part))").alias("paragraphs"))
    bad = both.select("revision_id", F.expr("size(filter(done, p -> p.parse_error IS NOT NULL))").alias("n")).filter("n > 0").groupBy("revision_id").agg(F.sum("n").alias("failed"))
    told = lambda rows: rows.join(bad, "revision_id", "left").withColumn("parse_error", article_error(F.coalesce("failed", F.lit(0)), F.coalesce("failed", F.lit(0))))
    # those that read the first table come first, so that it can go before the others are written
    return {
        "sections": section_rows(parts),
        "components": component_rows(parts),
        "processed": told(parts),
        "paragraphs": paragraphs,
        "intermediate": inputs,
        "sentences": sentence_rows(spoken),
        "checkpoint": terminal_records(told(both.select(*ids)), source),
    }
