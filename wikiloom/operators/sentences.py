"""Paragraphs into sentences: references go, a lead-in with a colon takes the list behind it, lists become one sentence.

Sentences end at . ! ? (and their full-width forms) with closing quotes, before white space and a capital, digit, bracket,
quote or the end; not after common abbreviations or initials. This is a rule of our own; it keeps no state between
paragraphs. Numbers run per section over all its paragraphs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import by_row
from ..functions.texts import WHITE, quoted, replace_all, rstrip, strip
from .links import drop_ref_placeholders, format_wikilinks, is_list_only

ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Jr", "Sr", "vs", "etc", "e.g", "i.e", "cf", "No", "Vol", "Fig", "ca", "approx", "Inc", "Ltd", "Co", "Gen", "Col", "Lt", "Sgt", "Rev")
_SIGNS = "*#;:"
_COLONS = (":", "：")
TOKEN = "\x02"


def render_items(items: list[tuple[int, str]]) -> str:
    """A run of list items (depth, content) as one phrase: tops joined by '; ', each with what hangs below it as 'item: (a,b)'."""
    return "; ".join(text for text, _ in _nodes(items) if text)


def _nodes(items: list[tuple[int, str]]) -> Iterator[tuple[str, bool]]:
    """(text, whether it has items below) of the top items: an item owns the deeper ones that follow."""
    at = 0
    while at < len(items):
        depth, content = items[at]
        end = at + 1
        while end < len(items) and items[end][0] > depth:
            end += 1
        below = [(t, deep) for t, deep in _nodes(items[at + 1 : end]) if t]
        own = content.strip().rstrip(".;；。").strip()
        if below:
            joined = below[0][0]
            for (_, left), (text, right) in zip(below, below[1:], strict=False):
                joined += (";" if left or right else ",") + text
            own = f"{own.rstrip(' 	:：;；')}: ({joined})" if own else joined
        yield own, end > at + 1
        at = end


def fold_lists(text: str) -> str:
    """Each run of list lines as one phrase, kept from being cut by TOKEN at its blanks, with a full stop; behind a line that ends in a colon on that line."""
    out: list[str] = []
    run: list[tuple[int, str]] = []

    def close() -> None:
        phrase = render_items(run)
        run.clear()
        if phrase:
            kept = re.sub(r"(?<=[.!?。！？])(?=[\s\"')\]])", TOKEN, phrase) + "."
            if out and out[-1].rstrip().endswith(_COLONS):
                out[-1] = f"{out[-1].rstrip()} {kept}"
            else:
                out.append(kept)

    for line in text.splitlines():
        item = line.strip(" \t")
        content = item.lstrip(_SIGNS)
        if content != item:
            run.append((len(item) - len(content), content.lstrip(" \t")))
            continue
        if run:
            close()
        out.append(line)
    if run:
        close()
    return "\n".join(out)


def _folded(column: Column | str) -> Column:
    return by_row(lambda text: None if text is None else fold_lists(text), pa.string(), "string")(column)


def _folded_each(column: Column) -> Column:
    def one(texts: list[str | None] | None) -> list[str | None] | None:
        return None if texts is None else [None if t is None else fold_lists(t) for t in texts]

    return by_row(one, pa.list_(pa.string()), "array<string>")(column)


def _starts(rows: str, goes_on: str) -> str:
    """SQL: where the runs of the array ``rows`` begin. goes_on: whether row i, x, belongs to the run before it."""
    return f"filter(transform({rows}, (x, i) -> IF({goes_on}, NULL, i)), i -> i IS NOT NULL)"


def _runs(rows: str, starts: str, made: str) -> str:
    """SQL: ``made`` of each run g of ``rows``; each row is in one slice."""
    return f"transform(transform({starts}, (h, j) -> slice({rows}, h + 1, coalesce(get({starts}, j + 1), size({rows})) - h)), g -> {made})"


def _merged(rows: DataFrame) -> DataFrame:
    """``rows`` with paragraphs __r (section_no, paragraph_no, toc, text) as __p, where a list-only one joins the one before that ends in a colon."""
    before, own = "get(__r, i - 1)", "x.text"
    signed = f"left(ltrim('{WHITE}', {own}), 1) IN ({', '.join(map(quoted, _SIGNS))})"  # a cheap test before the exact one
    colon = f"right({rstrip(before + '.text')}, 1) IN ({', '.join(map(quoted, _COLONS))})"
    joins = f"i > 0 AND {signed} AND {before}.section_no = x.section_no AND {colon} AND {is_list_only(own)}"
    text = f"array_join(transform(g, (p, k) -> IF(k = 0, {rstrip('p.text')}, {strip('p.text')})), '\\n')"
    one = f"IF(size(g) = 1, g[0], struct(g[0].section_no AS section_no, g[0].paragraph_no AS paragraph_no, g[0].toc AS toc, {text} AS text))"
    rows = rows.withColumn("__h", F.expr(_starts("__r", joins)))
    return rows.withColumn("__p", F.expr(f"IF(size(__h) = size(__r), __r, {_runs('__r', '__h', one)})")).drop("__r", "__h")


def _pieces(text: str) -> str:
    """SQL: the sentences of a text, as an array. A full stop behind an abbreviation ends none."""
    abbreviations = "|".join(a.replace(".", "\\.") for a in ABBREVIATIONS)
    # one pass that begins at the signs; nothing in it goes back over what it has taken
    end = rf"([.!?。！？](?<![.!?。！？]{{2}})[.!?。！？]*+[\"'”’)\]]*+)(?<!(?<![A-Za-z])(?:{abbreviations}|[A-Z])\.)\s++(?=[\p{{Lu}}\p{{N}}\[({{\"'“‘♣])"
    token, mark = quoted(TOKEN), quoted(chr(3))
    clean = f"IF(contains(m, {token}) OR contains(m, {mark}), replace(replace(m, {token}, ''), {mark}, ''), m)"
    marked = f"transform(array({replace_all(text, end, '$1' + chr(1))}), m -> {clean})[0]"
    return f"filter(transform(split({marked}, '\\u0001', -1), t -> {strip('t')}), t -> t <> '')"


def sentence_rows(pages: DataFrame) -> DataFrame:
    """The relation of sentences of ``pages`` (with paragraphs): revision_id, page_id, page_title, section_no, paragraph_no, sentence_no, toc, raw_text, text.

    Skipped paragraphs give none, blank ones neither. All of it is done in a page's row, where sections are in order.
    """
    ready = f"transform(filter(paragraphs, p -> NOT p.skipped_part), p -> struct(p.section_no AS section_no, p.paragraph_no AS paragraph_no, p.toc AS toc, {drop_ref_placeholders('p.text')} AS text))"
    keys = ["revision_id", "page_id", "page_title"]
    rows = _merged(pages.select(*keys, F.expr(ready).alias("__r")))
    # only texts with list lines go through the list helper
    signs = " OR ".join(f"contains(p.text, '{s}')" for s in _SIGNS)
    some = f"({signs}) AND p.text RLIKE {quoted(r'(?:\A|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029])[ \t]*+[*#;:]')}"
    rows = rows.withColumn("__lists", F.expr(f"transform(__p, p -> IF({some}, p.text, NULL))"))
    rows = rows.withColumn("__lists", _folded_each(F.when(F.expr("exists(__lists, t -> t IS NOT NULL)"), F.col("__lists"))))
    sentence = "struct(p.section_no AS section_no, p.paragraph_no AS paragraph_no, p.toc AS toc, t AS raw_text)"
    rows = rows.withColumn("__s", F.expr(f"transform(__p, (p, i) -> transform({_pieces('coalesce(__lists[i], p.text)')}, t -> {sentence}))"))
    # numbers go on over a section's paragraphs; they are made for the whole page, a number a sentence
    rows = rows.withColumn("__n", F.expr("transform(__s, x -> size(x))"))
    rows = rows.withColumn("__h", F.expr(_starts("__p", "i > 0 AND get(__p, i - 1).section_no <=> x.section_no")))
    upto = "transform(array(aggregate(g, 0, (a, b) -> a + b)), n -> IF(n = 0, cast(array() as array<int>), sequence(1, n)))[0]"
    rows = rows.withColumn("__n", F.expr(f"flatten({_runs('__n', '__h', upto)})"))
    result = rows.select(*keys, "__n", F.posexplode_outer(F.flatten("__s")).alias("pos", "s")).filter("s IS NOT NULL")
    result = result.select(*keys, "s.section_no", "s.paragraph_no", F.expr("get(__n, pos)").alias("sentence_no"), "s.toc", "s.raw_text")
    return result.withColumn("text", F.expr(format_wikilinks("raw_text")))
