"""Pages into sections and paragraphs with heading paths, without a shuffle: all of it is expressions over one page row.

Headings are marked by control characters that XML text can't hold, and the text is cut at the marks. Arrays are
exploded with explode_outer and a filter behind it: plain explode makes the optimizer push a test of the array's size
down through the projections, which repeats their expressions many times over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import quoted, strip

_END = r"(?:\r\n?+|\n)"
#: Two line ends or more, with nothing but blanks between and behind them.
BLANK_LINES = rf"{_END}(?:[ \t]*+{_END})+[ \t]*+"

# Roots of heading paths from which on paragraphs are neither expanded nor cut into sentences.
SKIPPED_ROOTS = ("references", "other websites", "related pages", "more reading", "category", "external links", "footnotes", "notes")

SECTION_TYPE = "struct<section_no:int,toc:string,heading:string,raw_text:string,text:string>"


def _section_marks(text: str) -> str:
    """SQL: ``text`` with control characters round the insides of its level-2 headings: lines with exactly two signs at either end.

    A line of two signs alone opens a heading whose inside is the next line, if that ends in exactly two.
    """
    joined = f"regexp_replace({text}, {quoted(r'(?<![^\n])==\n(?=[^\n]*[^=\n]==[ \t\x0B\f\r]*(?:\n|\z))')}, {quoted('==' + chr(4))})"
    joined = f"IF(startswith({text}, '==\n') OR contains({text}, '\n==\n'), {joined}, {text})"
    bare = rf"regexp_replace(l, {quoted(r'\s+$')}, '')"
    test = "h LIKE '==_%==' AND substr(h, 3, 1) <> '=' AND substr(h, -3, 1) <> '='"
    line = f"transform(array({bare}), h -> IF({test}, concat('\\u0001', substr(h, 3, length(h) - 4), '\\u0002'), l))[0]"
    return f"replace(array_join(transform(split({joined}, '\n', -1), l -> IF(startswith(l, '=='), {line}, l)), '\n'), '\\u0004', '\n')"


def _sub_marks(text: str) -> str:
    """SQL: ``text`` with its deeper headings as control character, signs, control character, title, control character.

    A deeper heading is a line that begins with three signs or more and ends with as many, blanks behind it aside.
    """
    signs = f"length(regexp_extract(h, {quoted('^=+')}, 0))"
    inside = "substr(h, n + 1, length(h) - 2 * n)"
    made = f"transform(array({signs}), n -> IF(length(h) > 2 * n AND endswith(h, repeat('=', n)), concat('\\u0001', repeat('=', n), '\\u0003', {inside}, '\\u0002'), l))[0]"
    line = f"transform(array(rtrim(' \\t', l)), h -> {made})[0]"
    return f"array_join(transform(split({text}, '\n', -1), l -> IF(startswith(l, '==='), {line}, l)), '\n')"


def with_sections(pages: DataFrame, content: str = "content") -> DataFrame:
    """``pages`` and ``sections``: array of struct(section_no, toc, heading, raw_text, text).

    Text before the first heading is the section Summary, left out if blank; a text without headings is one Summary.
    Null and empty text have no section. Numbers run from 1 in order of appearance.
    """
    marked = _section_marks(f"`{content}`")
    empty = "cast(NULL as string)"
    head = f"struct('Summary' AS toc, {empty} AS heading, {strip('parts[0]')} AS text)"
    halves = "transform(slice(parts, 2, size(parts)), p -> split(p, '\\u0002', 2))"
    rest = f"transform({halves}, q -> struct({strip('q[0]')} AS toc, concat('==', q[0], '==') AS heading, {strip('q[1]')} AS text))"
    found = f"CASE WHEN size(parts) = 1 THEN array({head}) ELSE concat(filter(array({head}), s -> s.text <> ''), {rest}) END"
    numbered = "transform(found, (s, i) -> struct(i + 1 AS section_no, s.toc AS toc, s.heading AS heading, s.text AS raw_text, s.text AS text))"
    result = pages.withColumn("parts", F.expr(f"split({marked}, '\\u0001', -1)")).withColumn("found", F.expr(found)).withColumn("sections", F.expr(numbered))
    none = F.expr(f"cast(array() as array<{SECTION_TYPE}>)")
    return result.withColumn("sections", F.when((F.col(content) == "") | F.col(content).isNull(), none).otherwise(F.col("sections"))).drop("parts", "found")


def with_paragraphs(pages: DataFrame) -> DataFrame:
    """``pages`` (with sections) and ``paragraphs``: array of struct(section_no, paragraph_no, toc, text, skipped_part).

    Blocks between blank lines are cut at deeper headings. A heading of level n keeps n - 2 parts of the path that was,
    however deep that is; the path goes on over the blocks of a section. Empty text falls back to the raw text.
    skipped_part: a path whose root is among SKIPPED_ROOTS skips this and all later paragraphs of the page.
    """
    body = "coalesce(nullif(s.text, ''), s.raw_text, '')"
    # blocks once more as one text, a blank line between two, cut at the headings
    # the pattern is only for texts whose line ends aren't all bare
    bare = f"transform(array({body}), b -> IF(contains(b, '\r') OR contains(b, '\n ') OR contains(b, '\n\t'), regexp_replace(b, {quoted(BLANK_LINES)}, '\n\n'), b))[0]"
    blocks = f"array_join(filter(transform(split({bare}, '\n\n', -1), b -> {strip('b')}), b -> b <> ''), '\\n\\n')"
    cut = f"split({_sub_marks('u')}, '\\u0001', -1)"
    base = "IF(coalesce(s.toc, '') = '', 0, 2)"
    level, title = "length(split(p, '\\u0003', 2)[0])", strip("split(split(p, chr(3), 2)[1], chr(2), 2)[0]")
    # the paths of all headings as one growing string: arrays would be copied for each
    step = f"transform(array(concat(slice(st.path, 1, greatest(0, {level} - {base})), array({title}))), q -> struct(q AS path, concat(st.out, '\\u0005', array_join(q, ':')) AS out))[0]"
    start = "struct(IF(coalesce(s.toc, '') = '', cast(array() as array<string>), array(s.toc)) AS path, coalesce(s.toc, '') AS out)"
    paths = f"split(aggregate(slice(w, 2, size(w)), {start}, (st, p) -> {step}, st -> st.out), '\\u0005', -1)"
    texts = f"filter(transform(split(IF(k = 0, p, split(p, chr(2), 2)[1]), '\n\n', -1), b -> {strip('b')}), b -> b <> '')"
    rows = f"transform(array({paths}), t -> flatten(transform(w, (p, k) -> transform({texts}, b -> struct(nullif(t[k], '') AS toc, b AS text)))))[0]"
    rows = f"transform(transform(array({blocks}), u -> {cut}), w -> {rows})[0]"
    one = f"transform({rows}, (x, i) -> struct(s.section_no AS section_no, i + 1 AS paragraph_no, x.toc AS toc, x.text AS text))"
    root = f"{strip('substring_index(coalesce(x.toc, ' + chr(39) * 2 + '), ' + chr(39) + ':' + chr(39) + ', 1)')}"
    lengths = ", ".join(sorted({str(len(r)) for r in SKIPPED_ROOTS}))  # lower-casing into ASCII keeps the length
    hit = f"transform(array({root}), q -> length(q) IN ({lengths}) AND lower(q) IN ({', '.join(map(quoted, SKIPPED_ROOTS))}))[0]"
    all_rows = pages.withColumn("__all", F.expr(f"flatten(transform(sections, s -> {one}))"))
    all_rows = all_rows.withColumn("__first", F.expr(f"array_position(transform(__all, x -> {hit}), true)"))
    made = "transform(__all, (x, i) -> struct(x.section_no AS section_no, x.paragraph_no AS paragraph_no, x.toc AS toc, x.text AS text, (__first > 0 AND i + 1 >= __first) AS skipped_part))"
    return all_rows.withColumn("paragraphs", F.expr(made)).drop("__all", "__first")


def with_text_process(pages: DataFrame) -> DataFrame:
    """``pages`` (with sections) and ``text_process``: sections with their headings put back, joined by blank lines."""
    part = "CASE WHEN coalesce(s.heading, '') = '' THEN s.text WHEN s.text = '' THEN s.heading ELSE concat(s.heading, '\\n\\n', s.text) END"
    return pages.withColumn("text_process", F.expr(f"array_join(transform(sections, s -> {part}), '\\n\\n')"))


def section_rows(pages: DataFrame) -> DataFrame:
    """The relation of sections: a row each, keyed by revision and number."""
    return pages.select("revision_id", "page_id", "page_title", F.explode_outer("sections").alias("s")).filter("s IS NOT NULL").select(
        "revision_id", "page_id", "page_title", "s.section_no", "s.toc", "s.raw_text", "s.text"
    )


def paragraph_rows(pages: DataFrame) -> DataFrame:
    """The relation of paragraphs."""
    return pages.select("revision_id", "page_id", "page_title", F.explode_outer("paragraphs").alias("p")).filter("p IS NOT NULL").select(
        "revision_id", "page_id", "page_title", "p.section_no", "p.paragraph_no", "p.toc", "p.text", "p.skipped_part"
    )


def decomposed(pages: DataFrame, between: Callable[[DataFrame], DataFrame] = lambda pages: pages) -> DataFrame:
    """Wikitext pages (model null or wikitext) with sections, paragraphs and text_process; other models have none, and their content as text_process.

    between: a step over the pages with sections, before they are cut into paragraphs.
    """
    plain = F.col("model").isNull() | (F.col("model") == "wikitext")
    some = pages.withColumn("__raw", F.when(plain, F.col("content")))
    some = with_text_process(with_paragraphs(between(with_sections(some, "__raw"))))
    return some.withColumn("text_process", F.when(plain, F.col("text_process")).otherwise(F.coalesce("content", F.lit("")))).drop("__raw")
