"""Typed components of section texts, replaced by placeholders.

A small scanner in Arrow batches finds the outermost markup of a text (templates, tables, references, links, bare
addresses) in one pass, numbers what of it is a component over a page's sections, and puts the placeholders in. Restoring
and the component relations are expressions and one explode.

Rules: paired start/end templates are one block with what lies between; a template is independent if its line or
paragraph holds templates only; infoboxes and tables always count; within lists nothing else counts; links to pages are
recorded but stay in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.batches import by_row
from ..functions.texts import quoted

TYPES = ("infobox", "table", "independent_template", "wikilinks", "external_links", "file", "image", "ref")
MARK = "♣  ♣  ♣"

_OPEN = re.compile(r"\{\{|\[\[|\{\||<ref\b[^>]*>|<table\b[^>]*>|\[(?=(?:https?:)?//)|(?<![\w\[])https?://[^\s\[\]<>\"|{}]+|<nowiki>", re.I)
#: opening brackets: kind, and the pattern of both brackets
_PAIRS = {"{{": ("template", r"\{\{|\}\}"), "[[": ("link", r"\[\[|\]\]"), "{|": ("table", r"\{\||\|\}")}
_LIST = re.compile(r"[ \t]*[*#;:]")
_STARTS, _ENDS = ("start", "top", "begin"), ("end", "bottom")


def _closed(text: str, brackets: str) -> dict[int, int]:
    """Where each pair of these brackets that is closed begins and ends (behind it), from one pass."""
    found, open_at = {}, []
    for m in re.finditer(brackets, text):
        if m[0] in _PAIRS:
            open_at.append(m.start())
        elif open_at:
            found[open_at.pop()] = m.end()
    return found


def _ends(text: str, pattern: str) -> Callable[[int], int]:
    """A function from a place to the end of the first match behind it, -1 if there is none."""
    found = [(m.start(), m.end()) for m in re.finditer(pattern, text, re.I)]
    starts = [s for s, _ in found]

    def first(at: int) -> int:
        i = bisect_left(starts, at)
        return found[i][1] if i < len(found) else -1

    return first


def outermost(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the outermost markup, in order: template, table, ref, link, url."""
    found, at = [], 0
    closed = {what: _closed(text, pattern) for what, (_, pattern) in _PAIRS.items()}
    table, ref, nowiki, square, line = (_ends(text, p) for p in ("</table>", r"</ref\s*>", "</nowiki>", r"\]", r"\n"))
    while m := _OPEN.search(text, at):
        what, start = m[0].lower(), m.start()
        kind, end = "", -1
        if what in _PAIRS:
            kind, end = _PAIRS[what][0], closed[what].get(start, -1)
        elif what.startswith("<table"):
            kind, end = "table", table(m.end())
        elif what.startswith("<ref"):
            kind, end = "ref", m.end() if what.endswith("/>") else ref(m.end())
        elif what == "<nowiki>":
            end = nowiki(m.end())
        elif what == "[":
            kind, end = "url", square(m.end())
            if -1 < line(start) < end:
                end = -1
        else:
            kind, end = "url", m.end() - (len(m[0]) - len(m[0].rstrip(".,;:!?")))
        if end < 0:
            at = m.end()
            continue
        if kind:
            found.append((kind, start, end))
        at = end
    return found


def _name(template: str) -> str:
    return template[2:-2].split("|", 1)[0]


def _marker(template: str) -> tuple[str, str]:
    """('open' or 'close', family) of a paired template, else ('', '')."""
    name = re.sub(r"[\s/_-]+", "", _name(template).casefold())
    for kind, ends in (("open", _STARTS), ("close", _ENDS)):
        for end in ends:
            if name.endswith(end):
                return kind, name[: -len(end)]
    return "", ""


def _blocks(text: str, nodes: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Paired templates with all between as one node; a closer of another family is passed over; inner blocks vanish."""
    stack, pairs = [], []
    for kind, start, end in nodes:
        side, family = _marker(text[start:end]) if kind == "template" else ("", "")
        if side == "open":
            stack.append((start, family))
        elif side == "close" and stack and (not family or family == stack[-1][1]):
            pairs.append((stack.pop()[0], end))
    outer: list[tuple[int, int]] = []
    for a, b in sorted(pairs):  # pairs are nested or apart
        if not outer or a >= outer[-1][1]:
            outer.append((a, b))
    inside = _within(outer)
    return sorted([*(n for n in nodes if not inside(n[1])), *(("block", a, b) for a, b in outer)], key=lambda n: n[1])


def _within(spans: list[tuple[int, int]]) -> Callable[[int], bool]:
    """Whether a place lies in one of ``spans``, which are in order and apart."""
    starts = [a for a, _ in spans]

    def test(at: int) -> bool:
        i = bisect_right(starts, at) - 1
        return i >= 0 and at < spans[i][1]

    return test


def _alone(text: str, nodes: list[tuple[str, int, int]]) -> set[int]:
    """Starts of templates whose line, or whose paragraph, has nothing but templates and white space."""
    bare = list(text)
    for kind, start, end in nodes:
        if kind == "template":
            bare[start:end] = ["\0" if c not in "\r\n" else "\1" for c in text[start:end]]
        else:
            bare[start:end] = "x" * (end - start)
    shadow, found = "".join(bare), set()
    stops = {s: e for k, s, e in nodes if k == "template"}
    starts = list(stops)
    for pattern in (r"[^\n]+", r"(?s).+?(?=\r?\n[ \t]*\r?\n|\Z)"):
        for m in re.finditer(pattern, shadow):
            if "\0" in m[0] and not m[0].replace("\0", "").replace("\1", "").strip():
                found.update(s for s in starts[bisect_left(starts, m.start()) : bisect_left(starts, m.end())] if stops[s] <= m.end())
    return found


def scan(text: str | None) -> list[tuple[int, str, int, int, str, str]]:
    """(phase, type, start, end, recorded text, source) of a section's components; positions are in the text without comments."""
    if not text:
        return []
    nodes = _blocks(text, outermost(text))
    alone, taken = _alone(text, nodes), []
    for kind, start, end in nodes:
        source = text[start:end]
        if kind == "block":
            taken.append((1, "independent_template", start, end, source, source))
        elif kind == "template" and _name(source).strip().lower().startswith("infobox"):
            taken.append((1, "infobox", start, end, source, source))
        elif kind == "template" and start in alone and not _marker(source)[0]:
            taken.append((1, "independent_template", start, end, source, source))
        elif kind == "table":
            taken.append((1, "table", start, end, source, source))
    in_taken = _within([(t[2], t[3]) for t in taken])
    in_list = _within([(m.start(), m.end()) for m in re.finditer(r"[^\n]*\n?", text) if m[0] and _LIST.match(m[0])])
    for kind, start, end in nodes:
        if kind not in ("ref", "link", "url") or in_taken(start) or in_list(start):
            continue
        source = text[start:end]
        if kind == "ref":
            taken.append((2, "ref", start, end, source, source))
        elif kind == "url":
            address = source.strip("[]").split(None, 1)[0] if source.startswith("[") else source
            taken.append((2, "external_links", start, end, address, source))
        else:
            title = source[2:-2].split("|", 1)[0].strip()
            head = title.lower().split(":", 1)[0] if ":" in title else ""
            if head in ("image", "file"):
                taken.append((2, head, start, end, source, source))
            else:
                taken.append((2, "wikilinks", start, end, title, source))
    return taken


_MADE = "struct<texts:array<string>,components:array<struct<type:string,component_id:string,text:string,source:string>>>"


def page_components(texts: list[str], page_id: int) -> dict:
    """Section texts without comments and with placeholders, and the page's components in order of section, phase and place."""
    numbers: dict[str, int] = {}
    out, components = [], []
    for text in texts:
        placed = []
        for phase, kind, start, end, shown, source in sorted(scan(text), key=lambda x: (x[0], x[2])):
            numbers[kind] = numbers.get(kind, 0) + 1
            name = f"{kind}-{page_id}-{numbers[kind]:04d}"
            components.append({"type": kind, "component_id": name, "text": shown, "source": source})
            if kind != "wikilinks":
                placed.append((start, end, name))
        pieces, at = [], 0
        for start, end, name in sorted(placed):
            pieces += [text[at:start], f"{MARK}  {name}{MARK}"]
            at = end
        out.append("".join([*pieces, text[at:]]) if text is not None else None)
    return {"texts": out, "components": components}


def with_components(pages: DataFrame) -> DataFrame:
    """``pages`` (with sections): section texts get placeholders, and ``components``: array of struct(type, component_id, text, source).

    Ids are type-page-NNNN, numbered by type over the page: section by section, templates and tables before the rest.
    """

    def one(texts: list[str] | None, page_id: int) -> dict:
        return page_components(texts, page_id) if texts is not None else {"texts": None, "components": None}

    component = pa.struct([(n, pa.string()) for n in ("type", "component_id", "text", "source")])
    made = pa.struct([("texts", pa.list_(pa.string())), ("components", pa.list_(component))])

    bare = f"transform(sections, s -> {without_comments('s.text')})"
    seen = pages.withColumn("__made", by_row(one, made, _MADE)(F.expr(bare), F.col("page_id")))
    sections = "transform(sections, (s, n) -> struct(s.section_no AS section_no, s.toc AS toc, s.heading AS heading, s.raw_text AS raw_text, __made.texts[n] AS text))"
    return seen.withColumn("sections", F.expr(sections)).withColumn("components", F.col("__made.components")).drop("__made")


def without_comments(text: str) -> str:
    """SQL: ``text`` without closed comments: each part behind an opener from its closer on."""
    rest = "IF(instr(p, '-->') > 0, substr(p, instr(p, '-->') + 3), concat('<!--', p))"
    return f"IF(instr({text}, '<!--') > 0, array_join(transform(split({text}, '<!--', -1), (p, i) -> IF(i = 0, p, {rest})), ''), {text})"


def restored(text: str, components: str = "components") -> str:
    """SQL: ``text`` with its placeholders replaced by the sources of ``components``, once; unknown ones stay."""
    pattern = quoted(rf"{MARK}  ([^♣]+){MARK}")
    ids = f"regexp_extract_all({text}, {pattern}, 1)"
    sources = f"map_from_entries(transform(coalesce({components}, array()), c -> struct(c.component_id, c.source)))"
    source = f"coalesce(known[i], concat('{MARK}  ', i, '{MARK}'))"
    whole = f"array_join(zip_with(split({text}, {pattern}, -1), {ids}, (a, i) -> concat(a, IF(i IS NULL, '', {source}))), '')"
    return f"IF(instr({text}, '{MARK}') > 0, transform(array({sources}), known -> {whole})[0], {text})"


def component_rows(pages: DataFrame, kind: str | None = None) -> DataFrame:
    """(page_id, type, component_id, component_text): of one type, or all in one long table."""
    rows = pages.select("page_id", F.explode_outer("components").alias("c")).filter("c IS NOT NULL")
    rows = rows.select("page_id", "c.type", "c.component_id", F.col("c.text").alias("component_text"))
    return rows if kind is None else rows.filter(F.col("type") == kind)


