"""Links, references and lists of paragraph text, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.texts import quoted, replace_all

ARROW = "↓"
MARK = "♣  ♣  ♣"
REF_PLACEHOLDER = rf"(?i){MARK}  ref-[^♣\r\n]+?{MARK}"


def format_wikilinks(text: str) -> str:
    """SQL: [[T]] becomes [[T↓T]] and [[T|D]] becomes [[D↓T]]; an empty part or two bars leave a link as it is."""
    trimmed = r"((?:[^\[\]|\s](?:[^\[\]|]*[^\[\]|\s])?))"
    both = replace_all(text, rf"(?U)\[\[\s*{trimmed}\s*\|\s*{trimmed}\s*\]\]", f"\x04$2{ARROW}$1\x05")
    each = replace_all(both, rf"(?U)\[\[\s*{trimmed}\s*\]\]", f"[[$1{ARROW}$1]]")
    return f"replace(replace(IF(contains({text}, '[['), {each}, {text}), '\\u0004', '[['), '\\u0005', ']]')"


def drop_ref_placeholders(text: str) -> str:
    """SQL: without the placeholders of references."""
    return f"IF(contains({text}, '{MARK}'), {replace_all(text, REF_PLACEHOLDER, '')}, {text})"


def is_list_line(line: str) -> str:
    """SQL: the first character that isn't blank is a list sign."""
    return f"left(ltrim(' \\t', {line}), 1) IN ('*', '#', ';', ':')"


def is_list_only(text: str) -> str:
    """SQL: has lines that are not blank, and all of them are list items."""
    lines = f"filter(split({text}, '\\\\R'), l -> trim(BOTH FROM l) <> '')"
    return f"(size({lines}) > 0 AND forall({lines}, l -> {is_list_line('l')}))"


def page_url(title: Column, base: str = "https://en.wikipedia.org/wiki/") -> Column:
    """The page's address: blanks as underscores, the rest percent-encoded."""
    coded = F.url_encode(F.regexp_replace(title, " ", "_"))
    for code, plain in (("%2F", "/"), ("%3A", ":"), ("\\+", "_")):
        coded = F.regexp_replace(coded, code, plain)
    return F.concat(F.lit(base), coded)


def safe_html(text: str) -> str:
    """SQL: plain text as HTML: markup characters as entities, line ends as breaks."""
    safe = f"coalesce({text}, '')"
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        safe = f"replace({safe}, {quoted(char)}, {quoted(entity)})"
    return f"regexp_replace({safe}, '\\r\\n?|\\n', '<br>')"


def highlighted(text: str) -> str:
    """SQL: ``safe_html`` in which formatted links and component marks stand out."""
    safe = f"replace({safe_html(text)}, '<br>', '\\n')"
    # The classes of the two kinds of marks
    for name, pattern in (("arrow-link-marker", rf"\[\[[^\[\]\n\x01]*{ARROW}[^\[\]\n\x01]*\]\]"), ("template-marker", r"♣\s*♣\s*♣[^♣\n\x01]+-[0-9]+-[0-9]+\s*♣\s*♣\s*♣")):
        safe = replace_all(safe, f"({pattern})", f'\x01span class="{name}"\x02$1\x01/span\x02')
    return f"replace(replace(replace({safe}, '\\u0001', '<'), '\\u0002', '>'), '\\n', '<br>')"
