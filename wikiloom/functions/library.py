"""Text, title, address, language and number functions that wiki modules offer, as Spark SQL over string expressions."""

from __future__ import annotations

from .parserfns import NAMESPACES, let, url_quote, url_quote_plus, wiki_url
from .texts import quoted, strip

# Characters that nowiki text spells as entities.
NOWIKI = {"&": "&amp;", '"': "&#34;", "'": "&#39;", "<": "&lt;", "=": "&#61;", ">": "&gt;", "[": "&#91;", "]": "&#93;", "{": "&#123;", "|": "&#124;", "}": "&#125;"}
#: Starts of lines that would begin a list, a heading or preformatted text.
LINE_STARTS = {"#": "&#35;", "*": "&#42;", ":": "&#58;", ";": "&#59;", " ": "&#32;"}
# Basic entities of text.
ENTITIES = {"<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#039;", " ": "&nbsp;"}


def trim(text: str, characters: str | None = None) -> str:
    """Without the characters (white space) at both ends."""
    if characters is None:
        return strip(text)
    own = "".join(f"\\{c}" if not c.isalnum() else c for c in characters)
    return f"regexp_replace({text}, {quoted(f'^[{own}]+|[{own}]+$')}, '')"


def split(text: str, by: str, plain: bool = False) -> str:
    """Array of the parts between matches; an empty pattern gives the characters."""
    if by == "":
        return f"filter(split({text}, ''), c -> c <> '')"
    return f"split({text}, {quoted(chr(92) + 'Q' + by + chr(92) + 'E' if plain else by)}, -1)"


def truncate(text: str, length: int, ellipsis: str = "...") -> str:
    """The first ``length`` characters (a negative length: the last), and an ellipsis, of a text longer than that in bytes."""
    cut = f"concat(substr({text}, 1, {length}), {quoted(ellipsis)})" if length >= 0 else f"concat({quoted(ellipsis)}, right({text}, {-length}))"
    return f"IF(octet_length({text}) <= {abs(length)}, {text}, {cut})"


def list_to_text(items: str, between: str = ", ", last: str = " and ") -> str:
    """An array as 'a, b and c'."""
    return f"IF(size({items}) < 2, array_join({items}, ''), concat(array_join(slice({items}, 1, size({items}) - 1), {quoted(between)}), {quoted(last)}, element_at({items}, -1)))"


def nowiki(text: str) -> str:
    """Markup characters as entities."""
    for char, entity in NOWIKI.items():
        text = f"replace({text}, {quoted(char)}, {quoted(entity)})"
    for char, entity in LINE_STARTS.items():
        text = f"regexp_replace({text}, {quoted('(?m)^' + chr(92) + char)}, {quoted(entity)})"
    return f"replace({text}, '__', '_&#95;')"


def encode(text: str) -> str:
    text = f"replace({text}, '&', '&amp;')"
    for char, entity in ENTITIES.items():
        text = f"replace({text}, {quoted(char)}, {quoted(entity)})"
    return text


def decode(text: str) -> str:
    for char, entity in ENTITIES.items():
        text = f"replace({text}, {quoted(entity)}, {quoted(char)})"
    return f"replace({text}, '&amp;', '&')"


def anchor(text: str) -> str:
    return f"replace({text}, ' ', '_')"


def local_url(page: str, query: str | None = None) -> str:
    plain = f"concat('/wiki/', {wiki_url(page)})"
    return plain if query is None else f"IF({query} = '', {plain}, concat('/w/index.php?title=', {url_quote_plus(page)}, '&', {query}))"


def full_url(page: str, host: str = "en.wikipedia.org") -> str:
    return f"concat('//{host}', {local_url(page)})"


def canonical_url(page: str, host: str = "en.wikipedia.org") -> str:
    return f"concat('https:', {full_url(page, host)})"


def query_string(pairs: str) -> str:
    """A map as k=v&..., sorted by key."""
    return f"array_join(transform(array_sort(map_entries({pairs})), e -> concat({url_quote_plus('e.key')}, '=', {url_quote_plus('e.value')})), '&')"


def parse_query(query: str) -> str:
    """Array of struct(key, value) of a query string; a bare key has a null value."""
    decoded = lambda x: f"coalesce(try_url_decode({x}), {x})"
    name, value = "substring_index(q, '=', 1)", "substr(q, instr(q, '=') + 1)"
    return f"transform(filter(split({query}, '&'), q -> q <> ''), q -> struct({decoded(name)} AS key, IF(instr(q, '=') > 0, {decoded(value)}, NULL) AS value))"


def url_parts(url: str) -> str:
    """struct(protocol, host, path, query, fragment) of an address; missing parts are null."""
    part = lambda i: f"nullif(regexp_extract({url}, {quoted(r'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?(?:#(.*))?$')}, {i}), '')"
    return "struct(" + ", ".join(f"{part(i)} AS {n}" for i, n in enumerate(("protocol", "host", "path", "query", "fragment"), 1)) + ")"


def title_parts(title: str) -> str:
    """struct(ns, ns_name, text, base, root, sub, valid) of a page title."""
    names = {x.lower(): (i, n) for i, n, al in NAMESPACES for x in (n, *al) if x}
    number = " ".join(f"WHEN {quoted(k)} THEN {i}" for k, (i, _) in names.items())
    name = " ".join(f"WHEN {quoted(k)} THEN {quoted(n)}" for k, (_, n) in names.items())
    clean = strip(f"replace({title}, '_', ' ')")
    prefix = f"lower({strip('substring_index(t, chr(58), 1)')})"
    known = f"instr(t, ':') > 0 AND {prefix} IN ({', '.join(map(quoted, names))})"
    first = "concat(upper(substr(x, 1, 1)), substr(x, 2))"
    bare = f"IF({known}, {strip('substr(t, instr(t, chr(58)) + 1)')}, t)"
    fields = (
        f"struct(IF({known}, CASE {prefix} {number} END, 0) AS ns, IF({known}, CASE {prefix} {name} END, '') AS ns_name, y AS text, regexp_replace(y, '/[^/]*$', '') AS base, "
        f"substring_index(y, '/', 1) AS root, substring_index(y, '/', -1) AS sub, y <> '' AND y NOT RLIKE {quoted('[#<>' + chr(92) + '[' + chr(92) + ']|{}]')} AS valid)"
    )
    return let(clean, "t", let(bare, "x", let(first, "y", fields)))


def is_subpage(title: str, of: str) -> str:
    return f"startswith({title}, concat({of}, '/'))"


def plural(number: str, forms: list[str]) -> str:
    """The form for a number: the first for 1, else the second, or the last there is."""
    return f"IF({number} = 1, {quoted(forms[0])}, {quoted(forms[min(1, len(forms) - 1)])})"


# Units of time, largest first, in seconds.
DURATIONS = [("years", 31_556_952), ("weeks", 604_800), ("days", 86_400), ("hours", 3_600), ("minutes", 60), ("seconds", 1)]


def duration_intervals(seconds: str) -> str:
    """struct of whole units of time that make up a number of seconds."""
    fields, rest = [], seconds
    for name, size in DURATIONS:
        fields.append(f"cast(floor({rest} / {size}) as bigint) AS {name}")
        rest = f"({rest} % {size})"
    return f"struct({', '.join(fields)})"


def partial_url(title: str) -> str:
    return url_quote(f"replace({title}, ' ', '_')", "/:")


def json_encode(value: str) -> str:
    """A struct, map or array as JSON text."""
    return f"to_json({value})"


def json_decode(text: str, path: str = "$", kind: str = "string") -> str:
    """The value at a path of JSON text; null where there is none or the text is no JSON."""
    return f"try_variant_get(try_parse_json({text}), {quoted(path)}, {quoted(kind)})"


def tag(name: str, attributes: str, content: str) -> str:
    """An element: ``attributes`` is a map, whose entries come in order of name; without content (null) it closes itself."""
    value = f"replace(replace(replace(replace(e.value, '&', '&amp;'), {quoted(chr(34))}, '&quot;'), '<', '&lt;'), '>', '&gt;')"
    given = f"array_join(transform(array_sort(map_entries({attributes})), e -> concat(' ', e.key, {quoted('=' + chr(34))}, {value}, {quoted(chr(34))})), '')"
    return f"concat('<', {name}, {given}, IF({content} IS NULL, ' />', concat('>', {content}, '</', {name}, '>')))"


def find_namespace(name: str) -> str:
    """The number of a namespace by name or alias, in any case, blanks or underscores; null if there is none."""
    cases = " ".join(f"WHEN {quoted(x.lower())} THEN {i}" for i, n, al in NAMESPACES for x in (n, *al) if x)
    return f"(CASE lower({strip(f'replace({name}, {quoted(chr(95))}, {quoted(chr(32))})')}) {cases} WHEN '' THEN 0 END)"


def compare_titles(a: str, b: str) -> str:
    """-1, 0 or 1: titles are ordered by namespace, then by text."""
    key = lambda t: f"struct({t}.ns, {t}.text)"
    return let(title_parts(a), "p", let(title_parts(b), "q", f"CASE WHEN {key('p')} < {key('q')} THEN -1 WHEN {key('p')} = {key('q')} THEN 0 ELSE 1 END"))


def format_duration(seconds: str) -> str:
    """The units of time that a number of seconds has, as '1 day, 2 hours and 5 seconds'."""
    unit = lambda n: f"IF(d.{n} = 0, NULL, concat(cast(d.{n} as string), ' ', IF(d.{n} = 1, {quoted(n[:-1])}, {quoted(n)})))"
    units = f"filter(array({', '.join(unit(n) for n, _ in DURATIONS)}), x -> x IS NOT NULL)"
    return let(duration_intervals(seconds), "d", let(units, "u", f"IF(size(u) = 0, '0 seconds', {list_to_text('u')})"))


def filled(message: str, args: str) -> str:
    """A message with $1, $2 ... replaced by the array ``args``; the last ones first, so that $1 leaves $10 alone."""
    return f"aggregate(sequence(size({args}), least(1, size({args})), -1), {message}, (m, i) -> IF(i = 0, m, replace(m, concat('$', cast(i as string)), {args}[i - 1])))"


def gender(what: str, masculine: str, feminine: str, neutral: str | None = None) -> str:
    """The form for 'feminine', 'neutral' or anything else; without a neutral form it is null."""
    return f"CASE {what} WHEN 'feminine' THEN {feminine} WHEN 'neutral' THEN {neutral or 'NULL'} ELSE {masculine} END"


# Arrows by direction, for languages written from left to right.
ARROWS = {"forwards": "→", "backwards": "←", "left": "←", "right": "→", "up": "↑", "down": "↓"}


def arrow(direction: str) -> str:
    """The arrow of a direction; that to the right for any other word."""
    return f"CASE {direction} {' '.join(f'WHEN {quoted(k)} THEN {quoted(v)}' for k, v in ARROWS.items())} ELSE '→' END"
