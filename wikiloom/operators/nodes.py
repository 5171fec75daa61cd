"""Markup as a table of nodes, and tree queries as filters and interval joins.

A node is a span of a page's text: (page_id, node_id, parent_id, kind, name, start, stop, depth). Nested markup lies inside its
parent's span, so descendants are an interval test. One small bracket scanner in Arrow batches finds the spans; nothing
else is done outside of Spark's operators.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.batches import by_row
from ..functions.parserfns import FUNCTIONS, UNIMPLEMENTED
from .braces import calls
from .expand import OF_PAGE, OF_TABLES, SUMS, parsed_call

_TOKEN = re.compile(
    r"(?P<hide><!--|<nowiki>)|(?P<open>\{\{\{|\{\{|\[\[|\{\|)|(?P<close>\}\}\}|\}\}|\]\]|\|\})"
    r"|(?P<heading>^(={1,6})[^=\n](?:[^\n]*[^=\n])?\5[ \t]*$)|(?P<item>^[*#:;]+)|(?P<rule>^----+)|(?P<magic>__[A-Z]+__)"
    r"|(?P<tag></?[A-Za-z][A-Za-z0-9]*\b[^<>]*>)|(?P<link>\[(?=(?:https?:)?//))|(?P<url>https?://[^\s\[\]<>\"|{}]+)|(?P<quote>'{2,5})",
    re.M | re.S,
)
_PAIRS = {"{{{": ("TEMPLATE_ARG", "}}}"), "{{": ("TEMPLATE", "}}"), "[[": ("LINK", "]]"), "{|": ("TABLE", "|}")}
_OPENERS = {closer: opener for opener, (_, closer) in _PAIRS.items()}
_NAME = re.compile(r"[^|\n]*")
_QUOTES = {2: "ITALIC", 3: "BOLD"}
_EMPTY = {"br", "hr", "img", "ref/"}


class _Open:
    """What is open, innermost last. Closing takes what was opened inside along, so all of it costs one step for each opener."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.count: dict[str, int] = {}
        self.brackets: list[str] = []

    def add(self, what: str, at: int) -> None:
        self.stack.append((what, at))
        self.count[what] = self.count.get(what, 0) + 1
        if what in _PAIRS:
            self.brackets.append(what)

    def close(self, what: str) -> int:
        """Where the innermost ``what`` was opened; -1 if none is open."""
        if not self.count.get(what):
            return -1
        while True:
            top, at = self.stack.pop()
            self.count[top] -= 1
            if top in _PAIRS:
                self.brackets.pop()
            if top == what:
                return at


def spans(text: str | None) -> list[tuple[str, str, int, int]]:
    """(kind, name, start, stop) of all closed markup; brackets and tags without a partner are text."""
    text = text or ""
    found, held, at = [], _Open(), 0
    none_behind: set[str] = set()  # ends that don't come any more
    square = line = -1  # the next closing bracket and line end
    while m := _TOKEN.search(text, at):
        kind, start, stop, what = m.lastgroup, m.start(), m.end(), m[0]
        if what == "}}}" and held.brackets[-1:] != ["{{{"]:
            what, stop = "}}", stop - 1  # the third bracket belongs to what comes next
        at = stop
        if kind == "hide":
            closer = "-->" if what == "<!--" else "</nowiki>"
            end = -1 if closer in none_behind else text.find(closer, stop)
            if end >= 0:
                at = end + len(closer)
            else:
                none_behind.add(closer)
                if what == "<nowiki>":
                    held.add("<nowiki", start)
        elif m["heading"]:
            found.append((f"LEVEL{len(m[5])}", what.strip("= \t"), start, stop))
        elif kind == "open":
            held.add(what, start)
        elif kind == "close":
            opener = _OPENERS[what]
            begin = held.close(opener)
            if begin >= 0:
                found.append((_PAIRS[opener][0], _NAME.match(text, begin + len(opener), start)[0].strip(), begin, stop))
        elif kind == "tag":
            name = re.match(r"</?(\w+)", what)[1].lower()
            if what.endswith("/>") or name in _EMPTY:
                found.append(("HTML", name, start, stop))
            elif what.startswith("</"):
                begin = held.close(f"<{name}")
                if begin >= 0:
                    found.append(("HTML", name, begin, stop))
            else:
                held.add(f"<{name}", start)
        elif kind == "quote":
            if len(what) in _QUOTES:
                begin = held.close(what)
                if begin >= 0:
                    found.append((_QUOTES[len(what)], "", begin, stop))
                else:
                    held.add(what, start)
        elif kind == "link":
            if -1 < square < stop or square == -1:
                square = text.find("]", stop)
                square = len(text) if square < 0 else square
            if -1 < line < stop or line == -1:
                line = text.find("\n", stop)
                line = len(text) if line < 0 else line
            if square < line:
                found.append(("URL", text[start:square].strip("_[]").split(None, 1)[0], start, square + 1))
                at = square + 1
        elif kind == "item":
            end = text.find("\n", stop)
            found.append(("LIST_ITEM", what, start, len(text) if end < 0 else end))
        else:
            found.append(({"rule": "HLINE", "magic": "MAGIC_WORD", "url": "URL"}[kind], "" if kind == "rule" else what.strip("_"), start, stop))
    return sorted(found, key=lambda n: (n[2], -n[3]))


def numbered(found: list[tuple[str, str, int, int]]) -> list[tuple[int, int, str, str, int, int, int]]:
    """Nodes in order with their parents: the innermost span round each; 0 is the page itself."""
    rows, open_nodes = [], []
    for i, (kind, name, start, stop) in enumerate(found, 1):
        while open_nodes and open_nodes[-1][1] < stop:
            open_nodes.pop()
        rows.append((i, open_nodes[-1][0] if open_nodes else 0, kind, name, start, stop, len(open_nodes) + 1))
        open_nodes.append((i, stop))
    return rows


def node_rows(pages: DataFrame, text_col: str = "content") -> DataFrame:
    """(page_id, node_id, parent_id, kind, name, start, stop, depth, text) of all markup of ``pages``. Null text has none."""
    kind = "array<struct<node_id:int,parent_id:int,kind:string,name:string,start:int,stop:int,depth:int>>"
    fields = [(n, pa.string() if n in ("kind", "name") else pa.int32()) for n in ("node_id", "parent_id", "kind", "name", "start", "stop", "depth")]
    found = by_row(lambda text: numbered(spans(text)), pa.list_(pa.struct(fields)), kind)
    made = pages.select("page_id", F.col(text_col).alias("__t")).withColumn("__n", found("__t"))
    rows = made.select("page_id", "__t", F.explode_outer("__n").alias("n")).filter("n IS NOT NULL")
    return rows.select("page_id", "n.*", F.expr("substr(__t, n.start + 1, n.stop - n.start)").alias("text"))


def children(nodes: DataFrame, kinds: Iterable[str], invert: bool = False) -> DataFrame:
    """Nodes of (not of) these kinds that lie directly in the page."""
    test = F.col("kind").isin(*kinds)
    return nodes.filter((F.col("parent_id") == 0) & (~test if invert else test))


def inside(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(outer_id and the node): nodes anywhere within the nodes ``outer`` of the same page."""
    o = outer.select("page_id", F.col("node_id").alias("outer_id"), F.col("start").alias("__a"), F.col("stop").alias("__b"))
    return nodes.join(o, "page_id").filter("start >= __a AND stop <= __b AND node_id <> outer_id").drop("__a", "__b")


def containing(nodes: DataFrame, kinds: Iterable[str]) -> DataFrame:
    """Nodes with at least one node of these kinds anywhere within."""
    held = inside(nodes.filter(F.col("kind").isin(*kinds)), nodes).select("page_id", F.col("outer_id").alias("node_id")).distinct()
    return nodes.join(held, ["page_id", "node_id"], "left_semi")


def html(nodes: DataFrame, tag: str, attributes: dict[str, str] | None = None) -> DataFrame:
    """HTML nodes of a tag whose attributes contain the given texts."""
    found = nodes.filter((F.col("kind") == "HTML") & (F.col("name") == tag))
    for name, part in (attributes or {}).items():
        value = F.regexp_extract("text", rf"(?is)^<[^>]*\b{re.escape(name)}\s*=\s*[\"']?([^\"'>]*)", 1)
        found = found.filter(F.contains(value, F.lit(part)))
    return found


def template_calls(nodes: DataFrame) -> DataFrame:
    """(page_id, node_id, name, args) of the templates among ``nodes``: arguments as written, in order."""
    return nodes.filter("kind = 'TEMPLATE'").withColumn("c", F.expr(parsed_call("text"))).select("page_id", "node_id", "c.name", "c.args")


_HIDDEN = re.compile(r"(?s)<!--.*?-->|<nowiki\s*>.*?</nowiki\s*>")
_INNER = re.compile(r"\{\{|\[\[|\[(?=(?:https?:)?//)")


def parameters(call: str) -> list[tuple[str, str]]:
    """(name, value) of what the template ``call`` is given, in order of first appearance; others than named ones by their number from 1.

    An equals sign before any inner call or link makes a name. Named values are stripped, and left out where blank; those of a number keep what stands behind an
    inner call or link. Several values of one name are joined. Bars inside of calls, links, nowiki elements and comments cut nothing, and comments go.
    """
    call = _HIDDEN.sub(lambda m: "" if m[0].startswith("<!--") else m[0].translate(_COVER), call)
    end = len(call) - 2
    cuts = next(([*bars, end] for begin, stop, bars in calls(call) if begin == 2 and stop == end), [end])
    found: dict[str, list[str]] = {}
    position = 0
    for a, b in zip(cuts, cuts[1:]):
        arg = call[a + 1 : b]
        inner = _INNER.search(arg)
        name, sign, value = arg[: inner.start() if inner else len(arg)].partition("=")
        if not sign:
            position += 1
            found.setdefault(str(position), []).append(arg)
            continue
        name, value = name.strip(), arg[arg.index("=") + 1 :]
        numbered = name.isdecimal() and int(name) > 0
        value = value.lstrip() if numbered and inner else value.strip()
        if value:
            found.setdefault(str(int(name)) if numbered else name, []).append(value)
    return [(name.translate(_UNCOVER), "".join(values).translate(_UNCOVER)) for name, values in found.items()]


#: Marks that cut nothing inside of nowiki elements, and the way back.
_COVER = str.maketrans("{}[]|=", "\x01\x02\x03\x04\x05\x06")
_UNCOVER = {held: chr(mark) for mark, held in _COVER.items()}


def template_parameters(nodes: DataFrame) -> DataFrame:
    """(page_id, node_id, name, parameter, value) of the templates among ``nodes``: a row for each parameter, one of nulls for a template without any.

    The namespace before a name goes. Calls of parser functions aren't templates.
    """
    functions = [*FUNCTIONS, *UNIMPLEMENTED, *OF_PAGE, *OF_TABLES, *SUMS]
    pair = pa.struct([("parameter", pa.string()), ("value", pa.string())])
    made = by_row(lambda text: [{"parameter": k, "value": v} for k, v in parameters(text)], pa.list_(pair), "array<struct<parameter:string,value:string>>")
    found = nodes.filter("kind = 'TEMPLATE'").withColumn("c", F.expr(parsed_call("text")))
    found = found.filter(~(F.col("c.name").isin(*functions) & F.substring_index("text", "|", 1).contains(":")))
    name = F.regexp_replace("c.name", "(?is)^(?:template|t):", "")
    return found.select("page_id", "node_id", name.alias("name"), F.explode_outer(made("text")).alias("p")).select("page_id", "node_id", "name", "p.*")


def named_arguments(args: str) -> str:
    """SQL: an array of arguments as a map: names stripped, others by their number from 1; of equal names the last counts."""
    named = "x RLIKE '(?s)^[^=<>\\\\[\\\\]{}]+='"
    key = f"IF({named}, trim(substring_index(x, '=', 1)), cast(size(filter(slice({args}, 1, i + 1), y -> NOT ({named.replace('x RLIKE', 'y RLIKE')}))) as string))"
    pairs = f"transform({args}, (x, i) -> struct({key} AS k, IF({named}, trim(substr(x, instr(x, '=') + 1)), x) AS v))"
    return f"transform(array({pairs}), p -> map_from_entries(filter(p, (e, i) -> NOT exists(slice(p, i + 2, size(p)), f -> f.k = e.k))))[0]"


def content_of_levels(nodes: DataFrame, pages: DataFrame, text_col: str = "content") -> DataFrame:
    """(page_id, node_id, name, body): headings and the text behind each up to the next heading of its level or a higher one."""
    levels = nodes.filter("kind LIKE 'LEVEL%'").select("page_id", "node_id", "name", "stop", "start", F.expr("cast(substr(kind, 6) as int)").alias("level"))
    later = Window.partitionBy("page_id").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    after = F.collect_list(F.struct("level", "start")).over(later)
    ends = levels.withColumn("__end", F.get(F.filter(after, lambda o: o["level"] <= F.col("level")), F.lit(0))["start"])
    both = ends.join(pages.select("page_id", F.col(text_col).alias("__t")), "page_id")
    return both.select("page_id", "node_id", "name", F.expr("trim(BOTH '\n ' FROM substr(__t, stop + 1, coalesce(__end, length(__t)) - stop))").alias("body"))


def outline(nodes: DataFrame) -> DataFrame:
    """(page_id, tree): a page's nodes as indented lines."""
    line = F.concat(F.repeat(F.lit("  "), F.col("depth") - 1), "kind", F.when(F.col("name") != "", F.concat(F.lit(" "), "name")).otherwise(F.lit("")))
    held = F.array_sort(F.collect_list(F.struct("node_id", line.alias("line"))))
    return nodes.groupBy("page_id").agg(held.alias("n")).select("page_id", F.array_join(F.col("n.line"), "\n").alias("tree"))


def texts(pages: DataFrame, nodes: DataFrame, text_col: str = "content") -> DataFrame:
    """(page_id, start, text): what lies between the nodes directly in a page, without blank pieces."""
    tops = nodes.filter("parent_id = 0").groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("n"))
    both = pages.select("page_id", F.col(text_col).alias("__t")).join(tops, "page_id", "left").withColumn("n", F.coalesce("n", F.expr("cast(array() as array<struct<start:int,stop:int>>)")))
    begins = "concat(array(0), transform(n, x -> x.stop))"
    ends = "concat(transform(n, x -> x.start), array(length(__t)))"
    pieces = f"filter(zip_with({begins}, {ends}, (a, b) -> struct(a AS start, substr(__t, a + 1, b - a) AS text)), p -> trim(BOTH ' \\n\\t' FROM p.text) <> '')"
    return both.filter("__t IS NOT NULL").select("page_id", F.inline(F.expr(pieces)))


def template_counts(nodes: DataFrame) -> DataFrame:
    """(page_id, templates): how many templates a page's markup holds, nested ones too; pages without any node are not among them."""
    return nodes.groupBy("page_id").agg(F.count(F.when(F.col("kind") == "TEMPLATE", 1)).alias("templates"))
