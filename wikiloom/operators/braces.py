"""Scans of balanced braces: parameters of template bodies are bound, branches that may not be taken are held back, and bars inside of elements are covered."""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.batches import by_row

_MARK = re.compile(r"\{{2,}|\}{2,}|\[\[|\]\]|\|")
_NAMED = re.compile(r"(?s)^\s*([^=<>\[\]]+?)\s*=(.*)$")


def arguments(args: list[str]) -> dict[str, str]:
    """Name or position -> value; of several the last. Named values are stripped."""
    found, position = {}, 0
    for arg in args:
        named = _NAMED.match(arg)
        if named:
            found[named[1]] = named[2].strip()
        else:
            position += 1
            found[str(position)] = arg
    return found


class _Frame:
    """What stands behind an opening mark: pieces of text, and which of them are bars of its own."""

    def __init__(self, opened: str):
        self.opened, self.pieces, self.bars = opened, [], []


def bind(body: str, values: dict[str, str]) -> str:
    """``body`` with each {{{name|default}}} as its value, else its default, else as it stands.

    A run of closing braces ends the innermost open runs, three braces as a parameter before two as a call; what an opening run has left stays open.
    Values are put in as they are; names and defaults are bound themselves. A default ends at a second bar.
    """
    stack = [_Frame("")]

    def add(text: str) -> None:
        if text:
            stack[-1].pieces.append(text)

    def give_up() -> None:
        """The innermost mark has no end: it is text, and so is what stands behind it."""
        frame = stack.pop()
        stack[-1].pieces.append(frame.opened)
        stack[-1].bars.extend(len(stack[-1].pieces) + b for b in frame.bars)
        stack[-1].pieces.extend(frame.pieces)

    def close(width: int) -> None:
        frame = stack[-1]
        if width == 3:
            bars = [*frame.bars, len(frame.pieces), len(frame.pieces)]
            name = "".join(frame.pieces[: bars[0]])
            default = "".join(frame.pieces[bars[0] + 1 : bars[1]]) if frame.bars else None
            held = values.get(name.strip(), default)
            made = "{{{" + "".join(frame.pieces) + "}}}" if held is None else held
        else:
            made = "{{" + "".join(frame.pieces) + "}}"
        left = frame.opened[width:]
        stack.pop()
        if len(left) >= 2:
            stack.append(_Frame(left))
        else:
            add(left)
        add(made)

    at = 0
    for mark in _MARK.finditer(body):
        add(body[at : mark.start()])
        at, text = mark.end(), mark[0]
        if text[0] == "{" or text == "[[":
            stack.append(_Frame(text))
        elif text == "|":
            stack[-1].bars.append(len(stack[-1].pieces))
            add(text)
        elif text == "]]":
            if stack[-1].opened == "[[":
                add("[[" + "".join(stack.pop().pieces) + "]]")
            else:
                add(text)
        else:
            left = len(text)
            while left >= 2:
                while len(stack) > 1 and stack[-1].opened == "[[":
                    give_up()
                if len(stack) == 1:
                    break
                width = 3 if min(left, len(stack[-1].opened)) >= 3 else 2
                close(width)
                left -= width
            add("}" * left)
    add(body[at:])
    while len(stack) > 1:
        give_up()
    return "".join(stack[0].pieces)


def _bound(body: str | None, args: list[str]) -> str | None:
    return bind(body, arguments(args)) if body is not None and "{{{" in body else body


def bound(body: Column, args: Column) -> Column:
    """``body`` with its parameters bound to an array of arguments; null stays null. Takes time in the length of the body and of what is put in."""
    return by_row(_bound, pa.string(), "string")(body, F.coalesce(args, F.array().cast("array<string>")))


#: Functions by how many arguments behind the first are evaluated at once; the others only where they are taken.
LAZY = {"#if": 0, "#ifeq": 1, "#iferror": 0, "#ifexpr": 0, "#ifexist": 0, "#switch": 0}
#: Where the history of a call begins and ends, and what stands for a bar inside of an element.
_FROM, _TO, COVERED = "\x11", "\x12", "\x06"
#: What stands for the marks of a branch that is held back, and the way back.
_HOLD = str.maketrans("{}|=", "\x15\x16\x17\x18")
RELEASED = {chr(held): chr(mark) for mark, held in _HOLD.items()} | {COVERED: "|"}
_RELEASE = str.maketrans(RELEASED)
_ELEMENT = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9-]*)(?:\s[^<>]*)?>")
_OPENING = re.compile(r"[\[\]{}]")


def calls(text: str) -> list[tuple[int, int, list[int]]]:
    """(begin, end, bars of its own) of what stands between two braces, innermost first. Bars within links aren't a call's own."""
    stack, found = [], []  # [mark, where, width left, bars]
    for mark in _MARK.finditer(text):
        kind = mark[0]
        if kind[0] == "{" or kind == "[[":
            stack.append([kind[0], mark.start(), len(kind), []])
        elif kind == "|":
            if stack:
                stack[-1][3].append(mark.start())
        elif kind == "]]":
            if stack and stack[-1][0] == "[":
                stack.pop()
        else:
            at, left = mark.start(), len(kind)
            while left >= 2:
                while stack and stack[-1][0] == "[":  # a link without end is text
                    bars = stack.pop()[3]
                    if stack:
                        stack[-1][3].extend(bars)
                if not stack:
                    break
                top = stack[-1]
                width = 3 if min(left, top[2]) >= 3 else 2
                if width == 2:
                    found.append((top[1] + top[2], at, top[3]))
                top[2:] = top[2] - width, []
                at, left = at + width, left - width
                if top[2] < 2:
                    stack.pop()
    return found


def covered(text: str) -> str:
    """``text`` with the bars inside of paired elements covered: those of the tags too. Elements that hold brackets or braces are left as they are."""
    if "|" not in text or "</" not in text:
        return text
    marks = [m.start() for m in _OPENING.finditer(text)]
    opened, spans = {}, []
    for tag in _ELEMENT.finditer(text):
        name = tag[2].lower()
        if not tag[1]:
            if not tag[0].endswith("/>"):
                opened.setdefault(name, []).append((tag.start(), tag.end()))
        elif opened.get(name):
            begin, inside = opened[name].pop()
            if bisect_left(marks, inside) == bisect_left(marks, tag.start()):
                spans.append((begin, tag.end()))
    return _changed(text, spans, {ord("|"): COVERED})


def _changed(text: str, spans: list[tuple[int, int]], table: dict[int, str]) -> str:
    """``text`` with the characters inside of ``spans``, which may hold each other, exchanged."""
    pieces, at = [], 0
    for begin, end in sorted(spans):
        begin = max(begin, at)
        if end > begin:
            pieces += text[at:begin], text[begin:end].translate(table)
            at = end
    return "".join(pieces) + text[at:]


def settled(text: str, lazy: dict[str, int]) -> str:
    """``text`` for the next round: what was held back comes free, then branches with calls of the ``lazy`` functions that still stand there are held back, and bars covered.

    The key of a case of #switch is evaluated, its value and the default are held back.
    """
    text = covered(text.translate(_RELEASE))
    spans = []
    for begin, end, bars in calls(text):
        if text[begin : begin + 1] == _FROM:
            begin = text.find(_TO, begin, end) + 1
        cuts = [*bars, end]
        colon = text.find(":", begin, cuts[0])
        if colon < 0:
            continue
        name = text[begin:colon].strip()
        name = name if name in lazy else name.lower()
        if name not in lazy:
            continue
        for a, b in zip(cuts[lazy[name] :], cuts[lazy[name] + 1 :]):
            first = text.find("{{", a, b)
            if first < 0:
                continue
            equals = text.find("=", a, first) if name == "#switch" else a
            if equals >= 0:
                spans.append((equals + 1, b))
            elif b == end:
                spans.append((a + 1, b))
    return _changed(text, spans, _HOLD)


def settling(lazy: dict[str, int], call: str):
    """A function of a text column: ``settled``, or without branches held back where nothing else than what they hold could be called."""
    innermost = re.compile(call)

    def one(text: str | None) -> str | None:
        if text is None or "{{" not in text and not any(c in text for c in RELEASED):
            return text
        made = settled(text, lazy)
        return made if innermost.search(made) else covered(text.translate(_RELEASE))

    return by_row(one, pa.string(), "string")
