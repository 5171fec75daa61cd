"""Text expressions with Python's notion of white space and lines, as Spark SQL strings."""

from __future__ import annotations


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: What ``(?U)\s`` matches: Unicode's white space. Trimming by it takes a fraction of the time of a pattern.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: str) -> str:
    """Without white space (Unicode) at both ends."""
    edge = f"contains('{WHITE}', substr(t, 1, 1)) OR contains('{WHITE}', substr(t, -1, 1))"  # most texts have none
    return f"transform(array({text}), t -> IF({edge}, btrim(t, '{WHITE}'), t))[0]"


def rstrip(text: str) -> str:
    """Without white space (Unicode) at the end."""
    return f"rtrim('{WHITE}', {text})"


def replace_all(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(by)})"
