"""Members of a JSON object and elements of an array as spans of its text, found by regular expressions.

All loops of the expressions are possessive, so a text is read once from left to right and the stack grows
with the nesting alone. A match must begin where the one before it ended; a text that is not strict
JSON, or is nested deeper than ``DEPTH``, leaves a rest that ``whole`` notices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Levels below a member or element that are followed.
DEPTH = 100
_IN_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_PLAIN = r"[^\[\]{}\"']*+"


def _nested(depth: int) -> str:
    """Brackets with whatever they hold; which kind closes is left to the JSON parser."""
    inner = f'"{_IN_STRING}"'
    found = rf"[\[{{]{_PLAIN}(?:{inner}{_PLAIN})*+[\]}}]"
    for _ in range(depth - 1):
        found = rf"[\[{{]{_PLAIN}(?:(?:{inner}|{found}){_PLAIN})*+[\]}}]"
    return found


_VALUE = rf"""(?:"{_IN_STRING}"|[^\s,:\[\]{{}}"']++|{_nested(DEPTH)})"""
_MEMBER = rf'(?s)\G\s*+[{{,]\s*+"{_IN_STRING}"\s*+:\s*+{_VALUE}'
#: As above, but for the sign and the white space before each, and what closes a text as the last of all.
_MEMBERS = rf'(?s)\G(?:\s*+[{{,]\s*+(?=")|(?:\A\s*+\{{|(?!\A))\s*+(?=\}}\s*+\z))("{_IN_STRING}"\s*+:\s*+{_VALUE}|\}})'
_ELEMENTS = rf"(?s)\G(?:\s*+[\[,]\s*+(?=[^\s\]])|(?:\A\s*+\[|(?!\A))\s*+(?=\]\s*+\z))({_VALUE}|\])"
_FLAT = rf'(?s)\A\s*+\{{{_PLAIN}(?:"{_IN_STRING}"{_PLAIN})*+\}}\s*+\z'


def member_spans(text: Column) -> Column:
    """The members of an object, each with the sign and the white space before it."""
    return F.regexp_extract_all(text, F.lit(_MEMBER), F.lit(0))


def members(text: Column) -> Column:
    """The members of an object as they are written, and ``}`` as the last element if they are all there is."""
    return F.regexp_extract_all(text, F.lit(_MEMBERS), F.lit(1))


def all_elements(text: Column) -> Column:
    """The elements of an array as they are written, and ``]`` as the last if they are all there is."""
    return F.regexp_extract_all(text, F.lit(_ELEMENTS), F.lit(1))


def whole(text: Column, spans: Column, opening: str, closing: str) -> Column:
    """Whether nothing is left of ``text`` but what closes it: then ``spans`` are all there is."""
    used = F.aggregate(spans, F.lit(0), lambda n, span: n + F.length(span))
    rest = F.substring(text, used + 1, F.length(text))
    start = F.when(F.size(spans) == 0, F.lit(opening)).otherwise(F.lit(""))
    return F.regexp_replace(rest, r"\s+", "") == F.concat(start, F.lit(closing))


def value_of(span: Column) -> Column:
    """The text of a member's value."""
    return F.regexp_replace(span, rf'(?s)\A\s*+[{{,]\s*+"{_IN_STRING}"\s*+:\s*+', "")


def is_flat_object(text: Column) -> Column:
    """Whether a text has the outline of one object without others or arrays in it, and nothing after it."""
    return F.regexp_like(text, F.lit(_FLAT))
