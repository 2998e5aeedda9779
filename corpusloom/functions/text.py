"""String expressions shared by the renderers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Markers of the rendered texts.
END = "<|end|>"
ASSISTANT_OPEN = "<|assistant|>\n"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode whitespace included."""
    return F.trim(text, F.lit(WHITESPACE))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tag(role: Column | str) -> Column:
    """``<|role|>`` and a line break."""
    if isinstance(role, str):
        return F.lit(f"<|{role}|>\n")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def marked_turn(role: Column | str, content: Column) -> Column:
    """One turn closed by the end marker."""
    return F.concat(tag(role), or_empty(content), F.lit(f"{END}\n"))


def plain_turn(role: Column | str, content: Column) -> Column:
    """One turn without an end marker."""
    return F.concat(tag(role), or_empty(content), F.lit("\n"))


def joined(pieces: Column) -> Column:
    """All strings of an array, one after the other."""
    return F.coalesce(F.array_join(pieces, ""), F.lit(""))


def code_points(text: Column) -> Column:
    """Unicode code points of a text as ARRAY<INT>."""
    points = F.transform(F.split(text, ""), lambda c: F.ascii(c))
    return F.when(F.length(text) > 0, points).otherwise(F.array().cast("array<int>"))
