"""Scalar text functions: previews, fixed-width cells, stripping and the token proxy."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pactmill import fixed_values as fv

# Unicode whitespace. JSON parsers themselves skip only four of these characters.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_TOKEN = r"[^ \t\r\n]+"


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(_SPACE))


def preview(text: Column, width: int = 300) -> Column:
    """First ``width`` characters, then always three dots."""
    return F.concat(F.substring(text, 1, width), F.lit("..."))


def short_preview(text: Column, width: int = 80) -> Column:
    """The text itself, or its first ``width`` characters and three dots when it is longer."""
    return F.when(F.length(text) > width, preview(text, width)).otherwise(text)


def cell(text: Column, width: int = 45) -> Column:
    """Cut to ``width`` and pad on the right to ``width``."""
    return F.rpad(text, width, " ")


def padded(text: Column, width: int = 8) -> Column:
    """Pad on the right to ``width``; longer text is left whole."""
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def tokens(text: Column) -> Column:
    """Whitespace-separated pieces: a proxy for model tokens, not the model's own tokens."""
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of proxy tokens, without building the array."""
    return F.regexp_count(text, F.lit(_TOKEN)).cast("bigint")


def capped(text: Column, cap: int = fv.MAX_SEQ_LENGTH) -> Column:
    """The text up to the end of its ``cap``-th proxy token, white space as it is."""
    blank = F.substring(text, 1, 1).isin(*" \t\r\n")  # then the first piece is the empty one before it
    pieces = F.when(blank, F.split(text, r"[ \t\r\n]+", cap + 2)).otherwise(F.split(text, r"[ \t\r\n]+", cap + 1))
    rest = F.element_at(pieces, -1)
    inside = F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(rest)), F.lit(" \t\r\n"))
    return F.when(F.size(pieces) == F.when(blank, cap + 2).otherwise(cap + 1), inside).otherwise(text)


def minutes(seconds: Column) -> Column:
    """Seconds as minutes with one decimal."""
    return F.round(seconds / F.lit(60.0), 1)
