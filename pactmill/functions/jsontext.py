"""Strict JSON checks on text columns.

Spark's JSON functions accept trailing text, single quotes and other leniencies. The check used here parses
``[<text>,<hash of text>]`` as a VARIANT and requires the hash back as element 1: a lenient reading that stops early
or closes the bracket itself cannot produce it. ``NaN`` and infinities are rejected, since they are not JSON; the
``exact`` variants below accept them, as Python's own reader does.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from pactmill.functions import text as tx

_FENCE = "```json"


def plausible(text: Column) -> Column:
    """Cheap look at both ends: what cannot be one JSON value is not worth a parse that fails by exception."""
    def ends(opening: str, closing: str) -> Column:
        return F.startswith(text, F.lit(opening)) & F.endswith(text, F.lit(closing))

    return (
        ends("{", "}") | ends("[", "]") | ends('"', '"')
        | F.substring(text, 1, 1).isin(*"-0123456789tfn \t\r\n") | F.substring(text, -1, 1).isin(*" \t\r\n")
    )


def wrapped(text: Column) -> Column:
    """VARIANT of ``[text, hash]``; NULL where no JSON value can be read."""
    inside = F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]"))
    return F.when(plausible(text), F.try_parse_json(inside))


def is_strict(variant: Column, text: Column) -> Column:
    """Whether ``variant``, from :func:`wrapped`, holds exactly one JSON value and then the hash."""
    return F.coalesce(F.try_variant_get(variant, "$[1]", "bigint") == F.xxhash64(text), F.lit(False))


def strict_json(text: Column) -> Column:
    """True where the text is one JSON value and nothing else."""
    return is_strict(wrapped(text), text)


def braces_slice(raw: Column) -> Column:
    """From the first ``{`` to the last ``}``; NULL when there is no such span. The slice is not stripped."""
    first = F.instr(raw, "{")
    last = F.length(raw) - F.length(F.substring_index(raw, "}", -1))
    return F.when((first > 0) & (last > first), F.substring(raw, first, last - first + 1))


def fenced_block(raw: Column) -> Column:
    """Stripped text between the first json fence and the next fence; NULL when there is none or it is empty."""
    opened = F.locate(_FENCE, raw)
    start = opened + len(_FENCE)
    closed = F.call_function("locate", F.lit("```"), raw, start)
    return F.when((opened > 0) & (closed > start), tx.strip(F.substring(raw, start, closed - start)))


def is_object_text(json_text: Column) -> Column:
    """For text already known to be strict JSON and stripped: is it an object?"""
    return F.startswith(json_text, F.lit("{"))


# strings, the signs of the layout, blanks, and everything else
_JSON_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[ \t\r\n]++|[^ \t\r\n{}\[\],:"]++'


def top_level_value(text: Column, name: str) -> Column:
    """The JSON text that a top-level key has in an object, exactly as it is written; of repeated keys the last counts, as it
    does for :func:`wrapped`. NULL where the key is absent. ``text`` must be strict JSON of an object.

    One pass over the tokens keeps the depth, the key it is in and where that key's value begins and ends.
    """
    def step(at: Column, token: Column) -> Column:
        outer = at["depth"] == 1
        ends = outer & token.isin(",", "}")
        own = ends & (at["key"] == F.lit(json.dumps(name, ensure_ascii=False)))
        starts = outer & (token == ":")
        # escaped letters in a key are read; in a value it does not matter what this does
        plain = F.when(F.contains(token, F.lit("\\")), F.to_json(F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")))
        word = F.coalesce(F.substring(plain, F.lit(2), F.length(plain) - 2), token)
        return F.struct(
            (at["place"] + F.length(token)).alias("place"),
            (at["depth"] + F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)).alias("depth"),
            F.when(outer & F.startswith(token, F.lit('"')), word).otherwise(at["word"]).alias("word"),
            F.when(starts, at["word"]).when(ends, F.lit(None).cast("string")).otherwise(at["key"]).alias("key"),
            F.when(starts, at["place"] + 1).otherwise(at["begin"]).alias("begin"),
            F.when(own, at["begin"]).otherwise(at["first"]).alias("first"),
            F.when(own, at["place"]).otherwise(at["last"]).alias("last"),
        )

    nothing = F.lit(None).cast("string")
    start = F.struct(
        F.lit(1).alias("place"), F.lit(0).alias("depth"), nothing.alias("word"), nothing.alias("key"), F.lit(0).alias("begin"),
        F.lit(0).alias("first"), F.lit(0).alias("last"),
    )
    value = lambda at: F.when(
        at["last"] > 0, F.btrim(F.substring(text, at["first"], at["last"] - at["first"]), F.lit(" \t\r\n"))
    )
    return F.aggregate(F.regexp_extract_all(text, F.lit(_JSON_TOKEN), F.lit(0)), start, step, value)


def encode_call(call: Column) -> Column:
    """Compact JSON text of a struct; null fields and non-ASCII characters are kept."""
    return F.to_json(call, {"ignoreNullFields": "false"})


def encode_indented(value: Column, kind: DataType, width: int = 2, depth: int = 0) -> Column:
    """JSON text of a struct, array or map of type ``kind``, laid out in lines. Nulls and non-ASCII characters are kept; empty containers
    stay on their line. The layout follows from the type, so it is one expression; text that is JSON already goes to :func:`indented`.
    """
    inner, outer = "\n" + " " * (width * (depth + 1)), "\n" + " " * (width * depth)
    listed = lambda x: F.to_json(F.array(x))
    leaf = lambda x: F.substring(listed(x), F.lit(2), F.length(listed(x)) - 2)
    below = lambda x, of: encode_indented(x, of, width, depth + 1)
    if isinstance(kind, StructType):
        if not kind.fields:
            return F.when(value.isNull(), "null").otherwise("{}")
        parts = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ": "), below(value[f.name], f.dataType)) for f in kind.fields]
        text = F.concat(F.lit("{" + inner), F.concat_ws("," + inner, *parts), F.lit(outer + "}"))
    elif isinstance(kind, (ArrayType, MapType)):
        signs = "[]" if isinstance(kind, ArrayType) else "{}"
        if isinstance(kind, ArrayType):
            parts = F.transform(value, lambda x: below(x, kind.elementType))
        else:
            parts = F.transform(F.map_entries(value), lambda e: F.concat(
                leaf(e["key"].cast("string")), F.lit(": "), below(e["value"], kind.valueType)
            ))
        text = F.when(F.size(value) == 0, signs).otherwise(
            F.concat(F.lit(signs[0] + inner), F.array_join(parts, "," + inner), F.lit(outer + signs[1]))
        )
    else:
        return leaf(value)
    return F.when(value.isNull(), "null").otherwise(text)


def _storable(text: str) -> str:
    """Text that can be stored: half of a surrogate pair, which JSON can escape, becomes the replacement character."""
    return text.encode("utf-8", "surrogatepass").decode("utf-8", "replace") if not text.isascii() else text


def indented(json_text: Column, width: int) -> Column:
    """Re-indent JSON text, keeping key order and non-ASCII characters; text that is not JSON comes back as it is."""

    @F.pandas_udf("string")
    def layout(texts: pd.Series) -> pd.Series:
        def one(value):
            if value is None:
                return None
            try:
                return _storable(json.dumps(json.loads(value), ensure_ascii=False, indent=width))
            except (ValueError, RecursionError):
                return value

        return texts.map(one)

    return layout(json_text)


FACTS_TYPE = "strategy int, t string, keys array<string>, method string, endpoint string"


def exact_facts(*candidates: Column) -> Column:
    """What Python's JSON reader finds in the first candidate it can read: its number (0: none), the text, the
    top-level keys (NULL unless an object) and the two checked fields where they are strings."""

    def facts(texts) -> tuple:
        for number, text in enumerate(texts, 1):
            try:
                found = json.loads(text) if text is not None else ...
            except (ValueError, RecursionError):  # nested deeper than Python's reader goes: not read
                continue
            if isinstance(found, dict):
                checked = [_storable(v) if isinstance(v := found.get(name), str) else None for name in ("method", "endpoint")]
                return (number, text, [_storable(key) for key in found], *checked)
            if found is not ...:
                return (number, text, None, None, None)
        return (0, None, None, None, None)

    @F.pandas_udf(FACTS_TYPE)
    def read(*columns: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(map(facts, zip(*columns)), columns=["strategy", "t", "keys", "method", "endpoint"])

    return read(*candidates)
