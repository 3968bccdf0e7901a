"""Text functions: delimited lists and maps, suffixes, JSON escapes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of the list and map forms, and the blanks around them that go.
ITEM_SEPARATOR = ","
PAIR_SEPARATOR = ":"
BLANKS = " \t\n\x0b\f\r"

# Characters with a short JSON escape. The backslash comes first, so that the
# backslashes written by the other escapes are not escaped again.
SHORT_ESCAPES = {
    "\\": "\\\\",
    '"': '\\"',
    "/": "\\/",
    "\b": "\\b",
    "\f": "\\f",
    "\n": "\\n",
    "\r": "\\r",
    "\t": "\\t",
}
# Fixed value: the characters escaped by code (C0, DEL, C1).
CONTROL = "[\\x{00}-\\x{1f}\\x{7f}-\\x{9f}]"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def null_or_empty(value: Column) -> Column:
    """Whether text is null or has no characters; blanks are characters."""
    return value.isNull() | (value == F.lit(""))


def _split(value: Column, separator: str) -> Column:
    """Parts between separators, without the blanks next to a separator.

    Trimming the parts is linear in the text, which a pattern with blanks on both sides of the
    separator is not on long runs of blanks.
    """
    blanks = F.lit(BLANKS)

    def trim(part: Column, at: Column, last: Column) -> Column:
        opened = F.when(at > 0, F.ltrim(part, blanks)).otherwise(part)
        return F.when(at < last, F.rtrim(opened, blanks)).otherwise(opened)

    return _bind(
        F.split(value, separator),
        lambda parts: F.transform(parts, lambda part, at: trim(part, at, F.size(parts) - 1)),
    )


def csv_list(value: Column) -> Column:
    """Comma separated text as an array without the empty items; null gives an empty array."""
    items = F.filter(_split(value, ITEM_SEPARATOR), lambda item: item != F.lit(""))
    return F.coalesce(items, F.array().cast("array<string>"))


def _strip_trailing(value: Column, separator: str) -> Column:
    # One run of blanks and separators, anchored at its own start: the possessive form keeps
    # the match linear on long runs.
    run = f"(?<![\\s{separator}])\\s*+{separator}[\\s{separator}]*+$"
    return F.regexp_replace(value, run, "")


def _parse_pair(pair: Column) -> Column:
    parts = _split(_strip_trailing(pair, PAIR_SEPARATOR), PAIR_SEPARATOR)
    return _bind(
        parts,
        lambda kv: F.when(
            F.size(kv) < F.lit(2),
            F.raise_error(F.concat(F.lit("not a key:value pair: "), pair)).cast(
                "struct<k:string,v:string>"
            ),
        ).otherwise(F.struct(F.get(kv, F.lit(0)).alias("k"), F.get(kv, F.lit(1)).alias("v"))),
    )


def _last_per_key(pairs: Column) -> Column:
    """Of pairs with the same key keep the last: sort by key and position, keep the run ends."""
    numbered = F.array_sort(
        F.transform(
            pairs,
            lambda pair, at: F.struct(
                pair["k"].alias("k"), at.alias("at"), pair["v"].alias("v")
            ),
        )
    )
    return _bind(
        numbered,
        lambda run: F.filter(
            run,
            lambda pair, at: ~F.coalesce(F.get(run, at + 1)["k"] == pair["k"], F.lit(False)),
        ),
    )


def csv_map(value: Column) -> Column:
    """``k1:v1, k2:v2`` text as a map.

    Empty text is an empty map, of a repeated key the last value counts, and what follows a
    second colon is dropped. Trailing empty items are ignored; null text, an empty item
    before another one, and an item without a value are errors.
    """
    text = _strip_trailing(
        F.coalesce(value, F.raise_error(F.lit("csv_map of null")).cast("string")), ITEM_SEPARATOR
    )
    items = _split(text, ITEM_SEPARATOR)
    pairs = F.when(text == F.lit(""), F.array().cast("array<struct<k:string,v:string>>")).otherwise(
        F.transform(items, _parse_pair)
    )
    return F.map_from_entries(
        F.transform(_last_per_key(pairs), lambda pair: F.struct(pair["k"], pair["v"]))
    )


def replace_suffix(value: Column, old: str, new: str) -> Column:
    """Replace the literal suffix ``old`` by ``new``; text without it is an error."""
    stem = F.substring(value, F.lit(1), F.length(value) - F.lit(len(old)))
    return F.when(F.endswith(value, F.lit(old)), F.concat(stem, F.lit(new))).otherwise(
        F.raise_error(
            F.concat(
                F.lit(f"expected text that ends with {old!r}: "), F.coalesce(value, F.lit("null"))
            )
        ).cast("string")
    )


def _escape_code(text: Column, character: Column) -> Column:
    code = F.lower(F.hex(F.ascii(character).cast("long")))
    return F.replace(text, character, F.concat(F.lit("\\u"), F.lpad(code, 4, "0")))


def json_escape(value: Column) -> Column:
    """Text escaped for use inside a JSON string.

    All of it is replacement of one character throughout the text: of those with a short
    escape, then of the other control characters that the text holds.
    """
    short = reduce(
        lambda text, item: F.replace(text, F.lit(item[0]), F.lit(item[1])),
        SHORT_ESCAPES.items(),
        value,
    )
    return _bind(
        short,
        lambda text: F.aggregate(
            F.array_distinct(F.regexp_extract_all(text, F.lit(f"({CONTROL})"), F.lit(1))),
            text,
            _escape_code,
        ),
    )
