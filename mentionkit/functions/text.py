"""Text cleaning as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionkit.functions.entities import decode_entities

# Fixed value: what Python's ``\s`` matches, written for Java's regex.
_SPACE = r"[\s\x1c-\x1f]"
_SPACE_RUN = rf"(?U){_SPACE}+"
# whitespace other than a plain space
_OTHER_SPACE = r"(?U)[\s\x1c-\x1f&&[^ ]]"
# Fixed value: the same characters, for trimming.
_SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Tag, link and emphasis patterns.
_TAG = r"<[^>]+>"
_MARKDOWN_LINK = r"\[([^\]]+)\]\([^)]+\)"
_EMPHASIS = "[*_~`]"
_MARKDOWN_MARKS = ("[", "*", "_", "~", "`")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace, not just spaces."""
    return F.trim(text, F.lit(_SPACE_CHARS))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, _TAG, " ")


def unlink_markdown(text: Column) -> Column:
    """``[label](target)`` becomes ``label``."""
    return F.regexp_replace(text, _MARKDOWN_LINK, "$1")


def drop_emphasis(text: Column) -> Column:
    return F.regexp_replace(text, _EMPHASIS, "")


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE_RUN, " ")


def clean_text(text: Column, markdown: bool = False) -> Column:
    """Readable text: references decoded, tags gone, whitespace single; NULL if nothing is left.

    Decoding comes first, so that encoded tags go, too. A text without any of the
    marks in question takes the short way round the regular expressions. ``text``
    is read several times for that; pass a plain column.
    """
    body = (
        F.when(F.contains(text, F.lit("&")), strip_tags(decode_entities(text)))
        .when(F.contains(text, F.lit("<")), strip_tags(text))
        .otherwise(text)
    )
    if markdown:
        body = drop_emphasis(unlink_markdown(body))

    one_line = F.replace(text, F.lit("\n"), F.lit(" "))
    marks = ("&", "<", *(_MARKDOWN_MARKS if markdown else ()))
    involved = reduce(or_, [F.contains(text, F.lit(m)) for m in marks])
    uneven = F.contains(one_line, F.lit("  ")) | one_line.rlike(_OTHER_SPACE)
    return empty_to_null(F.trim(F.when(involved | uneven, collapse_whitespace(body)).otherwise(one_line)))


def first_filled(*texts: Column) -> Column:
    """First value that is neither NULL nor empty; the last one as it is."""
    return F.coalesce(*[empty_to_null(t) for t in texts[:-1]], texts[-1])
