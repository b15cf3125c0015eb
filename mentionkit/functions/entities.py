"""HTML character references as a column expression.

The result equals Python's ``html.unescape``: one pass, named references with
and without the closing semicolon, the longest known name for a run-on such as
``&notit;``, and numeric references with their replacement rules. The tables come
from the standard library, so none is spelled out here.
"""

from __future__ import annotations

import html
import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_REPLACEMENT = "\ufffd"
_MAX_CODE_POINT = 0x10FFFF


@lru_cache(maxsize=1)
def _named() -> str:
    """Names and their text by first letter: a map is searched entry by entry, so it is kept short."""
    by_letter = {}
    for name, value in html5.items():
        by_letter.setdefault(name[0], {})[name] = value
    return json.dumps(by_letter)


@lru_cache(maxsize=1)
def _open_name() -> str:
    """Pattern for the longest reference at the start that counts without a semicolon."""
    names = sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True)
    return f"^(?:{'|'.join(names)})"


@lru_cache(maxsize=1)
def _irregular_code_points() -> str:
    """Code points that do not stand for themselves, found by trying those that may."""
    candidates = [*range(0xA0), *range(0xFDD0, 0xFDF0)]
    candidates += [(plane << 16) + low for plane in range(17) for low in (0xFFFE, 0xFFFF)]
    decoded = {n: html.unescape(f"&#{n};") for n in candidates}
    return json.dumps({str(n): v for n, v in decoded.items() if v != chr(n)})


def _character(n: Column) -> Column:
    """Character for a code point given as bigint; NULL means out of range."""
    surrogate_or_outside = n.isNull() | n.between(0xD800, 0xDFFF) | (n > _MAX_CODE_POINT)
    regular = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    irregular = F.from_json(F.lit(_irregular_code_points()), "map<string,string>")[n.cast("string")]
    return F.when(surrogate_or_outside, F.lit(_REPLACEMENT)).otherwise(F.coalesce(irregular, regular))


# hexadecimal or decimal digits without leading zeros
_NUMERIC = r"^#(?:[xX]0*([0-9a-fA-F]+)|0*([0-9]+));?"


def _numeric(part: Column) -> Column:
    """Decode a numeric reference at the start of ``part`` (the text after an '&')."""
    hexadecimal, decimal = F.regexp_extract(part, _NUMERIC, 1), F.regexp_extract(part, _NUMERIC, 2)
    # longer numbers are outside the code space; NULL keeps the conversions in range
    number = F.when(hexadecimal == "", F.when(F.length(decimal) <= 10, decimal)).otherwise(
        F.conv(F.when(F.length(hexadecimal) <= 8, hexadecimal), 16, 10)
    )
    return F.concat(_character(number.cast("bigint")), F.regexp_replace(part, _NUMERIC, ""))


def _named_reference(part: Column) -> Column:
    name = F.regexp_extract(part, r"^[^\t\n\f <&#;]{1,32};?", 0)
    run_on = F.regexp_extract(name, _open_name(), 0)
    named = F.from_json(F.lit(_named()), "map<string,map<string,string>>")[F.left(part, F.lit(1))]
    return F.coalesce(
        F.concat(named[name], F.substr(part, F.length(name) + 1)),
        F.concat(named[run_on], F.substr(part, F.length(run_on) + 1)),
        F.concat(F.lit("&"), part),
    )


def _decode_part(part: Column, i: Column) -> Column:
    return (
        F.when(i == 0, part)
        .when(part.rlike("^[A-Za-z]"), _named_reference(part))
        .when(part.rlike("^#(?:[0-9]|[xX][0-9a-fA-F])"), _numeric(part))
        .otherwise(F.concat(F.lit("&"), part))
    )


def decode_entities(text: Column) -> Column:
    """Replace HTML character references; a text without '&' passes through."""
    decoded = F.array_join(F.transform(F.split(text, "&"), _decode_part), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)
