"""Sentiment scores: buckets, model prompts and replies, word-list score."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket limits, shortest text worth scoring.
NEUTRAL_LIMIT = 0.2
MIN_TEXT_LENGTH = 10

PROMPT_TEMPLATE = (
    'Rate how the post below feels about "{tool}". Judge "{tool}" alone: ignore opinions on other products, '
    'and where several are compared, use only the part about "{tool}". Mind irony and faint praise. '
    "Answer with one decimal number from -1 (hostile) over 0 (neutral) to 1 (enthusiastic) and nothing else; "
    "keep -1 and 1 for clear extremes.\n\n<text>{text}</text>"
)


def is_positive(score: Column) -> Column:
    return score > NEUTRAL_LIMIT


def is_negative(score: Column) -> Column:
    return score < -NEUTRAL_LIMIT


def is_neutral(score: Column) -> Column:
    return score.between(-NEUTRAL_LIMIT, NEUTRAL_LIMIT)


def percent(part: Column, total: Column) -> Column:
    return F.round(part / total * 100, 1)


def exact(score: Column) -> Column:
    """A score as a decimal: sums and means of these do not depend on the order, so a tie is rounded the same every time."""
    return score.cast("decimal(38,15)")


def rounded_mean(mean: Column, places: int) -> Column:
    return F.round(mean, places).cast("double")


def is_scorable(text: Column) -> Column:
    return F.length(text) > MIN_TEXT_LENGTH


def build_prompt(
    text: Column,
    tool: Column,
    max_chars: int | None = None,
    template: str = PROMPT_TEMPLATE,
) -> Column:
    """Prompt for one (post, entity).

    The whole text is sent unless the caller sets a budget per model call with
    ``max_chars``. A closing tag inside the post cannot end the text block early.
    """
    body = text if max_chars is None else F.left(text, F.lit(max_chars))
    body = F.replace(body, F.lit("</text>"), F.lit("< /text>"))
    head, _, tail = template.partition("{text}")
    return F.concat(*_fill_tool(head, tool), body, *_fill_tool(tail, tool))


def _fill_tool(template: str, tool: Column) -> list[Column]:
    pieces = []
    for i, literal in enumerate(template.split("{tool}")):
        if i:
            pieces.append(tool)
        pieces.append(F.lit(literal))
    return pieces


def parse_score(reply: Column) -> Column:
    """Model reply to double; anything but a finite number becomes NULL."""
    number = reply.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def lexicon_score(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """(p - n) / (p + n) over the words of the whole text that are on either list; 0 if none is.

    Words are runs of a-z in the lowercased text; a listed word that is none is refused, as it would never be found.
    One pass picks the listed words, the counts are taken over those.
    """
    words = sorted({*positive, *negative})
    unfit = [w for w in words if not re.fullmatch("[a-z]+", w)]
    if unfit:
        raise ValueError(f"not runs of a-z: {unfit}")
    if not words:
        return F.when(text.isNotNull(), F.lit(0.0))
    initials = "".join(sorted({w[0] for w in words}))
    # the look ahead at the first letter rejects most positions at once
    listed = rf"(?=[{initials}])(?<![a-z])(?:{'|'.join(words)})(?![a-z])"
    found = F.regexp_extract_all(F.lower(text), F.lit(listed), F.lit(0))
    return F.aggregate(
        found,
        F.struct(F.lit(0).alias("p"), F.lit(0).alias("n")),
        lambda acc, w: F.struct(
            (acc["p"] + w.isin(*positive).cast("int")).alias("p"), (acc["n"] + w.isin(*negative).cast("int")).alias("n")
        ),
        lambda acc: F.when(acc["p"] + acc["n"] == 0, F.lit(0.0)).otherwise(
            F.round((acc["p"] - acc["n"]) / (acc["p"] + acc["n"]), 3)
        ),
    )
