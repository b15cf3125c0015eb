"""Chat formatting with prefix-target expansion.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings inside roles and texts get a backslash after their first character and
backslashes are doubled, so formatted text holds no control string of its own and can be turned back exactly.

Every assistant turn is exploded into an example of its own, one stored row each: all turns before it are context, and only its reply is trained on. The
context of an example is a prefix of its formatted conversation, so the conversation is kept once, in one row per turn with its place, and an
example row names ranges of it: context from 0 to ``context_chars``, the reply's head up to ``loss_start``, loss from there to ``loss_end``. Long conversations
thus grow in proportion, not with the square of their turns; ``example_texts`` writes examples out where a trainer wants them so. What is
reported of the loss is read back from the example rows.

Places are code points. Digests go through a conversation's turns in order as a stream, so a task holds one batch of turns, however long a
conversation is. Defined results: NULL roles and texts are empty; turns are in order of turn (NULL first), role, text; repeated turns stay; a
NULL conv_id is a conversation; conversations without assistant turns have no examples; no rows give no rows; very long texts stay whole; other
columns, whatever their names, are not read. Ids of all 64 bits come back unchanged, also beside NULL.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches
from mentionkit.sources.shared import store

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of common chat templates
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TARGET = "assistant"
CONTROL_CHECK = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))

_PIECE = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*)" + re.escape(END), re.DOTALL)
_ESCAPED = re.compile(r"\\(\\?)")


def escaped(text: Column) -> Column:
    out = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def control_check(spark: SparkSession) -> DataFrame:
    """A conversation whose texts are made of control strings."""
    rows = F.array(*[F.struct(F.lit(c).cast("long"), F.lit(t).cast("long"), F.lit(r), F.lit(x)) for c, t, r, x in CONTROL_CHECK])
    return spark.range(1).select(F.inline(rows)).toDF("conv_id", "turn", "role", "text")


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, seq, piece, start, loss_start, loss_end``; the last two are NULL but for assistant turns."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_head", F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP))).withColumn("_body", escaped(F.col("text")))
    rows = rows.withColumn("piece", F.concat("_head", "_body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("seq", F.row_number().over(order).cast("long")).withColumn(
        "start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long"))
    )
    first = F.when(F.col("role") == TARGET, F.col("start") + F.length("_head"))
    return rows.select("conv_id", "seq", "piece", "start", first.alias("loss_start"), (first + F.length("_body")).alias("loss_end"))


def examples(pieces: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id, target_seq, context_chars, loss_start, loss_end``."""
    return pieces.where("loss_start IS NOT NULL").select(
        "conv_id", F.col("seq").alias("target_seq"), F.col("start").alias("context_chars"), "loss_start", "loss_end"
    )


def example_texts(pieces: DataFrame) -> DataFrame:
    """Examples written out: ``text`` is the context and the target turn. Grows with the square of a conversation's turns."""
    e, p = examples(pieces).alias("e"), pieces.alias("p")
    both = e.join(p, F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("p.seq") <= F.col("e.target_seq")))
    rows = both.groupBy("e.conv_id", "e.target_seq", "e.loss_start", "e.loss_end").agg(
        F.array_sort(F.collect_list(F.struct("p.seq", "p.piece"))).alias("parts")
    )
    return rows.select("conv_id", "target_seq", F.array_join("parts.piece", "").alias("text"), "loss_start", "loss_end")


class _Reading:
    """What one conversation's pieces and examples say, taken in order; an example follows the piece of its reply."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_examples = self.example_chars = 0
        self.last, self.last_start = "", 0

    def add(self, piece: str, start: int) -> None:
        found = _PIECE.fullmatch(piece)
        if found is None or start != self.chars:
            raise ValueError(f"conversation {self.conv_id}: piece {self.n_turns + 1} is not where or what it should be")
        role, text = unescaped(found[1]), unescaped(found[2])
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.last, self.last_start = piece, start
        self.chars += len(piece)

    def example(self, context: int, first: int, end: int) -> None:
        if context != self.last_start or not context <= first <= end <= self.chars:
            raise ValueError(f"conversation {self.conv_id}: example {self.n_examples + 1} is no range of it")
        target = unescaped(self.last[first - context : end - context])
        self.loss.update(target.encode())
        self.loss_chars += len(target)
        self.n_examples += 1
        self.example_chars += self.chars

    def row(self) -> tuple:
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
            self.n_examples, self.example_chars,
        )


_SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_examples long, example_chars long"
)


def _summaries(batches):
    now = None
    for batch in batches:
        done = []
        columns = [batch[c].tolist() for c in ("conv", "piece", "start", "loss_start", "loss_end")]
        for conv, piece, start, first, end in zip(*columns):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.row())
                now = _Reading(conv)
            if piece is not None:
                now.add(piece, start)
            else:
                now.example(start, first, end)
        yield _frame(done)
    if now is not None:
        yield _frame([now.row()])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in _SUMMARY.split(", ")]
    # ids travel as text: a column of numbers with NULL would pass through floats
    columns = {n: [r[k] for r in rows] for k, n in enumerate(names)}
    columns["conv_id"] = [None if c is None else int(c) for c in columns["conv_id"]]
    return pd.DataFrame({n: pd.array(v, dtype=object if n.endswith("sha256") else "Int64") for n, v in columns.items()})


def summaries(pieces: DataFrame, found: DataFrame) -> DataFrame:
    """Read formatted conversations and their examples back: turns, loss text and sizes of each conversation, with digests."""
    small_batches(pieces.sparkSession)
    none = F.lit(0).cast("long")
    rows = pieces.select("conv_id", "seq", F.lit(0).alias("kind"), "piece", "start", none.alias("loss_start"), none.alias("loss_end"))
    ranges = found.select(
        "conv_id", F.col("target_seq").alias("seq"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("piece"), F.col("context_chars").alias("start"),
        "loss_start", "loss_end",
    )
    both = rows.unionAll(ranges).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "kind")
    return both.select(F.col("conv_id").cast("string").alias("conv"), "piece", "start", "loss_start", "loss_end").mapInPandas(_summaries, _SUMMARY)


def chat_report(turns: DataFrame) -> DataFrame:
    """Format the conversations and the control check, explode their examples, store both, read them back."""
    rows = turns.select("conv_id", "turn", "role", "text").unionByName(control_check(turns.sparkSession))
    pieces = store(formatted(rows), "chat")
    return summaries(pieces, store(examples(pieces), "chat-examples"))
