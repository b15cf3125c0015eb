"""Scoring of pending mentions, in batches that can stop and resume.

A scorer is a function that adds the column ``sentiment_score`` to a frame of
mentions. Two are given: a word-list score in generated code, and a wrapper that
hands prompts to any Python callable in Arrow batches on the executors.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mentionkit import schemas
from mentionkit.functions.scores import build_prompt, is_scorable, lexicon_score, parse_score
from mentionkit.operators.aggregates import SCORE
from mentionkit.operators.keys import SALTS, SCORED_KEY, among, key_counts, keep_first, not_in, pick
from mentionkit.sources.shared import store
from mentionkit.sources.tables import Tables

Scorer = Callable[[DataFrame], DataFrame]

FILE_ROWS = 50_000
"""Pending rows that one file of a batch should hold."""


def lexicon_scorer(positive: Sequence[str], negative: Sequence[str]) -> Scorer:
    return lambda df: df.withColumn(SCORE, lexicon_score(F.col("text"), positive, negative))


REPLIES = "model_replies"
CALL_PROMPTS = 64
"""Prompts handed to the model at once; a time limit is looked at between two calls."""


class ModelScorer:
    """Score by asking a model: ``reply_to`` answers a list of prompts.

    Each distinct prompt is asked once. With ``tables``, replies are kept there under a digest of prompt and ``model``, so later batches and runs, and
    copies of a post, do not pay for them again. If a call fails, its prompts are asked one by one; one that fails alone has no reply, is not kept and is
    asked again by a later run if rows without a score are not stored. Prompts that a time limit does not reach give no rows.

    ``reply_to`` is pickled to the executors and should open its client on first use.
    """

    def __init__(
        self, reply_to: Callable[[list[str]], list[str]], max_chars: int | None = None, tables: Tables | None = None, model: str = "",
        deadline: float | None = None,
    ) -> None:
        self.reply_to, self.max_chars, self.tables, self.model, self.deadline = reply_to, max_chars, tables, model, deadline

    def until(self, deadline: float) -> ModelScorer:
        """The same scorer with a time, in seconds since 1970, after which no call is begun."""
        return ModelScorer(self.reply_to, self.max_chars, self.tables, self.model, deadline)

    def __call__(self, df: DataFrame) -> DataFrame:
        prompt = build_prompt(F.col("text"), F.col("tool"), self.max_chars)
        digest = F.sha2(F.concat(F.lit(f"{self.model}\n"), prompt), 256)
        asked = df.withColumn("_prompt", prompt).withColumn("_digest", digest)
        open_prompts = asked.filter(F.col("_prompt").isNotNull()).select("_digest", "_prompt")
        known = None
        if self.tables is not None:
            self.tables.ensure(REPLIES, schemas.REPLY_SCHEMA)
            known = self._kept()
        answers = self._answers().asNondeterministic()
        # digests alone travel, and the prompts of copies
        unique = pick(open_prompts, store(key_counts(open_prompts, ["_digest"], known), "prompts"), ["_digest"])
        new = unique.select("_digest", answers(F.col("_prompt")).alias("a")).select("_digest", "a.*")
        # a model is no function of its prompt, and each call costs: what comes after must not make a second one
        new = store(new, "replies").filter("reached").select("_digest", "reply")
        if self.tables is not None:
            answered = F.col("reply").isNotNull()
            self.tables.append(new.filter(answered).select(F.col("_digest").alias("digest"), "reply"), REPLIES)
            # replies of two runs at once may both be kept
            kept = among(self._kept(), asked.filter(F.col("_digest").isNotNull()), ["_digest"]).dropDuplicates(["_digest"])
            new = new.filter(~answered).unionByName(kept)
        met = asked.withColumnRenamed("_digest", "_own").join(new, F.col("_own") == F.col("_digest"), "left")
        # no prompt, no reply; a prompt that was not reached gives no row
        reached = F.col("_own").isNull() | F.col("_digest").isNotNull()
        return met.filter(reached).select(*df.columns, parse_score(F.col("reply")).alias(SCORE))

    def _kept(self) -> DataFrame:
        return self.tables.read(REPLIES).withColumnRenamed("digest", "_digest")

    def _answers(self):
        reply_to, deadline = self.reply_to, self.deadline

        def one_by_one(prompts: list[str]) -> list[str | None]:
            out: list[str | None] = []
            for p in prompts:
                try:
                    out.append(reply_to([p])[0])
                except Exception:  # the model's own errors, of whatever kind, cost this prompt only
                    out.append(None)
            return out

        def called(prompts: list[str]) -> list[str | None]:
            try:
                replies = list(reply_to(prompts))
            except Exception:
                return one_by_one(prompts)
            return replies if len(replies) == len(prompts) else one_by_one(prompts)

        @F.pandas_udf("reply string, reached boolean")
        def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                prompts, out = batch.tolist(), []
                for at in range(0, len(prompts), CALL_PROMPTS):
                    part = prompts[at : at + CALL_PROMPTS]
                    late = deadline is not None and time.time() >= deadline
                    out += [(None, False)] * len(part) if late else [(r, True) for r in called(part)]
                yield pd.DataFrame(out, columns=["reply", "reached"])

        return answers


def model_scorer(
    reply_to: Callable[[list[str]], list[str]], max_chars: int | None = None, tables: Tables | None = None, model: str = ""
) -> ModelScorer:
    return ModelScorer(reply_to, max_chars, tables, model)


def _scorable(silver: DataFrame) -> DataFrame:
    return silver.filter(is_scorable(F.col("text")) & F.col("post_id").isNotNull())


def pending(silver: DataFrame, scored: DataFrame | None) -> DataFrame:
    """Scorable mentions that have no scored row yet, one per key.

    Copies are reduced before the join, which reuses their partitioning.
    """
    unique = _one_copy(_scorable(silver))
    return unique if scored is None else not_in(unique, scored, SCORED_KEY)


def open_keys(silver: DataFrame, scored: DataFrame) -> DataFrame:
    """Keys of the scorable mentions without a scored row; key columns only. Those that cannot be scored are never open."""
    return not_in(_scorable(silver).select(*SCORED_KEY).distinct(), scored, SCORED_KEY)


def pending_by_key(silver: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``pending``, picked by open keys."""
    return _one_copy(among(_scorable(silver), wanted, SCORED_KEY))


def _picked(silver: DataFrame, seen: DataFrame) -> DataFrame:
    """The rows of ``pending``, picked by the stored ``key_counts`` of the scorable mentions: texts do not travel, but for copies."""
    return pick(_scorable(silver), seen, SCORED_KEY, [F.desc_nulls_last("ingested_at")])


def _one_copy(mentions: DataFrame) -> DataFrame:
    return keep_first(mentions, SCORED_KEY, [F.desc_nulls_last("ingested_at")])


def as_scored(df: DataFrame) -> DataFrame:
    return df.select(*schemas.SCORED.names)


@dataclass(frozen=True)
class ScoringRun:
    scored: int
    remaining: int
    batches: int
    complete: bool = True
    """False if a limit ended the run before every pending row was tried."""


def score_pending(
    silver: DataFrame,
    tables: Tables,
    scored_table: str,
    scorer: Scorer,
    batch_rows: int = 1_000_000,
    max_batches: int | None = None,
    max_minutes: float | None = None,
    store_unparsed: bool = True,
    before: Callable[[DataFrame], object] | None = None,
) -> ScoringRun:
    """Score what is pending and append it batch by batch.

    The open keys are found once; their rows are written to the shared folder with one folder per batch, so that a
    batch opens its own files only. A run that stops, or dies, leaves the rest pending for the next one. All batches
    are run unless ``max_batches`` or ``max_minutes`` is given.

    A time limit is looked at between batches, and by scorers with a method ``until`` inside their tasks as well: rows that they
    do not reach come back as no rows and stay pending. ``before`` is called with all rows to be tried before any is scored.

    ``store_unparsed=False`` leaves rows without a usable score out of the table, so
    that they are tried again.
    """
    deadline = None if max_minutes is None else time.time() + max_minutes * 60
    tables.ensure(scored_table, schemas.SCORED)
    seen = store(key_counts(_scorable(silver), SCORED_KEY, tables.read(scored_table)), "open-keys")
    # one pending row per open key
    total = seen.filter("wanted").count()
    batches = math.ceil(total / batch_rows)
    done = reached = batch = 0
    tried = batches if max_batches is None else min(batches, max_batches)
    todo = _by_batch(_picked(silver, seen), batches, tried, total) if tried else None
    if before is not None and todo is not None:
        before(todo.drop("_batch"))
    if deadline is not None and hasattr(scorer, "until"):
        scorer = scorer.until(deadline)
    while batch < tried:
        if deadline is not None and time.time() >= deadline:
            break
        given_back = Observation()
        scored = as_scored(scorer(todo.filter(F.col("_batch") == batch))).observe(given_back, F.count(F.lit(1)).alias("rows"))
        if not store_unparsed:
            scored = scored.filter(F.col(SCORE).isNotNull())
        done += tables.append(scored, scored_table)
        reached += given_back.get["rows"]
        batch += 1
    # a limit inside a batch leaves rows of it behind
    return ScoringRun(scored=done, remaining=total - done, batches=batch, complete=reached == total)


def _by_batch(rows: DataFrame, batches: int, tried: int, total: int) -> DataFrame:
    """The rows of the batches that this run tries, stored with one folder per batch.

    A small batch is gathered to one file. Rows of larger ones are written from where they lie, unless there are more than ``SALTS`` batches: then
    a batch is written by as many tasks as give files of about ``FILE_ROWS`` rows, ``SALTS`` at most.
    """
    hashed = F.xxhash64(*SCORED_KEY)
    batch = F.pmod(hashed, F.lit(batches)).cast("int")
    files = min(SALTS, math.ceil(total / batches / FILE_ROWS))
    part = F.pmod(F.shiftright(hashed, 32), F.lit(files))
    dealt = rows.withColumn("_batch", batch)
    if tried < batches:
        dealt = dealt.filter(F.col("_batch") < tried)
    if files == 1 or tried > SALTS:
        dealt = dealt.repartition("_batch", part)
    return store(dealt, "pending", partition_by=["_batch"])
