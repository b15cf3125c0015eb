"""The increments as Structured Streaming queries.

``land_stream`` and ``refine_stream`` keep tables up to date from file streams.
Each micro-batch goes through the batch operators, and rows whose key the target
has already are left out, so a batch that is replayed after a failure adds
nothing; the target's keys are first cut down to those of the batch. The other functions are plain transformations of streaming frames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mentionkit import schemas
from mentionkit.catalog import EntityCatalog
from mentionkit.functions.scores import exact, is_positive, percent, rounded_mean
from mentionkit.operators.aggregates import SCORE, daily_rollup, scored_only
from mentionkit.operators.keys import MENTION_KEY, SALTS, keep_first, not_in, not_in_history
from mentionkit.operators.refine import SOURCES, Source, as_silver, find_mentions, new_mentions, normalise
from mentionkit.plans.land import keep_rejected, note_keys
from mentionkit.sources.shared import store
from mentionkit.sources.tables import Tables


def mention_stream(bronze: DataFrame, source: Source, catalog: EntityCatalog, **options) -> DataFrame:
    """Stateless part of refinement on a streaming frame; copies are still in."""
    return find_mentions(normalise(bronze, source), catalog, **options)


def first_within_watermark(mentions: DataFrame, delay: str, time: str = "ingested_at") -> DataFrame:
    """Drop copies of a mention that arrive within ``delay`` of each other.

    Copies are dropped per salt first, so that a key with very many copies sends at
    most one row per salt to the task that keeps its state.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    salted = mentions.withColumn("_salt", salt).withWatermark(time, delay)
    per_salt = salted.dropDuplicatesWithinWatermark([*MENTION_KEY, "_salt"]).drop("_salt")
    return per_salt.dropDuplicatesWithinWatermark(list(MENTION_KEY))


def daily_stream(scored: DataFrame, delay: str, time: str = "created_at") -> DataFrame:
    """Per tool and day, emitted once the watermark has passed the day."""
    s, n = F.col(SCORE), F.count(F.lit(1))
    return (
        scored_only(scored)
        .withWatermark(time, delay)
        .groupBy("tool", F.window(time, "1 day").alias("_day"))
        .agg(
            n.alias("post_count"),
            rounded_mean(F.avg(exact(s)), 3).alias("avg_sentiment"),
            percent(F.count_if(is_positive(s)), n).alias("positive_pct"),
        )
        .select("tool", F.to_date("_day.start").alias("post_date"), "post_count", "avg_sentiment", "positive_pct")
    )


def rollup_stream(scored: DataFrame, tables: Tables, table: str, checkpoint: str) -> StreamingQuery:
    """Fold scored rows into additive daily rows, one set per micro-batch.

    No day waits for a watermark and no late row is lost: ``daily_from_rollup`` and its kin over the table give the
    reports of all rows so far. A replayed micro-batch is known by its number, so table and checkpoint belong together.
    """

    def write(batch: DataFrame, number: int) -> None:
        own = tables.on(batch.sparkSession)
        rows = daily_rollup(batch).withColumn("_batch", F.lit(number).cast("bigint"))
        own.ensure(table, rows.schema)
        own.append(not_in(rows, own.read(table), ["_batch"]), table)

    return _run(scored, write, checkpoint)


def land_stream(
    payload: DataFrame,
    flatten: Callable[[DataFrame], DataFrame],
    tables: Tables,
    table: str,
    schema: T.StructType,
    keys: list[str],
    checkpoint: str,
) -> StreamingQuery:
    """Append the flattened payload lines whose key the table does not have yet; lines that are no payload go to their own table."""
    tables.ensure(table, schema)
    source = next((s for s in SOURCES if s.bronze_table == table), None)

    def write(batch: DataFrame, _: int) -> None:
        own = tables.on(batch.sparkSession)
        if source is not None:
            batch = keep_rejected(own, batch, source)
        rows = store(keep_first(flatten(batch), keys, [F.desc("ingested_at")]), "landed")
        new = not_in_history(rows, own.read(table), keys)
        if source is not None:
            new = store(new, "landing")
            note_keys(own, new, source)
        own.append(new, table, evolve=True)

    return _run(payload, write, checkpoint)


def refine_stream(
    bronze: DataFrame,
    source: Source,
    catalog: EntityCatalog,
    tables: Tables,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Refine every micro-batch into the silver table of the source."""
    tables.ensure(source.silver_table, schemas.SILVER)

    def write(batch: DataFrame, _: int) -> None:
        own = tables.on(batch.sparkSession)
        mentions = store(find_mentions(normalise(batch, source), catalog, **options), "refined")
        own.append(as_silver(new_mentions(mentions, own.read(source.silver_table))), source.silver_table)

    return _run(bronze, write, checkpoint)


def write_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a streaming frame to parquet files, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    # takes all files present, in micro-batches, and stops
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
