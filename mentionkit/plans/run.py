"""The whole run: land and refine each source, score, check, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from mentionkit.catalog import EntityCatalog
from mentionkit.operators.audit import AuditLog
from mentionkit.operators.refine import HACKERNEWS, PRODUCTHUNT, REDDIT, SOURCES, Source
from mentionkit.operators.scoring import Scorer, ScoringRun
from mentionkit.plans import gold
from mentionkit.plans.land import KEY_FILTERS, LANDING_MARKS, REJECTED_LINES, land_hackernews, land_producthunt, land_reddit
from mentionkit.plans.silver import MARK_TABLE, refine_source
from mentionkit.schemas import KEY_FILTER_SCHEMA, LANDING_MARK_SCHEMA, MARK_SCHEMA, REJECTED
from mentionkit.sources.tables import Tables

LAND: Mapping[str, Callable[[Tables, DataFrame, datetime | None], int]] = {
    HACKERNEWS.name: land_hackernews,
    REDDIT.name: land_reddit,
    PRODUCTHUNT.name: land_producthunt,
}


@dataclass(frozen=True)
class RunResult:
    landed: dict[str, int]
    refined: dict[str, int]
    scoring: ScoringRun
    quality: DataFrame
    counts: DataFrame | None
    """Row counts of the reports; None if a limited run left them as they were."""


def run_all(
    tables: Tables,
    payloads: Mapping[str, DataFrame],
    catalog: EntityCatalog,
    scorer: Scorer,
    run_time: datetime | None = None,
    scored_sources: Sequence[Source] = gold.SCORED_SOURCES,
    partial_reports: bool = False,
    **limits,
) -> RunResult:
    """``payloads`` maps source names to landed frames: all, some or none of the sources.

    The sources do not depend on each other; their jobs are submitted side by side. Scoring reads the silver tables
    of all ``scored_sources`` that exist, so rows that an earlier run left pending do not wait for their source. If
    limits end the scoring early, the reports are left as they were unless ``partial_reports`` is set.
    """
    unknown = set(payloads) - set(LAND)
    if unknown:
        raise ValueError(f"unknown sources {sorted(unknown)}")
    zone = tables.spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError(f"the session time zone is {zone}, days and start dates need UTC")
    chosen = [s for s in SOURCES if s.name in payloads]
    # created up front, as the branches would race for them
    AuditLog(tables).ensure()
    tables.ensure(MARK_TABLE, MARK_SCHEMA)
    tables.ensure(LANDING_MARKS, LANDING_MARK_SCHEMA)
    tables.ensure(KEY_FILTERS, KEY_FILTER_SCHEMA)
    tables.ensure(REJECTED_LINES, REJECTED)

    def branch(source: Source) -> tuple[int, int]:
        landed = LAND[source.name](tables, payloads[source.name], run_time)
        return landed, refine_source(tables, source, catalog, run_time)

    with ThreadPoolExecutor(max(1, len(chosen))) as pool:
        done = dict(zip([s.name for s in chosen], pool.map(branch, chosen)))

    scoring = gold.score_sources(tables, scorer, scored_sources, **limits)
    return RunResult(
        landed={name: landed for name, (landed, _) in done.items()},
        refined={name: refined for name, (_, refined) in done.items()},
        scoring=scoring,
        quality=gold.fold_quality(tables, catalog),
        counts=gold.fold_reports(tables) if scoring.complete or partial_reports else None,
    )
