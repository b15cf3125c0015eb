"""Entity catalogs: which names count as a mention, and from which date on.

A catalog is small, hand-kept configuration that lives on the driver. The
matcher turns it into column expressions; the DataFrame forms serve joins
against catalogs and checks that are kept as tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionkit.schemas import ALIAS_SCHEMA, START_DATE_SCHEMA


@dataclass(frozen=True)
class Entity:
    """One tracked name.

    ``strong`` aliases count on their own; ``weak`` aliases count only in a text
    that also holds a context keyword. Posts from before ``start`` never count.
    """

    name: str
    strong: tuple[str, ...] = ()
    weak: tuple[str, ...] = ()
    start: date | None = None


@dataclass(frozen=True)
class EntityCatalog:
    entities: tuple[Entity, ...]
    context: tuple[str, ...] = ()
    exclusions: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        problems = self.problems()
        if problems:
            raise ValueError("invalid catalog: " + "; ".join(problems))

    @classmethod
    def from_mappings(
        cls,
        aliases: Mapping[str, Mapping[str, Sequence[str]]],
        starts: Mapping[str, date],
        context: Iterable[str] = (),
        exclusions: Iterable[str] = (),
    ) -> EntityCatalog:
        """Build from two dicts keyed by entity; the key sets have to agree."""
        missing = sorted(set(aliases) - set(starts))
        orphaned = sorted(set(starts) - set(aliases))
        if missing or orphaned:
            raise ValueError(f"entities without a start date: {missing}; start dates without an entity: {orphaned}")
        return cls(
            tuple(
                Entity(name, tuple(tiers.get("strong", ())), tuple(tiers.get("weak", ())), starts[name])
                for name, tiers in aliases.items()
            ),
            tuple(context),
            tuple(exclusions),
        )

    def problems(self) -> list[str]:
        found = []
        names = [e.name for e in self.entities]
        if len(set(names)) != len(names):
            found.append("entity names repeat")
        for e in self.entities:
            if not (e.strong or e.weak):
                found.append(f"{e.name} has no alias")
            if e.start is not None and type(e.start) is not date:
                found.append(f"start of {e.name} is not a date")
        needles = [a for e in self.entities for a in e.strong + e.weak]
        for needle in [*needles, *self.context, *self.exclusions]:
            # texts are lowercased before the search, so other needles never match
            if not needle or needle != needle.lower():
                found.append(f"{needle!r} is empty or not lowercase")
        return found

    @property
    def sorted_entities(self) -> tuple[Entity, ...]:
        return tuple(sorted(self.entities, key=lambda e: e.name))

    @property
    def alias_count(self) -> int:
        return sum(len(e.strong) + len(e.weak) for e in self.entities)

    @property
    def starts(self) -> dict[str, date]:
        return {e.name: e.start for e in self.entities if e.start is not None}

    def start_of(self, entity: Column) -> Column:
        """Start date of the entity named by a column; NULL if it has none."""
        if not self.starts:
            return F.lit(None).cast("date")
        pairs = [F.lit(x) for item in self.starts.items() for x in item]
        return F.create_map(*pairs)[entity]

    def aliases_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (e.name, alias, tier)
            for e in self.entities
            for tier, aliases in (("strong", e.strong), ("weak", e.weak))
            for alias in aliases
        ]
        return _sized(spark, rows, ALIAS_SCHEMA)

    def starts_df(self, spark: SparkSession) -> DataFrame:
        return _sized(spark, list(self.starts.items()), START_DATE_SCHEMA)


def _sized(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """Rows as a frame whose size is known to the planner, so that the bytes decide whether it is broadcast."""
    arrow = {"string": pa.string(), "date": pa.date32()}
    columns = {f.name: pa.array([r[i] for r in rows], arrow[f.dataType.simpleString()]) for i, f in enumerate(schema)}
    return spark.createDataFrame(pa.table(columns), schema)


def catalog_key_gaps(aliases: DataFrame, starts: DataFrame) -> DataFrame:
    """Entities present on one side only, for catalogs kept as tables.

    Both sides are reduced to distinct keys before they meet, so a key with very
    many alias rows adds one row per task to the shuffle.
    """
    a, s = aliases.select("tool").distinct(), starts.select("tool").distinct()
    return (
        a.join(s, "tool", "left_anti")
        .withColumn("issue", F.lit("no start date"))
        .unionByName(s.join(a, "tool", "left_anti").withColumn("issue", F.lit("no alias")))
    )


# The tracked tools, their aliases and earliest dates.
AI_TOOLS = EntityCatalog(
    entities=(
        Entity("ChatGPT", ("chatgpt", "chat gpt", "gpt-4", "gpt4", "openai chat"), (), date(2022, 11, 1)),
        Entity("Claude", ("claude.ai", "anthropic claude", "claude ai"), ("claude",), date(2023, 3, 1)),
        Entity("Gemini", ("google gemini", "gemini ai"), ("gemini", "bard"), date(2023, 12, 1)),
        Entity("Perplexity", ("perplexity ai", "perplexity.ai"), ("perplexity",), date(2022, 12, 1)),
        Entity(
            "Cursor",
            ("cursor ai", "cursor editor", "cursor ide", "cursor.sh", "cursor.com"),
            (),
            date(2023, 3, 1),
        ),
        Entity("GitHub Copilot", ("github copilot", "gh copilot"), ("copilot",), date(2021, 6, 1)),
        Entity(
            "Windsurf",
            ("windsurf editor", "windsurf ide", "windsurf.dev", "codeium windsurf"),
            ("windsurf",),
            date(2024, 11, 1),
        ),
        Entity("NotebookLM", ("notebooklm", "notebook lm"), (), date(2023, 7, 1)),
        Entity("Lovable", ("lovable.dev", "lovable ai"), ("lovable",), date(2024, 11, 1)),
        Entity("Bolt.new", ("bolt.new", "stackblitz bolt"), ("bolt new", "boltnew"), date(2024, 9, 1)),
        Entity("v0", ("v0.dev", "v0 by vercel", "vercel v0"), (), date(2023, 10, 1)),
        Entity(
            "Replit Agent",
            ("replit agent", "replit ai agent", "replit ghostwriter"),
            (),
            date(2024, 9, 1),
        ),
    ),
    context=(
        "ai", "a.i.", "artificial intelligence", "llm", "chatbot", "chat bot",
        "coding assistant", "code assistant", "vibe coding", "ai prompt",
        "generative ai", "machine learning", "openai", "anthropic", "google ai",
        "app builder", "no-code app", "low-code app", "ai agent", "ai copilot",
        "language model", "ai model", "ai tool", "ai startup", "ai coding",
        "prompt engineering", "text-to-app", "text to app",
    ),
    exclusions=(
        "claude shannon",
        "claude monet",
        "claude debussy",
        "claude rains",
        "claude van damme",
    ),
)
