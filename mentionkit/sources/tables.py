"""Session-catalog tables: read, create, append, replace."""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from collections.abc import Collection, Mapping
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# formats whose tables are folders of files without a log of versions
_FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")

CODEC = "zstd"
"""How parquet files of tables are compressed."""

TIME, DAY = "ingested_at", "_ingested_day"


class Tables:
    """Named tables under an optional prefix, in one file format.

    ``prefix`` is a catalog or a start of the schema name; ``fmt`` any format the
    session can write. Plain file formats take one writer per table at a time:
    threads of this object wait for each other, other applications are not seen.

    Tables named in ``by_day`` are created with a folder per day of ``ingested_at``, or of the column that ``by_day`` gives for them, which
    ``read_since`` and ``read_days`` prune by; one that exists keeps the layout it has. The day is no column of what ``read`` returns.
    """

    def __init__(
        self, spark: SparkSession, prefix: str = "", fmt: str = "parquet", by_day: Collection[str] | Mapping[str, str] = ()
    ) -> None:
        self.spark = spark
        self.prefix = prefix
        self.fmt = fmt
        self.by_day = dict(by_day) if isinstance(by_day, Mapping) else dict.fromkeys(by_day, TIME)
        self._locks: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)

    def on(self, spark: SparkSession) -> Tables:
        """The same tables seen from another session, such as that of a micro-batch."""
        other = Tables(spark, self.prefix, self.fmt, self.by_day)
        other._locks = self._locks
        return other

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self._with_day(table).drop(DAY)

    def read_since(self, table: str, since: datetime | None) -> DataFrame:
        """The rows ingested at ``since`` or later; all of them if there is no mark yet."""
        rows = self._with_day(table)
        if since is not None:
            rows = rows.filter(F.col(TIME) >= F.lit(since))
            if DAY in rows.columns:
                # a day more, so that sessions of another time zone miss nothing
                rows = rows.filter(F.col(DAY) >= F.to_date(F.lit(since - timedelta(days=1))))
        return rows.drop(DAY)

    def read_days(self, table: str, days: Collection[date | None], time: str = TIME) -> DataFrame:
        """The rows of those days of the column ``time``; None is the day of rows without a time.

        A table laid out by that column opens the days' folders only. Any other is read by ranges of the column, which row groups
        without such rows are skipped by.
        """
        rows = self._with_day(table)
        known = sorted(d for d in days if d is not None)
        if DAY in rows.columns and self.by_day.get(table, TIME) == time:
            gapless = known and (known[-1] - known[0]).days + 1 == len(set(known))
            # a day each is a literal each
            wanted = F.col(DAY).between(known[0], known[-1]) if gapless else F.col(DAY).isin(known) if known else F.lit(False)
            return rows.filter(wanted | F.col(DAY).isNull() if None in days else wanted).drop(DAY)
        spans: list[list[date]] = []
        for d in known:
            if spans and spans[-1][1] == d:
                spans[-1][1] = d + timedelta(days=1)
            else:
                spans.append([d, d + timedelta(days=1)])
        parts = [(F.col(time) >= F.lit(a).cast("timestamp")) & (F.col(time) < F.lit(b).cast("timestamp")) for a, b in spans]
        if None in days:
            parts.append(F.col(time).isNull())
        return rows.filter(reduce(or_, parts, F.lit(False))).drop(DAY)

    def _with_day(self, table: str) -> DataFrame:
        # another session may have appended files since this one listed them
        self.spark.catalog.refreshTable(self.name(table))
        return self.spark.read.table(self.name(table))

    def read_if_exists(self, table: str) -> DataFrame | None:
        """None stands for the first run."""
        return self.read(table) if self.exists(table) else None

    def ensure(self, table: str, schema: T.StructType) -> None:
        """Create the table if it is absent."""
        name = self.name(table)
        database = name.rpartition(".")[0]
        if database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        layout = ""
        if table in self.by_day:
            if self.by_day[table] not in schema.names:
                raise ValueError(f"{name} has no column {self.by_day[table]} to be laid out by")
            columns, layout = f"{columns}, `{DAY}` date", f" PARTITIONED BY (`{DAY}`)"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {self.fmt}{self._options()}{layout}")

    def _options(self) -> str:
        return f" OPTIONS (compression '{CODEC}')" if self.fmt == "parquet" else ""

    def append(self, df: DataFrame, table: str, evolve: bool = False) -> int:
        """Append by column name and return the number of rows written.

        The count comes from the write itself, so the plan runs once. With
        ``evolve``, columns the table lacks are added to it first; columns the frame
        lacks are NULL.
        """
        with self._locks[table]:
            return self._append(df, table, evolve)

    def _append(self, df: DataFrame, table: str, evolve: bool) -> int:
        self.ensure(table, df.schema)
        name = self.name(table)
        target = self.spark.read.table(name).schema
        extra = [f for f in df.schema.fields if f.name not in target.names]
        if extra and not evolve:
            raise ValueError(f"{name} has no columns {[f.name for f in extra]}")
        changed = {
            f.name: wider for f in df.schema.fields
            if f.name in target.names and (wider := merged(target[f.name].dataType, f.dataType)) != _nullable(target[f.name].dataType)
        }
        nested = [n for n in changed if not isinstance(target[n].dataType, T.AtomicType)]
        if nested and not evolve:
            raise ValueError(f"{name} has other fields in {nested}")
        if changed and evolve:
            self._widen(table, changed)
        if extra:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
        target = self.spark.read.table(name).schema
        aligned = df.select([
            conformed(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType).alias(f.name)
            if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields if f.name != DAY
        ])
        folders = [DAY] if DAY in target.names else []
        if folders:
            time = self.by_day.get(table, TIME)
            aligned = aligned.withColumn(DAY, F.to_date(time))
            if time != TIME:
                # rows of one ingestion have a day or two, but any number of other days: each task would write a file for each of them
                aligned = aligned.hint("rebalance", DAY)
        written = Observation()
        counted = aligned.observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.format(self.fmt).mode("append").partitionBy(*folders).saveAsTable(name)
        return written.get["rows"]

    def _writer(self, df: DataFrame) -> DataFrameWriter:
        writer = df.write.format(self.fmt)
        return writer.option("compression", CODEC) if self.fmt == "parquet" else writer

    def _widen(self, table: str, types: Mapping[str, T.DataType]) -> None:
        """Give columns wider types. Files hold the old ones, so the rows are written once more and the table is exchanged for one with the wider types.

        A run that dies between the two renames leaves the old rows in ``<name>_before_...`` and the new ones in ``<name>_...``.
        """
        name = self.name(table)
        old = self.spark.read.table(name)
        rows = old.select([
            conformed(F.col(f"`{f.name}`"), f.dataType, types[f.name]).alias(f.name) if f.name in types else F.col(f"`{f.name}`")
            for f in old.schema.fields
        ])
        folder = f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"
        folders = [DAY] if DAY in old.columns else []
        self._writer(rows).partitionBy(*folders).save(folder)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        layout = f" PARTITIONED BY (`{DAY}`)" if folders else ""
        staged = f"{name}_{uuid.uuid4().hex[:8]}"
        self.spark.sql(f"CREATE TABLE {staged} ({columns}) USING {self.fmt}{self._options()}{layout} LOCATION '{folder}'")
        if folders:
            self.spark.sql(f"MSCK REPAIR TABLE {staged}")
        before = f"{name}_before_{uuid.uuid4().hex[:8]}"
        self.spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
        self.spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        self.spark.sql(f"DROP TABLE {before}")

    def replace(self, df: DataFrame, table: str) -> None:
        """Rebuild the table from the frame.

        With a plain file format the rows are written to a folder of their own, to which the table is then switched: a
        reader sees all old or all new rows, and a run that dies before the switch leaves the old ones. The old folder
        stays for those who still read it. Other formats overwrite in one step themselves.
        """
        name = self.name(table)
        if self.fmt not in _FILE_FORMATS:
            df.write.format(self.fmt).mode("overwrite").saveAsTable(name)
            return
        self.ensure(table, df.schema)
        if self.spark.read.table(name).schema.simpleString() != df.schema.simpleString():
            raise ValueError(f"{name} has other columns than the rows that replace it")
        folder = f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"
        self._writer(df).save(folder)
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(name)

    def replace_days(self, df: DataFrame, table: str, day: str) -> None:
        """Put the frame's rows in place of all rows of the same days; the table has a folder per value of the column ``day``.

        Spark writes all new folders before it takes any into place. A run that dies between two of them has replaced some days, so
        whoever calls this has to know the days until it returns, and can then run again.
        """
        name = self.name(table)
        with self._locks[table]:
            if not self.exists(table):
                database = name.rpartition(".")[0]
                if database:
                    self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {self.fmt}{self._options()} PARTITIONED BY (`{day}`)")
            target = self.spark.read.table(name)
            rows = df.select(*target.columns)
            # a setting of the session, as an insert into a table takes no option for it
            mode = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(mode)
            self.spark.conf.set(mode, "dynamic")
            try:
                rows.write.insertInto(name, overwrite=True)
            finally:
                self.spark.conf.set(mode, before)
            self.spark.catalog.refreshTable(name)

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")


# the widenings that lose nothing
_WIDER = {
    ("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"),
    ("float", "double"), ("int", "double"), ("date", "timestamp"),
}


def merged(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds values of both: fields of both inside structs, arrays and maps, the wider of two numbers; else the old one."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields = [T.StructField(f.name, merged(f.dataType, new[f.name].dataType) if f.name in new.names else _nullable(f.dataType)) for f in old.fields]
        return T.StructType([*fields, *(T.StructField(f.name, _nullable(f.dataType)) for f in new.fields if f.name not in old.names)])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged(old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, merged(old.valueType, new.valueType))
    return new if (old.simpleString(), new.simpleString()) in _WIDER else _nullable(old)


def _nullable(t: T.DataType) -> T.DataType:
    """The type as a table keeps it, with NULL allowed everywhere."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _nullable(t.valueType))
    return t


def conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value as ``want``: fields by name, those it lacks NULL."""
    if _nullable(have) == _nullable(want):
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        fields = [
            (conformed(value[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conformed(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(value, lambda _, x: conformed(x, have.valueType, want.valueType))
    return value.cast(want)
