"""The star schema: dimensions with stable integer keys, facts upserted at their grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from tidemark.functions import calendar_columns, date_key, month_key
from tidemark.operators.joins import lookup_join, measured_bytes
from tidemark.operators.merge import absent, insert_if_absent, number_members, upsert
from tidemark.operators.quality import count_orphans
from tidemark.plans.rollups import PARTIALS
from tidemark.sources import schemas
from tidemark.sources.partitions import Folders, PartitionedTable, Section, State, content_key, survivors
from tidemark.sources.registry import get_source
from tidemark.sources.storage import Snapshots, make_folder

MONTH = "month_key"
# Sections of a fact: its rows, where the row of a key is, and partial aggregates.
ROWS, INDEX, ROLLUP = "rows", "index", "rollup"
INDEX_BUCKETS = 16
# A batch of wide rows in so many partitions or fewer isn't shuffled by them.
FEW_PARTITIONS = 4
INDEX_SCHEMA = StructType([
    StructField("key", BinaryType()), StructField("partition", IntegerType()), StructField("bucket", IntegerType()),
])


@dataclass(frozen=True)
class Dimension:
    """`refreshed` attributes follow the latest load; without any a seen member never changes."""

    name: str
    key: str
    natural: tuple[str, ...]
    refreshed: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.natural, *self.refreshed]


@dataclass(frozen=True)
class Lookup:
    """Resolve Silver columns to a dimension's key; `role` names the key in the fact."""

    dimension: str
    silver_columns: tuple[str, ...]
    role: str
    how: str = "inner"


@dataclass(frozen=True)
class Fact:
    name: str
    source: str
    grain: tuple[str, ...]
    lookups: tuple[Lookup, ...]
    partition: str
    date_column: str | None = None
    # The row of a grain may move to another partition in a later load.
    moves: bool = False


DIMENSIONS = {
    d.name: d
    for d in (
        Dimension("dim_country", "country_key", ("country_iso3",), ("country_name",)),
        Dimension("dim_currency", "currency_key", ("currency_code",)),
        Dimension("dim_coin", "coin_key", ("coin_id",), ("symbol", "name")),
        Dimension("dim_location", "location_key", ("latitude", "longitude")),
        Dimension("dim_news_source", "news_source_key", ("source_name",)),
    )
}
_COUNTRY = (Lookup("dim_country", ("country_iso3",), "country_key"),)
FACTS = {
    f.name: f
    for f in (
        Fact("fact_gdp", "world_bank", ("country_key", "indicator_id", "year"), _COUNTRY, "year"),
        Fact(
            "fact_inflation",
            "world_bank_inflation",
            ("country_key", "indicator_id", "year"),
            _COUNTRY,
            "year",
        ),
        Fact(
            "fact_exchange_rate",
            "exchange_rate",
            ("base_currency_key", "quote_currency_key", "date_key"),
            (
                Lookup("dim_currency", ("base_code",), "base_currency_key"),
                Lookup("dim_currency", ("currency",), "quote_currency_key"),
            ),
            MONTH,
            date_column="logical_date",
        ),
        Fact(
            "fact_weather",
            "open_meteo",
            ("location_key", "date_key"),
            (Lookup("dim_location", ("latitude", "longitude"), "location_key"),),
            MONTH,
            date_column="date",
        ),
        Fact(
            "fact_crypto",
            "coingecko",
            ("coin_key", "date_key"),
            (Lookup("dim_coin", ("coin_id",), "coin_key"),),
            MONTH,
            date_column="logical_date",
        ),
        Fact(
            "fact_news",
            "newsapi",
            ("url",),
            (Lookup("dim_news_source", ("source_name",), "news_source_key", "left"),),
            MONTH,
            date_column="logical_date",
            moves=True,
        ),
    )
}
FACT_OF_SOURCE = {f.source: f for f in FACTS.values()}


def calendar(silver: DataFrame, date_column: str) -> DataFrame:
    """One calendar row per distinct known date; never more rows than the calendar has days."""
    days = silver.select(F.col(date_column).cast("date").alias("d")).where("d is not null").distinct()
    return days.select(*[c.cast("int").alias(n) if n.startswith("day_of") else c.alias(n)
                         for n, c in calendar_columns(F.col("d")).items()])


def members(silver: DataFrame, dimension: Dimension, lookups: Sequence[Lookup]) -> DataFrame:
    """Distinct known members of a dimension, over every role it plays in the source."""
    found = None
    for lookup in lookups:
        named = dict(zip(lookup.silver_columns, dimension.natural, strict=True))
        role = silver.select(*[F.col(s).alias(n) for s, n in named.items()], *dimension.refreshed)
        role = role.na.drop(subset=list(dimension.natural))
        if dimension.refreshed:
            # One value per member; the greatest known one, so that a reload finds the same.
            attributes = [F.max(c).alias(c) for c in dimension.refreshed]
            role = role.groupBy(*dimension.natural).agg(*attributes)
        found = role if found is None else found.unionByName(role)
    return found if dimension.refreshed else found.distinct()


def narrow_columns(source: str) -> list[str]:
    """Silver columns that the dimensions and the calendar are loaded from."""
    fact = FACT_OF_SOURCE[source]
    own = [c for lookup in fact.lookups for c in (*lookup.silver_columns, *DIMENSIONS[lookup.dimension].refreshed)]
    return list(dict.fromkeys([*own, *([fact.date_column] if fact.date_column else [])]))


class Warehouse:
    """The star schema under one root folder.

    Dimensions are small and kept as complete snapshots. Facts are partitioned by month or year, and
    a load replaces the partitions its rows fall into, all at once and with one write, so its cost
    follows the batch, not the history.
    """

    def __init__(self, spark: SparkSession, root: str, rollups: bool = False) -> None:
        """With `rollups`, loads keep partial aggregates of the facts; once kept, every later load goes on."""
        self.spark, self.root, self.rollups = spark, root.rstrip("/"), rollups
        self._measured: dict[tuple[str, str | None], int] = {}

    def _schema(self, name: str):
        return schemas.struct(schemas.WAREHOUSE[name])

    def _dimension(self, name: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/{name}", self._schema(name))

    def _fact_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create_schema(self) -> None:
        """Make a folder for every table; one without data reads as empty, others stay as they are."""
        for name in schemas.WAREHOUSE:
            make_folder(self.spark, f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        """A table with its declared columns; empty when nothing was loaded yet."""
        if name not in schemas.WAREHOUSE:
            raise ValueError(f"unknown table {name!r}; known: {sorted(schemas.WAREHOUSE)}")
        if name not in FACTS:
            return self._dimension(name).read()
        return self._stored(FACTS[name]).select(*self._schema(name).fieldNames())

    def _fact(self, fact: Fact) -> PartitionedTable:
        sections = {ROWS: Section(self._schema(fact.name), fact.partition, fact.grain)}
        if fact.moves:
            sections[INDEX] = Section(INDEX_SCHEMA, "bucket", ("key",))
        if fact.name in PARTIALS:
            kept = PARTIALS[fact.name]
            sections[ROLLUP] = Section(kept.schema(fact.partition), fact.partition, kept.entity)
        return PartitionedTable(self.spark, self._fact_path(fact.name), sections)

    def _stored(self, fact: Fact) -> DataFrame:
        return self._fact(fact).read(ROWS)

    def key_of(self, name: str, natural: Mapping[str, Any]) -> int | None:
        """Key of one dimension member, None when there is no such member."""
        members = self.table(name)
        for column, value in natural.items():
            members = members.where(F.col(column) == F.lit(value))
        found = members.select(DIMENSIONS[name].key).first()
        return found[0] if found else None

    def slice(
        self,
        name: str,
        entity: Mapping[str, Any] | None = None,
        since: date | int | None = None,
        until: date | int | None = None,
    ) -> DataFrame:
        """Rows of a fact for some entity and span of days (or years), filtered in the file scan.

        `entity` names Silver columns; each set of them that identifies a dimension member is turned
        into its key, which the stored rows are sorted by. The span prunes partitions.
        """
        fact, rows, entity = FACTS[name], self._stored(FACTS[name]), entity or {}
        for lookup in fact.lookups:
            given = [entity.get(c) for c in lookup.silver_columns]
            if any(value in (None, "") for value in given):
                continue
            natural = dict(zip(DIMENSIONS[lookup.dimension].natural, given, strict=True))
            key = self.key_of(lookup.dimension, natural)
            rows = rows.where(F.lit(False) if key is None else F.col(lookup.role) == key)
        time = "date_key" if fact.date_column else "year"
        for bound, keeps in ((since, Column.__ge__), (until, Column.__le__)):
            if bound is None:
                continue
            number = bound if isinstance(bound, int) else int(f"{bound:%Y%m%d}")
            rows = rows.where(keeps(F.col(time), F.lit(number)))
            if fact.partition == MONTH:
                rows = rows.where(keeps(F.col(MONTH), F.lit(number // 100)))
        return rows.select(*self._schema(name).fieldNames())

    def dimension_bytes(self, name: str) -> int:
        """Measured size of a dimension, taken once per snapshot."""
        state = (name, self._dimension(name).current())
        if state not in self._measured:
            self._measured[state] = measured_bytes(self.table(name))
        return self._measured[state]

    def describe(
        self, rows: DataFrame, name: str, on: Sequence[str], how: str = "inner", **renamed: str
    ) -> DataFrame:
        """Join rows to a dimension, some of whose columns are renamed (new=old) first."""
        table = self.table(name)
        old = set(renamed.values())
        kept = [F.col(c) for c in table.columns if c not in old]
        table = table.select(*kept, *[F.col(o).alias(n) for n, o in renamed.items()])
        return lookup_join(rows, table, on, how, self.dimension_bytes(name))

    # -- dimensions

    def load_calendar(self, silver: DataFrame, date_column: str) -> None:
        table = self._dimension("dim_date")
        table.replace(insert_if_absent(table.read(), calendar(silver, date_column), ["date_key"]))

    def load_dimension(self, silver: DataFrame, name: str, lookups: Sequence[Lookup]) -> None:
        """Refresh the attributes of seen members and number the unseen ones."""
        dimension = DIMENSIONS[name]
        table = self._dimension(name)
        existing, incoming = table.read(), members(silver, dimension, lookups)
        last = existing.agg(F.max(dimension.key)).first()[0] or 0
        unseen = number_members(
            absent(incoming, existing, dimension.natural), dimension.natural, dimension.key, last
        )
        if dimension.refreshed:
            keyed = existing.select(dimension.key, *dimension.natural).join(
                incoming, list(dimension.natural)
            )
            existing = upsert(existing, keyed.select(existing.columns), [dimension.key])
        table.replace(existing.unionByName(unseen))

    # -- facts

    def resolve(self, silver: DataFrame, fact: Fact) -> DataFrame:
        """Silver rows as fact rows: natural keys replaced by dimension keys."""
        rows = silver
        for lookup in fact.lookups:
            dimension = DIMENSIONS[lookup.dimension]
            named = dict(zip(dimension.natural, lookup.silver_columns, strict=True))
            table = self.table(lookup.dimension).select(
                F.col(dimension.key).alias(lookup.role),
                *[F.col(n).alias(s) for n, s in named.items()],
            )
            size = self.dimension_bytes(lookup.dimension)
            rows = lookup_join(rows, table, lookup.silver_columns, lookup.how, size)
        if fact.date_column:
            rows = rows.withColumn("date_key", date_key(F.col(fact.date_column).cast("date")))
        for column in fact.grain:
            missing = F.raise_error(F.lit(f"{fact.name}: {column} must not be null"))
            rows = rows.withColumn(column, F.coalesce(F.col(column), missing))
        return rows.select(*self._schema(fact.name).fieldNames())

    def _partitioned(self, rows: DataFrame, fact: Fact) -> DataFrame:
        if fact.partition == MONTH:
            rows = rows.withColumn(MONTH, month_key(F.col("date_key")))
        return rows

    def merge_fact(self, rows: DataFrame, fact: Fact, dealt: bool = True) -> None:
        """Upsert rows (unique on the grain) into the stored fact.

        The rows are written once, into a folder of their own. Of the partitions they fall into, stored
        rows with other keys are carried over; then all these partitions switch at once. Running a
        failed load again gives the same result.

        Where a row may have moved from, an index of key and partition tells: it is read in the buckets
        of the batch's keys, and no stored row beyond the partitions it names.

        Unless `dealt`, the batch is written as its tasks hold it (see `PartitionedTable.write`).
        """
        table = self._fact(fact)
        base = table.state()
        batch = table.write(ROWS, self._partitioned(rows, fact), dealt)
        fresh = table.open(ROWS, batch.folders)
        changes = {ROWS: dict(batch.folders)}
        replaced = batch.values & set(base.of(ROWS))
        if fact.moves:
            moved_from, changes[INDEX] = self._index(table, base, fresh, fact)
            replaced |= moved_from & set(base.of(ROWS))
        if replaced:
            kept = survivors(table.read(ROWS, replaced, base), fresh, fact.grain)
            carried = table.write(ROWS, kept).folders if kept is not None else {}
            for value in replaced:
                changes[ROWS][value] = batch.folders.get(value, ()) + carried.get(value, ())
        if fact.name in PARTIALS and (self.rollups or base.of(ROLLUP)):
            changes[ROLLUP] = self._rolled_up(table, base, changes[ROWS], fact)
        table.publish(base, changes)

    def _rolled_up(
        self, table: PartitionedTable, base: State, changed: dict[int, Folders], fact: Fact
    ) -> dict[int, Folders]:
        """Partial aggregates of the changed partitions, or of all if none have been kept yet."""
        now = changed if base.of(ROLLUP) else {**base.of(ROWS), **changed}
        rows = table.open(ROWS, {v: f for v, f in now.items() if f})
        kept = table.write(ROLLUP, PARTIALS[fact.name].of(rows, fact.partition))
        return {v: kept.folders.get(v, ()) for v in now}

    def partials(self, name: str) -> DataFrame:
        """The kept partial aggregates of a fact, one row per entity and partition."""
        table = self._fact(FACTS[name])
        state = table.state()
        if state.of(ROWS) and not state.of(ROLLUP):
            raise ValueError(f"{name}: no roll-ups are kept; load with Warehouse(..., rollups=True)")
        return table.read(ROLLUP, state=state)

    def _index(
        self, table: PartitionedTable, base: State, fresh: DataFrame, fact: Fact
    ) -> tuple[set[int], dict[int, Folders]]:
        """The partitions that keys of a batch are in so far, and the folders of the index after it."""
        key = content_key(*fact.grain)
        bucket = F.pmod(F.xxhash64("key"), F.lit(INDEX_BUCKETS)).cast("int")
        entries = fresh.select(key.alias("key"), F.col(fact.partition).alias("partition")).withColumn("bucket", bucket)
        batch = table.write(INDEX, entries)
        changes = dict(batch.folders)
        known = table.read(INDEX, batch.values, base)
        own = table.open(INDEX, batch.folders)
        # At most one value per month or year.
        hits = known.join(own.select("key"), "key", "left_semi").select("partition").distinct()
        moved_from = {r[0] for r in hits.collect()}
        kept = survivors(known, own, ["key"])
        carried = table.write(INDEX, kept).folders if kept is not None else {}
        return moved_from, {v: f + carried.get(v, ()) for v, f in changes.items()}

    def load_dimensions(self, source: str, silver: DataFrame) -> None:
        """Load the members of all dimensions that the rows of a source name."""
        by_dimension: dict[str, list[Lookup]] = {}
        for lookup in FACT_OF_SOURCE[source].lookups:
            by_dimension.setdefault(lookup.dimension, []).append(lookup)
        for name, lookups in by_dimension.items():
            self.load_dimension(silver, name, lookups)

    def load(self, source: str, silver: DataFrame, narrow: DataFrame | None = None) -> None:
        """Load one Silver dataset: its dimensions first, then its fact.

        The dataset is read once per step, so it should be stored rather than a long plan. Where rows are
        too wide to be stored twice, `narrow` has their columns `narrow_columns(source)`, stored, and
        `silver` may be a plan: it is run once, and its rows aren't shuffled again if they fall into few
        partitions.
        """
        get_source(source)
        fact, described = FACT_OF_SOURCE[source], silver if narrow is None else narrow
        self.load_dimensions(source, described)
        dealt = True
        if fact.date_column:
            self.load_calendar(described, fact.date_column)
            if narrow is not None and fact.partition == MONTH:
                months = narrow.select(F.trunc(fact.date_column, "month")).distinct()
                dealt = months.limit(FEW_PARTITIONS + 1).count() > FEW_PARTITIONS
        self.merge_fact(self.resolve(silver, fact), fact, dealt)

    # -- checks

    def integrity(self, fact_name: str, rows: DataFrame | None = None) -> DataFrame:
        """One row per rule of a fact: check, column, violations. With `rows` these are checked before they
        are loaded, instead of the stored ones."""
        fact = FACTS[fact_name]
        rows = self.table(fact_name) if rows is None else rows
        reports = []

        def report(check: str, column: str, violations: DataFrame) -> None:
            reports.append(
                violations.select(
                    F.lit(fact_name).alias("fact"),
                    F.lit(check).alias("check"),
                    F.lit(column).alias("column"),
                    "violations",
                )
            )

        for lookup in fact.lookups:
            dimension = DIMENSIONS[lookup.dimension]
            keys = self.table(lookup.dimension).select(F.col(dimension.key).alias(lookup.role))
            report("reference", lookup.role, count_orphans(rows, keys, [lookup.role]))
        if "date_key" in rows.columns:
            report("reference", "date_key", count_orphans(rows, self.table("dim_date"), ["date_key"]))
        repeated = rows.groupBy(*fact.grain).count().where("count > 1")
        report(
            "unique", ",".join(fact.grain), repeated.agg(F.count(F.lit(1)).alias("violations"))
        )
        # All null checks of a fact share one scan.
        required = [*fact.grain, *[c for c in ("date_key",) if c in rows.columns]]
        required = list(dict.fromkeys(required))
        nulls = rows.agg(
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(required)]
        )
        listed = [
            F.struct(
                F.lit(fact_name).alias("fact"),
                F.lit("not_null").alias("check"),
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("violations"),
            )
            for i, c in enumerate(required)
        ]
        result = nulls.select(F.inline(F.array(*listed)))
        for part in reports:
            result = result.unionByName(part)
        return result
