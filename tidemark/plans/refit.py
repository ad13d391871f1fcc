"""Forecast models fitted again from kept moments instead of from all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.moments import merged, moments, products, without_row
from tidemark.operators.regression import scaled, solved
from tidemark.plans.forecast import Forecast
from tidemark.sources.partitions import PartitionedTable, Section

NAMES = ("a", "b", "y")  # lagged value, rolling mean, target
KEPT = "moments"


class MomentStore:
    """Moments of one domain's usable rows, per entity and period (a month, or a year), in one table.

    A batch replaces the periods it has rows of, so it has to bring these whole; its cost follows the batch.
    With the moments of an entity and period goes its latest row, because a fit leaves out the latest row
    of every entity: that row is taken out of the moments again.
    """

    def __init__(self, spark: SparkSession, path: str, spec: Forecast, view: DataFrame) -> None:
        """`view` gives the types of entity and time; its rows are not read."""
        self.spec = spec
        of = {c: view.schema[c].dataType for c in (*spec.entity, *spec.order)}
        numbers = ["n", *[f"mean_{v}" for v in NAMES], *[c for c, _, _ in products(NAMES)]]
        last = T.StructType([
            *[T.StructField(c, of[c]) for c in spec.order], *[T.StructField(v, T.DoubleType()) for v in NAMES],
        ])
        schema = T.StructType([
            *[T.StructField(c, of[c]) for c in spec.entity], T.StructField("period", T.IntegerType()),
            T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in numbers[1:]], T.StructField("last", last),
        ])
        self.table = PartitionedTable(spark, path, {KEPT: Section(schema, "period", spec.entity)})

    def _period(self) -> Column:
        time = F.col(self.spec.time)
        return time if self.spec.time == "year" else F.year(time) * 100 + F.month(time)

    def _values(self) -> dict[str, Column]:
        columns = (*self.spec.features, self.spec.target)
        return {v: scaled(F.col(c), self.spec.log_scale) for v, c in zip(NAMES, columns, strict=True)}

    def add(self, rows: DataFrame) -> None:
        """Take in rows of the domain's view; those of a period replace what was kept of it."""
        known = rows.na.drop(subset=[*self.spec.features, self.spec.target])
        known = known.select(*self.spec.entity, *self.spec.order, self._period().cast("int").alias("period"),
                             *[c.alias(v) for v, c in self._values().items()])
        by = [*self.spec.entity, "period"]
        numbers = moments(known, by, **{v: F.col(v) for v in NAMES})
        order = F.struct(*self.spec.order)
        latest = known.groupBy(*by).agg(F.max_by(F.struct(*self.spec.order, *NAMES), order).alias("last"))
        same = [numbers[c].eqNullSafe(latest[c]) for c in by]
        kept = numbers.join(latest, same).select(*[numbers[c] for c in numbers.columns], "last")
        base = self.table.state()
        self.table.publish(base, {KEPT: self.table.write(KEPT, kept).folders})

    def training_moments(self) -> DataFrame:
        """Moments per entity and period of all rows but the latest of each entity."""
        kept = self.table.read(KEPT)
        entity = list(self.spec.entity)
        newest = kept.groupBy(*entity).agg(F.max("period").alias("__newest"))
        newest = newest.select(*[F.col(c).alias(f"__{c}") for c in entity], "__newest")
        same = [kept[c].eqNullSafe(newest[f"__{c}"]) for c in entity]
        marked = kept.join(newest, same).withColumn("held", F.col("period") == F.col("__newest"))
        marked = marked.where("not held or n > 1")
        left = without_row(NAMES, {v: F.col(f"last.{v}") for v in NAMES})
        columns = ["n", *[f"mean_{v}" for v in NAMES], *[c for c, _, _ in products(NAMES)]]
        return marked.select(*entity, "period", *[F.when(F.col("held"), left[c]).otherwise(F.col(c)).alias(c) for c in columns])

    def fit(self) -> DataFrame:
        """One row: intercept, coef_lag, coef_rolling, train_rows, as `least_squares` gives for the rows."""
        total = merged(self.training_moments(), NAMES)
        n = F.col("n")
        return solved(
            total.select(
                n.alias("train_rows"), F.col("mean_a").alias("ma"), F.col("mean_b").alias("mb"), F.col("mean_y").alias("my"),
                *[F.try_divide(F.col(c), n).alias(c.replace("_", "")) for c in ("a_a", "b_b", "a_b", "a_y", "b_y")],
            )
        )
