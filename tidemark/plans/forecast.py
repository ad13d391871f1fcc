"""Forecasts: pooled regressions per domain, a run log, a registry and batch scoring."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import lookup_join
from tidemark.operators.merge import upsert
from tidemark.operators.regression import LinearModel, error_metrics, least_squares
from tidemark.operators.series import last_per_entity, split_holdout
from tidemark.plans import views
from tidemark.plans.warehouse import Warehouse
from tidemark.session import scratch_path
from tidemark.sources import schemas
from tidemark.sources.partitions import ConflictError, PartitionedTable, Section
from tidemark.sources.storage import create_exclusively, delete, exists, files_in

# The least number of usable rows and the name of the promoted version.
MIN_ROWS = 4
CHAMPION = "champion"
ALIASES, ALIAS_PARTS = "rows", 16


class InsufficientDataError(Exception):
    """A domain has too little history to be trained on."""


class UnknownDomainError(ValueError):
    """No forecast is defined for that domain."""


class MissingParameterError(ValueError):
    """A forecast was asked for without naming its entity."""


@dataclass(frozen=True)
class Forecast:
    """What to predict for a domain and from which two features."""

    domain: str
    view: Callable[..., DataFrame]
    entity: tuple[str, ...]
    time: str
    target: str
    lag: str
    rolling: str
    # Targets that grow by multiples across entities are fitted on a log scale.
    log_scale: bool = True
    upper: bool = True
    parameters: tuple[str, ...] = ("country",)
    # What settles rows of one entity and time: a country has a row per indicator.
    ties: tuple[str, ...] = ()

    @property
    def model(self) -> str:
        return f"{self.domain}_forecast"

    @property
    def features(self) -> tuple[str, str]:
        return (self.lag, self.rolling)

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.ties)


FORECASTS = {
    f.domain: f
    for f in (
        Forecast(
            "gdp", views.view_gdp, ("country_iso3",), "year",
            "gdp_usd", "lag1_gdp_usd", "gdp_3yr_avg_usd", ties=("indicator_id",),
        ),
        Forecast(
            "inflation", views.view_inflation, ("country_iso3",), "year",
            "inflation_pct", "lag1_inflation_pct", "inflation_3yr_avg_pct", log_scale=False,
            ties=("indicator_id",),
        ),
        Forecast(
            "exchange_rate", views.view_exchange_rate, ("base_code", "currency"), "date",
            "rate", "lag1_rate", "rate_7d_avg", parameters=("base", "quote"),
        ),
        Forecast(
            "crypto", views.view_crypto, ("coin_id",), "date",
            "price_usd", "lag1_price_usd", "price_7d_avg_usd", upper=False,
            parameters=("coin_id",),
        ),
    )
}


def get_forecast(domain: str) -> Forecast:
    if domain not in FORECASTS:
        raise UnknownDomainError(f"unknown domain {domain!r}; known: {sorted(FORECASTS)}")
    return FORECASTS[domain]


def usable_rows(view: DataFrame, spec: Forecast) -> DataFrame:
    """Rows with both features and the target, the latest of each entity marked as holdout."""
    needed = [*spec.entity, *spec.order, *spec.features, spec.target]
    rows = view.select(*needed).na.drop(subset=[*spec.features, spec.target])
    return split_holdout(rows, spec.entity, spec.order)


@dataclass(frozen=True)
class Training:
    spec: Forecast
    model: LinearModel
    metrics: dict[str, float]
    train_rows: int
    test_rows: int
    params: dict[str, str] = field(default_factory=dict)


def train(view: DataFrame, spec: Forecast) -> Training:
    """Fit on all but the latest row of each entity and measure on those.

    Two aggregates: only the fitted numbers and the two errors reach the driver.
    """
    rows = usable_rows(view, spec)
    fitted = least_squares(
        rows.where("not is_holdout"), *spec.features, spec.target, spec.log_scale
    ).first()
    train_rows = fitted["train_rows"]
    if not train_rows:
        usable = rows.count()
        reason = "nothing to train on" if usable >= MIN_ROWS else f"fewer than {MIN_ROWS} rows"
        raise InsufficientDataError(f"{spec.domain}: {usable} usable rows, {reason}")
    model = LinearModel(
        fitted["intercept"], fitted["coef_lag"], fitted["coef_rolling"], spec.log_scale
    )
    scored = rows.where("is_holdout").withColumn("predicted", _predict(model, spec))
    errors = error_metrics(scored, spec.target, "predicted").first()
    if train_rows + errors["test_rows"] < MIN_ROWS:
        raise InsufficientDataError(
            f"{spec.domain}: {train_rows + errors['test_rows']} usable rows, fewer than {MIN_ROWS}"
        )
    kind = "log_linear_regression" if spec.log_scale else "linear_regression"
    return Training(
        spec,
        model,
        {"mae": errors["mae"], "rmse": errors["rmse"]},
        train_rows,
        errors["test_rows"],
        {"model_type": kind, "features": ",".join(spec.features)},
    )


def _predict(model: LinearModel, spec: Forecast) -> Column:
    return model.predict(F.col(spec.lag), F.col(spec.rolling))


# -- promotion and listing as set operations over registry-shaped frames


def promotion_decisions(candidates: DataFrame, champions: DataFrame) -> DataFrame:
    """Candidates (model, version, mae) against champions (model, champion_mae).

    A candidate is promoted when its model has no champion or it is strictly better.
    """
    better = F.col("champion_mae").isNull() | (F.col("mae") < F.col("champion_mae"))
    return lookup_join(candidates, champions, ["model"], "left").withColumn("promote", better)


def registry_listing(versions: DataFrame, aliases: DataFrame, runs: DataFrame) -> DataFrame:
    """Per model: latest version, champion version and the champion's metrics (empty if none)."""
    latest = versions.groupBy("model").agg(F.max("version").alias("latest_version"))
    champion = (
        aliases.where(F.col("alias") == CHAMPION)
        .select("model", "version")
        .join(versions, ["model", "version"])
        .join(runs.select("run_id", "metrics"), "run_id")
        .select("model", F.col("version").alias("champion_version"), "metrics")
    )
    none = F.create_map().cast("map<string,double>")
    return latest.join(champion, "model", "left").select(
        F.col("model").alias("name"),
        "latest_version",
        "champion_version",
        F.coalesce("metrics", none).alias("metrics"),
    )


class Registry:
    """Run log, model versions and aliases as three tables under one root, for any number of writers.

    Runs and versions are only ever added: each is appended as files of its own, and nothing that is
    there is read or written again. A version belongs to whoever creates its claim, a small file that can
    be created once. Aliases are a small table whose partitions (by a hash of the model) switch at once;
    who loses such a switch tries again on what is there then.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        aliases = schemas.struct(schemas.REGISTRY["model_aliases"])
        part = T.StructField("part", T.IntegerType())
        self._aliases = PartitionedTable(
            spark, f"{self.root}/model_aliases", {ALIASES: Section(T.StructType([*aliases.fields, part]), "part", ("model",))}
        )

    def table(self, name: str) -> DataFrame:
        schema, path = schemas.struct(schemas.REGISTRY[name]), f"{self.root}/{name}"
        if name == "model_aliases":
            return self._aliases.read(ALIASES).select(*schema.fieldNames())
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def _append(self, name: str, rows: DataFrame) -> None:
        """Add rows in a folder of their own: writers that commit into one folder disturb each other."""
        rows.write.parquet(f"{self.root}/{name}/{uuid.uuid4().hex}")

    def _add(self, name: str, row: tuple) -> None:
        self._append(name, self.spark.createDataFrame([row], schemas.struct(schemas.REGISTRY[name])).coalesce(1))

    def log_run(self, result: Training) -> str:
        """Record a finished training; this neither registers nor promotes it."""
        run_id = uuid.uuid4().hex
        m = result.model
        self._add(
            "model_runs",
            (
                run_id, result.spec.model, result.params, result.metrics, m.intercept, m.coef_lag,
                m.coef_rolling, m.log_scale, result.train_rows, result.test_rows,
                datetime.now(timezone.utc),
            ),
        )
        return run_id

    def _claim(self, model: str, by: str, count: int = 1) -> list[int]:
        """The next versions of a model, claimed by creating a file for each that didn't exist."""
        folder = f"{self.root}/model_claims/{quote(model, safe='')}"
        taken = files_in(self.spark, folder)
        version, found = int(taken[-1]) if taken else 0, []
        while len(found) < count:
            version += 1
            if create_exclusively(self.spark, f"{folder}/{version:09d}", by):
                found.append(version)
        return found

    def register(self, model: str, run_id: str) -> int:
        """Register a run as the next version of its model; no other writer gets the same."""
        (version,) = self._claim(model, run_id)
        self._add("model_versions", (model, version, run_id))
        return version

    def log_and_register(self, runs: DataFrame) -> None:
        """Log many finished runs and register them as versions, in the order in which they were logged.

        Runs are appended as one frame. What comes to the driver is the number of runs of each model, to
        claim their versions.
        """
        schema = schemas.struct(schemas.REGISTRY["model_runs"])
        path = scratch_path(self.spark, "runs")
        runs.select(*schema.fieldNames()).write.parquet(path)
        logged = self.spark.read.schema(schema).parquet(path)
        counts = sorted((r["model"], r["count"]) for r in logged.groupBy("model").count().collect())
        batch = uuid.uuid4().hex
        claimed = [(m, i, v) for m, n in counts for i, v in enumerate(self._claim(m, batch, n), 1)]
        places = self.spark.createDataFrame(claimed, "model string, place int, version int")
        own = Window.partitionBy("model").orderBy("started_at", "run_id")
        numbered = logged.select("model", "run_id", F.row_number().over(own).alias("place"))
        self._append("model_runs", logged)
        self._append("model_versions", numbered.join(places, ["model", "place"]).select("model", "version", "run_id"))
        delete(self.spark, path)

    def promote_best(self) -> None:
        """Promote the best version of every model whose champion it beats strictly."""
        runs = self.table("model_runs").select("run_id", F.col("metrics")["mae"].alias("mae"))
        scored = self.table("model_versions").join(runs, "run_id").where("mae is not null")
        best = scored.groupBy("model").agg(F.min(F.struct("mae", "version")).alias("best"))
        champions = self.table("model_aliases").where(F.col("alias") == CHAMPION).select("model", "version")
        champions = champions.join(scored, ["model", "version"]).select("model", F.col("mae").alias("champion_mae"))
        decided = promotion_decisions(best.select("model", "best.version", "best.mae"), champions)
        # At most one row a model.
        self._point([(r["model"], r["version"]) for r in decided.where("promote").collect()])

    def champion(self, model: str):
        """The run behind the promoted version (with `version`), or None."""
        alias = self.table("model_aliases").where(
            (F.col("model") == model) & (F.col("alias") == CHAMPION)
        )
        versions = self.table("model_versions")
        runs = self.table("model_runs").drop("model")
        found = alias.join(versions, ["model", "version"]).join(runs, "run_id")
        return found.first()

    def champion_model(self, domain: str) -> tuple[LinearModel, int] | None:
        row = self.champion(get_forecast(domain).model)
        if row is None:
            return None
        model = LinearModel(
            row["intercept"], row["coef_lag"], row["coef_rolling"], row["log_scale"]
        )
        return model, row["version"]

    def should_promote(self, model: str, mae: float) -> bool:
        current = self.champion(model)
        return current is None or mae < current["metrics"]["mae"]

    def promote(self, model: str, version: int) -> None:
        """Point the champion alias of a model at a version."""
        self._point([(model, version)])

    def _point(self, champions: list[tuple[str, int]]) -> None:
        if not champions:
            return
        part = F.pmod(F.xxhash64("model"), F.lit(ALIAS_PARTS)).cast("int").alias("part")
        rows = [(model, CHAMPION, version) for model, version in champions]
        while True:
            base = self._aliases.state()
            moved = self.spark.createDataFrame(rows, schemas.struct(schemas.REGISTRY["model_aliases"])).select("*", part)
            parts = {r[0] for r in moved.select("part").distinct().collect()}
            kept = self._aliases.read(ALIASES, parts, base)
            switched = upsert(kept, moved.select(*kept.columns), ["model", "alias"])
            try:
                self._aliases.publish(base, {ALIASES: self._aliases.write(ALIASES, switched).folders})
                return
            except ConflictError:
                continue

    def listing(self) -> DataFrame:
        return registry_listing(
            self.table("model_versions"), self.table("model_aliases"), self.table("model_runs")
        )


def train_register_deploy(wh: Warehouse, registry: Registry, domain: str) -> dict:
    """The training chain of one domain; says what was registered and whether it was promoted."""
    spec = get_forecast(domain)
    result = train(spec.view(wh), spec)
    run_id = registry.log_run(result)
    version = registry.register(spec.model, run_id)
    promoted = registry.should_promote(spec.model, result.metrics["mae"])
    if promoted:
        registry.promote(spec.model, version)
    return {
        "model": spec.model,
        "run_id": run_id,
        "version": version,
        "promoted": promoted,
        **result.metrics,
    }


# -- scoring


def score_latest(
    view: DataFrame, spec: Forecast, champion: tuple[LinearModel, int] | None
) -> DataFrame:
    """Forecast for the latest row of every entity, with a status instead of an error.

    status: ok, not_enough_history (a feature is unknown), no_champion.
    """
    latest = last_per_entity(
        view.select(*spec.entity, *spec.order, *spec.features), spec.entity, spec.order
    )
    enough = F.col(spec.lag).isNotNull() & F.col(spec.rolling).isNotNull()
    predicted = F.lit(None).cast("double")
    version = F.lit(None).cast("int")
    ready = F.lit("no_champion")
    if champion is not None:
        model, number = champion
        predicted = F.when(enough, _predict(model, spec))
        version, ready = F.when(enough, F.lit(number)), F.lit("ok")
    return latest.select(
        F.lit(spec.domain).alias("domain"),
        *spec.entity,
        spec.time,
        *spec.features,
        F.when(enough, ready).otherwise(F.lit("not_enough_history")).alias("status"),
        predicted.alias("predicted_value"),
        version.alias("model_version"),
    )


def answers(requests: DataFrame, scores: DataFrame, spec: Forecast) -> DataFrame:
    """A row for every request (its columns are the spec's entity) with the forecast or why there is none.

    status: missing_parameter (a name is unknown or empty), no_data (nobody knows the entity), and those of
    `score_latest`. Names are folded as the domain writes them; repeated requests get a row each.
    """
    fold = F.upper if spec.upper else F.lower
    folded = [fold(c).alias(f"__{c}") for c in spec.entity]
    asked = requests.select(*spec.entity, *folded)
    known = [(asked[f"__{c}"] == scores[c]) & (asked[f"__{c}"] != "") for c in spec.entity]
    condition = known[0]
    for one in known[1:]:
        condition = condition & one
    joined = asked.join(scores, condition, "left")
    missing = F.lit(False)
    for c in spec.entity:
        missing = missing | F.coalesce(asked[c] == "", F.lit(True))
    status = F.when(missing, "missing_parameter").otherwise(F.coalesce(scores["status"], F.lit("no_data")))
    return joined.select(
        *[asked[c] for c in spec.entity], status.alias("status"), scores["predicted_value"], scores["model_version"]
    )


def predict(wh: Warehouse, registry: Registry, domain: str, **entity: str) -> dict:
    """Forecast for one entity; `status` is also no_data when the warehouse does not know it."""
    spec = get_forecast(domain)
    missing = [p for p in spec.parameters if not entity.get(p)]
    if missing:
        raise MissingParameterError(f"{domain} needs {', '.join(missing)}")
    folded = {p: entity[p].upper() if spec.upper else entity[p].lower() for p in spec.parameters}
    view = spec.view(wh, entity=dict(zip(spec.entity, folded.values(), strict=True)))
    row = score_latest(view, spec, registry.champion_model(domain)).first()
    answer = {"domain": domain, "entity": folded, "status": "no_data"}
    if row is not None:
        answer.update(
            status=row["status"],
            predicted_value=row["predicted_value"],
            based_on={f: row[f] for f in spec.features},
            model_version=row["model_version"],
        )
    return answer
