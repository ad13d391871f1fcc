"""Toxicity by compression distance: how much better a window compresses with a dictionary of toxic
text than with one of ordinary text."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch
from tidemark.llm.words import give_back, trimmed

#: At most so many labelled rows of each class are learnt from (those of the smallest id hashes).
SAMPLE_ROWS = 16_384
GRAM = 5  # characters in a unit
WINDOW = 32  # characters in a window; a longer word is cut
TOXIC_UNITS, ORDINARY_UNITS = 4_096, 32_768  # units in a dictionary, and as many beginnings and words
STRICT, LOOSE = 20.0, 6.0  # how many times as frequent in toxic text a unit of a toxic dictionary is
THRESHOLDS = (1, 2, 4, 6, 8, 10, 12, 16, 20, 24, 32)  # bytes that a window may have to gain; training picks one
CACHE = 100_000  # windows remembered by a worker
UNITS_HELD = 100_000  # units that a task counts before it passes the counts on

_letters = re.compile(r"[^\W\d_]+").findall


def windows_of(text: str | None) -> list[str]:
    """Words in lower case, cut into windows."""
    if not text:
        return []
    words = _letters(text.lower())
    if max(map(len, words), default=0) <= WINDOW:
        return words
    return [w[i : i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]


def units(window: str) -> list[str]:
    """The overlapping units of a window between its marked ends."""
    framed = f"^{window}$"
    return [framed[i : i + GRAM] for i in range(max(1, len(framed) - GRAM + 1))]


def codes(window: str) -> list[str]:
    """What stands for a window: its units, its beginnings, and the whole of it between its marked ends."""
    framed = f"^{window}$"
    starts = [framed[:i] for i in range(GRAM - 1, len(framed) + 1)]
    return list(dict.fromkeys([*units(window), *starts, framed]))


def _coded(parts: list[str]) -> bytes:
    """Eight bytes for each unit. What a dictionary lacks can't be compressed and costs all of them, so
    lengths of windows of a few letters can be told apart."""
    return b"".join(hashlib.blake2b(u.encode("utf-8", "replace"), digest_size=8).digest() for u in parts)


FEATURES = 5  # of a text at one threshold


@dataclass
class Model:
    strict: list[str]
    loose: list[str]
    ordinary: list[str]
    threshold: int = 4  # bytes that a window must gain; fitted by `train`
    weights: tuple[float, ...] = ()
    mixed: bool = False  # whether the toxic dictionaries have ordinary text too; fitted by `train`

    def toxic(self) -> frozenset[str]:
        """The units of either toxic dictionary; each is cut by itself, so neither holds the other."""
        return frozenset(self.strict).union(self.loose)

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """Of ordinary text, and of the strict and the loose units of toxic text. If these are `mixed` with
        ordinary text, ordinary pieces of a window count for neither side, else against it."""
        toxic = self.toxic()
        plain = [u for u in self.ordinary if u not in toxic]
        base = plain if self.mixed else []
        return [
            zstandard.ZstdCompressor(
                level=3, write_content_size=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(_coded(content) or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for content in (plain, base + self.strict, base + self.loose)
        ]


class Reader:
    """Scores texts with a model inside a task."""

    def __init__(self, model: Model):
        self.model = model
        self.plain, self.strict, self.loose = model.compressors()
        self.known = model.toxic()
        self.seen: dict[str, tuple[int, int]] = {}

    def gains(self, window: str) -> tuple[int, int]:
        """Bytes saved by the strict and by the loose dictionary of toxic text against the ordinary one."""
        found = self.seen.get(window)
        if found is None:
            parts = codes(window)
            if self.known.isdisjoint(parts):
                found = (0, 0)  # nothing to match: no dictionary of toxic text saves a byte
            else:
                coded = _coded(parts)
                base = len(self.plain.compress(coded))
                found = (base - len(self.strict.compress(coded)), base - len(self.loose.compress(coded)))
            if len(self.seen) >= CACHE:
                self.seen.clear()
            self.seen[window] = found
        return found

    def features(self, text: str | None, *thresholds: int) -> tuple[float, ...]:
        """FEATURES numbers for each threshold, or for that of the model."""
        thresholds = thresholds or (self.model.threshold,)
        counts = Counter(windows_of(text))
        hits, near = [0] * len(thresholds), [0] * len(thresholds)
        for window, n in counts.items():
            strict, loose = self.gains(window)
            if max(strict, loose) <= 0:
                continue
            for i, least in enumerate(thresholds):
                hits[i] += n * (strict >= least)
                near[i] += n * (loose >= least)
        share = 100 / max(counts.total(), 1)
        return tuple(
            x for h, m in zip(hits, near, strict=True)
            for x in (1.0, *(float(np.log1p(v)) for v in (h, h * share, m, m * share)))
        )

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.model.weights, self.features(text)), -30, 30))))


def _unit_counts(sample: DataFrame) -> DataFrame:
    """unit, toxic, ordinary: documents of each class that have the unit."""

    def counted(seen: list[Counter]) -> pa.RecordBatch:
        both = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_pydict({
            "unit": pa.array(both, pa.string()),
            "toxic": pa.array([seen[1][u] for u in both], pa.int64()),
            "ordinary": pa.array([seen[0][u] for u in both], pa.int64()),
        })

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({u for w in set(windows_of(text.as_py())) for u in codes(w)})
                # Counts go on before they are many: the exchange adds them up, and workers stay small.
                if len(seen[0]) + len(seen[1]) >= UNITS_HELD:
                    yield counted(seen)
                    seen = [Counter(), Counter()]
        yield counted(seen)
        del seen
        give_back()

    rows = sample.select("text", "toxic").mapInArrow(count, "unit string, toxic long, ordinary long")
    return rows.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (w * (y - p)) - penalty * beta
        curve = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _loss(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray) -> float:
    """Weighted log loss, rounded so that the order of a sum doesn't decide between equal ones."""
    z = np.clip(x @ beta, -30, 30)
    return round(float((w * (np.logaddexp(0, z) - y * z)).sum()), 6)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled rows (doc_id, toxic) of `docs`, at most `rows` of each class.

    Half of the sample gives the dictionaries: units are counted in Spark, and those that are at least
    STRICT (or LOOSE) times as frequent in toxic documents make the toxic ones, the most frequent of
    ordinary documents the ordinary one. The other half calibrates how many bytes a window must gain to be
    a hit and whether ordinary pieces count against it (of THRESHOLDS and both ways, what loses least), and
    what hits mean for a document.
    Rows without a class, without a text or unknown to `docs` are not learnt from; of contradicting labels
    the toxic one counts. With only one class the score is its share.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _trained(docs, labels, rows, scratch)


def _trained(docs: DataFrame, labels: DataFrame, rows: int, scratch: Scratch) -> Model:
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic")
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64(F.lit(3), F.col("doc_id"))
    picked = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(rows) for c in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    sample = scratch.staged(sample.withColumn("half", F.pmod(F.xxhash64(F.lit(4), F.col("doc_id")), F.lit(2))), "toxicity-sample")

    first = sample.where("half = 0")
    counts = scratch.staged(_unit_counts(first), "toxicity-units")
    n = {r["toxic"]: r["count"] for r in first.groupBy("toxic").count().collect()}
    n_toxic, n_plain = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    least = max(3, n_toxic // 200)
    ratio = (F.col("toxic") / n_toxic) / ((F.col("ordinary") + 1) / n_plain)

    def best(over: float) -> list[str]:
        kept = counts.where((F.col("toxic") >= least) & (ratio > over))
        return most(kept, "toxic", TOXIC_UNITS)

    def most(kept: DataFrame, of: str, limit: int) -> list[str]:
        kinds = [kept.where(kind).orderBy(F.desc(of), "unit").limit(limit) for kind in (F.length("unit") == GRAM, F.length("unit") != GRAM)]
        rows = [(-r[of], r["unit"]) for kind in kinds for r in kind.select(of, "unit").collect()]
        return [unit for _, unit in sorted(rows)]

    model = Model(best(STRICT), best(LOOSE), most(counts.where("ordinary > 0"), "ordinary", ORDINARY_UNITS))
    ways = [model, replace(model, mixed=True)]
    shared = docs.sparkSession.sparkContext.broadcast(ways)

    @trimmed
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(way) for way in shared.value]
        for batch in batches:
            found = [[x for r in readers for x in r.features(t.as_py(), *THRESHOLDS)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"]
            )

    measured = sample.where("half = 1").select("text", "toxic").mapInArrow(measure, "x array<double>, toxic int").collect()
    x = np.array([r["x"] for r in measured])
    y = np.array([r["toxic"] for r in measured], float)
    if len(set(y)) < 2:
        total = sum(sizes.values())
        share = (sizes.get(1, 0) + 0.5) / (total + 1)
        return Model(model.strict, model.loose, model.ordinary, weights=(float(np.log(share / (1 - share))), 0.0, 0.0, 0.0, 0.0))
    # The classes weigh as much as they do among all labelled rows.
    w = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (1 - y).sum())
    w = w * len(y) / w.sum()
    fits = []
    for i, (way, threshold) in enumerate((way, t) for way in ways for t in THRESHOLDS):
        own = x[:, i * FEATURES : (i + 1) * FEATURES]
        weights = _logistic(own, y, w)
        fits.append((_loss(own, y, w, weights), replace(way, threshold=threshold, weights=tuple(weights.tolist()))))
    return min(fits, key=lambda fit: fit[0])[1]


def toxicity(docs: DataFrame, model: Model):
    """A column of scores from 0 to 1 for the column `text` of `docs`: the whole text is read.

    Null, empty and wordless texts get the score of a text without hits. The model is of bounded size
    and broadcast; no row leaves its partition.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(shared.value)
        for texts in batches:
            yield pa.array([reader.score(t.as_py()) for t in texts], pa.float64())
            del texts
            give_back()
        del reader
        give_back()

    return score("text")
