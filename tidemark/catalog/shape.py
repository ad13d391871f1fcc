"""One output contract for a Spark query and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY, INSTANT = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Shape:
    """Column list such as 'coin_id date:d price:r n:b'.

    Kinds: none as is, r rounded to six digits, r2 to two, d day as text, t instant as text,
    i 32-bit integer, b 64-bit integer. Rounding hides the order of floating sums; adding zero
    turns a negative zero into zero.
    """

    spec: str

    def _columns(self) -> list[tuple[str, str]]:
        parts = [item.partition(":") for item in self.spec.split()]
        return [(name, kind) for name, _, kind in parts]

    def of(self, df: DataFrame) -> DataFrame:
        def portable(name: str, kind: str) -> Column:
            column = F.col(f"`{name}`")
            if kind.startswith("r"):
                column = F.round(column, int(kind[1:] or 6)) + F.lit(0.0)
            elif kind in ("d", "t"):
                column = F.date_format(column, DAY if kind == "d" else INSTANT)
            elif kind:
                column = column.cast("int" if kind == "i" else "bigint")
            return column.alias(name)

        return df.select(*[portable(n, k) for n, k in self._columns()])

    def sql(self, body: str) -> str:
        def portable(name: str, kind: str) -> str:
            column = f'"{name}"'
            if kind.startswith("r"):
                column = f"round({column}, {kind[1:] or 6}) + CAST(0 AS DOUBLE)"
            elif kind in ("d", "t"):
                text = "%Y-%m-%d" if kind == "d" else "%Y-%m-%d %H:%M:%S"
                column = f"strftime({column}, '{text}')"
            elif kind:
                column = f"CAST({column} AS {'INTEGER' if kind == 'i' else 'BIGINT'})"
            return f'{column} AS "{name}"'

        listed = ", ".join(portable(n, k) for n, k in self._columns())
        return f"SELECT {listed} FROM ({body}) AS result"


Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Collects queries and, where SQL can express them, their counterpart."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, shape: str, query: Query, body: str | None = None, ctes: str = "") -> None:
        if name in self.queries:
            raise ValueError(f"{name} is registered twice")
        contract = Shape(shape)
        self.queries[name] = lambda spark, sf_dir: contract.of(query(spark, sf_dir))
        if body is not None:
            self.oracles[name] = f"{ctes} {contract.sql(body)}".strip()
