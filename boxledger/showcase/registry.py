"""Registered queries: a Spark function and, where SQL can say it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sql import with_ctes
from .tables import Showcase

QUERIES: dict[str, "Query"] = {}

#: Shares are rounded to six places for the comparison.  The half is nudged so that no exact tie, which decimal and
#: binary division would round differently, lies on the boundary.
NUDGED_HALF = 0.500013


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Showcase], DataFrame]
    sql: str | None
    money: tuple[str, ...]
    ratio: tuple[str, ...]
    text: tuple[str, ...]
    whole: tuple[str, ...]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The result with decimals as doubles, shares rounded to six places and days as text."""
        df = self.build(Showcase(spark, sf_dir))
        changes = {c: F.col(c).cast("double") for c in self.money}
        changes |= {c: F.floor(F.col(c).cast("double") * 1e6 + NUDGED_HALF) / F.lit(1e6) for c in self.ratio}
        changes |= {c: F.col(c).cast("string") for c in self.text}
        changes |= {c: F.col(c).cast("bigint") for c in self.whole}
        return df.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in df.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in self.money]
        casts += [f"floor(CAST({c} AS DOUBLE) * 1e6 + {NUDGED_HALF}) / 1e6 AS {c}" for c in self.ratio]
        casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in self.text]
        casts += [f"CAST({c} AS BIGINT) AS {c}" for c in self.whole]
        if not casts:
            return self.sql
        return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{self.sql}\n)"


def query(name: str, sql: str | None = None, ctes: Sequence[str] = (), local: dict[str, str] | None = None, *,
          money: str = "", ratio: str = "", text: str = "", whole: str = ""):
    """Register a function of a :class:`Showcase` under ``name``; column lists are space separated."""
    def register(build: Callable[[Showcase], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, build, None if sql is None else with_ctes(ctes, sql, local), tuple(money.split()),
                              tuple(ratio.split()), tuple(text.split()), tuple(whole.split()))
        return build

    return register
