"""Reversible column steps and chains of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import registry


@dataclass(frozen=True)
class Select:
    """Keep columns in the given order; missing ones are an error that names the first five."""

    columns: tuple[str, ...]

    @classmethod
    def preset(cls, name: str, num_players: int = 6) -> Select:
        return cls(tuple(registry.select_columns(name, num_players)))

    def __call__(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise KeyError(f"{len(missing)} columns missing: {missing[:5]}")
        return df.select(*[F.col(f"`{c}`") for c in self.columns])


class Normalize:
    """Divide bounded columns by their bounds in one projection; inverse multiplies.

    Custom bounds replace the built-in ones entirely; bounds of absent columns are ignored,
    a zero bound is an error.  NULL and NaN pass through.
    """

    def __init__(self, bounds: dict[str, float] | None = None):
        if bounds and any(v == 0 for v in bounds.values()):
            raise ValueError("a bound must not be zero")
        self.bounds = bounds

    def divisors(self, columns: list[str]) -> dict[str, float]:
        if self.bounds is not None:
            return {c: float(self.bounds[c]) for c in columns if c in self.bounds}
        return {c: d for c in columns if (d := registry.divisor(c)) is not None}

    def _scaled(self, df: DataFrame, op: Callable) -> DataFrame:
        d = self.divisors(df.columns)
        return df.select(*[op(F.col(f"`{c}`"), F.lit(d[c])).alias(c) if c in d else F.col(f"`{c}`") for c in df.columns])

    def __call__(self, df: DataFrame) -> DataFrame:
        return self._scaled(df, lambda c, d: c / d)

    def inverse(self, df: DataFrame) -> DataFrame:
        return self._scaled(df, lambda c, d: c * d)


class Chain:
    """Steps applied in order; inverse goes back through those that have one. Any DataFrame -> DataFrame callable is a step."""

    def __init__(self, steps: list[Callable[[DataFrame], DataFrame]]):
        self.steps = list(steps)

    def __call__(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = df.transform(step)
        return df

    def inverse(self, df: DataFrame) -> DataFrame:
        for step in reversed(self.steps):
            if hasattr(step, "inverse"):
                df = df.transform(step.inverse)
        return df
