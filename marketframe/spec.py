"""Series layout: which columns key a series and which columns order it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SeriesSpec:
    """Names the key and order columns of a panel.

    ``keys`` partition the panel into independent series (the shuffle key of every
    window, split and fit); ``order`` is a total order inside a series. Row order of a
    DataFrame is never relied upon.
    """

    keys: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = ("ts", "seq")
    time: str = "ts"

    def with_keys(self, *extra: str) -> "SeriesSpec":
        return replace(self, keys=tuple(self.keys) + tuple(k for k in extra if k not in self.keys))

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def window_desc(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*[F.col(c).desc() for c in self.order])

    def rows(self, start: int, end: int) -> WindowSpec:
        return self.window().rowsBetween(start, end)

    def last(self, n: int) -> WindowSpec:
        """The trailing frame of ``n`` rows ending at the current row."""
        return self.window().rowsBetween(-(n - 1), 0)

    def cumulative(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, 0)

    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys)

    def key_cols(self) -> list[Column]:
        return [F.col(k) for k in self.keys]


DEFAULT_SPEC = SeriesSpec()
