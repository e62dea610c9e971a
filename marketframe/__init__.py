"""marketframe: price-series panel analytics expressed as Spark DataFrame plans.

Every operator takes and returns DataFrames. A *panel* is a long DataFrame keyed by
``symbol`` and ordered by ``(ts, seq)``; the single-series case is a panel of one.
"""

from marketframe.spec import SeriesSpec, DEFAULT_SPEC

__all__ = ["SeriesSpec", "DEFAULT_SPEC"]
