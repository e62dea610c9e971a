"""Imports every query module so their ``@register`` calls populate the registry."""

from marketframe.plans import q_series, q_bars, q_prep, q_stats, q_runs, q_models, q_io, q_stream, q_schema, q_checks, q_halo, q_arma  # noqa: F401
from marketframe.plans.registry import COVERS, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "COVERS"]
