"""All registered queries; importing a plan module registers what it holds."""

from __future__ import annotations

from . import archive, catalogue, history, runs, streams, telemetry, triggers  # noqa: F401
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
