"""SQL for the operators' queries that SQL can express, by query name."""

from __future__ import annotations

ORACLES: dict[str, str] = {}
