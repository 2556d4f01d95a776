"""Reference answers as SQL for DuckDB, written independently of the Spark operators."""

from __future__ import annotations

from importlib import import_module

PARTS = ("tables", "marts", "reports", "monitoring")


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in PARTS:
        out.update(import_module(f"oracle.{part}").statements())
    return out
