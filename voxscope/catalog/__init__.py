"""Every registered query with the DuckDB statement that must give the same rows."""

from __future__ import annotations

from . import aggregate, clusters, io, joining, mining, nested, pages, patterns, ranking, scalar, streams, text
from .base import Entry

MODULES = (text, scalar, aggregate, ranking, joining, nested, pages, io, mining, clusters, patterns, streams)


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for module in MODULES:
        for name, entry in module.registry.items():
            if name in found:
                raise ValueError(f"{name} is registered twice")
            found[name] = entry
    return found
