"""An anonymised copy of a whole warehouse layer."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.masking import sanitize
from tidemark.sources.warehouse import Warehouse


def build_public_copy(source: Warehouse, target: Warehouse, layer: str = "main", kept_urls: Sequence[str] = ()) -> list[str]:
    """Sanitise every table of a layer into another warehouse; the names of the tables written."""
    names = [table for found, table in source.tables() if found == layer]
    if not names:
        raise LookupError(f"no tables in layer {layer}")
    for name in names:
        target.replace(sanitize(source.read(layer, name), kept_urls), layer, name)
    return names
