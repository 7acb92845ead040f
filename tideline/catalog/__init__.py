"""Queries over the sample tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from tideline.catalog import applying, conflicts, extraction, filters, layouts, measures, messages, streams
from tideline.catalog.base import Query

QUERIES: dict[str, Query] = {
    **extraction.QUERIES,
    **filters.QUERIES,
    **messages.QUERIES,
    **applying.QUERIES,
    **measures.QUERIES,
    **streams.QUERIES,
    **conflicts.QUERIES,
    **layouts.QUERIES,
}
