"""Named queries with their expected SQL results, over the supplied tables."""

from __future__ import annotations

from stratamart.registry.core import ENTRIES, Entry


def all_entries() -> dict[str, Entry]:
    # registering happens on import
    from stratamart.registry import banking, jobs, operators, retail, verticals  # noqa: F401

    return ENTRIES
