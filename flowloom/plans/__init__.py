"""Named, checkable queries over the given tables."""

from __future__ import annotations

from flowloom.plans.registry import QUERIES, Query


def catalog() -> dict[str, Query]:
    """Every registered query by name."""
    from flowloom.plans import cleaning, messages, models, reports, streams, tables  # noqa: F401

    return dict(QUERIES)
