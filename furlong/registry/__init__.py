"""Registered queries."""

from __future__ import annotations

from furlong.registry.core import Registry, registry


def load() -> Registry:
    """The registry with every query module read."""
    from furlong.registry import markets, racing, shop  # noqa: F401

    return registry
