"""Register of this package's queries."""

from __future__ import annotations

from collections.abc import Callable

from ledgerloom.catalog.registry import Build, Query

REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return register
