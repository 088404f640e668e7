"""Registration of queries, and the shared pieces of their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build
    return add


def view(name: str, text: str, *needs: str) -> None:
    """Name a piece of SQL that others can start from."""
    _VIEWS[name] = (needs, text)


def view_of(name: str) -> tuple[tuple[str, ...], str]:
    """(names it needs, text) of a piece of SQL."""
    return _VIEWS[name]


def sql(body: str, *needs: str) -> str:
    """``body`` with the named views, and theirs, in front of it."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in _VIEWS[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({_VIEWS[n][1].strip()})" for n in order)
    return f"WITH {parts}\n{body.strip()}"
