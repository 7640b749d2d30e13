"""Declarative descriptions of captured tables and of flows over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    """One captured column: its Spark type, how it travels on the wire and what the source declares."""

    name: str
    type: str = "string"
    wire: str = "string"
    nullable: bool = True
    default: str | None = None
    length: int | None = None
    must_appear: bool = False
    scale: int = 0


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: columns, key, and the constraints the audits check."""

    name: str
    keys: tuple[str, ...]
    columns: tuple[Col, ...]
    schema: str = "public"
    checks: Mapping[str, str] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    fks: tuple[ForeignKey, ...] = ()
    range_column: str | None = None

    def column(self, name: str) -> Col:
        return next(c for c in self.columns if c.name == name)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct_type(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.type}" for c in self.columns))


@dataclass(frozen=True)
class NodeSpec:
    """A graph label fed by one change log."""

    label: str
    topic: str
    key: str
    properties: tuple[str, ...]


@dataclass(frozen=True)
class EdgeSpec:
    """A relationship created by a foreign key held in the target node's log."""

    type: str
    topic: str
    source_label: str
    source_field: str
    target_label: str
    target_key: str


@dataclass(frozen=True)
class Step:
    """One named transform; rows failing ``predicate`` pass by untouched."""

    name: str
    fn: Callable[..., DataFrame]
    params: Mapping[str, Any] = field(default_factory=dict)
    predicate: Column | None = None


@dataclass(frozen=True)
class FlowSpec:
    """Topics in, ordered transforms, table specs, sinks and an optional per-batch hook."""

    topics: Sequence[str] = ()
    topics_regex: str | None = None
    transforms: Sequence[Step] = ()
    tables: Mapping[str, TableSpec] = field(default_factory=dict)
    table_template: str = "${topic}"
    pos: Sequence[str] | None = None  # columns that order the events of a key; see ``plans.flow.order_of``
    sinks: Sequence[Callable[[str, DataFrame], None]] = ()
    on_batch: Callable[[DataFrame, int], None] | None = None
