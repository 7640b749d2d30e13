"""Topic, table and identifier names as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_match(column: Column, pattern: str) -> Column:
    """Regex match over the whole name; a partial hit does not count."""
    return column.rlike(f"^(?:{pattern})$")


def rename(column: Column, pattern: str, replacement: str) -> Column:
    """Whole-name regex rename with ``$1`` style groups; other names stay as they are."""
    return F.regexp_replace(column, f"^(?:{pattern})$", replacement)


def parse_topic(topic: Column, parts: int = 3, prefix: str = "") -> Column:
    """``prefix.schema.table`` (3) or ``<prefix>db.schema.table`` (4) -> struct(prefix, database, schema, table).

    Table and schema are counted from the right, so a prefix that holds dots does no harm.
    """
    if parts not in (3, 4):
        raise ValueError("parts must be 3 or 4")
    pieces = F.split(topic, r"\.")
    table = F.try_element_at(pieces, F.lit(-1))
    schema = F.try_element_at(pieces, F.lit(-2))
    if parts == 3:
        lead = F.array_join(F.slice(pieces, 1, F.greatest(F.size(pieces) - 2, F.lit(0))), ".")
        return F.struct(
            lead.alias("prefix"), F.lit(None).cast("string").alias("database"), schema.alias("schema"), table.alias("table")
        )
    bare = F.when(F.startswith(topic, F.lit(prefix)), F.substring(topic, F.lit(len(prefix) + 1), F.length(topic)))
    database = F.try_element_at(F.split(bare, r"\."), F.lit(1))
    return F.struct(F.lit(prefix).alias("prefix"), database.alias("database"), schema.alias("schema"), table.alias("table"))


def source_field(value: Column, name: str, doc: Column | None = None) -> Column:
    """A field of an event's ``source`` block, wrapped or bare; only values that mention one are parsed, unless ``doc`` has them parsed."""
    doc = F.try_parse_json(value) if doc is None else doc
    found = F.coalesce(*[F.try_variant_get(doc, f"{path}.{name}", "string") for path in ("$.payload.source", "$.source")])
    return F.when(F.contains(value, F.lit('"source"')), found)


def table_name(
    topic: Column, template: str = "${topic}", value: Column | None = None, origin: Column | None = None, doc: Column | None = None
) -> Column:
    """Target table from a template: ``${topic}`` (dots become underscores), ``${source.schema}``,
    ``${source.table}`` or fixed text, in any mix.

    Source names come from the event's own ``source`` block where ``value`` is given and has one, else from the topic, else from ``origin``, the topic
    before it was renamed. A topic that has no schema part names no table. ``doc`` is ``value`` parsed, where it is at hand.
    """
    places = [parse_topic(topic)] + ([] if origin is None else [parse_topic(origin)])

    def source(name: str) -> Column:
        told = [] if value is None else [source_field(value, name, doc)]
        return F.coalesce(*told, *[F.when(p["schema"].isNotNull(), p[name]) for p in places])

    known = {"topic": lambda: F.translate(topic, ".", "_"), "source.schema": lambda: source("schema"), "source.table": lambda: source("table")}
    parts = [
        known[piece[2:-1]]() if piece.startswith("${") else F.lit(piece)
        for piece in re.split(r"(\$\{[^}]+\})", template)
        if piece
    ]
    return F.concat(*parts)


def quote(name: str) -> str:
    """Back-ticked identifier, so reserved words and odd characters survive."""
    return "`" + name.replace("`", "``") + "`"
