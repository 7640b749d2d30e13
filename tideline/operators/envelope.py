"""Raw log rows -> parsed, typed change rows.

The value is parsed once into a variant. That keeps number tokens exact, tells an absent field from
an explicit null, and needs no schema up front, so one parsed stream serves tables whose columns
are still growing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.decode import decode_column
from tideline.functions.names import parse_topic
from tideline.functions.values import once
from tideline.spec import Col, TableSpec

def unwrap(doc: Column) -> Column:
    """Body of a parsed document, for both the ``{schema, payload}`` and the bare encoding.

    The field is read out of a struct, since a path that leads nowhere ends in an exception inside Spark, which costs as much as parsing.
    """
    return F.coalesce(F.try_variant_get(doc, "$", "struct<payload:variant>")["payload"], doc)


def unwrap_payload(text: Column) -> Column:
    """JSON text -> variant of the bare body."""
    return unwrap(F.try_parse_json(text))


def _where(only: Column | None, column: Column) -> Column:
    return column if only is None else F.when(only, column)


def parse_envelope(raw: DataFrame) -> DataFrame:
    """Adds ``event`` (variant), ``op``, ``ts_ms``, ``schema_name`` and ``table_name`` to raw rows.

    Names come from the topic first; ``source`` fields may be missing on older feeds. A value that was parsed before, into ``_doc``, is not parsed again.
    """
    where = parse_topic(F.col("topic"))
    held = raw if "_doc" in raw.columns else raw.withColumn("_doc", F.try_parse_json("value"))
    parsed = once(held, event=unwrap(F.col("_doc")))
    return parsed.select(
        *[c for c in raw.columns if c != "_doc"],
        "event",
        F.try_variant_get("event", "$.op", "string").alias("op"),
        F.try_variant_get("event", "$.ts_ms", "string").try_cast("bigint").alias("ts_ms"),
        F.coalesce(where["schema"], F.try_variant_get("event", "$.source.schema", "string")).alias("schema_name"),
        F.coalesce(where["table"], F.try_variant_get("event", "$.source.table", "string")).alias("table_name"),
    )


def _text_struct(columns: Sequence[Col]) -> str:
    return "struct<" + ",".join(f"`{c.name}`:{'variant' if c.wire == 'array' else 'string'}" for c in columns) + ">"


def _typed(image: Column, columns: Sequence[Col]) -> Column:
    return F.struct(*[_typed_field(image[c.name], c).alias(c.name) for c in columns])


def _typed_field(value: Column, col: Col) -> Column:
    if col.wire == "array":
        return value.try_cast(col.type)
    return decode_column(value, col)


def _key_text(df: DataFrame, spec: TableSpec, only: Column | None = None) -> DataFrame:
    """Adds ``_k``, the record key's fields as text; the key may be wrapped like the value."""
    shape = _text_struct([spec.column(k) for k in spec.keys])
    return df.withColumn("_kdoc", _where(only, F.try_parse_json("key"))).withColumn(
        "_k", F.try_variant_get(unwrap(F.col("_kdoc")), "$", shape)
    )


def parse_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds ``key_fields``: the record key (single or composite) as a struct of typed columns."""
    cols = [spec.column(k) for k in spec.keys]
    return _key_text(df, spec).withColumn("key_fields", _typed(F.col("_k"), cols)).drop("_kdoc", "_k")


def _found_key(spec: TableSpec) -> Column:
    """Each key column from the record key, else the after image, else the before image."""
    parts = []
    for k in spec.keys:
        images = [F.try_variant_get("event", f"$.{side}.{k}", "string") for side in ("after", "before")]
        parts.append(_typed_field(F.coalesce(F.col(f"_k.{k}"), *images), spec.column(k)).alias(k))
    return F.struct(*parts)


def _after_text(df: DataFrame, spec: TableSpec, only: Column | None = None) -> DataFrame:
    return df.withColumn("_a", _where(only, F.try_variant_get("event", "$.after", _text_struct(spec.columns))))


def _image(side: str, spec: TableSpec) -> Column:
    return F.when(F.col(side).isNotNull(), _typed(F.col(side), spec.columns))


def resolve_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds ``id``, the key struct, falling back from record key to after to before image.

    A key value that does not decode to its declared type stays NULL; it is not coerced.
    """
    return _key_text(df, spec).withColumn("id", _found_key(spec)).drop("_kdoc", "_k")


def is_absent(side: str, column: str) -> Column:
    """The field is not in the image at all (an explicit null is present)."""
    return F.try_variant_get("event", f"$.{side}.{column}", "variant").isNull()


def _bad_columns(spec: TableSpec) -> Column:
    """Names of after-image columns that are there but unreadable, or must appear and are absent."""
    marks = []
    for c in spec.columns:
        text, plain = F.col("_a")[c.name], c.wire in ("string", "json")
        fails = F.lit(False) if plain else text.isNotNull() & _typed_field(text, c).isNull()
        if c.must_appear:
            fails = fails | (text.isNull() & is_absent("after", c.name))  # a text that was found need not be looked for again
        if c.must_appear or not plain:
            marks.append(F.when(fails, F.lit(c.name)))
    return F.concat_ws(",", *marks) if marks else F.lit("")


def decode(parsed: DataFrame, spec: TableSpec, before: bool = False, only: Column | None = None) -> DataFrame:
    """Parsed envelope rows -> change rows with ``id``, ``after`` (and ``before``) typed by ``spec``.

    ``bad_columns`` lists, comma-separated, after-image fields that could not be used. Rows for which ``only`` does not hold are
    not decoded; their new columns are null.
    """
    made = {"id": _found_key(spec), "after": _image("_a", spec), "bad_columns": _bad_columns(spec)}
    made = {name: _where(only, column) for name, column in made.items()}
    rows = _after_text(_key_text(parsed, spec, only), spec, only)
    if before:
        rows = rows.withColumn("_b", F.try_variant_get("event", "$.before", _text_struct(spec.columns)))
        made["before"] = _image("_b", spec)
    return once(rows, **made).drop("_kdoc", "_k", "_a", "_b")


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill declared defaults where a field is absent from the after image; explicit nulls stay null."""
    fields = []
    for c in spec.columns:
        value = F.col("after")[c.name]
        if c.default is not None:
            literal = _typed_field(F.try_parse_json(F.lit(c.default)), c) if c.wire == "array" else decode_column(F.lit(c.default), c)
            value = F.when(is_absent("after", c.name), literal).otherwise(value)
        fields.append(value.alias(c.name))
    return df.withColumn("after", F.when(F.col("after").isNotNull(), F.struct(*fields)))
