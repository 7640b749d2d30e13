import base64
import json
from decimal import Decimal

import pytest
from tests.helpers import NARROW, raw, rows, value
from pyspark.sql import functions as F

from tideline.functions import decode as D
from tideline.functions.names import parse_topic, quote, rename, table_name
from tideline.operators import classify as C
from tideline.operators import envelope as E
from tideline.operators.route import flatten
from tideline.spec import Col, TableSpec


def encoded(n: int, size: int | None = None) -> str:
    size = size or (n.bit_length() // 8 + 1)
    return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()


@pytest.mark.parametrize("scale", [0, 2, 18])
def test_decimal_bytes_of_every_width(spark, scale):
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 2**31, -(2**31), 2**63 - 1, -(2**63), 2**64, -(2**64), 10**37, -(10**37), 10**38 - 1, 1 - 10**38]
    df = spark.createDataFrame([(str(n), encoded(n)) for n in numbers], "n string, b string")
    out = df.select("n", D.decimal_from_bytes(F.col("b"), f"decimal(38,{scale})", scale).alias("d")).collect()
    assert {r.n: r.d for r in out} == {str(n): Decimal((n < 0, tuple(map(int, str(abs(n)))), -scale)) for n in numbers}


def test_decimal_bytes_padded_and_broken(spark):
    df = spark.createDataFrame([(encoded(-5, 8),), ("",), ("not base64!",), (None,)], "b string")
    got = [r[0] for r in df.select(D.decimal_from_bytes(F.col("b"), "decimal(12,2)", 2)).collect()]
    assert got == [Decimal("-0.05"), None, None, None]


def test_number_tokens_stay_exact(spark):
    spec = TableSpec("t", ("id",), (Col("id", "bigint", "int"), Col("q", "decimal(28,18)", "decimal")))
    texts = ['{"op":"c","after":{"id":1,"q":9999999999.999999999}}', '{"op":"c","after":{"id":2,"q":"9999999999.999999999"}}', '{"op":"c","after":{"id":3,"q":"0.000000000000000001"}}']
    df = raw(spark, [(None, t) for t in texts])
    got = E.decode(E.parse_envelope(df), spec).select("id.id", "after.q")
    assert rows(got) == [(1, Decimal("9999999999.999999999000000000")), (2, Decimal("9999999999.999999999000000000")), (3, Decimal("1E-18"))]


def test_bytes_and_times(spark):
    df = spark.createDataFrame([("vu8=", "09:00:00+02:00", "32400000000", "21915")], "b string, z string, t string, d string")
    got = df.select(
        F.hex(D.bytes_from_text(F.col("b"))),
        D.time_from_zoned(F.col("z")),
        D.format_micros_of_day(D.micros_of_day(F.col("t"))),
        D.date_from_days(F.col("d")).cast("string"),
    ).head()
    assert tuple(got) == ("BEEF", "07:00:00.000000Z", "09:00:00.000000", "2030-01-01")


def test_every_decoder_gives_null_on_nonsense(spark):
    df = spark.createDataFrame([("?!",)], "x string")
    cols = [
        Col("a", "decimal(12,2)", "decimal"),
        Col("b", "decimal(12,2)", "connect_decimal", scale=2),
        Col("c", "timestamp_ntz", "micro_timestamp"),
        Col("d", "timestamp", "zoned_timestamp"),
        Col("e", "bigint", "micro_time"),
        Col("f", "string", "zoned_time"),
        Col("g", "date", "date"),
        Col("h", "bigint", "int"),
        Col("i", "boolean", "bool"),
        Col("j", "binary", "bytes"),
    ]
    assert set(df.select(*[D.decode_column(F.col("x"), c) for c in cols]).head()) == {None}


CASES = [
    ("wrapped", {"id": 1}, value("c", {"id": 1, "name": "a", "amount": "1.00"}, wrapped=True), "upsert", None),
    ("bare", {"id": 1}, value("u", {"id": 1, "name": "a", "amount": "1.00"}), "upsert", None),
    ("tombstone", {"id": 1}, None, "tombstone", None),
    ("blank", {"id": 1}, "   ", "tombstone", None),
    ("no op", None, '{"resolved": 5}', "control", None),
    ("empty op", {"id": 1}, value("", {"id": 1}), "control", None),
    ("null after", {"id": 1}, value("u", None), "skip", None),
    ("id in after", None, value("c", {"id": 2, "name": "a", "amount": "1"}), "upsert", None),
    ("id in before", None, value("d", None, {"id": 3}), "delete", None),
    ("no id", None, value("c", {"name": "a", "amount": "1"}), "quarantine", "no_key"),
    ("text id", {"id": "seven"}, value("c", {"id": "seven", "amount": "1"}), "quarantine", "no_key"),
    ("broken", {"id": 1}, '{"op":"c","after":{', "quarantine", "unparsable"),
    ("null amount", {"id": 1}, value("c", {"id": 1, "name": "a", "amount": None}), "upsert", None),
    ("absent amount", {"id": 1}, value("c", {"id": 1, "name": "a"}), "quarantine", "bad_value:amount"),
    ("bad amount", {"id": 1}, value("c", {"id": 1, "amount": "n/a"}), "quarantine", "bad_value:amount"),
    ("unknown op", {"id": 1}, value("t", {"id": 1, "amount": "1"}), "quarantine", "unknown_op"),
    ("wrapped key", '{"schema":{},"payload":{"id":9}}', value("d"), "delete", None),
    ("not an object", {"id": 1}, "5", "control", None),
]


def test_dispositions(spark):
    df = raw(spark, [(k, v) for _, k, v, _, _ in CASES])
    got = {r.offset: (r.disposition, r.reason) for r in C.with_disposition(df, NARROW).collect()}
    assert {CASES[i][0]: got[i] for i in got} == {name: (d, r) for name, _, _, d, r in CASES}


def test_split_is_complete(spark):
    df = raw(spark, [(k, v) for _, k, v, _, _ in CASES])
    data, control, bad = C.classify(df, NARROW)
    skipped = C.with_disposition(df, NARROW).filter("disposition IN ('skip', 'tombstone')")
    assert sum(x.count() for x in (data, control, bad, skipped)) == len(CASES)


def test_key_fallback_order(spark):
    df = raw(spark, [({"id": 1}, value("u", {"id": 2}, {"id": 3})), (None, value("u", {"id": 2}, {"id": 3})), (None, value("u", None, {"id": 3}))])
    got = E.resolve_key(E.parse_envelope(df), NARROW).select("offset", "id.id")
    assert rows(got) == [(0, 1), (1, 2), (2, 3)]


def test_defaults_only_for_absent_fields(spark):
    spec = TableSpec("t", ("id",), (Col("id", "bigint", "int"), Col("channel", default="web")))
    texts = [value("c", {"id": 1}), value("c", {"id": 2, "channel": None}), value("c", {"id": 3, "channel": "app"})]
    df = E.apply_defaults(E.decode(E.parse_envelope(raw(spark, [(None, t) for t in texts])), spec), spec)
    assert rows(df.select("id.id", "after.channel")) == [(1, "web"), (2, None), (3, "app")]


def test_numeric_and_boolean_wire_fields(spark):
    spec = TableSpec("t", ("id",), (Col("id", "bigint", "int"), Col("ok", "boolean", "bool"), Col("tags", "array<string>", "array"), Col("doc", wire="json")))
    text = value("c", {"id": 1, "ok": True, "tags": ["a", "b"], "doc": json.dumps({"x": [1]})})
    got = E.decode(E.parse_envelope(raw(spark, [(None, text)])), spec).select("after.*").head()
    assert tuple(got) == (1, True, ["a", "b"], '{"x": [1]}')


def test_delete_rewrite_without_before_image(spark):
    df = raw(spark, [({"id": 1}, value("c", {"id": 1, "name": "a", "amount": "1.00"})), ({"id": 1}, value("d"))])
    data, _, _ = C.classify(df, NARROW)
    got = flatten(data, NARROW)
    assert rows(got, "id", "name", "__op", "__deleted") == [(1, "a", "c", "false"), (1, None, "d", "true")]


def test_topic_names(spark):
    df = spark.createDataFrame([("a.b.shop.public.orders", "raw.shopdb.public.orders")], "t string, f string")
    three, four = parse_topic(F.col("t")), parse_topic(F.col("f"), 4, "raw.")
    got = df.select(three["prefix"], three["schema"], three["table"], four["database"], four["table"], table_name(F.col("t"), "x_${source.table}_y")).head()
    assert tuple(got) == ("a.b.shop", "public", "orders", "shopdb", "orders", "x_orders_y")


def test_rename_matches_whole_names(spark):
    df = spark.createDataFrame([("shop.public.orders",), ("old.shop.public.orders",)], "t string")
    assert [r[0] for r in df.select(rename(F.col("t"), r"shop\.public\.(.*)", "public_$1")).collect()] == ["public_orders", "old.shop.public.orders"]


def test_quote():
    assert quote("a`b") == "`a``b`"
