"""Change logs that Spark derives from the given tables, and the same logs as SQL for checking.

Every order, customer, supplier and event row takes part. Which rows are also updated, moved, deleted,
reopened or redelivered follows from their own column values.

Log offsets are ``id * 20 + kind``; a redelivered event repeats its offset.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.decode import WIRE_FORMS
from tideline.functions.values import once, stable_uuid
from tideline.session import pin_utc, scratch_path, split_skewed_joins
from tideline.spec import Col, ForeignKey, TableSpec

ORDERS = "shop.public.orders"
CUSTOMERS = "shop.public.customers"
SUPPLIERS = "shop.purchasing.suppliers"
SIGNALS = "shop.public.signals"
DAY_MS = 86_400_000
PARTITIONS = 4
SLICE_YEARS = (1994, 1996, 1998)  # first years of the later slices of the log
ROW_GROUP = 8 << 20  # bytes in memory: a file is read by as many tasks as it has row groups

ORDERS_SPEC = TableSpec(
    name="orders",
    keys=("id",),
    columns=(
        Col("id", "bigint", "int", nullable=False),
        Col("customer_id", "bigint", "int", nullable=False),
        Col("amount", "decimal(12,2)", "decimal", nullable=False, must_appear=True),
        Col("status", "string", nullable=False, length=8),
    ),
    checks={"amount": "amount >= 0"},
    fks=(ForeignKey("customer_id", "customers", "id"),),
)
CUSTOMERS_SPEC = TableSpec(
    name="customers",
    keys=("id",),
    columns=(
        Col("id", "bigint", "int", nullable=False),
        Col("name", "string", nullable=False, length=25),
        Col("segment", "string", length=10),
        Col("balance", "decimal(12,2)", "decimal"),
    ),
    unique=(("name",),),
)
SUPPLIERS_SPEC = TableSpec(
    name="suppliers",
    schema="purchasing",
    keys=("supplier_id",),
    columns=(
        Col("supplier_id", "bigint", "int", nullable=False),
        Col("nation_id", "bigint", "int", nullable=False),
        Col("balance", "decimal(12,2)", "decimal", must_appear=True),
    ),
)
# The type each wire form is decoded to here.
FORM_TYPES = {
    "string": "string",
    "int": "bigint",
    "bool": "boolean",
    "decimal": "decimal(12,2)",
    "connect_decimal": "decimal(12,2)",
    "json": "string",
    "bytes": "binary",
    "array": "array<string>",
    "micro_timestamp": "timestamp_ntz",
    "zoned_timestamp": "timestamp",
    "micro_time": "bigint",
    "zoned_time": "string",
    "date": "date",
}
WIDE_SPEC = TableSpec(
    name="wide",
    keys=("event_id",),
    columns=(
        Col("event_id", "bigint", "int", nullable=False),
        *(Col(f"as_{form}", FORM_TYPES[form], form, scale=2 if form == "connect_decimal" else 0) for form in WIRE_FORMS),
        Col("as_fine_decimal", "decimal(28,18)", "decimal"),
        Col("uuid", "string"),
        Col("channel", "string", default="web"),  # not every event has it
    ),
)


def pruned(spec: TableSpec, *names: str) -> TableSpec:
    """The spec with its key and only the named columns, so only those are read from the wire."""
    return TableSpec(spec.name, spec.keys, tuple(c for c in spec.columns if c.name in names or c.name in spec.keys), spec.schema)


def _ms(year: int, month: int, day: int) -> int:
    return int(datetime(year, month, day, tzinfo=timezone.utc).timestamp() * 1000)


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _events(rows: DataFrame, events: list[tuple[Column, Column]]) -> DataFrame:
    """One output row per (condition, struct) that holds: a single scan, no union."""
    made = F.array_compact(F.array(*[F.when(cond, event) for cond, event in events]))
    return rows.select("*", F.inline(made))


class Lake:
    """The given tables of one folder, and the logs made from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        pin_utc(spark)
        split_skewed_joins(spark)
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @staticmethod
    def files_for(rows: DataFrame, least: int, rows_a_file: int = 500_000) -> int:
        """How many files to write: as many as the rows ask for, and at least so many that a small input has several batches."""
        return max(least, -(-rows.count() // rows_a_file))

    @staticmethod
    def write_log(rows: DataFrame, path: str) -> None:
        """Log files in row groups small enough that many tasks share a file."""
        rows.write.option("parquet.block.size", ROW_GROUP).parquet(path)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    # orders ---------------------------------------------------------------------------------

    def _orders(self) -> DataFrame:
        leaving = "o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW')"
        urgent = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
        amount = "CAST(o_totalprice AS DECIMAL(12,2))"
        return self.table("orders").selectExpr(
            "o_orderkey AS id",
            "o_custkey AS c0",
            f"{amount} AS a0",
            "o_orderstatus AS s0",
            "o_orderpriority AS priority",
            "unix_millis(CAST(o_orderdate AS TIMESTAMP)) AS base_ms",
            f"{urgent} AS shipped",
            f"{amount} > 300000 AS moved",
            f"{leaving} AS removed",
            f"{leaving} AND {amount} > 250000 AS reopened",
            f"{urgent} AND o_orderstatus = 'F' AS redelivered",
        )

    def _order_events(self, wire: bool) -> DataFrame:
        def image(customer: str, amount: str, status: str) -> str:
            return f"named_struct('customer_id', {customer}, 'amount', CAST({amount} AS DECIMAL(12,2)), 'status', {status})"

        def event(when: str, kind: int, op: str, days: int, before: str, after: str) -> str:
            at = f"base_ms + {days * DAY_MS}"
            made = f"named_struct('kind', {kind}, 'op', {op}, 'ts_ms', {at}, 'before', {before}, 'after', {after})"
            return f"CASE WHEN {when} THEN {made} END"

        none = "CAST(NULL AS STRUCT<customer_id: BIGINT, amount: DECIMAL(12,2), status: STRING>)"
        no_op = "CAST(NULL AS STRING)"
        now_amount, now_status = "IF(shipped, a0 + 10, a0)", "IF(shipped, 'shipped', s0)"
        first = image("c0", "a0", "s0")
        shipped = image("c0", "a0 + 10", "'shipped'")
        second = image("c0", now_amount, now_status)
        moved = image("c0 + 1", now_amount, now_status)
        third = image("IF(moved, c0 + 1, c0)", now_amount, now_status)
        events = [
            event("true", 0, "IF(s0 = 'F', 'r', 'c')", 0, none, first),
            event("shipped", 1, "'u'", 1, first, shipped),
            event("moved", 2, "'u'", 2, second, moved),
            event("removed", 3, "'d'", 3, third, none),
            event("reopened", 5, "'c'", 4, none, image("c0", "a0", "'reopened'")),
            event("redelivered", 1, "'u'", 1, first, shipped),
        ]
        if wire:
            events += [
                event("removed", 4, no_op, 3, none, none),
                event("reopened", 6, "'u'", 5, none, none),
                event("redelivered", 7, "'u'", 5, none, first),
                event("moved AND s0 = 'F'", 8, "'t'", 5, none, first),
                event("s0 = 'O'", 9, no_op, 0, none, none),
                event("shipped AND s0 = 'O'", 10, "'u'", 5, first, first),
                event("moved AND s0 = 'O'", 11, "'u'", 5, first, none),
                event("moved AND s0 = 'P'", 12, "'u'", 5, first, first),
            ]
        return (
            self._orders()
            .selectExpr("id", "c0", "s0", "priority", f"inline(array_compact(array({', '.join(events)})))")
            .selectExpr("*", f"'{ORDERS}' AS topic", f"CAST(pmod(id, {PARTITIONS}) AS INT) AS partition", "id * 20 + kind AS offset")
        )

    def order_changes(self) -> DataFrame:
        """Flat order changes, redeliveries included."""
        return self._order_events(wire=False).select(
            "topic", "partition", "offset", "id", "op", "after.customer_id", "after.amount", "after.status", "ts_ms"
        )

    def order_images(self) -> DataFrame:
        return self._order_events(wire=False).select("topic", "partition", "offset", "id", "op", "ts_ms", "before", "after")

    def order_rows(self) -> DataFrame:
        """The events of the order log with their append time, not yet as JSON."""
        appended = F.timestamp_millis(F.col("ts_ms") + F.pmod("id", F.lit(1000)))
        return self._order_events(wire=True).withColumn("ts", appended)

    def order_raw(self) -> DataFrame:
        """The order log as it travels: JSON keys and values, wrapped or bare, with tombstones, resolved marks (some as the
        text of a hybrid clock), and events that are broken in one way each."""
        key, value = self._order_json()
        return once(self.order_rows(), key=key, value=value).select("topic", "partition", "offset", "ts", "key", "value")

    @staticmethod
    def _order_json() -> tuple[Column, Column]:
        """Key and value of a row of ``order_rows``."""
        wrapped = F.col("partition") < 2
        kind = F.col("kind")

        def image_json(side: str) -> Column:
            shown = F.struct(
                F.col("id"),
                F.col(f"{side}.customer_id").alias("customer_id"),
                F.when((kind == 12) & F.lit(side == "after"), F.lit("n/a")).otherwise(F.col(f"{side}.amount").cast("string")).alias("amount"),
                F.col(f"{side}.status").alias("status"),
            )
            return F.when(F.col(side).isNotNull(), shown)

        after, before = image_json("after"), image_json("before")
        shown = (
            F.when(kind == 7, F.to_json(F.struct(after["amount"].alias("amount"), after["status"].alias("status"))))
            .when(
                kind == 10,
                F.to_json(F.struct("id", after["customer_id"].alias("customer_id"), after["status"].alias("status"))),
            )
            .otherwise(F.to_json(after))
        )
        source = F.when(wrapped, F.lit(',"source":{"schema":"public","table":"orders"}')).otherwise("")
        event = F.concat(
            F.lit('{"op":"'), F.col("op"), F.lit('","ts_ms":'), F.col("ts_ms").cast("string"),
            F.lit(',"before":'), F.coalesce(F.to_json(before), F.lit("null")),
            F.lit(',"after":'), F.coalesce(shown, F.lit("null")), source, F.lit("}"),
        )
        content = (
            F.when(kind == 6, F.lit('{"op":"u","after":{"id":'))
            .when((kind == 9) & (F.col("partition") == 1), F.to_json(F.struct(F.concat(F.col("ts_ms").cast("string"), F.lit(".0000000003")).alias("resolved"))))
            .when(kind == 9, F.to_json(F.struct(F.col("ts_ms").alias("resolved"))))
            .otherwise(event)
        )
        value = F.when(kind == 4, F.lit(None).cast("string")).when(
            wrapped & (kind != 6), F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), content, F.lit("}"))
        ).otherwise(content)
        key_json = F.to_json(F.struct("id"))
        keyless = (
            kind.isin(7, 9)
            | ((kind == 1) & (F.col("s0") == "P"))
            | ((kind == 3) & (F.col("priority") == "5-LOW"))
        )
        key = F.when(~keyless, F.when(wrapped, F.concat(F.lit('{"schema":{},"payload":'), key_json, F.lit("}"))).otherwise(key_json))
        return key, value

    # customers and suppliers --------------------------------------------------------------------

    def _customer_events(self) -> DataFrame:
        seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
        late = seg == "BUILDING"
        name, owed = F.col("c_name"), bal.cast("decimal(12,2)")
        rich = bal > 5000
        raised = F.when(rich, owed + 100).otherwise(owed)

        def event(kind: int, op: Column, ms: Column, name: Column, segment: Column, balance: Column) -> Column:
            values = (name.cast("string").alias("name"), segment.cast("string").alias("segment"), balance.cast("decimal(12,2)").alias("balance"))
            return F.struct(F.lit(kind).alias("kind"), op.alias("op"), ms.cast("bigint").alias("ts_ms"), *values)

        gone = F.lit(None)
        made = F.when(late, F.lit(_ms(1996, 1, 1))).otherwise(F.lit(_ms(1994, 12, 1)))
        events = [
            (F.lit(True), event(0, F.when(late, "c").otherwise("r"), made, name, seg, owed)),
            (rich, event(1, F.lit("u"), F.lit(_ms(1997, 1, 1)), name, seg, raised)),
            (seg == "MACHINERY", event(2, F.lit("u"), F.lit(_ms(1997, 6, 1)), name, gone, raised)),
            (bal < 0, event(3, F.lit("d"), F.lit(_ms(1998, 1, 1)), gone, gone, gone)),
        ]
        return _events(self.table("customer"), events)

    def customer_changes(self) -> DataFrame:
        return self._customer_events().select(
            F.lit(CUSTOMERS).alias("topic"),
            F.pmod("c_custkey", F.lit(PARTITIONS)).cast("int").alias("partition"),
            (F.col("c_custkey") * 20 + F.col("kind")).alias("offset"),
            F.col("c_custkey").alias("id"),
            "op",
            "name",
            "segment",
            "balance",
            "ts_ms",
        )

    def supplier_changes(self) -> DataFrame:
        """Suppliers of another schema: read once, debts settled to zero, those of one nation removed."""
        owed = F.col("s_acctbal").cast("decimal(12,2)")

        def event(kind: int, op: str, ms: int, balance: Column) -> Column:
            at = F.lit(ms).cast("bigint").alias("ts_ms")
            return F.struct(F.lit(kind).alias("kind"), F.lit(op).alias("op"), at, balance.cast("decimal(12,2)").alias("balance"))

        events = [
            (F.lit(True), event(0, "r", _ms(1995, 1, 1), owed)),
            (owed < 0, event(1, "u", _ms(1995, 2, 1), F.lit(0))),
            (F.col("s_nationkey") == 7, event(2, "d", _ms(1995, 3, 1), F.lit(None))),
        ]
        return _events(self.table("supplier"), events).select(
            F.lit(SUPPLIERS).alias("topic"),
            F.pmod("s_suppkey", F.lit(PARTITIONS)).cast("int").alias("partition"),
            (F.col("s_suppkey") * 20 + F.col("kind")).alias("offset"),
            F.col("s_suppkey").cast("bigint").alias("supplier_id"),
            "op",
            F.when(F.col("op") != "d", F.col("s_nationkey").cast("bigint")).alias("nation_id"),
            "balance",
            "ts_ms",
        )

    @staticmethod
    def _flat_json(changes: DataFrame, key: str, values: list[str]) -> tuple[Column, Column]:
        """Key and value of flat changes as bare JSON."""
        shown = [F.col(v).cast("string").alias(v) if changes.schema[v].dataType.typeName() == "decimal" else F.col(v) for v in values]
        after = F.when(F.col("op") != "d", F.struct(key, *shown))
        return F.to_json(F.struct(key)), _json(F.col("op"), F.col("ts_ms"), after.alias("after"))

    @staticmethod
    def to_raw(changes: DataFrame, key: str, values: list[str]) -> DataFrame:
        """Flat changes as bare JSON log rows."""
        text, value = Lake._flat_json(changes, key, values)
        rows = changes.select("topic", "partition", "offset", F.timestamp_millis("ts_ms").alias("ts"), "ts_ms", "op", key, *values)
        return once(rows, key=text, value=value).select("topic", "partition", "offset", "ts", "key", "value")

    CUSTOMER_JSON = ("id", ["name", "segment", "balance"])
    SUPPLIER_JSON = ("supplier_id", ["nation_id", "balance"])

    def customer_raw(self) -> DataFrame:
        return self.to_raw(self.customer_changes(), *self.CUSTOMER_JSON)

    def supplier_raw(self) -> DataFrame:
        return self.to_raw(self.supplier_changes(), *self.SUPPLIER_JSON)

    def raw(self) -> DataFrame:
        """All topics in one log."""
        return self.order_raw().unionByName(self.customer_raw()).unionByName(self.supplier_raw())

    # other shapes ---------------------------------------------------------------------------

    def partition_topics(self) -> DataFrame:
        """Orders as one topic per month, the way a range-partitioned source publishes them."""
        o = self.table("orders")
        return o.select(
            F.concat(F.lit("shop.public.orders_"), F.date_format("o_orderdate", "yyyy_MM")).alias("topic"),
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.col("o_orderstatus").alias("status"),
        )

    def partition_raw(self) -> DataFrame:
        """The logs of the monthly topics. An order above 150000 moves to another month, for some an earlier one: a removal and a new row
        within the same millisecond, told apart by nanoseconds or by the counter of a hybrid clock. Low-priority orders are removed
        in the end, again within that millisecond."""
        o = self.table("orders")
        amount = F.col("o_totalprice").cast("decimal(12,2)")
        base = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
        moved, dropped = amount > 150000, F.col("o_orderpriority") == "5-LOW"
        away = F.add_months("o_orderdate", F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1))
        rows = o.select(
            F.col("o_orderkey").alias("id"), F.pmod("o_custkey", F.lit(3)).alias("turn"), base.alias("base_ms"),
            amount.alias("a0"), F.col("o_orderstatus").alias("s0"), F.col("o_orderdate").alias("home"), F.when(moved, away).otherwise(F.col("o_orderdate")).alias("last"),
            moved.alias("moved"), dropped.alias("dropped"),
        )

        def event(step: int, op: str, month: str, amount: Column, status: Column) -> Column:
            return F.struct(
                F.lit(step).alias("step"), F.lit(op).alias("op"), F.col(month).alias("month"),
                amount.cast("decimal(12,2)").alias("amount"), status.alias("status"),
            )

        gone = F.lit(None).cast("string")
        events = [
            (F.lit(True), event(0, "c", "home", F.col("a0"), F.col("s0"))),
            (F.col("moved"), event(1, "d", "home", F.lit(None), gone)),
            (F.col("moved"), event(2, "c", "last", F.col("a0") + 1, F.lit("moved"))),
            (F.col("dropped"), event(3, "d", "last", F.lit(None), gone)),
        ]
        made = _events(rows, events)
        nanos = F.concat(F.col("base_ms").cast("string"), F.lit("000000"))
        counted = F.concat(nanos, F.lit(".000000000"), F.col("step").cast("string"))
        # a third of the rows each: nanoseconds, a counter at the top, a counter in the source block
        clock = (
            F.when(F.col("turn") == 0, F.concat(F.lit(',"ts_ns":'), F.col("base_ms").cast("string"), F.lit("00000"), F.col("step").cast("string")))
            .when(F.col("turn") == 1, F.concat(F.lit(',"updated":"'), counted, F.lit('"')))
            .otherwise(F.concat(F.lit(',"ts_ns":'), nanos, F.lit(',"source":{"ts_hlc":"'), counted, F.lit('"}')))
        )
        after = F.when(F.col("op") == "c", F.to_json(F.struct("id", F.col("amount").cast("string").alias("amount"), "status")))
        value = F.concat(
            F.lit('{"op":"'), F.col("op"), F.lit('","ts_ms":'), F.col("base_ms").cast("string"), clock, F.lit(',"after":'), F.coalesce(after, F.lit("null")), F.lit("}"),
        )
        named = once(made, key=F.to_json(F.struct("id")), value=value)
        # an offset says nothing about another topic: here the later step of a move has the smaller one
        return named.select(
            F.concat(F.lit(f"{ORDERS}_"), F.date_format("month", "yyyy_MM")).alias("topic"), F.lit(0).alias("partition"),
            (F.col("id") * 20 + 9 - F.col("step")).alias("offset"), F.timestamp_millis("base_ms").alias("ts"), "key", "value",
        )

    def wide_raw(self) -> DataFrame:
        """One create event per row of ``events``, holding every wire form."""
        e = self.table("events").withColumnRenamed("value", "reading")
        at = F.col("ts").cast("timestamp")
        micros = F.unix_micros(at)
        ahead = at + F.expr("INTERVAL 2 HOURS")
        price = F.col("reading").cast("decimal(12,2)")
        cents = ((price - 50) * 100).cast("bigint")
        kind = F.col("event_type")
        k = F.get_json_object("props", "$.k").cast("int")
        first = F.struct(kind.alias("name"), k.alias("count"), price.alias("value"))
        second = F.struct(F.lit("user").alias("name"), F.col("user_id").cast("int").alias("count"), F.lit(0).cast("decimal(12,2)").alias("value"))
        forms = {
            "string": F.col("props"),
            "int": F.col("user_id"),
            "bool": F.col("reading") > 50,
            "decimal": price.cast("string"),
            "connect_decimal": F.base64(F.unhex(F.lpad(F.hex(cents), 16, F.lit("0")))),
            "json": F.to_json(F.struct(F.array(first, second).alias("parts"))),
            "bytes": F.base64(kind.cast("binary")),
            "array": F.array(kind, F.concat(F.lit("user"), F.col("user_id").cast("string"))),
            "micro_timestamp": micros,
            "zoned_timestamp": F.concat(F.date_format(ahead, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")),
            "micro_time": F.pmod(micros, F.lit(DAY_MS * 1000)),
            "zoned_time": F.concat(F.date_format(ahead, "HH:mm:ss.SSSSSS"), F.lit("+02:00")),
            "date": F.unix_date(F.to_date("ts")),
        }
        fine = F.concat(F.col("event_id").cast("string"), F.lit("."), F.lpad(F.col("user_id").cast("string"), 18, F.lit("0")))
        fields = [F.col("event_id"), *(forms[form].alias(f"as_{form}") for form in WIRE_FORMS), fine.alias("as_fine_decimal"), stable_uuid(F.col("event_id")).alias("uuid")]
        channel = F.when(kind != "click", F.lit("app")).alias("channel")
        head = [F.lit("c").alias("op"), F.unix_millis(at).alias("ts_ms")]
        bare, full = (_json(*head, F.struct(*fields, *more).alias("after")) for more in ((), (channel,)))
        rows = once(e, key=F.to_json(F.struct("event_id")), value=F.when(kind == "view", bare).otherwise(full))
        return rows.select(
            F.lit("shop.public.wide").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), at.alias("ts"), "key", "value"
        )

    def line_changes(self) -> DataFrame:
        """Line items as repeated writes to a composite key; later ship dates win, then part and supplier."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.when(F.col("l_returnflag") == "R", "d").otherwise("u").alias("op"),
            F.col("l_shipdate").alias("shipped_at"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        )

    LINE_POS = ("shipped_at", "part_id", "supplier_id", "quantity", "price")

    def transfers(self) -> DataFrame:
        """Each order is a payment from its customer to one of 25 merchant accounts (negative ids)."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("offset"),
            F.col("o_custkey").alias("payer"),
            (-1 - F.pmod("o_custkey", F.lit(25))).alias("payee"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        )

    def balances(self) -> DataFrame:
        own = self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance")
        )
        merchants = self.table("nation").select(
            (-1 - F.col("n_nationkey").cast("bigint")).alias("id"), F.lit(0).cast("decimal(18,2)").alias("balance")
        )
        return own.unionByName(merchants)

    def metric_lines(self) -> DataFrame:
        """One exporter line per row of ``events``: four hop counters by event type, and for errors the
        connector's identity, engine series and lines no rule knows."""
        user = F.col("user_id").cast("string")
        task = F.concat(F.lit(", task="), (F.col("user_id") % 3).cast("string"), F.lit("><>"))
        shown = F.col("value").cast("decimal(12,2)").cast("string")
        kind = F.col("event_type")

        def hop(side: str, verb: str) -> Column:
            return F.concat(
                F.lit(f"kafka.connect<type={side}-task-metrics, connector=conn"), user, task, F.lit(f"{side}-record-{verb}-total: "), shown
            )

        def identity(attribute: str, text: Column) -> Column:
            return F.concat(F.lit("kafka.connect<type=connector-metrics, connector=conn"), user, F.lit(f"><>{attribute}: "), text)

        k = F.get_json_object("props", "$.k").cast("int")
        error = (
            F.when(k < 20, identity("connector-version", F.concat(F.lit("3."), k.cast("string"))))
            .when(k < 40, identity("connector-type", F.when(k < 30, "source").otherwise("sink")))
            .when(k < 60, identity("status", F.when(k < 55, "running").otherwise("paused")))
            .when(k < 70, identity("connector-class", F.concat(F.lit("example.Class"), (k % 3).cast("string"))))
            .when(
                k < 80,
                F.concat(F.lit("capture.shop<type=connector-metrics, context=streaming, server=s"), user, F.lit("><>MilliSecondsBehindSource: "), shown),
            )
            .when(
                k < 90,
                F.concat(F.lit("capture.shop<type=connector-metrics, context=snapshot, server=s"), user, F.lit("><>SnapshotRunning: "), (k % 2).cast("string")),
            )
            .otherwise(F.concat(F.lit("java.lang<type=Memory><>HeapUsed: "), shown))
        )
        line = (
            F.when(kind == "click", hop("source", "poll"))
            .when(kind == "view", hop("source", "write"))
            .when(kind == "purchase", hop("sink", "read"))
            .when(kind == "signup", hop("sink", "send"))
            .otherwise(error)
        )
        return once(self.table("events"), line=line).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "line")

    def slices(self) -> int:
        return len(SLICE_YEARS) + 1

    def order_slice(self, k: int) -> DataFrame:
        """The order log of one span of years by append time, as a source would hand it over."""
        number = F.lit(0)
        for year in SLICE_YEARS:
            number = number + (F.year("ts") >= year).cast("int")
        return self.order_raw().filter(number == k)

    def raw_files(self, least: int = 6, rows_a_file: int = 500_000) -> str:
        """The whole log (``raw``) written once, oldest first, for streaming runs.

        As many files as its rows ask for, and ``least`` of them so that a small log has several batches too. Rows are
        counted, sampled and dealt out as events; each becomes JSON once, as it is written.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, least)
        if key not in _RAW_FILES:
            path = self.scratch("raw")
            customers, suppliers = (c.withColumn("ts", F.timestamp_millis("ts_ms")) for c in (self.customer_changes(), self.supplier_changes()))
            events = self.order_rows().unionByName(customers, allowMissingColumns=True).unionByName(suppliers, allowMissingColumns=True)
            dealt = events.repartitionByRange(self.files_for(events, least, rows_a_file), "ts", "offset")
            texts = {ORDERS: self._order_json(), CUSTOMERS: self._flat_json(customers, *self.CUSTOMER_JSON), SUPPLIERS: self._flat_json(suppliers, *self.SUPPLIER_JSON)}
            for i, (topic, (text, value)) in enumerate(texts.items()):  # one step each: generated code that is too long stays uncompiled
                mine = F.col("topic") == topic
                dealt = once(dealt, **{f"_key{i}": F.when(mine, text), f"_value{i}": F.when(mine, value)})
            found = [F.coalesce(*[f"_{c}{i}" for i in range(len(texts))]).alias(c) for c in ("key", "value")]
            self.write_log(dealt.select("topic", "partition", "offset", "ts", *found), path)
            _RAW_FILES[key] = path
        return _RAW_FILES[key]


_RAW_FILES: dict[tuple, str] = {}

# The same logs in SQL --------------------------------------------------------------------------

_ORDER_CTES = """
b AS (
  SELECT o_orderkey AS id, o_custkey AS c0, CAST(o_totalprice AS DECIMAL(12,2)) AS a0, o_orderstatus AS s0,
         o_orderpriority AS priority, epoch_ms(o_orderdate) AS base_ms,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS shipped,
         CAST(o_totalprice AS DECIMAL(12,2)) > 300000 AS moved,
         o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW') AS removed
  FROM orders),
steps AS (
  SELECT *, removed AND a0 > 250000 AS reopened, shipped AND s0 = 'F' AS redelivered,
         CASE WHEN shipped THEN CAST(a0 + 10 AS DECIMAL(12,2)) ELSE a0 END AS a1,
         CASE WHEN shipped THEN 'shipped' ELSE s0 END AS s1
  FROM b),
ch AS (
  SELECT id * 20 AS seq, id, CASE WHEN s0 = 'F' THEN 'r' ELSE 'c' END AS op, c0 AS customer_id, a0 AS amount,
         s0 AS status, base_ms AS ts_ms FROM steps
  UNION ALL SELECT id * 20 + 1, id, 'u', c0, a1, s1, base_ms + 86400000 FROM steps WHERE shipped
  UNION ALL SELECT id * 20 + 2, id, 'u', c0 + 1, a1, s1, base_ms + 172800000 FROM steps WHERE moved
  UNION ALL SELECT id * 20 + 3, id, 'd', NULL, NULL, NULL, base_ms + 259200000 FROM steps WHERE removed
  UNION ALL SELECT id * 20 + 5, id, 'c', c0, a0, 'reopened', base_ms + 345600000 FROM steps WHERE reopened
  UNION ALL SELECT id * 20 + 1, id, 'u', c0, a1, s1, base_ms + 86400000 FROM steps WHERE redelivered),
mirror AS (
  SELECT id, customer_id, amount, status, seq, ts_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM ch) WHERE rn = 1 AND op <> 'd')"""

_WIRE_CTES = """
wire AS (
  SELECT id, seq - id * 20 AS kind, seq, op, ts_ms FROM ch
  UNION ALL SELECT id, 4, id * 20 + 4, NULL, base_ms + 259200000 FROM steps WHERE removed
  UNION ALL SELECT id, 6, id * 20 + 6, NULL, base_ms + 432000000 FROM steps WHERE reopened
  UNION ALL SELECT id, 7, id * 20 + 7, 'u', base_ms + 432000000 FROM steps WHERE redelivered
  UNION ALL SELECT id, 8, id * 20 + 8, 't', base_ms + 432000000 FROM steps WHERE moved AND s0 = 'F'
  UNION ALL SELECT id, 9, id * 20 + 9, NULL, base_ms FROM steps WHERE s0 = 'O'
  UNION ALL SELECT id, 10, id * 20 + 10, 'u', base_ms + 432000000 FROM steps WHERE shipped AND s0 = 'O'
  UNION ALL SELECT id, 11, id * 20 + 11, 'u', base_ms + 432000000 FROM steps WHERE moved AND s0 = 'O'
  UNION ALL SELECT id, 12, id * 20 + 12, 'u', base_ms + 432000000 FROM steps WHERE moved AND s0 = 'P')"""

_CUSTOMER_CTES = """
cch AS (
  SELECT c_custkey * 20 AS seq, c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'c' ELSE 'r' END AS op,
         c_name AS name, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(12,2)) AS balance,
         epoch_ms(CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '1996-01-01' ELSE TIMESTAMP '1994-12-01' END) AS ts_ms
  FROM customer
  UNION ALL SELECT c_custkey * 20 + 1, c_custkey, 'u', c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(12,2)) + 100,
         epoch_ms(TIMESTAMP '1997-01-01') FROM customer WHERE c_acctbal > 5000
  UNION ALL SELECT c_custkey * 20 + 2, c_custkey, 'u', c_name, NULL,
         CAST(c_acctbal AS DECIMAL(12,2)) + CASE WHEN c_acctbal > 5000 THEN 100 ELSE 0 END,
         epoch_ms(TIMESTAMP '1997-06-01') FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey * 20 + 3, c_custkey, 'd', NULL, NULL, NULL,
         epoch_ms(TIMESTAMP '1998-01-01') FROM customer WHERE c_acctbal < 0),
cmirror AS (
  SELECT id, name, segment, CAST(balance AS DECIMAL(12,2)) AS balance FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM cch) WHERE rn = 1 AND op <> 'd')"""

_SUPPLIER_CTES = """
sch AS (
  SELECT s_suppkey * 20 AS seq, s_suppkey AS supplier_id, 'r' AS op, s_nationkey AS nation_id, CAST(s_acctbal AS DECIMAL(12,2)) AS balance FROM supplier
  UNION ALL SELECT s_suppkey * 20 + 1, s_suppkey, 'u', s_nationkey, 0 FROM supplier WHERE s_acctbal < 0
  UNION ALL SELECT s_suppkey * 20 + 2, s_suppkey, 'd', NULL, NULL FROM supplier WHERE s_nationkey = 7),
smirror AS (
  SELECT CAST(s_suppkey AS BIGINT) AS supplier_id, CAST(s_nationkey AS BIGINT) AS nation_id, CAST(greatest(s_acctbal, 0) AS DECIMAL(12,2)) AS balance
  FROM supplier WHERE s_nationkey <> 7)"""

_METRIC_CTES = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(value AS DECIMAL(12,2)) AS shown FROM events),
metric AS (
  SELECT event_id, ts,
    CASE event_type WHEN 'click' THEN 'kafka_connect_source_record_poll_total'
                    WHEN 'view' THEN 'kafka_connect_source_record_write_total'
                    WHEN 'purchase' THEN 'kafka_connect_sink_record_read_total'
                    WHEN 'signup' THEN 'kafka_connect_sink_record_send_total'
                    ELSE CASE WHEN k < 20 THEN 'kafka_connect_connector_version' WHEN k < 40 THEN 'kafka_connect_connector_type'
                              WHEN k < 60 THEN 'kafka_connect_connector_status' WHEN k < 70 THEN 'kafka_connect_connector_class'
                              WHEN k < 80 THEN 'capture_metrics_MilliSecondsBehindSource'
                              WHEN k < 90 THEN 'capture_metrics_SnapshotRunning' END END AS name,
    CASE WHEN event_type <> 'error' OR k < 70 THEN 'conn' || user_id END AS connector,
    CASE WHEN event_type <> 'error' THEN CAST(user_id % 3 AS VARCHAR) END AS task,
    CASE WHEN event_type = 'error' AND k < 20 THEN '3.' || k END AS version,
    CASE WHEN event_type = 'error' AND k >= 20 AND k < 40 THEN CASE WHEN k < 30 THEN 'source' ELSE 'sink' END END AS type,
    CASE WHEN event_type = 'error' AND k >= 40 AND k < 60 THEN CASE WHEN k < 55 THEN 'running' ELSE 'paused' END END AS status,
    CASE WHEN event_type = 'error' AND k >= 60 AND k < 70 THEN 'example.Class' || (k % 3) END AS class,
    CASE WHEN event_type = 'error' AND k < 70 THEN 1.0
         WHEN event_type = 'error' AND k >= 80 AND k < 90 THEN k % 2
         ELSE CAST(shown AS DOUBLE) END AS value
  FROM ev WHERE event_type <> 'error' OR k < 90)"""


def order_sql(body: str) -> str:
    """SQL over ``ch`` (all order changes), ``steps`` and ``mirror`` (latest live rows)."""
    return f"WITH {_ORDER_CTES}\n{body}"


def wire_sql(body: str) -> str:
    return f"WITH {_ORDER_CTES},{_WIRE_CTES}\n{body}"


def customer_sql(body: str) -> str:
    return f"WITH {_CUSTOMER_CTES}\n{body}"


def shop_sql(body: str) -> str:
    """SQL over the order, customer and supplier logs together."""
    return f"WITH {_ORDER_CTES},{_WIRE_CTES},{_CUSTOMER_CTES},{_SUPPLIER_CTES}\n{body}"


def metric_sql(body: str) -> str:
    return f"WITH {_METRIC_CTES}\n{body}"
