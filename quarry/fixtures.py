"""Inputs derived by Spark from the given tables (never synthesised).

Each builder reads the generated Parquet tables and reshapes them into the
shapes the pipelines consume: raw nested envelopes, upsert stages, day-
partitioned copies, JSON landing zones.  Every builder's work grows with
the tables it reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.columns import row_hash
from .functions.times import epoch_millis_ntz
from .session import run_path
from .sources.scan import add_date_partitions

DAY_MS = 86_400_000
LINES_PER_RECORD = 64
ROWS_PER_WRITER = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- envelopes

def _line_struct():
    ship_ms = epoch_millis_ntz(F.col("l_shipdate"))
    is_open = F.col("l_linestatus") == F.lit("O")
    return F.struct(
        F.col("l_linenumber").cast("string").alias("lineNumber"),
        F.col("l_partkey").alias("partKey"),
        F.col("l_suppkey").alias("suppKey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("returnFlag"),
        # A type-choice field: shipped lines carry epoch ms, open ones text.
        F.struct(F.when(~is_open, ship_ms).alias("long"),
                 F.when(is_open, F.date_format(F.col("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss")).alias("string"),
                 ).alias("shippedAt"),
    )


def _order_struct(lines):
    created = epoch_millis_ntz(F.col("o_orderdate"))
    return F.struct(
        F.col("o_orderkey").cast("string").alias("orderId"),
        F.col("o_custkey").alias("custId"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("totalPrice"),
        created.cast("string").alias("createdAt"),
        (created + F.lit(DAY_MS)).cast("string").alias("updatedAt"),
        (F.col("o_orderstatus") == F.lit("O")).alias("active"),
        lines.alias("lines"),
    )


def raw_orders(spark: SparkSession, sf_dir: str, lines_per_record: int = LINES_PER_RECORD,
               orders: DataFrame | None = None, lineitem: DataFrame | None = None) -> DataFrame:
    """``_raw_data struct<orderId, custId, status, priority, totalPrice,
    createdAt, updatedAt, active, lines array<struct<…, shippedAt
    struct<long, string>>>>, _emitted_at bigint``.

    Lines are nested at most ``lines_per_record`` per record: an order with
    more lines (a hot key) is split over several records, salted by a line
    hash so the grouping never puts one huge array in one task.  Orders with
    no line keep one record whose ``lines`` is empty (status F) or null.
    """
    orders = orders if orders is not None else table(spark, sf_dir, "orders")
    lineitem = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")

    line_hash = F.xxhash64("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                           "l_returnflag", "l_linestatus", "l_shipdate")
    # Only hot keys need salts: at most one per ``lines_per_record`` lines.  They are written,
    # so Spark knows their size, and broadcasts them where they are few.
    hot = (lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("__n"))
                   .where(F.col("l_orderkey").isNotNull() & (F.col("__n") > lines_per_record))
                   .select("l_orderkey", F.ceil(F.col("__n") / F.lit(lines_per_record)).alias("__salts")))
    hot_path = run_path(spark, "hot_orders")
    hot.write.parquet(hot_path)
    hot = spark.read.schema(hot.schema).parquet(hot_path)
    lines = (lineitem.where(F.col("l_orderkey").isNotNull()).join(hot, "l_orderkey", "left")
                     .withColumn("__salt", F.coalesce(F.pmod(line_hash, F.col("__salts")), F.lit(0).cast("long")))
                     .drop("__salts"))
    w = Window.partitionBy("l_orderkey", "__salt").orderBy("__h", "l_linenumber", "l_partkey", "l_suppkey",
                                                          "l_extendedprice", "l_shipdate")
    # Explicit (key, salt) partitioning: a partitioning on the key alone
    # would satisfy the window's clustering and keep a hot key in one task.  The
    # hash is computed after it again, so its random bytes are not shuffled.
    chunks = (lines.repartition("l_orderkey", "__salt").withColumn("__h", line_hash)
                   .withColumn("__sub", F.floor((F.row_number().over(w) - 1) / F.lit(lines_per_record)))
                   .groupBy("l_orderkey", "__salt", "__sub")
                   .agg(F.collect_list(_line_struct()).alias("__lines")))
    # An order is repeated for each salt of its key and joins on both, so the lines stay
    # where they were grouped: they are shuffled once.
    parts = (orders.join(hot.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
                   .withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1))))
    found = parts.join(chunks, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("__part") == F.col("__salt")), "left")
    # A hot order has lines; a salt that got none of them is no record.
    nothing = F.col("__lines").isNull()
    lines_of = F.when(nothing & (F.col("o_orderstatus") == "F"), F.array().cast(chunks.schema["__lines"].dataType)).otherwise(F.col("__lines"))
    emitted = epoch_millis_ntz(F.col("o_orderdate")) + F.lit(2 * DAY_MS)
    return (found.where(~nothing | F.col("__salts").isNull())
                 .select(_order_struct(lines_of).alias("_raw_data"), emitted.alias("_emitted_at")))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``_raw_data struct<userId string, props string, event struct<id, type,
    value, at string (epoch ms)>>, _emitted_at bigint`` — one record per
    event (structs only, the input of the struct-flatten recipes)."""
    ev = table(spark, sf_dir, "events")
    at = epoch_millis_ntz(F.col("ts"))
    return ev.select(
        F.struct(F.col("user_id").cast("string").alias("userId"),
                 F.col("props").alias("props"),
                 F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"),
                          F.col("value").alias("value"), at.cast("string").alias("at")).alias("event"),
                 ).alias("_raw_data"),
        at.alias("_emitted_at"))


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders nested two levels deep (no arrays): ``id``, ``order struct<status,
    amount struct<total, priority>, customer struct<id, nation struct<key>>>``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority")).alias("amount"),
            F.struct(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("since")).alias("customer"),
        ).alias("order"),
        F.col("o_orderdate").alias("created"),
    )


def multi_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: two independent arrays, a nested array, a map, a null
    struct and an empty array — the cross-product case of flatten_all."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("n"),
        F.array(F.col("c_nationkey"), F.col("c_nationkey") + 100).alias("xs"),
        F.array(F.col("c_mktsegment"), F.col("c_name")).alias("ys"),
        F.create_map(F.lit("nation"), F.col("c_nationkey")).alias("m"),
        F.array(F.array(F.col("c_nationkey")), F.array(F.col("c_nationkey") + 1, F.col("c_nationkey") + 2)).alias("aa"),
        F.when(F.lit(False), F.struct(F.col("c_nationkey").alias("n"))).alias("nn"),
        F.array().cast("array<int>").alias("ea"),
    )


def long_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part: an array of twice as many numbers as its size (null for every
    seventh size) and one of two texts."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("n"),
                    F.when(F.col("p_size") % 7 != 0, F.sequence(F.lit(1), F.col("p_size") * 2)).alias("xs"),
                    F.array("p_brand", "p_type").alias("ys"))


# ---------------------------------------------------------------- upsert stage

TARGET_COLUMNS = ["id", "cust", "status", "price", "priority", "dt_updated"]


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
                    F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("dt_updated"))


def orders_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's change feed against ``orders_target``, derived row by row from
    orders by priority/status class:

    ========================  =======================================
    class                     stage row
    ========================  =======================================
    1-URGENT                  newer (+1 day), price + 1
    1-URGENT and status F     a second row, +2 days (duplicate id)
    2-HIGH and status F       older (−1 day), price × 2
    2-HIGH and status P       id null (never matches)
    3-MEDIUM and status O     same date, status X
    4-NOT SPECIFIED, status P date null
    5-LOW and status O        new id −(key + 1)
    ========================  =======================================
    """
    t = orders_target(spark, sf_dir)
    pr, st, d, price = F.col("priority"), F.col("status"), F.col("dt_updated"), F.col("price")
    day = F.expr("INTERVAL 1 DAY")
    null_id = F.lit(None).cast("bigint")
    null_ts = F.lit(None).cast("timestamp_ntz")

    def row(cond, id_=F.col("id"), status=st, price_=price, dt_=d):
        return F.struct(cond.alias("keep"), id_.alias("id"), F.col("cust").alias("cust"), status.alias("status"),
                        price_.alias("price"), pr.alias("priority"), dt_.alias("dt_updated"))

    # One scan of the target: each order yields 0-2 stage rows through one
    # generator, instead of one scan per change class.
    rows = F.array(
        row(pr == "1-URGENT", price_=price + 1.0, dt_=d + day),
        row((pr == "1-URGENT") & (st == "F"), price_=price + 2.0, dt_=d + day + day),
        row((pr == "2-HIGH") & (st == "F"), price_=price * 2.0, dt_=d - day),
        row((pr == "2-HIGH") & (st == "P"), id_=null_id),
        row((pr == "3-MEDIUM") & (st == "O"), status=F.lit("X")),
        row((pr == "4-NOT SPECIFIED") & (st == "P"), dt_=null_ts),
        row((pr == "5-LOW") & (st == "O"), id_=-(F.col("id") + 1)),
    )
    return t.select(F.explode(rows).alias("r")).where(F.col("r.keep")).select("r.*").drop("keep")


# ---------------------------------------------------------------- written copies

def write_by_day(df: DataFrame, ts: str, path: str) -> str:
    """Written as ``partition_0=YYYY/partition_1=MM/partition_2=DD`` of ``ts``."""
    # Day plus a row-hash salt: a large day is written by several tasks, and each
    # task writes few day folders.
    writers = max(1, -(-df.count() // ROWS_PER_WRITER))
    salt = [F.pmod(row_hash(df), F.lit(writers))] if writers > 1 else []
    (add_date_partitions(df, ts).repartition("partition_0", "partition_1", "partition_2", *salt)
        .write.mode("overwrite").partitionBy("partition_0", "partition_1", "partition_2").parquet(path))
    return path


def write_events_by_day(spark: SparkSession, sf_dir: str, path: str) -> str:
    return write_by_day(table(spark, sf_dir, "events"), "ts", path)


def write_zone(spark: SparkSession, sf_dir: str, landing: str, entities=("customer", "supplier", "part")) -> dict:
    """The landing zone: each entity as JSON files in its own folder."""
    out = {}
    for name in entities:
        p = f"{landing.rstrip('/')}/files/{name}/"
        table(spark, sf_dir, name).write.mode("overwrite").json(p)
        out[name] = p
    return out


def write_damaged_zone(spark: SparkSession, sf_dir: str, landing: str) -> str:
    """Customers as JSON lines; those in debt have lost the last character of
    theirs, those of nation 7 have text where a number belongs."""
    c = table(spark, sf_dir, "customer")
    whole = F.to_json(F.struct(*c.columns))
    worded = F.to_json(F.struct(*[F.lit("seven").alias(x) if x == "c_nationkey" else F.col(x) for x in c.columns]))
    cut = F.col("c_acctbal") < 0
    line = F.when(cut, F.substring(whole, F.lit(1), F.length(whole) - 1)).when(F.col("c_nationkey") == 7, worded).otherwise(whole)
    c.select(line.alias("value")).write.mode("overwrite").text(landing)
    return landing


def write_curated_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Orders as several Parquet drops whose column sets differ: orders with
    status P were exported without ``o_orderpriority``."""
    o = table(spark, sf_dir, "orders")
    o.where(F.col("o_orderstatus") != "P").write.mode("overwrite").parquet(f"{path}/drop=a")
    o.where(F.col("o_orderstatus") == "P").drop("o_orderpriority").write.mode("overwrite").parquet(f"{path}/drop=b")
    return path


def write_drifting_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Orders in three drops: the key is a number, later text; the customer an
    int, later a long; the price is missing from the last drop."""
    o, key, drop = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.pmod("o_orderkey", F.lit(3))
    o.where(drop == 0).withColumn("o_custkey", F.col("o_custkey").cast("int")).write.mode("overwrite").parquet(f"{path}/drop=a")
    o.where(drop == 1).withColumn("o_orderkey", key.cast("string")).write.mode("overwrite").parquet(f"{path}/drop=b")
    o.where(drop == 2).drop("o_totalprice").write.mode("overwrite").parquet(f"{path}/drop=c")
    return path


def events_drops(spark: SparkSession, sf_dir: str, n: int = 3) -> list[DataFrame]:
    """The events table split into ``n`` arrival drops (every row in exactly
    one drop)."""
    ev = table(spark, sf_dir, "events")
    return [ev.where(F.pmod(F.col("event_id"), F.lit(n)) == i) for i in range(n)]


AS_OF = dt.date(2024, 1, 20)
