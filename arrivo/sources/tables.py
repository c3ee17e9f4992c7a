"""The driver's Parquet tables and their mapping to the trip shape.

``trips`` turns lineitem + orders + customer + supplier + nation into one
row per lineitem with the roles of a flight record (SURVEY 7.3). Nations, and
suppliers up to a measured size, are broadcast; Catalyst and AQE choose for
the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivo.operators.joins import broadcast_bytes, measured

TRIP_COLUMNS = (
    "trip_year", "trip_month", "trip_day", "trip_dow", "carrier", "route_num",
    "vehicle_id", "sched_minutes", "arr_delay", "dep_delay", "cancel_code",
    "origin", "dest", "distance", "taxi_out", "cancelled", "o_orderkey",
)

# Header of the vehicle dimension, in order
DIMENSION_HEADER = ("tailnum", "type", "manufacturer", "issue_date", "model",
                    "status", "aircraft_type", "engine_type", "year")


TRIPS_CONTRACT = {
    "trip_year": T.IntegerType(), "trip_month": T.IntegerType(), "trip_day": T.IntegerType(),
    "trip_dow": T.IntegerType(), "carrier": T.StringType(), "route_num": T.IntegerType(),
    "vehicle_id": T.StringType(), "sched_minutes": T.IntegerType(),
    "arr_delay": T.StringType(), "dep_delay": T.StringType(), "cancel_code": T.StringType(),
    "origin": T.StringType(), "dest": T.StringType(), "distance": T.IntegerType(),
    "taxi_out": T.StringType(), "cancelled": T.IntegerType(), "o_orderkey": T.LongType(),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _na_when(cond, value):
    return F.when(cond, F.lit("NA")).otherwise(value)


#: Bytes of suppliers (as ``measured`` counts them) up to which they are
#: broadcast; beyond it they are shuffled.
SUPPLIER_BYTES = 64 << 20


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item. Line items are cut to their trip values before
    the joins, and names join last, so that shuffles move keys and small
    numbers. The last shuffle is by order key, a column of the result: a
    whole-row distinct then needs no other."""
    ship = F.to_date("l_shipdate")
    dep_delay = F.round(100 * F.col("l_discount")).cast("int") - 5
    # a delay that a model can learn: departure, taxi time, distance and month,
    # and a part that no feature explains
    arr_delay = (3 * dep_delay + 4 * F.col("l_linenumber").cast("int") + (F.col("l_quantity") / 2).cast("int")
                 + 2 * F.month(ship) + (F.col("l_extendedprice") / 10000).cast("int") - 40)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", ship.alias("ship"),
        F.col("l_partkey").cast("int").alias("route_num"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_tax") > 0.04), F.lit(None).cast("int"))
         .otherwise(30 + 10 * F.col("l_linenumber")).alias("sched_minutes"),
        arr_delay.alias("arr"), dep_delay.alias("dep"), F.col("l_quantity").cast("int").alias("distance"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1).otherwise(0).alias("cancelled"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    origin = nation.select(F.col("n_nationkey").alias("on"), F.col("n_name").alias("origin"))
    dest = nation.select(F.col("n_nationkey").alias("dn"), F.col("n_name").alias("dest"))
    supplier = (table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
                .join(F.broadcast(origin), F.col("s_nationkey") == F.col("on"))
                .select("s_suppkey", "s_name", "origin"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # orders meet customers first, while they are a quarter of the lineitem rows
    orders = (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
              .join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_orderpriority", "c_nationkey"))
    by_order, by_supplier = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_suppkey") == F.col("s_suppkey")
    if broadcast_bytes(spark) >= 0 and measured(supplier)[1] <= SUPPLIER_BYTES:
        j = li.join(orders, by_order).join(F.broadcast(supplier), by_supplier)
    else:
        j = li.join(supplier, by_supplier).join(orders, by_order)
    j = j.join(F.broadcast(dest), F.col("c_nationkey") == F.col("dn"))
    okey = F.col("o_orderkey")
    return j.select(
        F.year("ship").alias("trip_year"),
        F.month("ship").alias("trip_month"),
        F.dayofmonth("ship").alias("trip_day"),
        (F.weekday("ship") + 1).alias("trip_dow"),
        F.col("s_name").alias("carrier"),
        F.col("route_num"),
        _na_when(F.col("l_linenumber") == 6, F.col("route_num").cast("string")).alias("vehicle_id"),
        F.col("sched_minutes"),
        _na_when(okey % 50 == 0, F.col("arr").cast("string")).alias("arr_delay"),
        _na_when(okey % 25 == 3, F.col("dep").cast("string")).alias("dep_delay"),
        _na_when(okey % 10 < 4, F.col("o_orderpriority")).alias("cancel_code"),
        F.col("origin"),
        F.col("dest"),
        F.col("distance"),
        F.col("l_linenumber").cast("string").alias("taxi_out"),
        F.col("cancelled"),
        okey.alias("o_orderkey"),
    )


def vehicle_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a 9-column vehicle dimension: the key is the part key as
    text, model = p_type (unknown for some), engine type = p_brand. Parts of
    sizes 41 to 43 are listed twice, with another model."""
    part = table(spark, sf_dir, "part")
    twice = part.filter(F.col("p_size").between(41, 43)).withColumn("p_type", F.concat("p_type", F.lit(" II")))
    return part.unionByName(twice).select(
        F.col("p_partkey").cast("string").alias("tailnum"),
        F.col("p_size").cast("string").alias("type"),
        F.col("p_name").alias("manufacturer"),
        F.lit(None).cast("string").alias("issue_date"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_type")).alias("model"),
        F.lit("Valid").alias("status"),
        F.lit(None).cast("string").alias("aircraft_type"),
        F.col("p_brand").alias("engine_type"),
        F.lit(None).cast("string").alias("year"),
    )


def place_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, city) lookup: nation name -> region name."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_name").alias("code"), F.col("r_name").alias("city")))
