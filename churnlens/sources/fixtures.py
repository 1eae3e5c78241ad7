"""Adapter: the driver's TPC-H-style test tables -> the seven raw SaaS tables.

The mapping rules (which order becomes a subscription, which line item a
support ticket, how statuses are derived) are data-definition rules of the
fixture, applied identically by the SQL oracle; they are not sampling.
customer -> companies, (customer, order key mod 4) -> users,
lineitem -> events, orders -> payments and subscriptions, part -> plans,
returned line items -> support tickets. Dirt is derived from keys: several
date and time layouts, unparsable values, blank keys, copies and orphans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import MONEY, RAW

# Fixed values of the fixture mapping.
PLAN_NAMES = {1: "Basic", 2: "Pro", 3: "Enterprise"}
EVENT_TYPE_BY_LINE = {1: "page_created", 2: "file_uploaded", 3: "invite_sent"}  # else login
USERS_PER_COMPANY_MOD = 4
ACTIVE_USER_SINCE = _dt.datetime(2001, 1, 1)
TIME_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm:ss",
                "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm")
JOIN_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy")


def _layout(c: Column, number: Column, layouts: tuple) -> Column:
    """A date or time as text in the layout of that number."""
    out = F.date_format(c, layouts[-1])
    for i, layout in enumerate(layouts[:-1]):
        out = F.when(number == i, F.date_format(c, layout)).otherwise(out)
    return out


def _copies(df: DataFrame, second: Column, third: Column | None = None) -> DataFrame:
    """Every row with copy 0, again as copy 1 where ``second``, as copy 2 where ``third``."""
    numbers = F.array(F.lit(0), F.when(second, 1), F.when(third, 2) if third is not None else F.lit(None))
    return df.withColumn("copy", F.explode(F.array_compact(numbers)))


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _txt(prefix: str, *cols) -> Column:
    parts = [F.lit(prefix)]
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(c.cast("string"))
    return F.concat(*parts)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer = _read(spark, sf_dir, "customer",
                     ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    orders = _read(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    lineitem = _read(spark, sf_dir, "lineitem",
                     ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                      "l_shipdate"])

    first_order = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("signup_date"))
    key = F.col("c_custkey")
    companies = _copies(
        customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
        .join(first_order, F.col("o_custkey") == key, "left"), key % 41 == 0, key % 43 == 0)
    companies = companies.select(
        F.when(F.col("copy") == 2, " ").otherwise(_txt("c", key)).alias("company_id"),
        F.col("c_name").alias("company_name"),
        "signup_date",
        F.col("c_mktsegment").alias("acquisition_channel"),
        _txt("industry_", F.col("n_regionkey")).alias("industry"),
        (F.lit(1) + (key * 7) % 1500).cast("int").alias("company_size"),
        F.col("n_name").alias("country"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.lit("active")).alias("status"))

    customer_key, slot = F.col("o_custkey"), F.col("slot")
    recent = F.col("last_o") >= F.lit(ACTIVE_USER_SINCE.isoformat(sep=" ")).cast("timestamp_ntz")
    even = customer_key % 2 == 0
    users = (orders.groupBy("o_custkey", (F.col("o_orderkey") % USERS_PER_COMPANY_MOD).alias("slot"))
             .agg(F.min("o_orderdate").alias("first_o"), F.max("o_orderdate").alias("last_o"))
             .select(_txt("u", customer_key, slot).alias("user_id"),
                     F.when((customer_key % 47 == 0) & (slot == 3), "c-unknown")
                     .otherwise(_txt("c", customer_key)).alias("company_id"),
                     F.when(slot == 0, "admin").otherwise("member").alias("role"),
                     _layout(F.col("first_o"), customer_key % 3, JOIN_LAYOUTS).alias("join_date"),
                     F.when(customer_key % 53 == 0, "never")
                     .otherwise(F.date_format("last_o", "MM/dd/yyyy")).alias("last_active_date"),
                     F.when(recent, F.when(even, "t").otherwise("Yes"))
                     .otherwise(F.when(even, "f").otherwise("0")).alias("is_active")))

    li_o = lineitem.join(orders.select("o_orderkey", "o_custkey"),
                         F.col("l_orderkey") == F.col("o_orderkey"))
    order_key, line = F.col("l_orderkey"), F.col("l_linenumber")
    etype = F.lit("login")
    for k, v in EVENT_TYPE_BY_LINE.items():
        etype = F.when(line % 7 == k, F.lit(v)).otherwise(etype)
    events = _copies(li_o, order_key % 73 == 0).select(
        _txt("e", order_key, line).alias("event_id"),
        F.when(order_key % 89 == 0, "u-unknown")
        .otherwise(_txt("u", F.col("o_custkey"), order_key % USERS_PER_COMPANY_MOD)).alias("user_id"),
        etype.alias("event_type"),
        F.when((order_key % 61 == 0) & (line == 1), "not a time")
        .otherwise(_layout(F.col("l_shipdate"), line % 5, TIME_LAYOUTS)).alias("event_timestamp"))

    level = F.lit(1) + F.col("p_partkey") % 3
    part = _read(spark, sf_dir, "part", ["p_partkey", "p_retailprice"])
    plans = part.groupBy(level.alias("level")).agg(F.min(F.col("p_retailprice").cast(MONEY)).alias("least"))
    name = F.create_map(*[F.lit(x) for pair in PLAN_NAMES.items() for x in pair])
    plans = plans.select(_txt("p", F.col("level")).alias("plan_id"),
                         name[F.col("level").cast("int")].alias("plan_name"),
                         (F.col("level").cast("int") * F.col("least")).cast(MONEY).alias("price_per_user"),
                         F.when(F.col("level") == 3, "annual").otherwise("monthly").alias("billing_cycle"))

    order = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("date")
    open_sub = (F.col("o_orderstatus") == "O") & (order % 2 == 0)
    subscriptions = orders.select(
        _txt("s", order).alias("subscription_id"),
        _txt("c", F.col("o_custkey")).alias("company_id"),
        F.when(order % 71 == 0, "p9").otherwise(_txt("p", F.lit(1) + order % 3)).alias("plan_id"),
        F.when(order % 2 == 0, F.date_format(odate, "yyyy-MM-dd"))
        .otherwise(F.date_format(odate, "yyyyMMdd")).alias("start_date"),
        F.when(open_sub, F.lit("")).otherwise(
            F.date_add(odate, (30 * (1 + order % 12)).cast("int")).cast("string")).alias("end_date"),
        F.when((F.col("o_orderstatus") == "F") & (order % 3 == 0), "cancelled")
        .when(open_sub, "active").otherwise("expired").alias("status"))

    payments = orders.select(
        F.when(order % 67 == 0, "").otherwise(_txt("pay", order)).alias("payment_id"),
        _txt("c", F.col("o_custkey")).alias("company_id"),
        F.when(order % 53 == 0, "").when(order % 59 == 0, "n/a")
        .otherwise(F.col("o_totalprice").cast(MONEY).cast("string")).alias("amount"),
        odate.alias("payment_date"),
        F.when(order % 7 == 0, "failed")
        .when(order % 11 == 0, "declined").otherwise("paid").alias("payment_status"))

    pk7 = F.col("l_partkey") % 7
    tickets = li_o.where(F.col("l_returnflag") == "R").select(
        _txt("t", order_key, line).alias("ticket_id"),
        _txt("c", F.col("o_custkey")).alias("company_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_quantity").cast(MONEY).alias("resolution_time_hours"),
        F.when(pk7 == 0, F.lit("")).when(pk7 == 6, F.lit("n/a"))
        .otherwise(pk7.cast("string")).alias("satisfaction_score"))

    out = {"companies": companies, "users": users, "events": events,
           "subscription_plans": plans, "subscriptions": subscriptions,
           "payments": payments, "support_tickets": tickets}
    return {k: v.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[k].fields])
            for k, v in out.items()}


def events_with_breaks(events: DataFrame) -> DataFrame:
    """Raw events, those of each order's fourth line with a line break, quotes and a comma in their type."""
    odd = F.col("event_id").endswith("-4")
    noted = F.concat("event_type", F.lit('\n"'), "event_id", F.lit('", again'))
    return events.withColumn("event_type", F.when(odd, noted).otherwise(F.col("event_type")))
