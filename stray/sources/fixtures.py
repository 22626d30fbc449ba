"""Adapters from the driver's test tables to the reference's inputs.

These are fixtures, not reference operators: the reference consumes a
per-user feature table produced outside it and raw per-user logs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event types of the `events` table, one count feature each.
EVENT_TYPES = ("signup", "purchase", "error", "view", "click")

# Which event type stands in for which raw log.
LOG_EVENT_TYPES = {
    "logon": "signup",
    "device": "click",
    "file": "view",
    "email": "purchase",
    "http": "error",
}

EVENT_FEATURES = tuple(f"n_{t}" for t in EVENT_TYPES) + (
    "value_sum", "value_avg", "value_max", "value_std")
ORDER_FEATURES = ("n_orders", "price_avg", "price_max", "price_std", "n_priorities", "acctbal")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_features_from_events(events: DataFrame) -> DataFrame:
    """One row per user: a count per event type and sum/avg/max/pop-std of value.

    Conditional sums instead of pivot: no extra job for pivot values, and
    the aggregate is partial (map-side), so a hot user costs one row per
    map partition.
    """
    return (events.groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == t).cast("bigint").alias(f"n_{t}") for t in EVENT_TYPES],
        F.sum("value").alias("value_sum"),
        F.avg("value").alias("value_avg"),
        F.max("value").alias("value_max"),
        F.stddev_pop("value").alias("value_std")))


def user_features_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per customer with orders: order count, price avg/max/pop-std,
    distinct priorities, account balance."""
    agg = (orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
        F.avg("o_totalprice").alias("price_avg"),
        F.max("o_totalprice").alias("price_max"),
        F.stddev_pop("o_totalprice").alias("price_std"),
        F.countDistinct("o_orderpriority").cast("bigint").alias("n_priorities")))
    cust = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("acctbal"))
    return agg.join(cust, "user_id", "inner")


def events_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_features_from_events(table(spark, sf_dir, "events"))


def orders_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_features_from_orders(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def logs_from_events(events: DataFrame) -> dict[str, DataFrame]:
    """The five raw logs: events of one type each, `user_id` renamed `user`."""
    ev = events.withColumnRenamed("user_id", "user")
    return {name: ev.where(F.col("event_type") == t) for name, t in LOG_EVENT_TYPES.items()}


def psychometric_from_customer(customer: DataFrame) -> DataFrame:
    """A static per-user table keyed by `user`."""
    return customer.withColumnRenamed("c_custkey", "user")


def embedding_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, z array<double>, label) from the embeddings table."""
    return embeddings.select(F.col("vec_id"),
                             F.transform("embedding", lambda x: x.cast("double")).alias("z"),
                             F.col("label"))
