"""Driver tables mapped onto the payment data model.

`lineitem` is a natural audit log: a (order, line) pair occurs in several
versions. `events` has real times of day and serves the ingest queries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import apply_job_settings

# Version order of lineitem rows shipped on the same day.
LINE_TIE_BREAKERS = ("part", "merchant", "amount", "quantity", "return_flag", "line_status")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    apply_job_settings(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_payments(spark: SparkSession, folder: str) -> DataFrame:
    """`lineitem` as the payments audit table."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    shipped = F.col("l_shipdate").cast("timestamp")
    third = F.col("l_partkey") % 3
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_suppkey").cast("string").alias("merchant_id"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_linenumber") % 3 == 0, "USD")
        .when(F.col("l_linenumber") % 3 == 1, "GBP")
        .otherwise("EUR")
        .alias("currency"),
        F.when(flag == "A", "APPROVED")
        .when(flag == "R", "REVERSED")
        .when(status == "O", "DECLINED")
        .otherwise("PENDING")
        .alias("status"),
        F.when(third == 0, "CARD").when(third == 1, "WALLET").otherwise("BANK_TRANSFER").alias("payment_method"),
        F.to_date("l_shipdate").cast("string").alias("event_date"),
        shipped.alias("ingest_ts"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("merchant"),
        F.col("l_quantity").alias("quantity"),
        flag.alias("return_flag"),
        status.alias("line_status"),
    )


def line_merchants(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers in credit as merchants; payments of the others find no merchant."""
    supplier = table(spark, folder, "supplier").filter("s_acctbal >= 0")
    nation = table(spark, folder, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("n_name").alias("merchant_category"),
    )


def event_payments_text(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as raw delivery text, one delivery per week of the month, plus the JSON `device`."""
    event, user = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    method = F.when(event % 3 == 0, "CARD").when(event % 3 == 1, "WALLET").otherwise("BANK_TRANSFER")
    return table(spark, folder, "events").select(
        F.concat(F.lit("TXN-"), event).alias("transaction_id"),
        F.concat(F.lit("M"), user).alias("merchant_id"),
        F.concat(F.lit("C"), user).alias("customer_id"),
        F.concat(F.lit("u"), user, F.lit("@mail.test")).alias("customer_email"),
        F.concat(F.lit("+1555"), F.lpad(user.cast("string"), 7, "0")).alias("customer_phone"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
        F.when(user % 3 == 0, "USD").when(user % 3 == 1, "GBP").otherwise("EUR").alias("currency"),
        F.when(kind.isin("purchase", "view"), "APPROVED")
        .when(kind == "error", "DECLINED")
        .when(kind == "click", "REVERSED")
        .otherwise("PENDING")
        .alias("status"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("transaction_ts"),
        method.alias("payment_method"),
        F.when(method == "CARD", F.lpad(user.cast("string"), 4, "0")).otherwise("").alias("card_last4"),
        F.concat(F.lit("GW-"), event).alias("gateway_ref"),
        F.concat(F.lit("week"), F.floor((F.dayofmonth("ts") - 1) / 7) + 1).alias("delivery"),
        F.col("props").alias("device"),
        event.alias("event_id"),
    )


def soiled_amounts(text: DataFrame) -> DataFrame:
    """The amount as eight kinds of text, five of which are not numbers."""
    kind, amount = F.col("event_id") % 8, F.col("amount")
    return text.withColumn(
        "amount",
        F.when(kind == 0, "N/A")
        .when(kind == 1, "")
        .when(kind == 2, F.concat(F.lit("1,"), amount))
        .when(kind == 3, "nan")
        .when(kind == 4, F.concat(F.lit(" "), amount, F.lit(" ")))
        .when(kind == 5, F.concat(amount, F.lit("d")))
        .when(kind == 6, F.concat(amount, F.lit("e1")))
        .otherwise(amount),
    )


def soiled_times(text: DataFrame) -> DataFrame:
    """The timestamp as five kinds of text, three of which are not times."""
    kind, when = F.col("event_id") % 5, F.col("transaction_ts")
    return text.withColumn(
        "transaction_ts",
        F.when(kind == 1, F.concat(F.replace(when, F.lit(" "), F.lit("T")), F.lit("Z")))
        .when(kind == 2, "x")
        .when(kind == 3, "2024-13-45 00:00:00")
        .when(kind == 4, "")
        .otherwise(when),
    )


def event_merchants(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in credit as merchants of the event payments, all columns as text."""
    return customer_merchants(spark, folder).filter("c_acctbal >= 0").drop("c_acctbal")


def customer_merchants(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as a merchant delivery row, with dates and flags in several spellings."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    nation = table(spark, folder, "nation")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("M"), key).alias("merchant_id"),
            F.col("c_name").alias("merchant_name"),
            segment.alias("merchant_category"),
            F.col("n_name").alias("country"),
            F.when(segment == "MACHINERY", "unknown")
            .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int")).cast("string"))
            .alias("onboarding_date"),
            F.when(segment == "BUILDING", "yes")
            .when(F.col("c_acctbal") < 0, "False")
            .when(segment == "HOUSEHOLD", " TRUE ")
            .otherwise("true")
            .alias("is_active"),
            F.when(F.col("n_regionkey") == 3, "EUR").otherwise("USD").alias("settlement_currency"),
            "c_acctbal",
        )
    )


def write_deliveries(text: DataFrame, folder: str, columns: Sequence[str], quote: str = '"') -> None:
    """One CSV folder per delivery, with these columns as header."""
    (
        text.select(*columns, "delivery")
        .write.mode("append")
        .partitionBy("delivery")
        .option("header", True)
        .option("quote", quote)
        .option("escape", '"')
        .csv(folder)
    )
