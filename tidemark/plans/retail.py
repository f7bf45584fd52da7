"""Retail dimensions: customers and orders to slowly changing dimensions, products, RFM."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import stock_status
from tidemark.functions.text import label, trimmed
from tidemark.operators import analytics, mapping, scd
from tidemark.operators.ordered import dense_sequence
from tidemark.plans import fixed_values as fixed
from tidemark.session import durable
from tidemark.sources import readers, sinks

CUSTOMER_COLUMNS = [
    "customerID", "companyName", "contactName", "contactTitle", "address", "city", "region",
    "postalCode", "country", "phone", "fax",
]
ORDER_SCHEMA = "orderID BIGINT, customerID STRING, employeeID BIGINT, orderDate STRING"
DETAIL_SCHEMA = "orderID BIGINT, productID BIGINT, unitPrice DOUBLE, quantity INT, discount DOUBLE"
PRODUCT_SCHEMA = (
    "productID INT, productName STRING, supplierID INT, categoryID INT, quantityPerUnit STRING, "
    "unitPrice DOUBLE, unitsInStock INT, unitsOnOrder INT, reorderLevel INT, discontinued INT"
)
CATEGORY_SCHEMA = "categoryID INT, categoryName STRING, description STRING, picture STRING"
PROFILE = ["customer_id", "company_name", "contact_name", "city", "country"]


def read_customers(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_csv(spark, f"{folder}/customers.csv", CUSTOMER_COLUMNS, null_value="NULL")


def read_by_header(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A CSV read by its header, typed for the columns it has; None without the file."""
    try:
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException:
        return None
    types = dict(c.strip().split(" ") for c in schema.split(","))
    df = readers.read_csv(spark, path, header)
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in header])


def order_amounts(spark: SparkSession, folder: str) -> DataFrame | None:
    """Orders that have lines, with their net amount; None when a file is missing."""
    orders = read_by_header(spark, f"{folder}/orders.csv", ORDER_SCHEMA)
    lines = read_by_header(spark, f"{folder}/order_details.csv", DETAIL_SCHEMA)
    if orders is None or lines is None:
        return None
    totals = analytics.order_totals(lines, "orderID", "unitPrice * quantity", "discount", "net_amount")
    return orders.join(totals, "orderID", "inner")


def lifetime_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Spend per customer; without order files nobody has any."""
    amounts = order_amounts(spark, folder)
    if amounts is None:
        return spark.createDataFrame([], "customer_id STRING, lifetime_spend DECIMAL(20,2)")
    return amounts.groupBy(F.col("customerID").alias("customer_id")).agg(
        F.round(F.sum("net_amount"), 2).cast("decimal(20,2)").alias("lifetime_spend")
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    names = {"customerID": "customer_id", "companyName": "company_name", "contactName": "contact_name"}
    defaults = {"city": "Unknown", "country": "Unknown", "region": "N/A", "phone": "N/A"}
    return raw.select(
        *[trimmed(F.col(c)).alias(n) for c, n in names.items()],
        *[trimmed(F.col(c), d).alias(c) for c, d in defaults.items()],
    )


def scd0(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "company_name", "contact_name", F.col("country").alias("original_country"),
        F.lit(fixed.SIGNUP_DATE).cast("date").alias("original_signup_date"),
        F.lit(fixed.SIGNUP_CREDIT_LIMIT).alias("initial_credit_limit_usd"),
    )


def scd1(customers: DataFrame, spend: DataFrame, tiers=fixed.LOYALTY_TIERS) -> DataFrame:
    wide = mapping.look_up(customers, spend, "customer_id", ["lifetime_spend"])
    names = ("loyalty_tier", "credit_limit_usd", "last_updated_at")
    return wide.withColumns(scd.tier_columns(F.col("lifetime_spend"), tiers, names)).select(*PROFILE, *names)


def scd2(dim1: DataFrame, tiers=fixed.LOYALTY_TIERS) -> DataFrame:
    final = dim1.select(*PROFILE, F.col("loyalty_tier").alias("_final"))
    return scd.version_keys(scd.planned_versions(final, "_final", tiers), ["customer_id"])


def scd3(dim1: DataFrame, tiers=fixed.LOYALTY_TIERS) -> DataFrame:
    return scd.with_previous_tier(dim1, tiers).select(
        *PROFILE,
        F.col("loyalty_tier").alias("current_loyalty_tier"),
        "previous_loyalty_tier",
        F.col("credit_limit_usd").alias("current_credit_limit_usd"),
        "previous_credit_limit_usd",
        "tier_change_date",
    )


def products(spark: SparkSession, folder: str) -> DataFrame | None:
    """Product dimension with category and stock status."""
    items = read_by_header(spark, f"{folder}/products.csv", PRODUCT_SCHEMA)
    groups = read_by_header(spark, f"{folder}/categories.csv", CATEGORY_SCHEMA)
    if items is None or groups is None:
        return None
    named = mapping.look_up(
        items, groups, "categoryID", {"categoryName": "category_name", "description": "category_description"}
    )
    return dense_sequence(named, ["productID"], "_n").select(
        label("PROD_SK_", F.col("_n"), 3).alias("product_sk"),
        F.col("productID").alias("product_id"),
        F.trim("productName").alias("product_name"),
        "category_name",
        "category_description",
        F.col("quantityPerUnit").alias("quantity_per_unit"),
        F.col("unitPrice").alias("unit_price"),
        F.col("unitsInStock").alias("units_in_stock"),
        F.col("unitsOnOrder").alias("units_on_order"),
        F.col("reorderLevel").alias("reorder_level"),
        (F.col("discontinued") == 1).alias("is_discontinued"),
        stock_status(F.col("unitsInStock"), F.col("reorderLevel")).alias("stock_status"),
    )


def customer_rfm(customers: DataFrame, amounts: DataFrame) -> DataFrame:
    """RFM scores and segments of the customers that have orders."""
    dated = amounts.withColumn("_day", F.substring("orderDate", 1, 10).try_cast("date"))
    metrics = analytics.rfm_metrics(dated, "customerID", "orderID", "_day", "net_amount")
    scored = analytics.rfm_segments(analytics.rfm_scores(metrics, "customerID"))
    named = mapping.look_up(scored, customers, "customerID", ["company_name", "country"], "customer_id")
    return named.withColumnRenamed("customerID", "customer_id").withColumn(
        "monetary_total_spend", F.col("monetary_total_spend").cast("double")
    )


def build(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    customers = clean_customers(read_customers(spark, raw))
    # types 2 and 3 start from the type 1 table, so it is written down once
    dim1 = durable(scd1(customers, lifetime_spend(spark, raw)), "scd1")
    tables = {
        "silver_customers": customers,
        "dim_customer_scd0": scd0(customers),
        "dim_customer_scd1": dim1,
        "dim_customer_scd2": scd2(dim1),
        "dim_customer_scd3": scd3(dim1),
    }
    goods = products(spark, raw)
    if goods is not None:
        tables["dim_product"] = goods
    amounts = order_amounts(spark, raw)
    if amounts is not None and "orderDate" in amounts.columns:
        tables["agg_customer_rfm"] = customer_rfm(customers, amounts)
    return tables


def run(spark: SparkSession, raw: str, out: str | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    tables = build(spark, raw)
    if out:
        sinks.write_bundle(tables, out, fmt)
    return tables
