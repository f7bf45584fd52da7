import csv
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import contracts
from tidemark.plans import governance, news, retail

ARTICLES = [
    # id, title, company, date, category, summary, url, author, revenue, words
    ("ART1", " OpenAI grows ", "Open AI", "2022-03-05", " AI & ML ", "s", "u", "Ann", "$1.480 billion", "120"),
    ("ART2", "t2", "OpenAI", "04/01/2022", "Artificial Intelligence", "s", "u", "", "£100M", "bad"),
    ("ART3", "t3", "OpenAI", "21-Feb-23", "Cloud", "s", "u", "Bob", "Not disclosed", "10"),
    ("ART4", "t4", "Unknown Inc", "October 19, 2022", "Odd", "s", "u", "nan", "€10M - €22M", ""),
    ("ART5", "t5", "AWS", "not a date", "Big Data", "s", "u", "Cy", "¥360,000,000,000", "7"),
    ("ART1", "again", "OpenAI", "2022-03-05", "Cloud", "s", "u", "Ann", "$9B", "1"),
]
HEADER = ["article_id", "title", "company_name", "published_date", "category", "summary", "url", "author", "revenue", "word_count"]
COMPANIES = {
    "OpenAI": {"founded_year": 2015, "headquarters": "SF", "employee_count": 12793, "industry": "AI/ML", "is_public": False, "stock_ticker": None},
    "Amazon Web Services": {"founded_year": 2006, "headquarters": "Seattle", "employee_count": 9999, "industry": "Cloud", "is_public": True, "stock_ticker": "AMZN"},
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    with open(folder / "articles.csv", "w", newline="") as f:
        csv.writer(f).writerows([HEADER, *ARTICLES])
    (folder / "company_metadata.json").write_text(json.dumps(COMPANIES))
    return str(folder)


@pytest.fixture(scope="module")
def gold(spark, raw):
    return news.run(spark, raw)


def test_silver(gold):
    silver = {r.article_id: r for r in gold["articles_clean"].collect()}
    assert len(silver) == 5
    a = silver["ART1"]
    assert (a.title, a.company_name_clean, a.category_clean, a.revenue_usd_M, a.original_index) == ("OpenAI grows", "OpenAI", "AI_ML", 1480, 0)
    assert (a.company_age, a.company_size_category, a.has_company_metadata) == (7, "Medium", True)
    assert (silver["ART2"].revenue_usd_M, silver["ART2"].author, silver["ART2"].word_count) == (127, "Unknown", None)
    assert silver["ART2"].published_date_clean == "01-04-2022"
    assert (silver["ART3"].revenue_usd_M, silver["ART3"].published_on) == (None, dt.date(2023, 2, 21))
    assert (silver["ART4"].revenue_usd_M, silver["ART4"].category_clean, silver["ART4"].has_company_metadata) == (18, "Odd", False)
    assert silver["ART4"].company_size_category == "Unknown"
    assert (silver["ART5"].revenue_usd_M, silver["ART5"].published_year, silver["ART5"].company_size_category) == (2400, None, "Small")


def test_star(gold):
    assert values(gold["dim_company"], "company_id", "company_name", "industry") == [
        ("COMP001", "Amazon Web Services", "Cloud"), ("COMP002", "OpenAI", "AI/ML"), ("COMP003", "Unknown Inc", None)]
    assert gold["fct_article"].count() == 5
    assert values(gold["fct_arr_observation"], "observation_id", "article_id", "company_id", "arr_usd") == [
        ("ARR0001", "ART5", "COMP001", 2_400_000_000), ("ARR0002", "ART1", "COMP002", 1_480_000_000),
        ("ARR0003", "ART2", "COMP002", 127_000_000), ("ARR0004", "ART4", "COMP003", 18_000_000)]
    assert values(gold["view_company_latest_arr"], "company_id", "latest_article_id", "total_observations_recorded") == [
        ("COMP001", "ART5", 1), ("COMP002", "ART2", 2), ("COMP003", "ART4", 1)]
    # an undated observation has no quarter to be counted in
    assert gold["agg_company_quarterly_arr"].count() == 3
    assert values(gold["ai_articles_enriched"], "article_id", "arr_usd") == [("ART1", 1_480_000_000), ("ART2", 127_000_000)]


def test_order_decides_the_latest(spark):
    rows = [("A", "2022-02-03", "$1M"), ("B", "2022-01-20", "$2M")]
    articles = spark.createDataFrame(
        [(i, "t", "C", d, "Cloud", "s", "u", "x", r, "1", n) for n, (i, d, r) in enumerate(rows)],
        ", ".join(f"{h} STRING" for h in HEADER) + ", original_index BIGINT")
    companies = spark.createDataFrame(
        [("C", 2000, "hq", 5, "x", True, "T")],
        "company_name STRING, founded_year INT, headquarters STRING, employee_count INT, industry STRING, is_public BOOLEAN, stock_ticker STRING")
    silver = news.clean(articles, companies)
    by_text = news.build_warehouse(silver)["agg_company_quarterly_arr"].first()
    by_date = news.build_warehouse(silver, "date")["agg_company_quarterly_arr"].first()
    # as text 03-02-2022 sorts before 20-01-2022
    assert (by_text.latest_arr_usd_M, by_date.latest_arr_usd_M) == (2, 1)


@pytest.fixture(scope="module")
def shop(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")

    def put(name, rows):
        with open(folder / name, "w", newline="") as f:
            csv.writer(f).writerows(rows)

    put("customers.csv", [retail.CUSTOMER_COLUMNS,
                          ["BERGS", " Berglunds ", "Ch", "Order", "Way 8", "Lulea", "NULL", "S-958", "Sweden", "1", "NULL"],
                          ["ALFKI", "Alfreds", "Ma", "Rep", "Str 57", "Berlin", "NULL", "12209", "Germany", "2", "3"],
                          ["PARIS", "Paris", "Mb", "Owner", "Rue", "NULL", "NULL", "75012", "France", "NULL", "4"]])
    put("orders.csv", [["orderID", "customerID", "employeeID", "orderDate"],
                       ["1", "BERGS", "5", "1997-01-01 00:00:00.000"], ["2", "BERGS", "5", "1998-05-01"], ["3", "ALFKI", "1", "1998-05-06"]])
    put("order_details.csv", [["orderID", "productID", "unitPrice", "quantity", "discount"],
                              ["1", "1", "100.0", "100", "0.1"], ["1", "2", "50", "100", "0"], ["2", "1", "10.5", "200", "0.05"], ["3", "1", "50", "100", "0"]])
    put("products.csv", [["productID", "productName", "supplierID", "categoryID", "quantityPerUnit", "unitPrice", "unitsInStock", "unitsOnOrder", "reorderLevel", "discontinued"],
                         ["2", "Chang", "1", "1", "24", "19", "17", "40", "25", "0"], ["1", "Chai", "1", "1", "10", "18", "39", "0", "10", "1"], ["3", "Zero", "1", "9", "1", "1", "0", "0", "0", "0"]])
    put("categories.csv", [["categoryID", "categoryName", "description", "picture"], ["1", "Beverages", "Drinks", "0x15"]])
    return str(folder)


def test_retail(spark, shop):
    tables = retail.run(spark, shop)
    assert values(tables["silver_customers"], "customer_id", "company_name", "city", "region", "phone") == [
        ("ALFKI", "Alfreds", "Berlin", "N/A", "2"), ("BERGS", "Berglunds", "Lulea", "N/A", "1"), ("PARIS", "Paris", "Unknown", "N/A", "N/A")]
    assert values(tables["dim_customer_scd1"], "customer_id", "loyalty_tier") == [("ALFKI", "Gold"), ("BERGS", "Platinum"), ("PARIS", "Bronze")]
    assert tables["dim_customer_scd2"].count() == 6
    assert values(tables["dim_product"], "product_sk", "product_name", "category_name", "stock_status", "is_discontinued") == [
        ("PROD_SK_001", "Chai", "Beverages", "In Stock", True), ("PROD_SK_002", "Chang", "Beverages", "Low Stock", False),
        ("PROD_SK_003", "Zero", None, "Out of Stock", False)]
    assert values(tables["agg_customer_rfm"], "customer_id", "recency_days", "frequency_orders_count", "monetary_total_spend", "company_name") == [
        ("ALFKI", 1, 1, 5000.0, "Alfreds"), ("BERGS", 6, 2, 15995.0, "Berglunds")]


def test_retail_without_orders(spark, shop, tmp_path):
    (tmp_path / "customers.csv").write_text(open(f"{shop}/customers.csv").read())
    tables = retail.build(spark, str(tmp_path))
    assert {r.loyalty_tier for r in tables["dim_customer_scd1"].collect()} == {"Bronze"}
    assert "dim_product" not in tables and "agg_customer_rfm" not in tables


def test_governance(spark, gold, shop, tmp_path):
    tables = {**{k: v for k, v in gold.items() if k != "articles_clean"}, **retail.build(spark, shop)}
    results, card = governance.validate(tables)
    failed = {(r.table_name, r.target): r.violations for r in results.filter("status = 'FAIL'").collect()}
    assert failed == {("fct_article", "published_date_clean"): 1, ("fct_article", "category_clean"): 1,
                      ("fct_arr_observation", "observation_year BETWEEN 2000 AND 2030"): 1}
    assert card.first().total_constraints_evaluated == results.count() == 25
    with pytest.raises(contracts.ContractViolation):
        governance.publish(spark, tables, str(tmp_path / "bad"))
    good = {k: v for k, v in tables.items() if k not in ("fct_article", "fct_arr_observation")}
    card = governance.publish(spark, good, str(tmp_path / "good")).first()
    assert (card.overall_status, card.failed_count) == ("PASSED", 0)
    assert spark.read.parquet(str(tmp_path / "good" / "dim_company")).count() == 3
    profiles = spark.read.json(str(tmp_path / "good" / "catalog" / "column_profiles"))
    assert profiles.filter("table_name = 'dim_company' AND column_name = 'company_id'").first().distinct_count == 3


def test_lineage(spark):
    from tidemark.operators.catalog import reachable

    edges = governance.lineage(spark)
    down = {r.node for r in reachable(edges, ["raw/articles.csv"]).collect()}
    assert "fct_article" in down and "vector search" in down and "dim_customer_scd1" not in down
    up = {r.node for r in reachable(edges, ["point-in-time audits"], upstream=True).collect()}
    assert "raw/ecommerce/orders.csv" in up
    assert governance.column_rules(spark).count() == 6
    assert governance.table_metadata(spark).filter(F.col("table_name") == "fct_arr_observation").count() == 2
