"""Raw-shaped views of the test tables: every column is text, with the dirt the cleaners repair.

One row per line item or order, so customers repeat within a month and deduplication has work to do.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanstrata.sources.lake import let_go

# A cut-off inside the range of the test tables, and their last installment.
STARTED_BEFORE = "2000-01-01"
FINAL_INSTALLMENT = 7

# What the raw views take from a line item, from its part and from its order.
_LINE = [
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
]
_PART = ["p_size", "p_retailprice", "p_type", "p_name"]
_ORDER = ["o_custkey", "o_totalprice", "o_orderdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_range(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last month of the raw views, from the data."""
    first = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"))
    last = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("b"))
    months = (_month("a").alias("a"), _month("b").alias("b"))
    return first.select(months[0]).first().a, last.select(months[1]).first().b


def _month(name: str) -> Column:
    return F.trunc(F.to_date(name), "MM").cast("string")


def rows_by_month(spark: SparkSession, sf_dir: str) -> dict[str, dict[date, int]]:
    """About how many rows each raw view has in each month: those of the table that has its dates."""

    def counted(name: str, column: str) -> dict[date, int]:
        month = F.trunc(F.to_date(column), "MM").alias("month")
        return {r[0]: r[1] for r in table(spark, sf_dir, name).groupBy(month).count().collect()}

    lines, orders = counted("lineitem", "l_shipdate"), counted("orders", "o_orderdate")
    return {name: orders if name == "attributes" else lines for name in RAW}


def _decimal(c: Column, scale: int = 2) -> Column:
    return c.cast(f"decimal(18,{scale})")


def _text(c: Column, scale: int = 2) -> Column:
    return _decimal(c, scale).cast("string")


def _customer() -> Column:
    return F.concat(F.lit(" CUS_"), F.col("o_custkey").cast("string"), F.lit(" "))


def _loan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _listed(rows: DataFrame, key: str, name: str, columns: list[str]) -> DataFrame:
    """The rows of each key as one list, so that a join by it neither drops rows nor repeats them."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*columns)).alias(name))


def stored_lines(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Line items with their orders, written once under ``path`` for all raw views that begin with them.

    ``accounts`` and ``parts`` have what financials take from customer and part, as lists: either may be
    missing or come twice, and a line item is one row of the other views in any case. The shuffles of
    these joins are let go before a view has its own.
    """
    accounts = _listed(table(spark, sf_dir, "customer"), "c_custkey", "accounts", ["c_acctbal"])
    parts = _listed(table(spark, sf_dir, "part"), "p_partkey", "parts", _PART)
    orders = table(spark, sf_dir, "orders").join(accounts, F.col("o_custkey") == F.col("c_custkey"), "left")
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select(*_LINE, *_ORDER, "accounts", "parts")
    rows.write.parquet(path, compression="zstd")
    let_go(spark)
    return spark.read.schema(rows.schema).parquet(path)


def raw_lms(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    price = _decimal(F.col("l_extendedprice"))
    overdue = _text(price * _decimal(F.col("l_discount")), 4)
    lines = _loan_lines(spark, sf_dir) if lines is None else lines
    return lines.select(
        F.col("l_orderkey").cast("string").alias("loan_id"),
        _customer().alias("Customer_ID"),
        F.to_date("o_orderdate").cast("string").alias("loan_start_date"),
        F.lit("7").alias("tenure"),
        F.col("l_linenumber").cast("string").alias("installment_num"),
        price.cast("string").alias("loan_amt"),
        F.when(F.col("l_quantity") == 1, "0.00")
        .otherwise(_text(price * _decimal(F.lit(0.02)), 4))
        .alias("due_amt"),
        _text(price * _decimal(F.col("l_tax")), 4).alias("paid_amt"),
        F.when((F.col("l_tax") == 0.08) & (F.col("l_linenumber") == 1), "")
        .otherwise(overdue)
        .alias("overdue_amt"),
        _text(F.col("o_totalprice")).alias("balance"),
        _month("l_shipdate").alias("snapshot_date"),
    )


def raw_clickstream(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = _loan_lines(spark, sf_dir) if lines is None else lines
    return lines.select(
        _customer().alias("customer_id"),
        _text(F.col("l_quantity")).alias("fe_1"),
        _text(F.col("l_discount")).alias("fe_2"),
        _text(F.col("l_tax")).alias("fe_3"),
        F.when(F.col("l_quantity") == 50, "")
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("fe_4"),
        _month("l_shipdate").alias("snapshot_date"),
    )


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    key = F.col("o_custkey")
    age = (18 + (key + F.col("o_orderkey")) % 60).cast("string")

    def digits(modulus: int, width: int) -> Column:
        return F.lpad((key % modulus).cast("string"), width, "0")

    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        _customer().alias("Customer ID"),
        F.regexp_replace("c_name", "#", "   ").alias("Name"),
        F.when(key % 11 == 0, "-500")
        .when(key % 13 == 0, "")
        .when(key % 7 == 0, F.concat(age, F.lit("_")))
        .otherwise(age)
        .alias("Age"),
        F.when(key % 5 == 0, "#F%$D@*&8")
        .otherwise(F.concat_ws("-", digits(1000, 3), digits(100, 2), digits(10000, 4)))
        .alias("SSN"),
        F.when(key % 9 == 0, "_______")
        .otherwise(F.concat(F.lit("  __"), "c_mktsegment", F.lit(" ("), "o_orderpriority", F.lit(")__ ")))
        .alias("Occupation"),
        _month("o_orderdate").alias("snapshot-date"),
    )


def raw_financials(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    if lines is None:
        # the customers meet the orders, which are fewer than the lines and narrower
        customers = table(spark, sf_dir, "customer")
        orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        known = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        rows = known.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    else:
        rows = lines.select("*", F.inline("accounts")).select("*", F.inline("parts"))
    line = F.col("l_linenumber")
    line_text = line.cast("string")
    size = F.col("p_size").cast("string")
    quantity = _text(F.col("l_quantity"))

    def marked(condition: Column, text: Column) -> Column:
        return F.when(condition, F.concat(text, F.lit("_"))).otherwise(text)

    return rows.select(
        _customer().alias("Customer_ID"),
        marked(F.col("o_custkey") % 6 == 0, _text(F.col("o_totalprice"))).alias("Annual_Income"),
        F.when(line == 3, "").otherwise(_text(F.col("c_acctbal"))).alias("Monthly_Inhand_Salary"),
        F.concat(line_text, F.lit(".0.5")).alias("Interest_Rate"),
        F.when(line == 2, "_")
        .when(line == 6, F.concat(F.lit("1.5e"), line_text))
        .otherwise(_text(F.col("l_discount")))
        .alias("Changed_Credit_Limit"),
        marked(F.col("l_returnflag") == "R", _text(F.col("l_extendedprice"))).alias("Outstanding_Debt"),
        _text(F.col("p_retailprice")).alias("Credit_Utilization_Ratio"),
        F.when((F.col("l_linestatus") == "F") & (line == 4), F.concat_ws("-", quantity, quantity))
        .otherwise(quantity)
        .alias("Total_EMI_per_month"),
        F.when(F.col("l_returnflag") == "A", "__10000__")
        .otherwise(F.concat(F.lit("--"), quantity))
        .alias("Amount_invested_monthly"),
        F.when(line == 5, "__-333333333333333333333333333__")
        .otherwise(_text(F.col("c_acctbal")))
        .alias("Monthly_Balance"),
        size.alias("Num_Credit_Inquiries"),
        F.concat(line_text, F.lit("_")).alias("Num_of_Delayed_Payment"),
        (line - 3).cast("string").alias("Delay_from_due_date"),
        F.concat(size, F.lit(".0")).alias("Num_Credit_Card"),
        F.when(line == 7, "99999999999").when(line == 6, "_").otherwise(line_text).alias("Num_Bank_Accounts"),
        F.when(
            line > 1, F.concat(size, F.lit(" Years and "), line_text, F.lit(" Months"))
        ).alias("Credit_History_Age"),
        F.when(F.col("l_returnflag") == "A", "_")
        .when(F.col("l_returnflag") == "N", "Standard")
        .alias("Credit_Mix"),
        F.when(F.col("l_linestatus") == "F", "!@9#%8")
        .otherwise("High_spent_Small_value_payments")
        .alias("Payment_Behaviour"),
        F.when(line == 1, F.concat(F.lit(", "), "p_type", F.lit(" Loan ,, "), "p_name", F.lit(" and ")))
        .when(line == 2, "")
        .otherwise(
            F.concat("p_type", F.lit(" Loan, "), "p_name", F.lit(" Loan, and "), "p_type", F.lit(" Loan"))
        )
        .alias("Type_of_Loan"),
        F.lit("99").alias("Num_of_Loan"),
        _month("l_shipdate").alias("snapshot_date"),
    )


RAW = {
    "clickstream": raw_clickstream,
    "attributes": raw_attributes,
    "financials": raw_financials,
    "lms": raw_lms,
}


def raw_sources(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The raw views, those of line items from ``lines`` (`stored_lines`) if given."""
    given = {name: () if lines is None or name == "attributes" else (lines,) for name in RAW}
    return {name: view(spark, sf_dir, *given[name]) for name, view in RAW.items()}
