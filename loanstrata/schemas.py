"""Source registry and the fixed schemas of the gold tables."""

from __future__ import annotations

from dataclasses import dataclass

SNAPSHOT = "snapshot_date"
CUSTOMER = "customer_id"
# The customer comes first: it tells rows apart soonest when they are sorted by key.
KEYS = [CUSTOMER, SNAPSHOT]


@dataclass(frozen=True)
class Source:
    """A raw table: its file name and the bit that marks it in a source mask."""

    name: str
    file_name: str
    bit: int


# The four raw tables, their file names, and their join order.
SOURCES = {
    "clickstream": Source("clickstream", "feature_clickstream.csv", 1),
    "attributes": Source("attributes", "features_attributes.csv", 2),
    "financials": Source("financials", "features_financials.csv", 4),
    "lms": Source("lms", "lms_loan_daily.csv", 8),
}
# Sources that a snapshot may lack without losing its rows.
OPTIONAL = ("clickstream", "lms")
# Column of the lake's clickstream that names the fe_* columns of the raw file a row came from.
SOURCE_COLUMNS = "source_columns"
# Column of a checked raw scan: the line of a row that has more or fewer cells than the header.
RAGGED = "ragged_line"
ALL_SOURCES_MASK = sum(s.bit for s in SOURCES.values())

# Target types of the loan-servicing columns.
LMS_TYPES = {
    "loan_id": "string",
    "customer_id": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

# Financial columns repaired to double and to int.
FINANCIAL_NUMBERS = [
    "annual_income",
    "monthly_inhand_salary",
    "interest_rate",
    "changed_credit_limit",
    "outstanding_debt",
    "credit_utilization_ratio",
    "total_emi_per_month",
    "amount_invested_monthly",
]
FINANCIAL_INTEGERS = [
    "num_credit_inquiries",
    "num_of_delayed_payment",
    "delay_from_due_date",
    "num_credit_card",
    "num_bank_accounts",
]

LABEL_STORE = {
    "loan_id": "string",
    "customer_id": "string",
    "label": "int",
    "label_def": "string",
    "snapshot_date": "date",
}

# Feature columns by the source that supplies them.
FEATURES = {
    "clickstream": {"clickstream_total_mean": "double"},
    "attributes": {"age_group": "string", "occupation": "string"},
    "financials": {
        "debt_to_income": "double",
        "emi_to_salary": "double",
        "balance_to_debt": "double",
        "credit_history_age": "double",
    },
    "lms": {
        "mob": "double",
        "installments_missed": "double",
        "first_missed_date": "date",
        "dpd": "double",
    },
}
# Silver columns that the features of a source and the labels are made of; clickstream needs all it has.
FEATURE_INPUTS = {
    "clickstream": (),
    "attributes": ("age", "occupation"),
    "financials": (
        "annual_income",
        "monthly_inhand_salary",
        "outstanding_debt",
        "total_emi_per_month",
        "monthly_balance",
        "credit_history_age",
    ),
    "lms": ("loan_start_date", "installment_num", "due_amt", "overdue_amt"),
}
LABEL_INPUTS = ("loan_id", "installment_num", "due_amt", "overdue_amt")
FEATURE_STORE = {
    "customer_id": "string",
    "snapshot_date": "date",
    **{name: dtype for cols in FEATURES.values() for name, dtype in cols.items()},
}

# Number of loan observations by everything that the delinquency counts ask for.
LOAN_CUBE = {
    "loan_start_date": "date",
    "mob": "int",
    "dpd": "int",
    "missed": "boolean",
    "n": "bigint",
    "snapshot_date": "date",
}

CUSTOMER_IDS = {"customer_id": "string", "id": "bigint", "snapshot_date": "date"}
CUSTOMER_BLOCKS = {"block": "bigint", "bits": "binary", "snapshot_date": "date"}

# Tables with a fixed schema, by layer and name.
FIXED = {
    ("gold", "label_store"): LABEL_STORE,
    ("gold", "feature_store"): FEATURE_STORE,
    ("analysis", "loan_cube"): LOAN_CUBE,
    ("analysis", "customer_ids"): CUSTOMER_IDS,
    ("analysis", "label_store_customers"): CUSTOMER_BLOCKS,
    ("analysis", "feature_store_customers"): CUSTOMER_BLOCKS,
}


def ddl(columns: dict[str, str]) -> str:
    """DDL string of a column → type mapping, as ``spark.read.schema`` takes it."""
    return ", ".join(f"{name} {dtype}" for name, dtype in columns.items())


def source(name: str) -> Source:
    """Look a source up by name; unknown names raise ``ValueError``."""
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}; expected one of {sorted(SOURCES)}")
    return SOURCES[name]
