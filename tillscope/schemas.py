"""Table schemas and vocabularies.

CSV input is read with these schemas: nothing is inferred, so a scan costs one
pass and a changed file cannot change a column's type.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in columns.items()])


CUSTOMERS = _schema(
    customer_id="string",
    customer_name="string",
    email="string",
    phone="string",
    city="string",
    state="string",
    x_customer_id="double",
    y_customer_id="double",
    mean_amount="double",
    std_amount="double",
    mean_nb_tx_per_day="double",
    registration_date="date",
    device_preference="string",
)

MERCHANTS = _schema(
    merchant_id="string",
    merchant_name="string",
    category="string",
    city="string",
    state="string",
    x_merchant_id="double",
    y_merchant_id="double",
    risk_score="int",
    registration_date="date",
    avg_transaction_value="double",
    status="string",
)

TRANSACTIONS = _schema(
    transaction_id="string",
    customer_id="string",
    merchant_id="string",
    amount="double",
    payment_method="string",
    category="string",
    city="string",
    state="string",
    timestamp="timestamp",
    status="string",
    device_type="string",
    is_fraud="int",
    fraud_score="double",
    risk_level="string",
    transaction_hour="int",
    weekend_flag="int",
    customer_merchant_distance="double",
)

REVIEWS = _schema(
    review_id="string",
    transaction_id="string",
    customer_id="string",
    merchant_id="string",
    rating="int",
    review_text="string",
    timestamp="timestamp",
)

TICKETS = _schema(
    ticket_id="string",
    customer_id="string",
    issue_type="string",
    description="string",
    status="string",
    priority="string",
    timestamp="timestamp",
)

ENTITIES: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "merchants": MERCHANTS,
    "transactions": TRANSACTIONS,
    "reviews": REVIEWS,
    "tickets": TICKETS,
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "merchants": "merchant_id",
    "transactions": "transaction_id",
    "reviews": "review_id",
    "tickets": "ticket_id",
}

# A row of the cleansed table must have these.
REQUIRED = {
    "customers": ["customer_id", "email"],
    "merchants": ["merchant_id"],
    "transactions": ["transaction_id", "customer_id", "merchant_id"],
    "reviews": ["review_text"],
    "tickets": ["description"],
}

# The vocabularies of the data model.
CATEGORIES = [
    "Electronics",
    "Fashion",
    "Food & Dining",
    "Travel",
    "Entertainment",
    "Groceries",
    "Health & Wellness",
    "Education",
    "Utilities",
    "Home & Garden",
]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "UPI", "Net Banking", "Wallet"]
DEVICES = ["Mobile", "Desktop", "Tablet"]
STATUSES = ["Success", "Failed", "Refunded"]
RISK_LEVELS = ["High", "Medium", "Low"]
ISSUES = ["Payment Failed", "Refund Issue", "Fraud Alert", "Account Access", "General Query"]
