"""Declared schemas of the order tables.

Only columns that an operator reads are declared; a file may hold more, in any
order. ``KEY`` is the person, as opposed to ``customer_id``, which is one order's
alias for that person.
"""

from __future__ import annotations

KEY = "customer_unique_id"

# Column names and types of the input tables.
TABLES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "order_items": {
        "order_id": "string",
        "product_id": "string",
        "seller_id": "string",
        "price": "double",
        "freight_value": "double",
    },
    "order_reviews": {
        "order_id": "string",
        "review_score": "int",
        "review_creation_date": "timestamp_ntz",
    },
    "order_payments": {"order_id": "string", "payment_value": "double"},
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_state": "string",
    },
    "products": {"product_id": "string", "product_category_name": "string"},
    "sellers": {"seller_id": "string"},
    "geolocation": {},
}

# Tables whose text columns may hold quoted line breaks.
MULTILINE_TABLES = ("order_reviews",)

# Feature columns in serving order, and the nine used for training.
FULL13 = (
    "recency_days",
    "order_count",
    "total_spend",
    "avg_order_value",
    "total_freight",
    "avg_delivery_delay",
    "max_delivery_delay",
    "avg_delivery_days",
    "pct_late_orders",
    "avg_review_score",
    "min_review_score",
    "pct_bad_reviews",
    "category_diversity",
)
COMPARED8 = (
    "recency_days",
    "order_count",
    "total_spend",
    "avg_order_value",
    "avg_delivery_delay",
    "pct_late_orders",
    "avg_review_score",
    "pct_bad_reviews",
)
CORE9 = (*COMPARED8, "category_diversity")
FEATURE_SETS = {"core9": CORE9, "full13": FULL13}
