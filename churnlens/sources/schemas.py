"""Declared schemas for the raw and silver layers.

Raw keeps text where the source system delivers text (dates held as
strings, booleans as 't'/'f', scores as free text); silver is typed.
PostgreSQL ``numeric`` has no precision; money/hours use decimal(18,2).
"""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

MONEY = DecimalType(18, 2)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


RAW = {
    "companies": _s(("company_id", StringType()), ("company_name", StringType()),
                    ("signup_date", DateType()), ("acquisition_channel", StringType()),
                    ("industry", StringType()), ("company_size", IntegerType()),
                    ("country", StringType()), ("status", StringType())),
    "events": _s(("event_id", StringType()), ("user_id", StringType()),
                 ("event_type", StringType()), ("event_timestamp", StringType())),
    "payments": _s(("payment_id", StringType()), ("company_id", StringType()),
                   ("amount", StringType()), ("payment_date", DateType()), ("payment_status", StringType())),
    "subscription_plans": _s(("plan_id", StringType()), ("plan_name", StringType()),
                             ("price_per_user", MONEY), ("billing_cycle", StringType())),
    "subscriptions": _s(("subscription_id", StringType()), ("company_id", StringType()),
                        ("plan_id", StringType()), ("start_date", StringType()),
                        ("end_date", StringType()), ("status", StringType())),
    "support_tickets": _s(("ticket_id", StringType()), ("company_id", StringType()),
                          ("created_at", TimestampNTZType()), ("resolution_time_hours", MONEY),
                          ("satisfaction_score", StringType())),
    "users": _s(("user_id", StringType()), ("company_id", StringType()), ("role", StringType()),
                ("join_date", StringType()), ("last_active_date", StringType()),
                ("is_active", StringType())),
}

SILVER = {
    "companies": _s(("company_id", StringType()), ("company_name", StringType()),
                    ("signup_date", DateType()), ("acquisition_channel", StringType()),
                    ("industry", StringType()), ("company_size", IntegerType()),
                    ("country", StringType()), ("status", StringType()),
                    ("company_size_bucket", StringType())),
    "events": _s(("event_id", StringType()), ("user_id", StringType()),
                 ("event_type", StringType()), ("event_timestamp", TimestampNTZType())),
    "payments": _s(("payment_id", StringType()), ("company_id", StringType()),
                   ("amount", MONEY), ("payment_date", DateType()), ("payment_status", StringType())),
    "subscription_plans": RAW["subscription_plans"],
    "subscriptions": _s(("subscription_id", StringType()), ("company_id", StringType()),
                        ("plan_id", StringType()), ("start_date", DateType()),
                        ("end_date", DateType()), ("status", StringType())),
    "support_tickets": _s(("ticket_id", StringType()), ("company_id", StringType()),
                          ("created_at", TimestampNTZType()), ("resolution_time_hours", MONEY),
                          ("satisfaction_score", IntegerType())),
    "users": _s(("user_id", StringType()), ("company_id", StringType()), ("role", StringType()),
                ("join_date", DateType()), ("last_active_date", DateType()),
                ("is_active", BooleanType())),
}

# Primary keys (silver) and foreign keys child.col -> parent table.
PRIMARY_KEYS = {
    "companies": ["company_id"], "events": ["event_id"], "payments": ["payment_id"],
    "subscription_plans": ["plan_id"], "subscriptions": ["subscription_id"],
    "support_tickets": ["ticket_id"], "users": ["user_id"],
}
FOREIGN_KEYS = [
    ("users", "company_id", "companies", "company_id"),
    ("events", "user_id", "users", "user_id"),
    ("payments", "company_id", "companies", "company_id"),
    ("subscriptions", "company_id", "companies", "company_id"),
    ("subscriptions", "plan_id", "subscription_plans", "plan_id"),
    ("support_tickets", "company_id", "companies", "company_id"),
]
TABLES = list(RAW)
