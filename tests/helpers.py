"""Small builders for hand-made silver frames."""

import datetime as dt
from decimal import Decimal

from churnlens.sources.schemas import SILVER

D = dt.date


def frame(spark, table, rows):
    """Silver-typed frame from dict rows (missing columns -> NULL)."""
    schema = SILVER[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def ts(y, m, d):
    return dt.datetime(y, m, d, 12, 0, 0)


PLANS = [{"plan_id": "p1", "plan_name": "Basic", "price_per_user": Decimal("10.00"),
          "billing_cycle": "monthly"},
         {"plan_id": "p2", "plan_name": "Pro", "price_per_user": Decimal("25.00"),
          "billing_cycle": "monthly"}]
