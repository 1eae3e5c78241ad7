"""churnlens — churn and revenue-at-risk analytics as Spark DataFrame functions.

Layers:
  sources/    readers, writers, declared schemas, test-data adapter
  operators/  reusable DataFrame operators (cleaning, temporal joins, checks)
  functions/  column-level helpers (calendar arithmetic, bucketing)
  plans/      table builders: silver, gold, analytics, features, model,
              evaluation, revenue at risk, dashboards, end-to-end runner
"""

__all__ = ["session"]
