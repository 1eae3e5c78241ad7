"""Raw -> silver cleaning (B1-B9) and CSV ingestion (A1)."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from churnlens.operators import clean
from churnlens.plans import silver
from churnlens.sources import io
from churnlens.sources.schemas import RAW


def test_malformed_values_become_null(spark):
    df = spark.createDataFrame(
        [(" 2024-01-05 ", "t", " 3 ", "12.50", "2024-01-05 10:11:12"),
         ("", "yes", "n/a", "", "not a time"),
         ("2024/02/30", "maybe", "9", "abc", "2024-01-05T01:02:03"),
         (None, " F ", "0", "1e2", "")],
        "d string, b string, s string, m string, t string")
    rows = df.select(clean.parse_date("d").alias("d"), clean.parse_bool("b").alias("b"),
                     clean.parse_int_in_range("s", 1, 5).alias("s"),
                     clean.parse_decimal("m").alias("m"),
                     clean.parse_timestamp("t").alias("t")).collect()
    assert rows[0] == (dt.date(2024, 1, 5), True, 3, Decimal("12.50"),
                       dt.datetime(2024, 1, 5, 10, 11, 12))
    assert rows[1] == (None, True, None, None, None)
    assert rows[2].d is None and rows[2].b is None and rows[2].s is None and rows[2].m is None
    assert rows[2].t == dt.datetime(2024, 1, 5, 1, 2, 3)
    assert rows[3].b is False and rows[3].s is None and rows[3].m == Decimal("100.00")


def test_dedupe_keeps_first_in_column_order(spark):
    df = spark.createDataFrame([("k", "u", dt.datetime(2024, 1, 2)),
                                ("k", "u", dt.datetime(2024, 1, 1)),
                                ("j", None, None), (None, "x", None)],
                               "event_id string, user_id string, event_timestamp timestamp_ntz")
    out = {r.event_id: r for r in clean.dedupe_by_key(df, ["event_id"]).collect()}
    assert set(out) == {"k", "j"}
    assert out["k"].event_timestamp == dt.datetime(2024, 1, 1)


def test_foreign_keys_null_passes_orphan_dropped(spark):
    parent = spark.createDataFrame([("c1",)], "company_id string")
    child = spark.createDataFrame([("u1", "c1"), ("u2", None), ("u3", "zz")],
                                  "user_id string, company_id string")
    kept = {r.user_id for r in clean.keep_referenced(child, "company_id", parent,
                                                      "company_id").collect()}
    assert kept == {"u1", "u2"}
    assert [r.user_id for r in clean.orphans(child, "company_id", parent, "company_id").collect()] \
        == ["u3"]


def test_csv_ingest_and_silver(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    files = {
        "companies": "company_id,company_name,signup_date,acquisition_channel,industry,company_size,country,status\n"
                     "c1, Acme ,2024-01-03,ads,saas,12,US,\nc1,Acme,2024-01-03,ads,saas,12,US,active\n"
                     "c2,Beta,bad-date,seo,,abc,DE,active\n",
        "users": "user_id,company_id,role,join_date,last_active_date,is_active\n"
                 "u1,c1,admin,2024-01-03,2024/02/01,t\nu2,c9,member,,,f\n",
        "events": "event_id,user_id,event_type,event_timestamp\n"
                  "e1,u1,login,2024-01-04 10:00:00\ne2,u1,invite_sent,2024-01-05 11:00:00\n",
        "payments": "payment_id,company_id,amount,payment_date,payment_status\n"
                    "p1,c1,12.5,2024/01/05,failed\np2,c1,oops,,paid\n",
        "subscription_plans": "plan_id,plan_name,price_per_user,billing_cycle\np1,Basic,10,monthly\n",
        "subscriptions": "subscription_id,company_id,plan_id,start_date,end_date,status\n"
                         "s1,c1,p1,2024-01-03,,active\n",
        "support_tickets": "ticket_id,company_id,created_at,resolution_time_hours,satisfaction_score\n"
                           "t1,c1,2024-01-06 08:00:00,2.5,\nt2,c1,2024-01-07 08:00:00,x,4\n",
    }
    for t, body in files.items():
        os.makedirs(f"{d}/{t}.csv")
        with open(f"{d}/{t}.csv/part-0.csv", "w") as fh:
            fh.write(body)
    raw = io.read_raw_dir(spark, d, "csv")
    assert [f.name for f in raw["users"].schema.fields] == [*RAW["users"].fieldNames(), io.CORRUPT]
    s, flagged = silver.build_silver(raw)
    comps = {r.company_id: r for r in s["companies"].collect()}
    assert comps["c1"].company_name == "Acme" and comps["c1"].status is None  # first row wins
    assert comps["c2"].signup_date is None and comps["c2"].company_size is None
    assert comps["c1"].company_size_bucket == "11-50"
    assert {r.user_id for r in s["users"].collect()} == {"u1"}                 # orphan dropped
    u = s["users"].first()
    assert u.last_active_date == dt.date(2024, 2, 1) and u.is_active is True
    t = {r.ticket_id: r for r in s["support_tickets"].collect()}
    assert t["t1"].satisfaction_score is None and t["t2"].resolution_time_hours is None
    assert s["events"].count() == 2
    pay = {r.payment_id: r for r in s["payments"].collect()}
    assert pay["p1"].payment_date == dt.date(2024, 1, 5) and pay["p1"].amount == Decimal("12.50")
    assert pay["p2"].amount is None and pay["p2"].payment_date is None
    q = {r.relationship: r.quarantined_rows for r in silver.quarantine_counts(flagged).collect()}
    assert q["users.company_id"] == 1 and q["events.user_id"] == 0
    gone = {(r.table_name, r.reason): r.rows for r in silver.rejected_rows(flagged).collect()}
    assert gone["users", "orphan_company_id"] == 1 and gone["payments", "unparsed_amount"] == 1
    assert gone["companies", "duplicate"] == 1 and gone["companies", "corrupt_line"] == 0


def test_csv_columns_by_name_and_broken_lines(spark, tmp_path):
    """Columns in another order and one more; a quoted line break; a line too short."""
    path = tmp_path / "plans.csv"
    path.write_text('plan_name,extra,plan_id,billing_cycle,price_per_user\n"Ba\nsic",x,p1,monthly,10\nPro,p2\n')
    rows = {r.plan_name: r for r in io.read_raw(spark, f"file://{path}", "subscription_plans").collect()}
    assert rows["Ba\nsic"].plan_id == "p1" and rows["Ba\nsic"].price_per_user == "10" and rows["Ba\nsic"][io.CORRUPT] is None
    assert rows["Pro"][io.CORRUPT] == "Pro,p2"
    path.write_text("plan_name,billing_cycle,price_per_user\n")
    with pytest.raises(ValueError, match="plan_id"):
        io.read_raw(spark, f"file://{path}", "subscription_plans")


@pytest.mark.parametrize("text", ["2024-01-04T10:00:00Z", "2024-01-04T12:00:00+02:00", "2024-01-04 10:00", "2024-01-04T10:00"])
def test_time_layouts(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(clean.parse_timestamp("t").alias("t")).first()
    assert row.t == dt.datetime(2024, 1, 4, 10)


def test_layout_by_shape_equals_trying_all(spark):
    """Texts of every layout, of none, and near to them: as the first of all layouts that parses."""
    import random

    from pyspark.sql import functions as F
    r = random.Random(3)
    stamp = [dt.datetime(r.randrange(1, 9999), r.randrange(1, 13), r.randrange(1, 29), r.randrange(24), r.randrange(60), r.randrange(60),
                         r.randrange(10**6)) for _ in range(60)]
    texts = [x.strftime(f).replace("%04Y", f"{x.year:04d}") for x in stamp for f in (
        "%04Y-%m-%d %H:%M:%S", "%04Y-%m-%dT%H:%M:%S", "%04Y-%m-%d %H:%M:%S.%f", "%04Y-%m-%dT%H:%M:%S.%f", "%04Y-%m-%dT%H:%M:%SZ",
        "%04Y-%m-%dT%H:%M:%S+02:00", "%04Y-%m-%d %H:%M:%S-11:30", "%04Y/%m/%d %H:%M:%S", "%m/%d/%04Y %H:%M:%S", "%04Y-%m-%d %H:%M",
        "%04Y-%m-%dT%H:%M", "%04Y-%m-%d", "%04Y/%m/%d", "%m/%d/%04Y", "%d.%m.%04Y", "%04Y%m%d")]
    for t in list(texts):
        at = r.randrange(len(t))
        texts.append(t[:at] + r.choice("0123456789 -/.:TZ+") + t[at + r.randrange(2):])
    texts += ["2024-02-30", "2024-13-01 00:00:00", "+12024-01-05", "12024-01-05", "-2024-01-05", "2024-1-5", "2024-01-05 10:11:12.5",
              "2024-01-05T10:11:12.123456789", "2024-01-05t10:11:12", "2024-01-05T10:11:12.5Z", "٢٠٢٤-٠١-٠٥", "20240105 ", "n/a", "", None, "5",
              "2024-01-05T24:00:00", "2024-01-05 23:59:60", "2024-01-05T10:11:12+0200", "2024-01-05T10:11:12+02"]
    t = clean.blank_to_null("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t", clean.parse_timestamp("t").alias("a"),
        F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in clean.TIMESTAMP_FORMATS]).cast("timestamp_ntz").alias("b"),
        clean.parse_date("t").alias("c"), F.coalesce(*[F.try_to_date(t, f) for f in clean.DATE_FORMATS]).alias("d"))
    rows = df.selectExpr("t", "cast(a as string) a", "cast(b as string) b", "cast(c as string) c", "cast(d as string) d").collect()
    assert [x for x in rows if (x.a, x.c) != (x.b, x.d)] == []
    assert sum(x.a is not None for x in rows) > 600 and sum(x.c is not None for x in rows) > 250


def test_collapse_equals_dedupe_and_counts(spark):
    """The same rows as ``dedupe_by_key``, with copies and totals; rows without a key stay, counted."""
    import random
    r = random.Random(9)
    rows = [(r.choice(["a", "b", "c", "d", None]), r.choice([None, "x", "y"]), r.choice([None, 1, 2, 3]), r.randrange(2)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, s string, n int, lost long")
    out = clean.collapse_by_key(df, ["k"], ["lost"]).collect()
    kept = {(x.k, x.s, x.n) for x in out if x._ok_pk}
    assert kept == {tuple(x) for x in clean.dedupe_by_key(df.drop("lost"), ["k"]).collect()}
    for x in out:
        same = [y for y in rows if (y[0] == x.k if x._ok_pk else y[:3] == (None, x.s, x.n))]
        assert (x._copies, x.lost) == (len(same), sum(y[3] for y in same))
    assert sum(x._copies for x in out) == len(rows)


def test_events_move_once_whatever_the_keys(spark, tmp_path):
    """A third of the events on one user, a third on NULL: one exchange of events, and it is by event;
    flags as by a join of all rows."""
    from pyspark.sql import functions as F
    users = spark.createDataFrame([(f"u{i}", "c") for i in range(50)], "user_id string, company_id string")
    n = F.col("id")
    raw = spark.range(3000).select(
        F.concat(F.lit("e"), n).alias("event_id"),
        F.when(n % 3 == 0, "u1").when(n % 3 == 1, None).otherwise(F.concat(F.lit("u"), n % 70)).alias("user_id"),
        F.lit("login").alias("event_type"), F.lit("2024-01-04 10:00:00").alias("event_timestamp"))

    def keep(name, df):
        io.write_table(df, str(tmp_path), name)
        return io.read_table(spark, str(tmp_path), name)
    df = silver.build_silver_table("events", raw, {"users": users}, keep=keep)
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert len(exchanges) == 1 and "hashpartitioning(event_id" in exchanges[0]
    assert "partial_min" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    joined = clean.flag_referenced(raw, "user_id", users, "user_id", "ok")
    assert sorted((r.event_id, r._fk_ok) for r in df.collect()) == sorted((r.event_id, r.ok) for r in joined.collect())
    assert df.where("not _fk_ok").count() == sum(i % 3 == 2 and i % 70 >= 50 for i in range(3000))
