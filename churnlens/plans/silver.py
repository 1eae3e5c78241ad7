"""Raw -> silver: typed, de-duplicated, referentially consistent tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators import clean
from ..operators.quality import union_all
from ..sources import io
from ..sources.schemas import PRIMARY_KEYS, SILVER


#: Prefixes of a raw column's text as given, and of the number of a key's rows in which it didn't parse.
GIVEN, UNPARSED = "_given_", "_unparsed_"
#: How many raw rows a row stands for, and how many of them were lines that don't fit the header.
COPIES, BROKEN = "_copies", "_broken"


def _typed(df: DataFrame, name: str, parser) -> DataFrame:
    """Apply a text parser only when the column arrives as text."""
    if isinstance(df.schema[name].dataType, StringType):
        return df.withColumn(name, parser(name))
    return df


def _date(name: str):
    """B5 for a column after B3."""
    return clean.parse_date(name, trimmed=True)


def _finish(df: DataFrame, table: str) -> DataFrame:
    """The table's columns and types (rows as they came), and texts as given that a report counts."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER[table].fields],
                     *[c for c in df.columns if c.startswith(GIVEN)])


def clean_companies(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = _typed(df, "signup_date", _date)
    df = _typed(df, "company_size", lambda c: clean.parse_int_in_range(c, 0, None))
    df = df.withColumn("company_size_bucket", clean.company_size_bucket("company_size"))
    return _finish(df, "companies")


def clean_users(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = df.withColumn("join_date", _date("join_date"))
    df = df.withColumn("last_active_date", _date("last_active_date"))
    df = df.withColumn("is_active", clean.parse_bool("is_active"))
    return _finish(df, "users")


def clean_events(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = clean.standardise_timestamp(df, "event_timestamp", trimmed=True)
    return _finish(df, "events")


def clean_plans(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = _typed(df, "price_per_user", clean.parse_decimal)
    return _finish(df, "subscription_plans")


def clean_subscriptions(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = _typed(df, "start_date", _date)
    df = _typed(df, "end_date", _date)
    return _finish(df, "subscriptions")


def clean_payments(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = _typed(df, "amount", clean.parse_decimal)
    df = _typed(df, "payment_date", _date)
    return _finish(df, "payments")


def clean_tickets(raw: DataFrame) -> DataFrame:
    df = clean.blank_strings_to_null(raw)
    df = clean.standardise_timestamp(df, "created_at", trimmed=True)
    df = _typed(df, "resolution_time_hours", clean.parse_decimal)
    lo, hi = clean.SATISFACTION_RANGE
    df = df.withColumn("satisfaction_score",
                       clean.parse_int_in_range(F.col("satisfaction_score").cast("string"), lo, hi))
    return _finish(df, "support_tickets")


CLEANERS = {
    "companies": clean_companies, "users": clean_users, "events": clean_events,
    "subscription_plans": clean_plans, "subscriptions": clean_subscriptions,
    "payments": clean_payments, "support_tickets": clean_tickets,
}


# Parents before children; each child is checked against its parent's
# finished (materialised) table.
BUILD_ORDER = ["companies", "subscription_plans", "users", "events", "payments",
               "subscriptions", "support_tickets"]
FK_PARENTS = {
    "users": [("company_id", "companies", "company_id")],
    "events": [("user_id", "users", "user_id")],
    "payments": [("company_id", "companies", "company_id")],
    "subscriptions": [("company_id", "companies", "company_id"),
                      ("plan_id", "subscription_plans", "plan_id")],
    "support_tickets": [("company_id", "companies", "company_id")],
}


#: Foreign keys that are checked by their orphan keys instead of a join of all rows.
BY_ORPHANS = {("events", "user_id")}
FK_OK = "_fk_ok"
PK_OK = "_ok_pk"


def fk_flag(fk: str) -> str:
    return f"_ok_{fk}"


def counted(table: str, raw: DataFrame) -> DataFrame:
    """Typed rows with a 0/1 column for each text that doesn't parse, and for a line that doesn't fit."""
    texts = PARSED.get(table, [])
    given = {f"{GIVEN}{c}": F.col(c).cast("string") for c in texts}
    if io.CORRUPT in raw.columns:
        given[f"{GIVEN}{BROKEN}"] = F.col(io.CORRUPT).isNotNull().cast("long")
    df = CLEANERS[table](raw.withColumns(given))
    counts = [(F.col(f"{GIVEN}{c}").isNotNull() & F.col(c).isNull()).cast("long").alias(f"{UNPARSED}{c}") for c in texts]
    if io.CORRUPT in raw.columns:
        counts.append(F.col(f"{GIVEN}{BROKEN}").alias(BROKEN))
    return df.select(*SILVER[table].fieldNames(), *counts)


def build_silver_table(table: str, raw: DataFrame, parents: dict[str, DataFrame], enforce_fk: bool = True,
                       keep=lambda name, df: df) -> DataFrame:
    """Type and de-duplicate one table, then flag the key (``_ok_pk``), each
    foreign key (``_ok_<fk>``) and their conjunction (``_fk_ok``). Silver
    keeps flagged rows, the quarantine the rest: rows without a key, and
    rows whose foreign key is not among the parents' finished silver keys.

    Each row carries how many raw rows it stands for and how many of them had
    texts that don't parse, so the reports read no raw table again. Events,
    the largest table, move once (by event): their foreign key is checked by
    the orphan keys, found over the key column alone beforehand."""
    rows = counted(table, raw)
    sums = [c for c in rows.columns if c not in SILVER[table].fieldNames()]
    df = clean.collapse_by_key(rows, PRIMARY_KEYS[table], sums, COPIES, PK_OK)
    ok = F.col(PK_OK)
    if enforce_fk:
        for fk, parent, pk in FK_PARENTS.get(table, []):
            if (table, fk) in BY_ORPHANS:
                keys = raw.select(clean.blank_to_null(F.col(fk)).alias(fk))
                orphans = keep(f"_orphans_{table}", clean.orphan_keys(keys, fk, parents[parent], pk))
                df = clean.flag_orphans(df, fk, orphans, fk_flag(fk))
            else:  # silver parents are de-duplicated on their key already
                df = clean.flag_referenced(df, fk, parents[parent], pk, fk_flag(fk), parent_unique=True)
            ok = ok & F.col(fk_flag(fk))
    return df.withColumn(FK_OK, ok)


def accepted(flagged: DataFrame) -> DataFrame:
    """Silver rows: every foreign key satisfied (flags dropped)."""
    return flagged.where(F.col(FK_OK)).select(*[c for c in flagged.columns if not c.startswith("_")])


def build_silver(raw: dict[str, DataFrame], enforce_fk: bool = True,
                 keep=lambda name, df: df) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All seven tables in dependency order. ``keep`` materialises the
    flagged table (identity for a purely lazy plan). Returns (silver,
    flagged): silver views filter on the flag, so each table is written
    once and the quarantine costs no extra pass."""
    out: dict[str, DataFrame] = {}
    flagged: dict[str, DataFrame] = {}
    for t in BUILD_ORDER:
        flagged[t] = keep(t, build_silver_table(t, raw[t], out, enforce_fk, keep))
        out[t] = accepted(flagged[t])
    return out, flagged


def quarantine_counts(flagged: dict[str, DataFrame]) -> DataFrame:
    """B7 report: rows with a key dropped per relationship (an orphan of a
    parent row that was itself dropped counts too)."""
    frames = []
    for child, rels in FK_PARENTS.items():
        for fk, _parent, _pk in rels:
            frames.append(flagged[child].agg(
                F.lit(f"{child}.{fk}").alias("relationship"),
                F.count_if(F.col(PK_OK) & ~F.col(fk_flag(fk))).alias("quarantined_rows")))
    return union_all(frames)


def typed_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All rows of the seven tables, typed, before any is dropped."""
    return {t: CLEANERS[t](raw[t]) for t in BUILD_ORDER}


# Columns that arrive as text and must parse.
PARSED = {"users": ["join_date", "last_active_date", "is_active"], "events": ["event_timestamp"],
          "payments": ["amount"], "subscriptions": ["start_date", "end_date"],
          "support_tickets": ["satisfaction_score"]}


def rejected_rows(flagged: dict[str, DataFrame]) -> DataFrame:
    """What cleaning turned away: (table_name, reason, rows) for rows without
    a key, further rows of a key, values that don't parse (non-blank text,
    NULL in silver; the row stays), orphans for each foreign key, and lines
    that don't fit their header. One aggregate over the counts that each
    flagged table carries; no raw table is read."""
    frames = []
    for t in BUILD_ORDER:
        keyed, total = F.col(PK_OK), lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
        reasons = {"null_key": total(F.when(~keyed, F.col(COPIES))), "duplicate": total(F.when(keyed, F.col(COPIES) - 1))}
        reasons |= {f"unparsed_{c}": total(f"{UNPARSED}{c}") for c in PARSED.get(t, [])}
        reasons |= {f"orphan_{fk}": F.count_if(keyed & ~F.col(fk_flag(fk))) for fk, _, _ in FK_PARENTS.get(t, [])}
        if BROKEN in flagged[t].columns:
            reasons["corrupt_line"] = total(BROKEN)
        pairs = F.array(*[F.struct(F.lit(k).alias("reason"), v.alias("rows")) for k, v in reasons.items()])
        frames.append(flagged[t].agg(pairs.alias("pairs")).select(F.lit(t).alias("table_name"), F.inline("pairs")))
    return union_all(frames)


def typed_key_check(flagged: DataFrame, table: str) -> DataFrame:
    """C1 of the typed rows before cleaning dropped any, from the counts a flagged table
    carries: rows, keys that occur more than once (NULL is one key), rows without a key."""
    keyed, copies = F.col(PK_OK), F.col(COPIES)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    without = total(F.when(~keyed, copies))
    return flagged.agg(F.lit(f"typed.{table}").alias("table_name"), total(copies).alias("rows"),
                       (F.count_if(keyed & (copies > 1)) + F.when(without > 1, 1).otherwise(0)).alias("duplicate_keys"),
                       without.alias("null_key_rows"))
