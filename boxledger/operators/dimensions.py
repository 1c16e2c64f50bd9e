"""Calendar, surrogate keys, unknown members and versioned dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import (date_key, day_part, fiscal_end, fiscal_month, fiscal_quarter, fiscal_start, fiscal_year,
                         full_name, nullif_blank, region_bucket, scd_hash)
from ..session import cut_lineage
from ..sources.tables import local_table
from .changes import crosswalk_update, insert_only_dim, update_changed_then_insert
from .joins import lookup_or_unknown

__all__ = ["fiscal_calendar", "calendar_bounds", "assign_surrogate_keys", "number_in_order", "unknown_member",
           "scd2_patron", "dim_performance", "dim_event", "dim_room", "dim_fund", "dim_account", "dim_department",
           "dim_source_module", "dim_channel", "dim_campaign", "dim_program", "dim_school", "dim_venue",
           "dim_email_campaign", "static_lookup", "POSTING_MODULES", "empty_dim"]

BEGINNING = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"

# What each ledger posting module is and where its cash lines land on the cash flow.
POSTING_MODULES = [
    ("OPENING", "Opening balance", "Opening balance", "Opening", 0),
    ("TESSITURA", "Tessitura postings", "Tickets, subscriptions and gifts", "In", 1),
    ("DIESE", "Diese rental invoices", "Hall rental fees", "In", 2),
    ("PAYROLL_PAYMENT", "Payroll payments", "Payroll", "Out", 3),
    ("AP_PAYMENT", "Payables payments", "Artists, suppliers and operations", "Out", 4),
    ("PAYROLL", "Payroll accrual", "Non-cash accruals", "Non-cash", 9),
    ("AP", "Payables accrual", "Non-cash accruals", "Non-cash", 9),
    ("MANUAL", "Manual journal", "Non-cash accruals", "Non-cash", 9),
]
POSTING_MODULE_SCHEMA = ("source_module string, module_name string, cash_flow_line string, cash_direction string, "
                         "sort_order int")

# The unknown member of each dimension.
UNKNOWN = {
    "performance": {"performance_id": "N/A", "title": "Unknown performance", "performance_date_key": -1, "capacity": 0},
    "venue": {"venue_id": "N/A", "venue_name": "Unknown"},
    "channel": {"channel_name": "Unknown"},
    "campaign": {"campaign_id": "N/A", "campaign_name": "Unknown campaign", "campaign_type": "Unknown"},
    "fund": {"fund_id": "N/A", "fund_name": "Unknown fund"},
    "program": {"program_id": "N/A", "program_name": "Unknown program", "program_type": "Unknown"},
    "school": {"school_id": "N/A", "school_name": "Community / not school-based"},
    "account": {"account_code": "N/A", "account_name": "Unknown account", "account_type": "Unknown",
                "account_group": "Unknown"},
    "department": {"department_code": "N/A", "department_name": "Unknown department"},
    "room": {"room_id": "N/A", "room_name": "Unknown room", "room_type": "Unknown", "venue_key": -1},
    "event": {"event_id": "N/A", "event_name": "Unknown event", "event_type": "Unknown", "event_date_key": -1,
              "performance_key": -1, "is_linked": False},
    "email_campaign": {"email_campaign_id": "N/A", "campaign_name": "Unknown campaign", "send_date_key": -1},
    "patron": {"patron_id": "N/A", "full_name": "Unknown patron", "region": "Unknown", "valid_from": BEGINNING,
               "valid_to": OPEN_END, "is_current": True},
}


# ---------------------------------------------------------------- calendar

def calendar_bounds(first_dates: Sequence[tuple[DataFrame, str]], last_dates: Sequence[tuple[DataFrame, str]],
                    budget: tuple[DataFrame, str] | None = None, as_of=None) -> DataFrame:
    """One row ``start``, ``end``: whole fiscal years from the earliest fact to the latest date known.

    ``as_of`` counts among the last dates (and stands in when there is no first date); a budget period counts up to
    the end of its month.
    """
    def extreme(frames, fold):
        return [df.agg(fold(F.col(c).cast("date")).alias("d")) for df, c in frames]

    def stacked(frames, fold):
        out = frames[0]
        for other in frames[1:]:
            out = out.unionByName(other)
        return out.agg(fold("d").alias("d"))

    spark = first_dates[0][0].sparkSession
    today = spark.range(1).select(F.lit(as_of).cast("date").alias("d"))
    lasts = extreme(last_dates, F.max) + [today]
    if budget is not None:
        lasts.append(budget[0].agg(F.last_day(F.max(F.col(budget[1]).cast("date"))).alias("d")))
    first = F.coalesce(stacked(extreme(first_dates, F.min), F.min).scalar(), F.lit(as_of).cast("date"))
    last = stacked(lasts, F.max).scalar()
    return spark.range(1).select(fiscal_start(fiscal_year(first)).alias("start"),
                                 fiscal_end(fiscal_year(last)).alias("end"))


def fiscal_calendar(bounds: DataFrame, with_unknown: bool = True) -> DataFrame:
    """One row per day between ``start`` and ``end`` of the one-row ``bounds``, plus the unknown day -1.

    The fiscal year runs July to June and is named after the year it ends in; Sunday is weekday 1.
    """
    d = F.col("date")
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("date"))
    calendar = days.select(
        date_key(d).alias("date_key"), d,
        F.dayofweek(d).alias("weekday_num"), F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.month(d).alias("month_num"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_num"), F.year(d).alias("calendar_year"),
        fiscal_year(d).alias("fiscal_year"), F.concat(F.lit("FY"), fiscal_year(d)).alias("fiscal_year_label"),
        fiscal_month(d).alias("fiscal_month_num"), fiscal_quarter(d).alias("fiscal_quarter"),
        F.concat(fiscal_year(d) - 1, F.lit("-"), F.right(fiscal_year(d).cast("string"), F.lit(2))).alias("season_label"),
    )
    if not with_unknown:
        return calendar
    zero = F.lit(0)
    unknown = bounds.sparkSession.range(1).select(
        F.lit(-1).alias("date_key"), F.lit("1900-01-01").cast("date").alias("date"), zero.alias("weekday_num"),
        F.lit("Unknown").alias("day_name"), F.lit(False).alias("is_weekend"), zero.alias("month_num"),
        F.lit("Unknown").alias("month_name"), zero.alias("quarter_num"), F.lit(1900).alias("calendar_year"),
        F.lit(1900).alias("fiscal_year"), F.lit("Unknown").alias("fiscal_year_label"), zero.alias("fiscal_month_num"),
        zero.alias("fiscal_quarter"), F.lit("Unknown").alias("season_label"))
    return calendar.unionByName(unknown)


# ---------------------------------------------------------------- keys

def number_in_order(df: DataFrame, order: str, name: str) -> DataFrame:
    """Dense numbers 1..n in the order of a unique column, without a single-task window.

    Rows are range-partitioned and sorted, then written to the shared checkpoint so that the position of a row cannot
    change between the two passes or after the loss of an executor.  A row's number is its place in its partition
    plus the rows of all earlier partitions; that list has one entry per partition.
    """
    placed = cut_lineage(
        df.repartitionByRange(F.col(order)).sortWithinPartitions(order)
        .withColumn("_place", F.monotonically_increasing_id()))
    partition = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(partition.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    # One row per partition is a proven bound, so this broadcast is safe at any size of ``df``.
    numbered = placed.withColumn("_part", partition).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_offset") + within + 1).drop("_part", "_offset", "_place")


def assign_surrogate_keys(dim: DataFrame, new: DataFrame, business_id: str, key: str) -> DataFrame:
    """Add unseen members with the next keys, numbered in the order of the business id.

    Existing keys never move.  The unknown member's -1 does not count towards the maximum.  An id that arrives more than
    once gets one key; of its rows the smallest in column order stays.
    """
    unseen = new.where(F.col(business_id).isNotNull()).join(dim.select(business_id), business_id, "left_anti")
    others = [c for c in unseen.columns if c != business_id]
    if others:
        first = unseen.groupBy(business_id).agg(F.min(F.struct(*others)).alias("_first"))
        unseen = first.select(business_id, *[F.col(f"_first.{c}").alias(c) for c in others])
    else:
        unseen = unseen.distinct()
    top = F.coalesce(dim.where(F.col(key) > 0).agg(F.max(key)).scalar(), F.lit(0))
    numbered = number_in_order(unseen, business_id, "_number")
    keyed = numbered.withColumn(key, (F.col("_number") + top).cast(dim.schema[key].dataType))
    present = set(keyed.columns)
    aligned = keyed.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in dim.schema
    ])
    return dim.unionByName(aligned)


def unknown_member(dim: DataFrame, key: str, values: Mapping | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Ensure the row with key -1.

    ``stored`` is the table as it was before the load, where that is cheaper to ask than ``dim`` itself; loads never
    drop the row.  The question is a scalar subquery, not a join.
    """
    values = {key: -1, **(values or {})}
    present = (dim if stored is None else stored).where(F.col(key) == -1).agg(F.count(F.lit(1)) > 0).scalar()
    row = dim.sparkSession.range(1).where(~present).select(*[
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema])
    return dim.unionByName(row)


def empty_dim(spark: SparkSession, ddl: str) -> DataFrame:
    return local_table(spark, [], ddl)


# ---------------------------------------------------------------- versioned people

TRACKED = ("address_line1", "city", "state", "postal_code", "patron_type")
TYPE1 = ("first_name", "last_name", "full_name", "email", "phone", "email_opt_in", "source_systems")


def scd2_patron(dim: DataFrame, snapshot: DataFrame, as_of, tracked: Sequence[str] = TRACKED,
                type1: Sequence[str] = TYPE1, person: str = "patron_id", key: str = "patron_key") -> DataFrame:
    """Versioned people.

    Contact columns are overwritten on the open version only.  Where the fingerprint of the tracked columns differs
    the open version closes at ``as_of`` and a new one opens.  People never seen before are valid from 1900-01-01, so
    older facts still find them.  Intervals are half open and disjoint.
    """
    as_of = F.lit(as_of).cast(dim.schema["valid_to"].dataType)
    beginning = F.lit(BEGINNING).cast(dim.schema["valid_to"].dataType)
    open_end = F.lit(OPEN_END).cast(dim.schema["valid_to"].dataType)
    staged = snapshot
    if "full_name" not in staged.columns:
        staged = staged.withColumn("full_name", full_name("first_name", "last_name"))
    if "region" not in staged.columns and "region" in dim.columns:
        staged = staged.withColumn("region", region_bucket("city", "state", "country"))
    staged = staged.withColumn("scd_hash", scd_hash(*tracked))

    arriving = staged.select(person, F.struct("scd_hash", *type1).alias("_s"))
    joined = dim.join(arriving, person, "left")
    is_open = F.col("is_current") & F.col("_s").isNotNull()
    closes = is_open & F.coalesce(F.col("scd_hash") != F.col("_s.scd_hash"), F.lit(False))
    changes = {c: F.when(is_open, F.col(f"_s.{c}")).otherwise(F.col(c)) for c in type1 if c in dim.columns}
    changes["valid_to"] = F.when(closes, as_of).otherwise(F.col("valid_to"))
    changes["is_current"] = F.col("is_current") & ~closes
    kept = joined.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in dim.columns])

    status = dim.groupBy(person).agg(F.max(F.when(F.col("is_current"), F.col("scd_hash"))).alias("_open_hash"),
                                     F.bool_or("is_current").alias("_has_open"))
    candidates = staged.join(status, person, "left")
    opens = ~F.coalesce(F.col("_has_open"), F.lit(False)) | (F.col("_open_hash") != F.col("scd_hash"))
    added = candidates.where(opens).withColumns({
        "valid_from": F.when(F.col("_has_open").isNull(), beginning).otherwise(as_of),
        "valid_to": open_end, "is_current": F.lit(True)})
    top = F.coalesce(dim.where(F.col(key) > 0).agg(F.max(key)).scalar(), F.lit(0))
    numbered = number_in_order(added.drop("_open_hash", "_has_open"), person, "_number")
    keyed = numbered.withColumn(key, (F.col("_number") + top).cast(dim.schema[key].dataType))
    result = kept.unionByName(keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dim.schema]))
    return unknown_member(result, key, UNKNOWN["patron"], dim)


# ---------------------------------------------------------------- the single dimensions

def _performance_rows(performance: DataFrame, season: DataFrame, venue: DataFrame) -> DataFrame:
    seasons = season.select("season_id", "season_name", "fiscal_year")
    venues = venue.select("venue_id", "venue_name")
    return (performance.join(seasons, "season_id", "left").join(venues, "venue_id", "left")
            .withColumns({"performance_date_key": date_key("performance_datetime"),
                          "day_part": day_part("performance_datetime")}))


def dim_performance(performance: DataFrame, season: DataFrame, venue: DataFrame, dim: DataFrame) -> DataFrame:
    """Shows with their season and venue.  Refreshed when status, capacity, title or time changes."""
    return update_changed_then_insert(dim, _performance_rows(performance, season, venue), "performance_id",
                                      "performance_key", ["status", "capacity", "title", "performance_datetime"],
                                      unknown=UNKNOWN["performance"])


def dim_event(event: DataFrame, performances: DataFrame, dim: DataFrame, link: str = "performance_id") -> DataFrame:
    """Booked events bridged to the show they belong to.  Refreshed on status, date, link or name."""
    shows = performances.select(F.col("performance_id").alias("_show"), "performance_key")
    rows = event.join(shows, event[link] == shows["_show"], "left").withColumns({
        "is_linked": F.col("performance_key").isNotNull(),
        "performance_key": F.coalesce("performance_key", F.lit(-1)),
        "event_date_key": date_key("event_date")})
    return update_changed_then_insert(dim, rows, "event_id", "event_key",
                                      ["status", "event_date_key", "performance_key", "event_name"],
                                      unknown=UNKNOWN["event"])


def dim_room(room: DataFrame, venues: DataFrame, dim: DataFrame) -> DataFrame:
    """Rooms; halls point at their venue, others at -1.  Refreshed on name, rate or capacity."""
    rows = lookup_or_unknown(room, venues, "venue_id", "venue_key")
    return update_changed_then_insert(dim, rows, "room_id", "room_key", ["room_name", "hourly_rate", "capacity"],
                                      unknown=UNKNOWN["room"])


def dim_fund(fund: DataFrame, crosswalk: DataFrame, dim: DataFrame) -> DataFrame:
    """Funds are only ever added; the ledger's code is stamped from the crosswalk."""
    return crosswalk_update(insert_only_dim(dim, fund, "fund_id", "fund_key", UNKNOWN["fund"]), crosswalk)


def dim_account(account: DataFrame, dim: DataFrame) -> DataFrame:
    """Chart of accounts, refreshed when name or group differs."""
    return update_changed_then_insert(dim, account, "account_code", "account_key", ["account_name", "account_group"],
                                      unknown=UNKNOWN["account"])


def dim_department(department: DataFrame, dim: DataFrame) -> DataFrame:
    return update_changed_then_insert(dim, department, "department_code", "department_key", ["department_name"],
                                      unknown=UNKNOWN["department"])


def static_lookup(spark: SparkSession) -> DataFrame:
    """The eight posting modules of the ledger."""
    return local_table(spark, POSTING_MODULES, POSTING_MODULE_SCHEMA)


dim_source_module = static_lookup


def dim_channel(orders: DataFrame, dim: DataFrame, channel: str = "channel") -> DataFrame:
    """Sales channels as they occur in orders."""
    found = orders.where(F.col(channel).isNotNull()).select(F.col(channel).alias("channel_name")).distinct()
    return insert_only_dim(dim, found, "channel_name", "channel_key", UNKNOWN["channel"])


def dim_campaign(campaign: DataFrame, dim: DataFrame) -> DataFrame:
    """Fundraising campaigns, refreshed when goal or name differs."""
    return update_changed_then_insert(dim, campaign, "campaign_id", "campaign_key", ["goal_amount", "campaign_name"],
                                      unknown=UNKNOWN["campaign"])


def dim_program(program: DataFrame, dim: DataFrame) -> DataFrame:
    return insert_only_dim(dim, program, "program_id", "program_key", UNKNOWN["program"])


def dim_school(school: DataFrame, dim: DataFrame) -> DataFrame:
    """Schools; the unknown member also stands for sessions held elsewhere."""
    return insert_only_dim(dim, school, "school_id", "school_key", UNKNOWN["school"])


def dim_venue(venue: DataFrame, dim: DataFrame) -> DataFrame:
    return update_changed_then_insert(dim, venue, "venue_id", "venue_key", ["venue_name", "capacity"],
                                      unknown=UNKNOWN["venue"])


def dim_email_campaign(campaign: DataFrame, dim: DataFrame) -> DataFrame:
    """Email campaigns, refreshed on name or send time.  A blank series becomes NULL on insert only."""
    rows = campaign.withColumn("send_date_key", date_key("send_datetime"))
    return update_changed_then_insert(dim, rows, "email_campaign_id", "email_campaign_key",
                                      ["campaign_name", "send_datetime"],
                                      insert_only={"series_promoted": nullif_blank("series_promoted")},
                                      unknown=UNKNOWN["email_campaign"])
