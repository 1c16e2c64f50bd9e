"""The driver's tables read as an arts organisation's data.

Parts are shows, line items are tickets, orders are gifts and revenue postings, customers are people (some with two
versions), events are bookings, clicks and sessions.  Everything is a lazy projection of whole tables.  ``CTE`` holds
the same frames as SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import date_key, fiscal_year, hours_booked, month_start
from ..operators.dimensions import calendar_bounds, fiscal_calendar, static_lookup
from ..operators.facts import fact_budget
from ..operators.joins import UNKNOWN_KEY, point_in_time_join, self_join_prior
from ..plans.finance import compare_legs
from ..sources.tables import local_table

AS_OF = "2024-02-01 12:00:00"
SPLIT = "1998-07-01 00:00:00"

ACCOUNTS = [
    (1, "1010", "Operating cash", "Asset", "Cash"),
    (2, "2100", "Accounts payable", "Liability", "Payables"),
    (3, "2200", "Accrued payroll", "Liability", "Payables"),
    (4, "4100", "Single tickets", "Revenue", "Earned Revenue"),
    (5, "4110", "Subscriptions", "Revenue", "Earned Revenue"),
    (6, "4200", "Contributions", "Revenue", "Contributed Revenue"),
    (7, "4300", "Hall rentals", "Revenue", "Earned Revenue"),
    (8, "5100", "Artist fees", "Expense", "Program"),
    (9, "5200", "Salaries and wages", "Expense", "Program"),
    (10, "5300", "Venue operations", "Expense", "Operating"),
    (11, "5400", "Marketing and advertising", "Expense", "Operating"),
    (12, "5500", "Education programs", "Expense", "Program"),
    (13, "5600", "General and administrative", "Expense", "Operating"),
]
FUNDS = [(1, "F1", "General", "GEN"), (2, "F2", "Education", "EDU"), (3, "F3", "Endowment", "END"),
         (4, "F4", "Special", None)]
DEPARTMENTS = [(k, f"D{k}", f"Department {k}") for k in range(1, 6)]


def dec(value, p: int = 14, s: int = 2):
    column = F.col(value) if isinstance(value, str) else value
    return column.cast(f"decimal({p},{s})")


class Showcase:
    """Lazy frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def literal(self, rows, ddl: str) -> DataFrame:
        return local_table(self.spark, rows, ddl)

    orders = cached_property(lambda self: self.raw("orders"))
    lineitem = cached_property(lambda self: self.raw("lineitem"))
    customer = cached_property(lambda self: self.raw("customer"))
    part = cached_property(lambda self: self.raw("part"))
    supplier = cached_property(lambda self: self.raw("supplier"))
    nation = cached_property(lambda self: self.raw("nation"))
    region = cached_property(lambda self: self.raw("region"))
    events = cached_property(lambda self: self.raw("events"))

    @cached_property
    def calendar(self) -> DataFrame:
        bounds = calendar_bounds([(self.orders, "o_orderdate")],
                                 [(self.events, "ts"), (self.lineitem, "l_shipdate")], as_of=AS_OF)
        return fiscal_calendar(bounds)

    # ---------------------------------------------------------------- people

    @cached_property
    def patrons(self) -> DataFrame:
        """Every customer once, and every third one with a second version from the split date on."""
        key = F.col("c_custkey")
        split = F.lit(SPLIT).cast("timestamp_ntz")
        start, end = F.lit("1900-01-01").cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz")

        def version(n, since, until, current):
            return F.struct((key * 2 + n).alias("patron_key"), since.alias("valid_from"), until.alias("valid_to"),
                            F.lit(current).alias("is_current"))

        versions = F.when(key % 3 == 0, F.array(version(1, start, split, False), version(2, split, end, True))).otherwise(
            F.array(version(1, start, end, True)))
        regions = self.nation.join(self.region, self.nation["n_regionkey"] == self.region["r_regionkey"]).select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
        people = self.customer.join(regions, "c_nationkey", "left")
        return people.select(
            key.alias("patron_id"), F.inline(versions), "region", F.col("c_name").alias("full_name"),
            F.when(key % 11 != 0, F.concat(F.lit("Cust"), key, F.lit("@Mail.org"))).alias("email"),
            F.concat(F.lit("555-010-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
            F.concat(key, F.lit(" Main St")).alias("address_line1"),
            F.date_add(F.lit("1995-01-01").cast("date"), ((key * 13) % 2300).cast("int")).alias("first_seen_date"))

    # ---------------------------------------------------------------- shows and tickets

    @cached_property
    def performance(self) -> DataFrame:
        key = F.col("p_partkey")
        day = F.date_add(F.lit("1996-01-01").cast("date"), ((key * 37) % 2100).cast("int"))
        hour = F.when(key % 2 == 0, 14).otherwise(19)
        return self.part.select(
            (key + 1).alias("performance_key"), F.concat(F.lit("P"), key).alias("performance_id"),
            F.col("p_name").alias("title"), F.col("p_type").alias("series"), F.col("p_brand").alias("genre"),
            F.concat(F.lit("Season "), fiscal_year(day)).alias("season_name"), fiscal_year(day).alias("fiscal_year"),
            F.concat(F.lit("V"), key % 4 + 1).alias("venue_id"), F.concat(F.lit("Hall "), key % 4 + 1).alias("venue_name"),
            F.concat(day.cast("string"), F.lit(" "), hour.cast("string"), F.lit(":00:00")).cast("timestamp_ntz").alias(
                "performance_datetime"),
            date_key(day).alias("performance_date_key"), day.alias("performance_date"),
            F.when(hour < 17, "Matinee").otherwise("Evening").alias("day_part"),
            (F.col("p_size") * 20 + 500).alias("capacity"),
            F.when(key % 20 == 0, "Cancelled").otherwise("Completed").alias("status"))

    @cached_property
    def sales(self) -> DataFrame:
        """One row per line item with its buyer as of the order."""
        return self.wide_sales.drop("first_seen_date", "series")

    @cached_property
    def wide_sales(self) -> DataFrame:
        """The sales with the buyer's first day and the show's series."""
        return self.sales_of(self.orders)

    def sales_of(self, orders: DataFrame, *more: str) -> DataFrame:
        """The sales of ``orders``; their lines carry the columns ``more`` of the orders too.

        Whatever belongs to the order is joined before its lines multiply it.
        """
        header = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patron_id"),
                               F.col("o_orderdate").alias("order_datetime"), "o_orderpriority", *more)
        header = point_in_time_join(header, self.patrons, "patron_id", "order_datetime")
        header = header.join(self.patrons.select("patron_key", "first_seen_date"), "patron_key", "left")
        lines = self.lineitem.join(header, "l_orderkey", "left").withColumn("patron_key", F.coalesce("patron_key", F.lit(UNKNOWN_KEY)))
        shows = self.performance.select(F.col("performance_key").alias("_show"), "performance_date_key",
                                        "performance_date", "series")
        lines = lines.withColumn("_show", F.when(F.col("l_partkey") % 97 == 0, -1).otherwise(F.col("l_partkey") + 1))
        lines = lines.join(shows, "_show", "left")
        discount = dec(dec("l_extendedprice") * dec("l_discount", 4, 2))
        return lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_line_id"),
            F.col("l_orderkey").alias("order_id"), "patron_id", "patron_key",
            F.coalesce(F.when(F.col("performance_date").isNotNull(), F.col("_show")), F.lit(-1)).alias("performance_key"),
            F.col("o_orderpriority").alias("channel_name"), date_key("order_datetime").alias("order_date_key"),
            F.to_date("order_datetime").alias("order_date"),
            F.coalesce("performance_date_key", F.lit(-1)).alias("performance_date_key"),
            F.datediff("performance_date", F.to_date("order_datetime")).alias("days_before_show"),
            F.col("l_quantity").cast("int").alias("quantity"), dec("l_extendedprice").alias("gross_amount"),
            discount.alias("discount_amount"), dec(dec("l_extendedprice") - discount).alias("net_amount"),
            (F.col("l_discount") >= 0.095).alias("is_comp"), (F.col("l_returnflag") == "R").alias("is_returned"),
            "first_seen_date", "series", *more)

    # ---------------------------------------------------------------- giving

    @cached_property
    def gifts(self) -> DataFrame:
        key = F.col("o_orderkey")
        rows = self.orders.withColumn("patron_id", F.col("o_custkey"))
        rows = point_in_time_join(rows, self.patrons, "patron_id", "o_orderdate")
        return rows.select(
            key.alias("gift_id"), "patron_id", "patron_key", date_key("o_orderdate").alias("gift_date_key"),
            F.to_date("o_orderdate").alias("gift_date"), fiscal_year("o_orderdate").alias("fiscal_year"),
            F.when(key % 40 == 0, -1).otherwise(key % 12 + 1).alias("campaign_key"),
            (F.col("o_custkey") % 4 + 1).alias("fund_key"),
            F.when(key % 50 == 0, -dec("o_totalprice")).otherwise(dec("o_totalprice")).alias("amount"),
            (key % 7 == 0).alias("is_anonymous"))

    @cached_property
    def campaigns(self) -> DataFrame:
        k = F.col("campaign_key")
        return self.orders.select((F.col("o_orderkey") % 12 + 1).alias("campaign_key")).distinct().select(
            k, F.concat(F.lit("C"), k).alias("campaign_id"), F.concat(F.lit("Campaign "), k).alias("campaign_name"),
            dec(k * 10000000 - 10000000).alias("goal_amount"))

    @cached_property
    def funds(self) -> DataFrame:
        return self.literal(FUNDS, "fund_key bigint, fund_id string, fund_name string, ledger_fund_code string")

    @cached_property
    def subscriptions(self) -> DataFrame:
        """The first order of a customer in a fiscal year; a renewal when there was one the year before."""
        yearly = self.orders.groupBy(F.col("o_custkey").alias("patron_id"), fiscal_year("o_orderdate").alias("fiscal_year")).agg(
            F.min("o_orderdate").alias("purchased_at"), F.count(F.lit(1)).alias("seats"),
            F.min(dec("o_totalprice")).alias("package_amount"))
        rows = self_join_prior(yearly, "fiscal_year", {"seats": "_before"}, ["patron_id"])
        rows = point_in_time_join(rows, self.patrons, "patron_id", "purchased_at")
        return rows.select((F.col("patron_id") * 10000 + F.col("fiscal_year")).alias("subscription_id"), "patron_id",
                           "patron_key", date_key("purchased_at").alias("purchase_date_key"), "fiscal_year", "seats",
                           "package_amount", F.col("_before").isNotNull().alias("is_renewal"))

    # ---------------------------------------------------------------- ledger

    @cached_property
    def accounts(self) -> DataFrame:
        return self.literal(ACCOUNTS, "account_key int, account_code string, account_name string, account_type string, "
                                      "account_group string")

    @cached_property
    def departments(self) -> DataFrame:
        return self.literal(DEPARTMENTS, "department_key bigint, department_code string, department_name string")

    modules = cached_property(lambda self: static_lookup(self.spark))

    @cached_property
    def journal(self) -> DataFrame:
        """Two lines per order (revenue and cash) and two per line item (expense and its payment or accrual)."""
        zero = dec(F.lit(0))
        key, price = F.col("o_orderkey"), dec("o_totalprice")

        def line(account, debit, credit):
            return F.struct(account.alias("account_code"), debit.alias("debit_amount"), credit.alias("credit_amount"))

        income = F.element_at(F.array(*[F.lit(c) for c in ("4100", "4110", "4200", "4300")]), (key % 4 + 1).cast("int"))
        # Every five-hundredth journal is a unit out of balance.
        cash = F.when(key % 500 == 0, dec(price + 1)).otherwise(price)
        receipts = self.orders.select(
            F.concat(F.lit("O"), key).alias("journal_id"),
            F.when(key % 4 == 3, "DIESE").otherwise("TESSITURA").alias("source_module"),
            F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 4 + 1).alias("fund_key"),
            (F.col("o_custkey") % 5 + 1).alias("department_key"),
            F.inline(F.array(line(income, zero, price), line(F.lit("1010"), cash, zero))))
        n, cost = F.col("l_linenumber"), dec(dec("l_extendedprice") * dec(F.lit(0.25), 3, 2))
        expense = (F.col("l_suppkey") % 6 * 100 + 5100).cast("string")
        credit = F.when(n % 4 < 2, "1010").when(n % 4 == 2, "2100").otherwise("2200")
        module = (F.when(n == 7, "OTHER").when(n % 4 == 0, "AP_PAYMENT").when(n % 4 == 1, "PAYROLL_PAYMENT")
                  .when(n % 4 == 2, "AP").otherwise("PAYROLL"))
        costs = self.lineitem.select(
            F.concat(F.lit("L"), F.col("l_orderkey"), F.lit("-"), n).alias("journal_id"), module.alias("source_module"),
            F.to_date("l_shipdate").alias("date"), (F.col("l_partkey") % 4 + 1).alias("fund_key"),
            (F.col("l_suppkey") % 5 + 1).alias("department_key"),
            F.inline(F.array(line(expense, cost, zero), line(credit, zero, cost))))
        both = receipts.unionByName(costs)
        return both.withColumns({"net_amount": dec(F.col("credit_amount") - F.col("debit_amount")),
                                 "effective_date_key": date_key("date")})

    @cached_property
    def gl(self) -> DataFrame:
        """The ledger fact with surrogate keys."""
        return self.journal.join(self.accounts.select("account_code", "account_key"), "account_code", "left").drop("account_code")

    @cached_property
    def gl_star(self) -> DataFrame:
        """Ledger lines with account, posting module and fiscal year, as the measures read them."""
        lines = self.journal.join(self.accounts, "account_code")
        return lines.join(self.modules.select("source_module", "cash_direction"), "source_module", "left").withColumns(
            {"fiscal_year": fiscal_year("date"), "month_start": month_start("date")})

    @cached_property
    def budget_lines(self) -> DataFrame:
        """Next year's budget: every account's month plus five percent; one account is only a draft."""
        signed = F.when(F.col("account_type") == "Revenue", F.col("net_amount")).otherwise(-F.col("net_amount"))
        monthly = self.gl_star.where(F.col("account_type").isin("Revenue", "Expense")).groupBy(
            "account_code", "month_start").agg(F.sum(signed).alias("actual"))
        start = F.add_months("month_start", 12)
        return monthly.select(
            F.concat("account_code", F.lit(":"), start.cast("string")).alias("budget_line_id"), "account_code",
            start.alias("period_start"), fiscal_year(start).alias("fiscal_year"),
            dec(F.col("actual").cast("decimal(16,2)") * dec(F.lit(1.05), 3, 2)).alias("amount"),
            F.when(F.col("account_code") < "5000", "GEN").otherwise("EDU").alias("fund_code"),
            F.when(F.col("account_code") < "5000", "D1").otherwise("D2").alias("department_code"),
            F.when(F.col("account_code") == "5600", "Draft").otherwise("Adopted").alias("budget_version"))

    @cached_property
    def budget(self) -> DataFrame:
        return fact_budget(self.budget_lines, self.calendar, self.accounts, self.funds, self.departments, as_of=AS_OF)

    @cached_property
    def budget_star(self) -> DataFrame:
        dated = self.budget.join(self.calendar.select("date_key", "date", month_start("date").alias("month_start")), "date_key")
        return dated.join(self.accounts, "account_key")

    # ---------------------------------------------------------------- planted reconciliation

    @cached_property
    def recon(self) -> DataFrame:
        """Order totals by month and priority against the same totals with planted differences."""
        stream = F.col("o_orderpriority")
        totals = self.orders.groupBy(month_start("o_orderdate").alias("month_start"), stream.alias("revenue_stream")).agg(
            F.sum(dec("o_totalprice")).alias("amount"))
        m = F.month("month_start")
        n = F.substring("revenue_stream", 1, 1).cast("int")
        leg = [F.col("month_start"), F.col("revenue_stream"), F.lit("GEN").alias("fund_code"),
               F.lit("Tessitura").alias("source_system"), F.lit("4100").alias("gl_account_code")]
        source = totals.where(~((m == 2) & (n == 1))).select(*leg, F.col("amount").alias("source_amount"))
        shifted = (F.when(m == 4, F.col("amount") + 500).when(m == 6, F.col("amount") * dec(F.lit(1.005), 4, 3))
                   .when(m == 8, F.col("amount") * dec(F.lit(0.9), 3, 2)).otherwise(F.col("amount")))
        ledger = totals.where(~((m == 3) & (n == 2))).select(*leg, dec(shifted, 16).alias("gl_amount"))
        first, last = totals.agg(F.min("month_start")).scalar(), totals.agg(F.max("month_start")).scalar()
        return compare_legs(source, ledger, first, last, self.notes, AS_OF)

    @cached_property
    def notes(self) -> DataFrame:
        """One note for each August line of an even year."""
        months = self.orders.select(month_start("o_orderdate").alias("month_start"),
                                    F.col("o_orderpriority").alias("revenue_stream")).distinct()
        picked = months.where((F.month("month_start") == 8) & (F.year("month_start") % 2 == 0))
        return picked.select("month_start", "revenue_stream", F.lit("GEN").alias("fund_code"), F.lit("timing").alias("cause"),
                             F.lit("posted late").alias("note"), F.lit("Explained").alias("resolution"),
                             F.lit("controller@example.org").alias("owner_upn"))

    # ---------------------------------------------------------------- hall calendar

    @cached_property
    def venue_events(self) -> DataFrame:
        k = F.col("user_id")
        kinds = F.array(F.lit("Concert"), F.lit("Rental"), F.lit("Rehearsal"))
        status = (F.when(k % 10 == 0, "Cancelled").when(k % 10 == 1, "Tentative").when(k % 10 == 2, "Completed")
                  .otherwise("Confirmed"))
        return self.events.groupBy("user_id").agg(F.max(F.to_date("ts")).alias("event_date")).select(
            (k + 1).alias("event_key"), F.concat(F.lit("E"), k).alias("event_id"),
            F.concat(F.lit("Event "), k).alias("event_name"),
            F.element_at(kinds, (k % 3 + 1).cast("int")).alias("event_type"), status.alias("status"),
            F.concat(F.lit("Client "), k % 20).alias("client_name"), (k % 5 != 0).alias("is_linked"), "event_date")

    @cached_property
    def rooms(self) -> DataFrame:
        k = F.col("room_key")
        return self.events.select((F.col("event_id") % 6 + 1).alias("room_key")).distinct().select(
            k, F.concat(F.lit("R"), k).alias("room_id"), F.concat(F.lit("Room "), k).alias("room_name"),
            F.when(k <= 2, "Hall").otherwise("Studio").alias("room_type"), (k % 4 + 1).alias("venue_key"))

    @cached_property
    def bookings(self) -> DataFrame:
        minutes = F.floor(F.col("value") * 3).cast("int") - 5
        rows = self.events.withColumn("end_datetime", F.timestamp_add("MINUTE", minutes, F.col("ts")))
        return rows.select(
            F.col("event_id").alias("booking_id"),
            F.when(F.col("event_id") % 211 == 0, -1).otherwise(F.col("user_id") + 1).alias("event_key"),
            (F.col("event_id") % 6 + 1).alias("room_key"), date_key("ts").alias("booking_date_key"),
            F.col("ts").alias("start_datetime"), "end_datetime", hours_booked("ts", "end_datetime").alias("hours_booked"),
            dec(dec("value", 10) * 10, 12).alias("rental_fee"))

    # ---------------------------------------------------------------- marketing

    @cached_property
    def email_campaigns(self) -> DataFrame:
        """Twenty mailings with their numbers, counted from the events that fall to each."""
        k = F.col("k")
        series = F.array(*[F.lit(s) for s in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")])
        counted = self.events.groupBy((F.col("event_id") % 20).alias("k")).agg(
            F.min("ts").alias("send_datetime"), F.count(F.lit(1)).alias("recipients"),
            F.count_if(F.col("event_type") != "error").alias("delivered"),
            F.count_if(F.col("event_type") == "view").alias("unique_opens"),
            F.count_if(F.col("event_type") == "click").alias("unique_clicks"),
            F.count_if(F.col("event_type") == "signup").alias("unsubscribes"))
        return counted.select(
            (k + 1).alias("email_campaign_key"), F.concat(F.lit("EM"), k).alias("email_campaign_id"),
            F.concat(F.lit("Mailing "), k).alias("campaign_name"), F.lit("Newsletter").alias("campaign_type"),
            F.when(k % 4 != 0, F.element_at(series, (k % 6 + 1).cast("int"))).alias("series_promoted"),
            F.lit("All").alias("audience_segment"), "send_datetime", date_key("send_datetime").alias("send_date_key"),
            "recipients", "delivered", "unique_opens", "unique_clicks", "unsubscribes")

    @cached_property
    def email_people(self) -> DataFrame:
        k = F.col("user_id")
        return self.events.select("user_id").distinct().select((k + 1).alias("patron_key"), k.alias("patron_id"))

    @cached_property
    def email_clicks(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "click").select(
            F.col("event_id").alias("click_id"), (F.col("event_id") % 20 + 1).alias("email_campaign_key"),
            F.when(F.col("event_id") % 83 == 0, -1).otherwise(F.col("user_id") + 1).alias("patron_key"),
            date_key("ts").alias("click_date_key"), F.to_date("ts").alias("click_date"), F.col("user_id").alias("patron_id"))

    @cached_property
    def email_sales(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "purchase").select(
            (F.col("user_id") + 1).alias("patron_key"), (F.col("event_id") % 200 + 1).alias("performance_key"),
            date_key("ts").alias("order_date_key"), F.to_date("ts").alias("order_date"), dec("value").alias("net_amount"),
            (F.col("event_id") % 9 == 0).alias("is_returned"), F.col("user_id").alias("patron_id"))

    @cached_property
    def ads(self) -> DataFrame:
        lines = self.lineitem.join(self.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey", "left")
        return lines.select(
            date_key("l_shipdate").alias("ad_date_key"),
            F.when(F.col("l_linestatus") == "O", "Meta Ads").otherwise("Google Ads").alias("platform"),
            F.when(F.col("l_suppkey") % 10 != 0, F.col("p_type")).alias("series_promoted"),
            (F.col("l_quantity").cast("int") * 100).alias("impressions"), F.col("l_quantity").cast("int").alias("clicks"),
            dec(dec("l_extendedprice") * dec(F.lit(0.01), 3, 2), 12).alias("spend"), fiscal_year("l_shipdate").alias("fiscal_year"))

    # ---------------------------------------------------------------- education

    @cached_property
    def sessions(self) -> DataFrame:
        school = F.col("event_id") % 15
        return self.events.where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("enrollment_id"), (F.col("user_id") % 10 + 1).alias("program_key"),
            F.when(school == 0, -1).otherwise(school).alias("school_key"), date_key("ts").alias("session_date_key"),
            F.to_date("ts").alias("session_date"), fiscal_year("ts").alias("fiscal_year"),
            F.floor("value").cast("int").alias("participants"), (F.floor("value") / 2).cast("decimal(6,1)").alias(
                "teaching_artist_hours"))

    @cached_property
    def programs(self) -> DataFrame:
        k = F.col("program_key")
        return self.events.select((F.col("user_id") % 10 + 1).alias("program_key")).distinct().select(
            k, F.concat(F.lit("Program "), k).alias("program_name"),
            F.when(k % 2 == 0, "In school").otherwise("Community").alias("program_type"))

    @cached_property
    def schools(self) -> DataFrame:
        k = F.col("school_key")
        key = F.when(F.col("event_id") % 15 == 0, -1).otherwise(F.col("event_id") % 15)
        return self.events.select(key.alias("school_key")).distinct().select(
            k, F.when(k > 0, F.concat(F.lit("S"), k)).otherwise("N/A").alias("school_id"),
            F.when(k > 0, F.concat(F.lit("Borough "), k % 5)).alias("borough"),
            F.when(k > 0, k % 3 == 0).alias("is_title_i"))

    # ---------------------------------------------------------------- logs

    @cached_property
    def run_log(self) -> DataFrame:
        """One log line per event: table, stage, outcome and time."""
        k = F.col("event_id")
        tables = F.array(*[F.lit(t) for t in ("tessitura.order", "mip.gl_transaction", "diese.booking",
                                              "marketing.email_clicks", "education.enrollments")])
        stages = F.array(F.lit("silver"), F.lit("bronze"), F.lit("api"))
        return self.events.select(
            F.concat(F.lit("run-"), k).alias("run_id"), F.lit("load").alias("notebook"),
            F.element_at(tables, (F.col("user_id") % 4 + 1).cast("int")).alias("entity"),
            F.element_at(stages, (k % 3 + 1).cast("int")).alias("stage"), F.floor("value").cast("bigint").alias("rows_out"),
            F.when(F.col("event_type") == "error", "Failed").otherwise("Succeeded").alias("status"),
            F.col("props").alias("message"), F.col("ts").alias("started_at"), F.col("ts").alias("ended_at"))

    @cached_property
    def load_log(self) -> DataFrame:
        return self.orders.select(
            F.concat(F.lit("step-"), F.col("o_orderkey") % 13).alias("procedure_name"),
            F.concat(F.lit("table-"), F.col("o_orderkey") % 13).alias("target_table"),
            F.col("o_custkey").alias("rows_inserted"), F.lit("Succeeded").alias("status"), F.col("o_orderpriority").alias("message"),
            F.col("o_orderdate").alias("started_at"), F.col("o_orderdate").alias("ended_at"))
