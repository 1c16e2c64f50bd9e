"""Ledger views: statement, budget against actual, cash flow, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import favourable_variance, fiscal_year, month_start
from ..operators.aggregate import running_balance, union_all
from ..operators.joins import full_outer_align, inner_star, note_join

__all__ = ["income_statement", "budget_vs_actual", "cash_flow_monthly", "build_recon", "recon_source_legs",
           "recon_ledger_legs", "compare_legs", "recon_with_notes", "recon_lines_to_investigate", "CASH_ACCOUNT"]

CASH_ACCOUNT = "1010"
# The ledger account of each revenue stream, the system that feeds it, and the default fund.
STREAMS = {"4100": ("Single tickets", "Tessitura"), "4110": ("Subscriptions", "Tessitura"),
           "4200": ("Contributions", "Tessitura"), "4300": ("Venue rentals", "Diese")}
GENERAL_FUND = "GEN"
NO_FUND = "N/A"
COVERED_MODULE = "TESSITURA"
MATCHED_BELOW, LOWEST_TOLERANCE, TOLERANCE_SHARE = 0.01, 1000, 0.01


def _day(calendar: DataFrame, key: str, *columns: str) -> tuple[DataFrame, str]:
    return calendar.select(F.col("date_key").alias(key), *columns), key


def income_statement(gl: DataFrame, accounts: DataFrame, departments: DataFrame, funds: DataFrame,
                     calendar: DataFrame) -> DataFrame:
    """Revenue and expense per month, account, department and fund; both shown positive."""
    lines = accounts.where(F.col("account_type").isin("Revenue", "Expense"))
    star = inner_star(gl, [
        (lines.select("account_key", "account_type", "account_group", "account_code", "account_name"), "account_key"),
        (departments.select("department_key", "department_name"), "department_key"),
        (funds.select("fund_key", F.col("ledger_fund_code").alias("fund_code"), "fund_name"), "fund_key"),
        _day(calendar, "effective_date_key", "fiscal_year", "fiscal_year_label", "fiscal_month_num", "month_name")])
    shown = F.when(F.col("account_type") == "Expense", -F.col("net_amount")).otherwise(F.col("net_amount"))
    return star.groupBy("fiscal_year", "fiscal_year_label", "fiscal_month_num", "month_name", "account_type",
                        "account_group", "account_code", "account_name", "department_name", "fund_code",
                        "fund_name").agg(F.sum(shown).alias("amount"))


def budget_vs_actual(gl: DataFrame, budget: DataFrame, accounts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Month and account, either side may be missing; a positive variance is favourable."""
    keys = ["fiscal_year", "month_start", "account_key"]
    dated = calendar.select("date_key", "fiscal_year", month_start("date").alias("month_start"))
    profit_loss = accounts.where(F.col("account_type").isin("Revenue", "Expense")).select("account_key", "account_type")
    signed = F.when(F.col("account_type") == "Revenue", F.col("net_amount")).otherwise(-F.col("net_amount"))
    actual = inner_star(gl, [(profit_loss, "account_key"),
                             (dated.withColumnRenamed("date_key", "effective_date_key"), "effective_date_key")])
    actual = actual.groupBy(*keys).agg(F.sum(signed).alias("actual"))
    planned = budget.join(dated.select("date_key", "month_start"), "date_key").groupBy(*keys).agg(
        F.sum("budget_amount").alias("budget"))
    aligned = full_outer_align(actual, planned, keys, ["actual", "budget"])
    named = aligned.join(accounts.select("account_key", "account_type", "account_group", "account_name"), "account_key")
    variance = favourable_variance("account_type", "actual", "budget")
    return named.select("fiscal_year", "month_start", "account_type", "account_group", "account_name",
                        F.col("actual").cast("decimal(18,2)").alias("actual"),
                        F.col("budget").cast("decimal(18,2)").alias("budget"),
                        variance.cast("decimal(18,2)").alias("favourable_variance"))


def cash_flow_monthly(gl: DataFrame, accounts: DataFrame, modules: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cash movement per month and cash-flow line, with the closing balance on every line of the month.

    A posting module that is not known keeps its money under NULL labels.
    """
    cash = accounts.where(F.col("account_code") == CASH_ACCOUNT).select("account_key")
    lines = inner_star(gl, [(cash, "account_key"),
                            (calendar.select(F.col("date_key").alias("effective_date_key"),
                                             month_start("date").alias("month_start")), "effective_date_key")])
    labelled = lines.join(modules.select("source_module", "cash_flow_line", "cash_direction"), "source_module", "left")
    monthly = labelled.groupBy("month_start", "cash_flow_line", "cash_direction").agg(
        F.sum(F.col("debit_amount") - F.col("credit_amount")).alias("cash_movement"))
    balanced = running_balance(monthly, "month_start", "cash_movement", "closing_cash_balance")
    return balanced.select("month_start", "cash_flow_line", "cash_direction",
                           F.col("cash_movement").cast("decimal(18,2)").alias("cash_movement"),
                           F.col("closing_cash_balance").cast("decimal(18,2)").alias("closing_cash_balance"))


# ---------------------------------------------------------------- reconciliation

LEG = ["month_start", "revenue_stream", "fund_code", "source_system", "gl_account_code"]


def _leg(rows: DataFrame, calendar: DataFrame, day_key: str, account: str, amount: str,
         fund: str | None = None) -> DataFrame:
    stream, system = STREAMS[account]
    dated = rows.join(calendar.select(F.col("date_key").alias(day_key), month_start("date").alias("month_start")), day_key)
    fund_code = F.coalesce(F.col(fund), F.lit(NO_FUND)) if fund else F.lit(GENERAL_FUND)
    totals = dated.groupBy("month_start", fund_code.alias("fund_code")).agg(F.sum(amount).alias("source_amount"))
    return totals.select("month_start", F.lit(stream).alias("revenue_stream"), "fund_code",
                         F.lit(system).alias("source_system"), F.lit(account).alias("gl_account_code"), "source_amount")


def recon_source_legs(sales: DataFrame, subscriptions: DataFrame, gifts: DataFrame, bookings: DataFrame,
                      events: DataFrame, funds: DataFrame, calendar: DataFrame, last_ledger_day) -> DataFrame:
    """What the source systems say, per month, stream and fund."""
    rentals = events.where((F.col("event_type") == "Rental") & (F.col("status") != "Cancelled")).select("event_key")
    rented = bookings.join(rentals, "event_key", "left_semi")
    covered = calendar.where(F.col("date") <= last_ledger_day)
    by_fund = gifts.join(funds.select("fund_key", "ledger_fund_code"), "fund_key")
    return union_all([
        _leg(sales.where(~F.col("is_returned")), calendar, "order_date_key", "4100", "net_amount"),
        _leg(subscriptions, calendar, "purchase_date_key", "4110", "package_amount"),
        _leg(by_fund, calendar, "gift_date_key", "4200", "amount", "ledger_fund_code"),
        _leg(rented, covered, "booking_date_key", "4300", "rental_fee")])


def recon_ledger_legs(gl: DataFrame, accounts: DataFrame, funds: DataFrame, calendar: DataFrame) -> DataFrame:
    """What the ledger says, on the same grain; only contributions are split by fund."""
    revenue = accounts.where(F.col("account_code").isin(*STREAMS)).select("account_key", "account_code")
    lines = inner_star(gl, [(revenue, "account_key"),
                            (calendar.select(F.col("date_key").alias("effective_date_key"),
                                             month_start("date").alias("month_start")), "effective_date_key")])
    lines = lines.join(funds.select("fund_key", "ledger_fund_code"), "fund_key", "left")
    code = F.col("account_code")

    def by_account(index: int):
        mapping = F.create_map(*[x for a, s in STREAMS.items() for x in (F.lit(a), F.lit(s[index]))])
        return mapping[code]

    fund = F.when(code == "4200", F.coalesce("ledger_fund_code", F.lit(NO_FUND))).otherwise(GENERAL_FUND)
    return lines.groupBy(
        "month_start", by_account(0).alias("revenue_stream"), fund.alias("fund_code"),
        by_account(1).alias("source_system"), code.alias("gl_account_code")).agg(F.sum("net_amount").alias("gl_amount"))


def compare_legs(source: DataFrame, ledger: DataFrame, first_month, last_month, notes: DataFrame | None = None,
                 as_of=None) -> DataFrame:
    """Both sides, variance and status for the months between two bounds.

    Matched means less than a cent apart; the tolerance is 1,000 or one percent of the source amount, whichever is
    larger.  A line outside it is Open unless a note says otherwise.
    """
    aligned = full_outer_align(source, ledger, LEG, ["source_amount", "gl_amount"])
    money = "decimal(16,2)"
    aligned = aligned.withColumns({"source_amount": F.col("source_amount").cast(money),
                                   "gl_amount": F.col("gl_amount").cast(money)})
    in_range = aligned.where(F.col("month_start").between(first_month, last_month))
    variance = (F.col("gl_amount") - F.col("source_amount")).cast(money)
    exact = F.greatest(F.abs("source_amount") * F.lit(TOLERANCE_SHARE).cast("decimal(3,2)"),
                       F.lit(LOWEST_TOLERANCE).cast("decimal(18,4)"))
    status = (F.when(F.abs("variance") < F.lit(MATCHED_BELOW).cast("decimal(3,2)"), "Matched")
              .when(F.abs("variance") <= exact, "Within tolerance").otherwise("Investigate"))
    compared = in_range.withColumn("variance", variance).withColumns({
        "fiscal_year": fiscal_year("month_start"), "tolerance_amount": exact.cast(money), "status": status})
    if notes is not None:
        compared = note_join(compared, notes, columns=("cause", "note", "resolution"))
    else:
        compared = compared.withColumns({c: F.lit(None).cast("string") for c in ("cause", "note", "resolution")})
    opened = F.coalesce("resolution", F.when(F.col("status") == "Investigate", "Open"))
    return compared.withColumns({"resolution": opened, "loaded_at": F.lit(as_of).cast("timestamp")}).select(
        "month_start", "fiscal_year", "revenue_stream", "fund_code", "source_system", "gl_account_code",
        "source_amount", "gl_amount", "variance", "tolerance_amount", "status", "loaded_at", "cause", "note",
        "resolution")


def build_recon(sales: DataFrame, subscriptions: DataFrame, gifts: DataFrame, bookings: DataFrame, events: DataFrame,
                gl: DataFrame, accounts: DataFrame, funds: DataFrame, calendar: DataFrame,
                notes: DataFrame | None = None, as_of=None) -> DataFrame:
    """Source revenue against the ledger per month, stream and fund.

    Every leg is grouped to month, stream and fund before legs meet.  The months compared are those the ledger's own
    ticketing postings cover; both bounds are scalar subqueries of the plan.
    """
    posted = gl.where(F.col("source_module") == COVERED_MODULE).select("effective_date_key").join(
        calendar.select(F.col("date_key").alias("effective_date_key"), "date"), "effective_date_key")
    first, last = posted.agg(F.min("date")).scalar(), posted.agg(F.max("date")).scalar()
    source = recon_source_legs(sales, subscriptions, gifts, bookings, events, funds, calendar, last)
    ledger = recon_ledger_legs(gl, accounts, funds, calendar)
    return compare_legs(source, ledger, F.trunc(first, "month"), F.trunc(last, "month"), notes, as_of)


def recon_with_notes(recon: DataFrame, notes: DataFrame) -> DataFrame:
    """The saved reconciliation beside the notes as they are now."""
    live = note_join(recon.drop("cause", "note", "resolution"), notes)
    return live.withColumn("resolution", F.coalesce("resolution", F.when(F.col("status") == "Investigate", "Open")))


def recon_lines_to_investigate(recon: DataFrame) -> DataFrame:
    """Lines outside tolerance, largest difference first."""
    return recon.where(F.col("status") == "Investigate").orderBy(F.abs("variance").desc(), "month_start",
                                                                  "revenue_stream", "fund_code")
