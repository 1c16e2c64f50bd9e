"""Finance report tables: measures by period, statement amounts with totals, Statement of Activities, trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fiscal_year, safe_ratio
from ..operators.aggregate import subtotals
from ..operators.joins import align_facts
from ..session import cut_lineage
from .measures import BUDGET_VALUES, CASH_VALUES, GL_VALUES
from .time_intelligence import as_of_date, period_table, trailing_year, with_comparisons

__all__ = ["fold_days", "ledger_periods", "budget_periods", "finance_periods", "cash_periods", "statement_amounts",
           "statement_periods", "statement_of_activities", "trend", "STATEMENT_LAYOUT"]

# The sixteen lines of the Statement of Activities.
STATEMENT_LAYOUT = [
    (1, "Revenue", "Header", ""),
    (2, "    Single ticket sales", "Account", "4100"),
    (3, "    Subscriptions", "Account", "4110"),
    (4, "    Hall rentals", "Account", "4300"),
    (5, "    Contributions", "Account", "4200"),
    (6, "Total revenue", "Total Revenue", ""),
    (7, "Expenses", "Header", ""),
    (8, "    Artist fees", "Account", "5100"),
    (9, "    Salaries and wages", "Account", "5200"),
    (10, "    Venue operations", "Account", "5300"),
    (11, "    Marketing and advertising", "Account", "5400"),
    (12, "    Education programs", "Account", "5500"),
    (13, "    General and administrative", "Account", "5600"),
    (14, "Total expenses", "Total Expenses", ""),
    (15, "Change in net assets", "Net", ""),
    (16, "Surplus margin", "Ratio", ""),
]
_PERIOD = ["fiscal_year", "month_start"]


def _minus(a: Column, b: Column) -> Column:
    """Difference with a missing side as zero; NULL only when both are missing."""
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def _ratio(a: Column, b: Column) -> Column:
    return safe_ratio(a.cast("double"), b.cast("double"))


def _values(definitions) -> dict[str, Column]:
    return {name: value() for name, value in definitions.items()}


def fold_days(lines: DataFrame, definitions, keys: Sequence[str] = ()) -> DataFrame:
    """One row per day (and key) with the summed measures, kept in the shared folder.

    The report tables look at the same days many times: for the cap, for each calculation, for trailing windows.
    Folding once means the ledger itself is read once, and everything after works on one row per day.
    """
    return cut_lineage(lines.groupBy(*keys, "date").agg(*[F.sum(v).alias(n) for n, v in _values(definitions).items()]))


def ledger_periods(gl: DataFrame, calendar: DataFrame, keys: Sequence[str] = (),
                   calculations: Sequence[str] = ("current", "py", "fytd", "py_fytd")) -> DataFrame:
    """Revenue, expenses, surplus, earned and contributed revenue with shares, by month and calculation."""
    daily = fold_days(gl, GL_VALUES, keys)
    return _ledger_table(daily, calendar, as_of_date(daily), keys, calculations)


def _ledger_table(daily: DataFrame, calendar: DataFrame, cap: Column, keys: Sequence[str] = (),
                  calculations: Sequence[str] = ("current", "py", "fytd", "py_fytd")) -> DataFrame:
    table = period_table(daily, list(GL_VALUES), calculations, keys, cap, calendar)
    added = {}
    for c in calculations:
        s = {"current": ""}.get(c, f"_{c}")
        surplus = _minus(F.col(f"revenue{s}"), F.col(f"expenses{s}"))
        added[f"net_surplus{s}"] = surplus
        added[f"earned_revenue_share{s}"] = _ratio(F.col(f"earned_revenue{s}"), F.col(f"revenue{s}"))
        added[f"surplus_margin{s}"] = _ratio(surplus, F.col(f"revenue{s}"))
    return table.withColumns(added)


def budget_periods(budget: DataFrame, calendar: DataFrame, cap: Column, keys: Sequence[str] = (),
                   calculations: Sequence[str] = ("current", "fytd", "full_year")) -> DataFrame:
    """The same measures of the budget; ``cap`` is the ledger's last day."""
    names = {"revenue": "revenue_budget", "expenses": "expense_budget", "earned_revenue": "earned_revenue_budget",
             "contributed_revenue": "contributed_revenue_budget"}
    values = {names[n]: v for n, v in _values(BUDGET_VALUES).items()}
    table = period_table(budget, values, calculations, keys, cap, calendar)
    added = {}
    for c in calculations:
        s = {"current": ""}.get(c, f"_{c}")
        surplus = _minus(F.col(f"revenue_budget{s}"), F.col(f"expense_budget{s}"))
        added[f"net_surplus_budget{s}"] = surplus
        added[f"surplus_margin_budget{s}"] = _ratio(surplus, F.col(f"revenue_budget{s}"))
    return table.withColumns(added)


def finance_periods(gl: DataFrame, budget: DataFrame, calendar: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ledger and budget side by side per month, with variances in favourable sign and comparisons to last year."""
    daily = fold_days(gl, GL_VALUES, keys)
    cap = as_of_date(daily)
    period = [*keys, *_PERIOD]
    table = align_facts([_ledger_table(daily, calendar, cap, keys), budget_periods(budget, calendar, cap, keys)], period)
    revenue, expenses = F.col("revenue_fytd"), F.col("expenses_fytd")
    revenue_plan, expense_plan = F.col("revenue_budget_fytd"), F.col("expense_budget_fytd")
    begun = F.col("month_start") <= cap
    table = with_comparisons(table, ["revenue", "expenses", "net_surplus"])
    return table.withColumns({
        "revenue_vs_budget_fytd": _minus(revenue, revenue_plan),
        "revenue_vs_budget_fytd_pct": _ratio(_minus(revenue, revenue_plan), revenue_plan),
        "expenses_vs_budget_fytd": _minus(expense_plan, expenses),
        "expenses_vs_budget_fytd_pct": _ratio(_minus(expense_plan, expenses), expense_plan),
        "expense_budget_used_share": _ratio(expenses, F.col("expense_budget_full_year")),
        "revenue_actual_to_date": F.when(begun, F.col("revenue")),
        "expenses_actual_to_date": F.when(begun, F.col("expenses"))})


def cash_periods(gl: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cash received, paid and held, money owed, and days of cash, per month with last year beside them."""
    daily = fold_days(gl, {**CASH_VALUES, "expenses": GL_VALUES["expenses"]})
    cap = as_of_date(daily)
    flows = ["cash_received", "cash_paid", "cash_flow_amount", "cash_movement"]
    stocks = {"cash": F.col("cash_movement"), "accounts_payable": F.col("accounts_payable"),
              "accrued_payroll": F.col("accrued_payroll")}
    moved = period_table(daily, flows, ["current", "fytd", "py_fytd"], (), cap, calendar)
    held = period_table(daily, stocks, ["balance", "balance_py", "balance_py_fytd"], (), cap, calendar)

    def spent(name: str, prior: bool) -> DataFrame:
        frame = trailing_year(daily, F.col("expenses"), name, cap, prior=prior)
        return frame.select(fiscal_year("month_start").alias("fiscal_year"), "month_start", name)

    table = align_facts([moved, held, spent("spent_365", False), spent("spent_365_py", True)], _PERIOD)
    known = moved.select("month_start").unionByName(held.select("month_start")).distinct()
    table = table.join(known, "month_start", "left_semi")
    added = {}
    for s in ("", "_fytd", "_py_fytd"):
        added[f"net_cash_flow{s}"] = _minus(F.col(f"cash_received{s}"), F.col(f"cash_paid{s}"))
    for s in ("", "_py_fytd"):
        owed = [F.col(f"{c}_balance{s}") for c in ("accounts_payable", "accrued_payroll")]
        added[f"owed_to_suppliers_and_staff{s}"] = F.when(
            owed[0].isNotNull() | owed[1].isNotNull(), F.coalesce(owed[0], F.lit(0)) + F.coalesce(owed[1], F.lit(0)))
    added["days_cash_on_hand"] = _ratio(F.col("cash_balance"), F.col("spent_365").cast("double") / 365)
    added["days_cash_on_hand_py"] = _ratio(F.col("cash_balance_py_fytd"), F.col("spent_365_py").cast("double") / 365)
    return table.withColumns(added)


def statement_amounts(gl: DataFrame, levels: Sequence[str] = ("account_type", "account_group", "account_code")) -> DataFrame:
    """Income statement with subtotals: revenue and expenses positive, the grand total is the net surplus."""
    lines = gl.where(F.col("account_type").isin("Revenue", "Expense"))
    rolled = subtotals(lines, levels, revenue=F.sum(GL_VALUES["revenue"]()), expenses=F.sum(GL_VALUES["expenses"]()))
    revenue, expenses = F.coalesce("revenue", F.lit(0)), F.coalesce("expenses", F.lit(0))
    amount = F.when(F.col("level") == 0, revenue - expenses).otherwise(revenue + expenses)
    return rolled.select(*levels, "level", amount.alias("statement_amount"))


def statement_periods(gl: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("account_type",)) -> DataFrame:
    """Statement amount per account type and month: year to date, last year, difference and share of |last year|."""
    lines = gl.where(F.col("account_type").isin("Revenue", "Expense"))
    cap = as_of_date(gl)
    shown = F.coalesce(GL_VALUES["revenue"](), GL_VALUES["expenses"]())
    table = period_table(lines, {"statement": shown}, ["fytd", "py_fytd"], keys, cap, calendar)
    return with_comparisons(table, ["statement"])


def statement_of_activities(gl: DataFrame, budget: DataFrame, calendar: DataFrame) -> DataFrame:
    """The sixteen-line statement per month: actual, budget and last year to date, with variances.

    Variances are favourable when positive, so expense lines are turned; percentages stay blank on the net and ratio
    lines.
    """
    by_account = account_periods(gl, budget, calendar)

    account_lines = by_account.select("fiscal_year", "month_start", F.lit("Account").alias("line_type"), "account_code",
                                      *[_sum2(f"revenue_{v}", f"expenses_{v}").alias(v) for v in _VALUES])
    sums = by_account.groupBy(*_PERIOD).agg(*[F.sum(f"{m}_{v}").alias(f"{m}_{v}") for m in ("revenue", "expenses")
                                              for v in _VALUES])

    def line(kind: str, value) -> Column:
        return F.struct(F.lit(kind).alias("line_type"), F.lit("").alias("account_code"),
                        *[value(v).cast("double").alias(v) for v in _VALUES])

    def surplus(v: str) -> Column:
        return _minus(F.col(f"revenue_{v}"), F.col(f"expenses_{v}"))

    totals = sums.select(*_PERIOD, F.inline(F.array(
        line("Header", lambda v: F.lit(None)),
        line("Total Revenue", lambda v: F.col(f"revenue_{v}")),
        line("Total Expenses", lambda v: F.col(f"expenses_{v}")),
        line("Net", surplus), line("Ratio", lambda v: _ratio(surplus(v), F.col(f"revenue_{v}"))))))
    values = account_lines.select(*_PERIOD, "line_type", "account_code",
                                  *[F.col(v).cast("double").alias(v) for v in _VALUES]).unionByName(totals)
    lines = sums.select(*_PERIOD, F.explode(F.array(*[
        F.struct(F.lit(o).alias("line_order"), F.lit(n).alias("line"), F.lit(t).alias("line_type"),
                 F.lit(c).alias("account_code")) for o, n, t, c in STATEMENT_LAYOUT])).alias("_l")).select(*_PERIOD, "_l.*")
    table = lines.join(values, [*_PERIOD, "line_type", "account_code"], "left")

    expense_line = (F.col("line_type") == "Total Expenses") | (
        (F.col("line_type") == "Account") & F.col("account_code").startswith("5"))
    actual, plan, prior = F.col("actual"), F.col("budget"), F.col("last_year")
    vs_budget = F.when(expense_line, _minus(plan, actual)).otherwise(_minus(actual, plan))
    vs_prior = F.when(expense_line, prior - actual).otherwise(actual - prior)
    prior_share = F.when(expense_line, _minus(prior, actual)).otherwise(_minus(actual, prior))
    has_percent = ~F.col("line_type").isin("Net", "Ratio")
    return table.select(
        *_PERIOD, "line_order", "line", "line_type", "account_code", *_VALUES,
        vs_budget.alias("vs_budget"), F.when(has_percent, _ratio(vs_budget, F.abs(plan))).alias("vs_budget_pct"),
        vs_prior.alias("vs_last_year"),
        F.when(has_percent, _ratio(prior_share, F.abs(prior))).alias("vs_last_year_pct"))


_VALUES = ("actual", "budget", "last_year")


def _sum2(a: str, b: str) -> Column:
    a, b = F.col(a), F.col(b)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def account_periods(gl: DataFrame, budget: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue and expenses per account and month: actual and budget year to date, last year to date."""
    pick, key = ("revenue", "expenses"), ["account_code"]
    daily = fold_days(gl, {n: GL_VALUES[n] for n in pick}, key)
    planned_daily = fold_days(budget, {f"{n}_plan": BUDGET_VALUES[n] for n in pick}, key)
    cap = as_of_date(daily)
    actual = period_table(daily, list(pick), ["fytd", "py_fytd"], key, cap, calendar)
    planned = period_table(planned_daily, [f"{n}_plan" for n in pick], ["fytd"], key, cap, calendar)
    both = align_facts([actual, planned], ["account_code", *_PERIOD])
    return both.select(
        "account_code", *_PERIOD,
        *[F.col(f"{n}_fytd").alias(f"{n}_actual") for n in pick],
        *[F.col(f"{n}_plan_fytd").alias(f"{n}_budget") for n in pick],
        *[F.col(f"{n}_py_fytd").alias(f"{n}_last_year") for n in pick])


def trend(gl: DataFrame, budget: DataFrame, calendar: DataFrame, metric: str = "Revenue") -> DataFrame:
    """One metric by month: actual up to the ledger's last day, budget, last year.  Revenue, Expenses or Net Surplus."""
    names = {"Revenue": ("revenue", "revenue_budget"), "Expenses": ("expenses", "expense_budget"),
             "Net Surplus": ("net_surplus", "net_surplus_budget")}
    actual, planned = names[metric]
    daily = fold_days(gl, GL_VALUES)
    cap = as_of_date(daily)
    ledger = _ledger_table(daily, calendar, cap, calculations=("current", "py"))
    plan = budget_periods(budget, calendar, cap, calculations=("current",))
    table = align_facts([ledger.select(*_PERIOD, actual, f"{actual}_py"), plan.select(*_PERIOD, planned)], _PERIOD)
    begun = F.col("month_start") <= cap
    return table.select(*_PERIOD, F.when(begun, F.col(actual)).alias("trend_actual"), F.col(planned).alias("trend_budget"),
                        F.when(F.add_months("month_start", -12) <= cap, F.col(f"{actual}_py")).alias("trend_last_year"))
