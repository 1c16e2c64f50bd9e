"""Quality rules for the driver's tables; bounds are chosen so that every rule has failures."""

from __future__ import annotations

from ..contracts import Rule

LINE_RULES = (
    Rule("range", "error", "l_quantity", min=1, max=48),
    Rule("range", "error", "l_discount", min=0, max=0.09),
    Rule("accepted_values", "error", "l_returnflag", values=("A", "N", "R")),
    Rule("accepted_values", "warn", "l_linestatus", values=("O",)),
    Rule("foreign_key", "error", "l_orderkey", ref_entity="shop.orders", ref_column="o_orderkey"),
    Rule("foreign_key", "warn", "l_partkey", ref_entity="shop.missing", ref_column="p_partkey"),
    Rule("expression", "warn", None, check="l_extendedprice * (1 - l_discount) > 1000"),
)
ORDER_RULES = (
    Rule("not_null", "error", "o_orderpriority"),
    Rule("regex", "error", "o_orderpriority", pattern="^[1-4]-"),
    Rule("regex", "warn", "o_orderstatus", pattern="^(F|O)$", allow_null=True),
    Rule("not_future", "error", "o_orderdate"),
    Rule("range", "warn", "o_totalprice", min=1000, max=480000),
)
