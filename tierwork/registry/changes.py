"""Tables brought up to date batch by batch, against the tables built whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..plans.propagate import GROUPS, Layout, propagate
from . import roles, star  # noqa: F401  (the marts' SQL is registered there)
from .base import SQL, Tables, query

# mart -> (label, up to three numbers), in words that both engines read
REPORT = {
    "monthly_revenue": ("concat(cast(year AS string), '-', cast(month AS string))", ["revenue", "order_count"]),
    "state_performance": ("state", ["order_count", "revenue", "avg_delivery_days"]),
    "category_ranking": ("category_name_english", ["revenue", "items_sold"]),
    "delivery_kpi": ("'all'", ["total_orders", "avg_delivery_days", "late_delivery_rate_pct"]),
    "review_by_category": ("category_name_english", ["avg_review_score", "review_count"]),
    "payment_distribution": ("payment_type", ["payment_count", "total_value"]),
    "customer_retention": ("'all'", ["total_customers", "repeat_customers", "retention_rate_pct"]),
}


def _line(mart: str, text: str, number: str) -> str:
    label, values = REPORT[mart]
    numbers = [f"cast({values[k] if k < len(values) else 'NULL'} AS {number}) AS v{k + 1}" for k in range(3)]
    return f"'{mart}' AS mart, {label.replace('string', text)} AS label, " + ", ".join(numbers)


def in_batches(t: Tables) -> list[dict[str, DataFrame]]:
    """The source tables in two batches. The second one holds later versions of orders,
    later shipments, and rows of every other table that arrive late."""
    middle = t.orders.agg(F.timestamp_seconds(F.percentile_approx(F.unix_seconds(F.col("o_orderdate").cast("timestamp")), 0.7)).cast("timestamp_ntz").alias("m")).first()["m"]
    late = {
        "orders": F.col("source_updated_at") > F.lit(middle), "order_items": F.col("shipping_limit_date") > F.lit(middle),
        "order_payments": F.col("payment_sequential") > 3, "order_reviews": F.col("order_id") % 5 == 0,
        "customers": F.col("customer_id") % 7 == 0, "products": F.col("product_id") % 11 == 0,
    }
    rows = {name: roles.SOURCES[name](t) for name in late}
    return [{name: df.filter(F.coalesce(late[name], F.lit(False)) == second) for name, df in rows.items()} for second in (False, True)]


@query("\n    UNION ALL ".join(f"SELECT {_line(mart, 'VARCHAR', 'DOUBLE')} FROM ({SQL[f'mart_{mart}']}) AS m" for mart in GROUPS))
def propagated_marts(t: Tables) -> DataFrame:
    """All marts after two batches of changes; the SQL builds them from all rows."""
    span = t.orders.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    wh, layout = t.warehouse("changes"), Layout(slots=8, of=lambda key: F.floor(key / 65536))
    for number, batch in enumerate(in_batches(t), 1):
        propagate(wh, number, batch, roles.translation(t), layout, (str(span[0]), str(span[1])))
    return reduce(DataFrame.unionByName, [
        wh.table(f"platinum.mart_{mart}").selectExpr(*_split(_line(mart, "string", "double"))) for mart in GROUPS])


def _split(line: str) -> list[str]:
    """The expressions of a select list; commas inside brackets stay."""
    parts, depth = [""], 0
    for c in line:
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts]
