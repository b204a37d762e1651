"""Change history derived from final states, and states derived back from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import in_month, month_start, up_to_month
from .joins import keep_known
from .windows import latest_version


def change_log(
    orders: DataFrame,
    status: str = "order_status",
    purchased: str = "order_purchase_timestamp",
    delivered: str = "order_delivered_customer_date",
    updated: str = "source_updated_at",
) -> DataFrame:
    """Versions each order went through.

    An order delivered in a later month than its purchase appears twice: as
    'shipped' without a delivery time, updated at purchase, and as it finally
    is, updated at delivery. Every other order has its final version only. The
    versions are made by an array explode, without a second scan.
    """
    two_steps = (F.col(status) == "delivered") & (month_start(delivered) > month_start(purchased))
    final_time = F.when(two_steps, F.col(delivered)).otherwise(F.col(purchased))
    changed = [status, delivered, updated]
    delivered_type = orders.schema[delivered].dataType
    final = F.struct(F.col(status).alias(status), F.col(delivered).alias(delivered), final_time.alias(updated))
    first = F.struct(
        F.lit("shipped").alias(status),
        F.lit(None).cast(delivered_type).alias(delivered),
        F.col(purchased).cast(delivered_type).alias(updated),
    )
    versions = F.when(F.coalesce(two_steps, F.lit(False)), F.array(first, final)).otherwise(F.array(final))
    rest = [c for c in orders.columns if c not in changed]
    exploded = orders.select(*rest, F.explode(versions).alias("_v"))
    columns = orders.columns if updated in orders.columns else [*orders.columns, updated]
    return exploded.select(*[F.col(f"_v.{c}").alias(c) if c in changed else F.col(c) for c in columns])


def state_as_of(log: DataFrame, month: str, keys: list[str], updated: str = "source_updated_at") -> DataFrame:
    """Latest version per key among those written up to the end of ``month``."""
    return latest_version(log.filter(up_to_month(updated, month)), keys, [updated])


def month_slice(
    orders: DataFrame, children: dict[str, DataFrame], month: str,
    purchased: str = "order_purchase_timestamp", key: str = "order_id",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Orders of one month and the child rows that belong to them."""
    parents = orders.filter(in_month(purchased, month))
    return parents, {name: keep_known(child, parents, [key]) for name, child in children.items()}
