"""Stock position per day, facility and product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clinical import days_of_supply, stock_status
from ..functions.dates import as_of_column, day_diff
from ..functions.nulls import mean, safe_div, sum_when
from ..operators.ordered import HOT_ROWS, Blocks, by_key, nulls_last
from ..session import written

# What adds to the stock and what takes from it.
INCOMING = ["receipt", "return"]
OUTGOING = ["issue", "adjustment"]
MONEY = "decimal(38,2)"


def signed_quantity():
    kind, quantity = F.col("movement_type"), F.col("quantity")
    return F.when(kind.isin(INCOMING), quantity).when(kind.isin(OUTGOING), -quantity).otherwise(0)


def daily_inventory(movements: DataFrame) -> DataFrame:
    kind = F.col("movement_type")
    zero = F.lit(0).cast("decimal(18,2)")

    def total(movement: str, value: str):
        return sum_when(kind == movement, F.col(value), zero).cast(MONEY)

    return movements.groupBy(
        "movement_date", "facility_id", "product_id", "product_name", "product_category"
    ).agg(
        total("receipt", "quantity").alias("receipts"),
        total("issue", "quantity").alias("issues"),
        total("adjustment", "quantity").alias("adjustments"),
        total("return", "quantity").alias("returns"),
        total("receipt", "total_cost").alias("receipt_cost"),
        total("issue", "total_cost").alias("issue_cost"),
        F.sum(signed_quantity()).cast(MONEY).alias("net_change"),
        mean("unit_cost").alias("unit_cost"),
    )


ROW_ORDER = ["movement_date", "facility_id", "product_name", "product_category"]


def moving_cost(daily: DataFrame, hot_rows: int = HOT_ROWS, block_rows: int | None = None, totals: DataFrame | None = None) -> DataFrame:
    """The mean cost of a product over three rows, across its facilities."""
    base = daily.columns

    def over(w):
        frame = w.rowsBetween(-2, 0)
        return safe_div(F.sum("unit_cost").over(frame), F.count("unit_cost").over(frame))

    def ordinary(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("product_id").orderBy(*nulls_last(*ROW_ORDER))
        return rows.select(*base, over(w).alias("moving_avg_cost"))

    def blocked(rows: DataFrame) -> DataFrame:
        blocks = Blocks(rows, nulls_last("product_id", *ROW_ORDER), block_rows)
        return blocks.near(blocks.rows, ["product_id"], {"moving_avg_cost": over}, before=2)

    return by_key(daily, ["product_id"], ordinary, blocked, hot_rows, totals=totals)


STOCK_KEYS = ["facility_id", "product_id"]
STOCK_ORDER = ["movement_date", "product_name", "product_category"]


def _stock_columns(rows: DataFrame) -> DataFrame:
    """The windows with plain window functions: one task for each facility and product.

    The longer order comes first and serves the shorter one, and the frame over the whole
    partition shares it, so rows are sorted once and two windows are enough.
    """
    stock = Window.partitionBy(*STOCK_KEYS)
    in_order = stock.orderBy(*nulls_last(*STOCK_ORDER))
    month = in_order.rowsBetween(-29, 0)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_date = stock.orderBy(*nulls_last("movement_date"))
    ordered = rows.select(
        "*",
        F.sum("issue_cost").over(month).cast(MONEY).alias("monthly_usage_cost"),
        F.sum("issues").over(month).cast(MONEY).alias("monthly_usage_quantity"),
        F.max("movement_date").over(whole).alias("last_movement_date"),
    )
    return ordered.select(
        *rows.columns,
        F.sum("net_change").over(by_date.rangeBetween(Window.unboundedPreceding, 0)).cast(MONEY).alias("current_stock"),
        "monthly_usage_cost", "monthly_usage_quantity", "last_movement_date",
    )


def _stock_blocks(rows: DataFrame, block_rows: int | None) -> DataFrame:
    """The same in blocks. Rows of one date share the stock at its end: the running sum by
    rows, less what the date's earlier rows and this one added, plus the date's whole."""
    blocks = Blocks(rows, nulls_last(*STOCK_KEYS, *STOCK_ORDER), block_rows)
    base, per_date = blocks.rows, [*STOCK_KEYS, "movement_date"]

    def last30(column: str):
        return lambda w: F.sum(column).over(w.rowsBetween(-29, 0))

    out = blocks.near(base, STOCK_KEYS, {"_cost": last30("issue_cost"), "_quantity": last30("issues")}, before=29)
    out = blocks.running_sums(out, STOCK_KEYS, {"_by_row": F.col("net_change")}, base)
    out = blocks.running_sums(out, per_date, {"_in_date": F.col("net_change")}, base)
    out = blocks.group_values(out, per_date, {"_of_date": (F.sum, "net_change")}, base)
    out = blocks.group_values(out, STOCK_KEYS, {"last_movement_date": (F.max, "movement_date")}, base)
    zero = F.lit(0).cast(MONEY)
    known = [F.coalesce(c, zero) for c in ("_by_row", "_in_date", "_of_date")]
    stock = F.when(F.col("_by_row").isNotNull() | F.col("_of_date").isNotNull(), known[0] - known[1] + known[2])
    return out.select(
        *rows.columns, stock.cast(MONEY).alias("current_stock"), F.col("_cost").cast(MONEY).alias("monthly_usage_cost"),
        F.col("_quantity").cast(MONEY).alias("monthly_usage_quantity"), "last_movement_date",
    )


def stock_windows(daily: DataFrame, hot_rows: int = HOT_ROWS, block_rows: int | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Running stock, 30-row usage and last date of a facility's product, hot ones in blocks.

    A NULL product gathers all names of a facility, so its rows are not bounded by days.
    """
    return by_key(daily, STOCK_KEYS, _stock_columns, lambda hot: _stock_blocks(hot, block_rows), hot_rows, totals=totals)


def inventory_position(movements: DataFrame, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Daily rows with the windows over facility and product.

    Whether a product is hot is judged by its movements, which are never fewer than its
    daily rows. ``counted`` may be a narrower table of them (facility_id, product_id), such as
    the movements before anything is joined to them.
    """
    # One pass counts by both keys; a product's count is the sum of its facilities'.
    of_stock = written((movements if counted is None else counted).groupBy(*STOCK_KEYS).agg(F.count("*").alias("_n")), "stock-counts")
    of_product = of_stock.groupBy("product_id").agg(F.sum("_n").alias("_n"))
    return stock_windows(moving_cost(daily_inventory(movements), hot_rows, totals=of_product), hot_rows, totals=of_stock)


def inventory_analytics(movements: DataFrame, as_of, counted: DataFrame | None = None) -> DataFrame:
    stock, usage = F.col("current_stock"), F.col("monthly_usage_quantity")
    return inventory_position(movements, counted=counted).select(
        "*",
        day_diff("last_movement_date", as_of_column(as_of)).alias("days_since_last_movement"),
        stock_status(stock, usage).alias("stock_status"),
        days_of_supply(stock, usage).alias("days_of_supply"),
        (stock.cast("double") * F.col("moving_avg_cost")).alias("inventory_value"),
    ).drop("last_movement_date")
