"""Sale requests against stock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loomstar.operators.keys import highest_key, with_serial
from loomstar.operators.lookup import lookup_key
from loomstar.operators.ordering import running_total
from loomstar.operators.skew import HOT_ROWS, HOT_SHARE, hot_keys, split_join
from loomstar.sources.schemas import fit, target

# Fixed values.
SOLD = "Sale successfully completed!"
REFUSED = "Insufficient Quantity! Check inventory."


def stock_levels(fact: DataFrame) -> DataFrame:
    """Per product: highest and lowest stock on record, and the price of its first sale."""
    return fact.where(F.col("product_key").isNotNull()).groupBy("product_key").agg(
        F.max("stock").alias("_most"), F.min("stock").alias("_least"), F.min_by("price", "sale_key").alias("price")
    )


def apply_sales(
    fact: DataFrame,
    requests: DataFrame,
    dim_product: DataFrame,
    dim_user: DataFrame,
    batch_date: str,
    order: Sequence[str] = ("request_no",),
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    unique_order: bool = True,
) -> DataFrame:
    """Answer a batch of requests (sale_id, user_id, product_id, quantity and the ``order`` columns) in ``order``.

    A request is accepted when some row of its product shows at least that stock. Each accepted request
    becomes a fact row whose stock is the product's lowest so far less the quantity, so it is a running
    total and may fall below zero. New rows never exceed the highest stock on record, so acceptance
    needs no replay. An unknown product, or a quantity that is not positive, is refused; an unknown user
    gives a row with a null key. ``unique_order=False`` allows requests that agree in all ``order`` columns.
    """
    keyed = lookup_key(requests, dim_product.select("product_id", "product_key"), "product_key", ["product_id"])
    keyed = lookup_key(keyed, dim_user.select("user_id", "user_key"), "user_key", ["user_id"])
    hot = hot_keys(keyed, ["product_key"], hot_rows, hot_share)
    stocked = split_join(keyed, stock_levels(fact), ["product_key"], "left", hot)
    accepted = F.coalesce((F.col("quantity") > 0) & (F.col("quantity") <= F.col("_most")), F.lit(False))
    judged = stocked.withColumn("accepted", accepted).withColumn("_taken", F.when(accepted, F.col("quantity")).otherwise(0))
    totals = running_total(judged, ["product_key"], list(order), "_taken", "_gone", unique_order)

    def if_sold(value):
        return F.when(F.col("accepted"), value)

    return totals.select(
        *[c for c in order if c not in ("sale_id", "quantity")],
        "sale_id",
        "product_key",
        "user_key",
        if_sold(F.lit(batch_date).cast("date")).alias("sale_date"),
        if_sold(F.col("price")).alias("price"),
        "quantity",
        if_sold(F.col("price") * F.col("quantity")).alias("total_sale"),
        if_sold(F.col("_least") - F.col("_gone")).alias("stock"),
        "accepted",
        F.when(F.col("accepted"), F.lit(SOLD)).otherwise(F.lit(REFUSED)).alias("notice"),
    )


def record_sales(fact: DataFrame, dim_date: DataFrame, answered: DataFrame, batch_date: str) -> tuple[DataFrame, DataFrame]:
    """(dates, sales): the date dimension with the batch date in it, and the accepted requests of ``apply_sales`` as fact rows.

    A date that is there already keeps its key, otherwise it gets the next one. The fact rows go on from the highest
    ``sale_key`` and fit ``sale_fact_table``, ready to be appended.
    """
    today = dim_date.sparkSession.range(1).select(F.lit(batch_date).cast("date").alias("sale_date"))
    parts = today.select("sale_date", F.month("sale_date").alias("month"), F.year("sale_date").alias("year"))
    absent = parts.join(dim_date.select("sale_date"), "sale_date", "left_anti").withColumn("date_key", highest_key(dim_date, "date_key") + 1)
    dates = dim_date.unionByName(absent)
    day = dates.where(F.col("sale_date") == F.lit(batch_date).cast("date")).groupBy("sale_date").agg(F.min("date_key").alias("date_key"))
    sold = answered.where("accepted").join(F.broadcast(day), "sale_date")  # one row
    columns = ["sale_id", "product_key", "user_key", "date_key", "price", "quantity", "total_sale", "stock"]
    return dates, fit(with_serial(sold.select(*columns), "sale_key", fact), target("sales", "sale_fact_table"))
