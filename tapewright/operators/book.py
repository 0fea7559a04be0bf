"""Order-book snapshots: level rows, top of book, microprice and imbalance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def level_fault(level: Column) -> Column:
    """Why a level cannot stand in a book: no finite price or quantity, nothing on offer; else NULL."""
    price, qty = level["price"], level["qty"]

    def finite(value: Column) -> Column:
        return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))
    return (F.when(~finite(price), "no_price").when(~finite(qty), "no_quantity")
            .when(qty <= 0, "no_size"))


def _sound(column: str) -> Column:
    return F.filter(column, lambda level: level_fault(level).isNull())


def levels(snapshots: DataFrame) -> DataFrame:
    """One row per level and side as sent; level 0 is the first one, ``level_fault`` says why one does not count."""
    rest = [c for c in snapshots.columns if c not in ("bids", "asks")]
    def side(name: str, column: str) -> Column:
        return F.transform(
            F.coalesce(column, F.expr("cast(array() as array<struct<price: double, qty: double>>)")),
            lambda lv, i: F.struct(F.lit(name).alias("side"), i.alias("level"),
                                   lv["price"].alias("price"), lv["qty"].alias("qty"),
                                   level_fault(lv).alias("level_fault")))

    sides = F.concat(side("bid", "bids"), side("ask", "asks"))
    return snapshots.select(*rest, F.inline(sides))


def _best(column: str, highest: bool) -> Column:
    """The best sound level as STRUCT<price, qty>; struct order is price first."""
    return F.array_max(_sound(column)) if highest else F.array_min(_sound(column))


def top_of_book(snapshots: DataFrame) -> DataFrame:
    return (snapshots
            .withColumns({"_bid": _best("bids", True), "_ask": _best("asks", False)})
            .withColumns({
                "bid": F.col("_bid.price"), "bid_qty": F.col("_bid.qty"),
                "ask": F.col("_ask.price"), "ask_qty": F.col("_ask.qty")})
            .withColumns({"mid": (F.col("bid") + F.col("ask")) / 2,
                          "spread": F.col("ask") - F.col("bid")})
            .drop("_bid", "_ask"))


def _total(column: str) -> Column:
    return F.aggregate(_sound(column), F.lit(0.0), lambda total, lv: total + lv["qty"])


def imbalance(snapshots: DataFrame) -> DataFrame:
    bid_total, ask_total = _total("bids"), _total("asks")
    return top_of_book(snapshots).withColumns({
        "microprice": F.try_divide(
            F.col("bid") * F.col("ask_qty") + F.col("ask") * F.col("bid_qty"),
            F.col("bid_qty") + F.col("ask_qty")),
        "imbalance": F.try_divide(bid_total - ask_total, bid_total + ask_total)})
