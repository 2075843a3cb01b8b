"""Order-detail fact: input checks and the settled join.

The settled fact holds one row per order detail, built from the newest version
of every input.  ``replay`` holds the changelog form with expiring state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.functions import amount_or_zero, is_blank, is_valid_amount, is_valid_integer
from rillhouse.operators.latest import latest_by
from rillhouse.session import clear_files, folder_exists, release_shuffles
from rillhouse.sources.schemas import (
    ACTIVITY_FIELDS, COUPON_FIELDS, DETAIL_FIELDS, FACT_FIELDS, ORDER_FIELDS,
)

ORDER_OF_ARRIVAL = ["arrival_ts", "seq"]
_AMOUNTS = ["order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount"]


def detail_reason() -> Column:
    """Why an order detail is rejected (null when it is not): keys must not be blank, the
    count must be a whole number and the amounts numbers or blank."""
    c = F.col
    bad_amount = ~is_valid_amount(c(_AMOUNTS[0]))
    for name in _AMOUNTS[1:]:
        bad_amount = bad_amount | ~is_valid_amount(c(name))
    return (F.when(is_blank(c("id")) | is_blank(c("order_id")) | is_blank(c("sku_id")),
                   F.lit("missing key"))
            .when(~is_valid_integer(c("sku_num")), F.lit("bad sku_num"))
            .when(bad_amount, F.lit("bad amount")))


def order_reason() -> Column:
    return (F.when(is_blank(F.col("id")), F.lit("missing key"))
            .when(~is_valid_amount(F.col("original_total_amount")), F.lit("bad amount")))


def promotion_reason() -> Column:
    """For activity and coupon rows."""
    return F.when(is_blank(F.col("order_detail_id")), F.lit("missing key"))


def check_details(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", detail_reason())


def check_orders(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", order_reason())


def check_promotions(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", promotion_reason())


def clean_inputs(details: DataFrame, orders: DataFrame, activities: DataFrame,
                 coupons: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    checked = (check_details(details), check_orders(orders), check_promotions(activities),
               check_promotions(coupons))
    return tuple(f.filter(F.col("reason").isNull()).drop("reason") for f in checked)


def detail_struct(fields: Iterable[str] = DETAIL_FIELDS) -> Column:
    """Detail part of a fact; blank amounts (except the unit price) become ``0``."""
    filled = {"split_total_amount", "split_activity_amount", "split_coupon_amount"}
    return F.struct(*[(amount_or_zero(F.col(n)) if n in filled else F.col(n)).alias(n)
                      for n in fields])


def order_struct(fields: Iterable[str] = ORDER_FIELDS) -> Column:
    return F.struct(*[(amount_or_zero(F.col(n)) if n == "original_total_amount"
                       else F.col(n)).alias(n) for n in fields])


def activity_struct() -> Column:
    return F.struct(*ACTIVITY_FIELDS)


def coupon_struct() -> Column:
    return F.struct(*COUPON_FIELDS)


def _versions(rows: DataFrame, key: str, payload: Column | None, name: str) -> DataFrame:
    """Newest version per key as ``key, <name>, <name>_at``, without payload as ``key, <name>_at``.

    Rows are shuffled before they are grouped: nearly all ids are unique, so reducing them
    first would sort, and on large inputs spill, whole input splits for nothing.
    """
    narrow = rows.select(F.col(key).alias("key"), *([] if payload is None else [payload.alias(name)]),
                         F.col("arrival_ts").alias(f"{name}_at"), "seq")
    return latest_by(narrow.repartition("key"), ["key"], [f"{name}_at", "seq"]).drop("seq")


def settle(details: DataFrame, orders: DataFrame, activities: DataFrame | None = None,
           coupons: DataFrame | None = None, columns: Iterable[str] | None = None) -> DataFrame:
    """Settled fact from cleaned inputs.

    With ``columns`` only these columns of the fact are made, in the fact's order: nothing else
    goes through the shuffles, and a promotion side that gives none of them is left out, as it
    changes no row.

    Details, activities and coupons share the detail id, so they are joined on one
    partitioning first; the order row is joined last, on the order id.  ``_join_ts``
    is the arrival (epoch ms) of the newest part.
    """
    wanted = {*FACT_FIELDS, "_fact_type", "_join_ts"} if columns is None else set(columns)
    of_detail = [n for n in DETAIL_FIELDS if n in wanted]
    of_order = [n for n in ORDER_FIELDS[1:] if n in wanted]
    fact = _versions(details, "id", detail_struct(dict.fromkeys([*of_detail, "order_id"])), "d")
    arrivals = [F.col("d_at"), F.col("o_at")]
    parts = [F.col(f"d.{n}") for n in of_detail] + [F.col(f"o.{n}") for n in of_order]
    for name, side, fields in (("a", activities, ACTIVITY_FIELDS), ("c", coupons, COUPON_FIELDS)):
        given = [n for n in fields[1:] if n in wanted]
        if side is None:
            parts += [F.lit(None).cast("string").alias(n) for n in given]
            continue
        if not given and "_join_ts" not in wanted:
            continue
        payload = F.struct(*given) if given else None
        fact = fact.join(_versions(side, "order_detail_id", payload, name), "key", "left")
        parts += [F.col(f"{name}.{n}") for n in given]
        arrivals.append(F.col(f"{name}_at"))
    # Joined on the id inside the struct, not on the grouping key: the (small) order side
    # then gets a shuffle of its own, which adaptive execution needs to split the task of
    # an order with very many details.
    orders_now = _versions(orders, "id", order_struct(["id", *of_order]), "o").drop("key")
    joined = fact.drop("key").join(orders_now, F.col("d.order_id") == F.col("o.id"), "inner")
    made = {"_fact_type": F.lit("order_detail"), "_join_ts": F.unix_millis(F.greatest(*arrivals))}
    return joined.select(*parts, *[c.alias(n) for n, c in made.items() if n in wanted])


#: Parts of ``settle_in_parts``.
PARTS = 4


def settle_in_parts(details: DataFrame, orders: DataFrame, activities: DataFrame | None, coupons: DataFrame | None,
                    path: str, columns: Iterable[str] | None = None, parts: int = PARTS,
                    evaluated: Callable[[], None] = lambda: None) -> DataFrame:
    """``settle`` one part of the detail ids after the other, so that only one part's shuffles take
    disk at a time; the fact is kept in ``path``, a new folder.

    The inputs are evaluated once: what ``settle`` reads of them is written by part first, and goes
    part by part as it is worked off.  ``evaluated`` is called when nothing is read of them any more.
    """
    spark = details.sparkSession
    wanted = {*FACT_FIELDS, "_fact_type", "_join_ts"} if columns is None else set(columns)
    sides = {"details": (details, "id", [n for n in DETAIL_FIELDS if n in wanted or n in ("id", "order_id")]),
             "orders": (orders, "id", [n for n in ORDER_FIELDS if n in wanted or n == "id"])}
    for name, side, fields in (("activities", activities, ACTIVITY_FIELDS), ("coupons", coupons, COUPON_FIELDS)):
        if side is not None and wanted.intersection(["_join_ts", *fields[1:]]):
            sides[name] = side, fields[0], [fields[0], *[n for n in fields[1:] if n in wanted]]
    schemas = {}
    for name, (side, key, fields) in sides.items():
        narrow = side.select(*fields, *ORDER_OF_ARRIVAL)
        schemas[name] = narrow.schema
        part = F.lit(0) if name == "orders" else F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        (narrow.withColumn("_part", part).write.option("compression", "zstd").partitionBy("_part")
         .parquet(f"{path}/{name}"))
        release_shuffles(spark)
    evaluated()

    def held(name: str, part: int) -> DataFrame | None:
        given = {"activities": activities, "coupons": coupons}.get(name, details)
        if name not in sides:
            return None if given is None else given.limit(0)
        folder = f"{path}/{name}/_part={part}"
        return spark.read.schema(schemas[name]).parquet(folder) if folder_exists(spark, folder) else (
            spark.createDataFrame([], schemas[name]))

    facts, schema = [], None
    for part in range(parts):
        inputs = [held(name, 0 if name == "orders" else part) for name in ("details", "orders", "activities", "coupons")]
        fact = settle(*inputs, columns=columns)
        facts.append(f"{path}/fact-{part}")
        schema = fact.schema
        fact.write.option("compression", "zstd").parquet(facts[-1])
        for name in sides:
            if name != "orders" or part + 1 == parts:
                clear_files(spark, f"{path}/{name}/_part={0 if name == 'orders' else part}", ".parquet")
        release_shuffles(spark)
    return spark.read.schema(schema).parquet(*facts)


def fact_text(fact: DataFrame) -> DataFrame:
    """The fact, or those columns of it that are there, as sent on: JSON text (null members are
    left out)."""
    members = [n for n in (*FACT_FIELDS, "_fact_type", "_join_ts") if n in fact.columns]
    return fact.select(
        F.to_json(F.struct(*members)).alias("value"),
        F.timestamp_millis("_join_ts").alias("arrival_ts"), F.col("id").alias("seq"))
