"""Vendor models: item-vendor roll-up, open purchase orders, vendor price list."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.amounts import decode_vendor_price
from ledgermill.functions.text import case_map, first_rule
from ledgermill.operators.aggregates import any_of, text_list
from ledgermill.operators.dedup import dedup_by_priority, latest, one_per
from ledgermill.operators.joins import alternative_detail
from ledgermill.operators.keys import trim_keys
from ledgermill.plans.inventory import items


def build_item_vendors(t) -> DataFrame:
    """One row per active finished good: primary vendor, list of the others, set-up problems by label."""
    wanted = items(t).where(
        (F.col("flag_stat_item") == "A") & (F.col("code_cat_cost") == fv.FINISHED_GOODS_COST_CATEGORY)
    )
    offers = trim_keys(t.item_vendor, ["id_item", "id_vnd_ordfm"]).select("id_item", "flag_vnd_prim", "id_vnd_ordfm")
    master = dedup_by_priority(
        trim_keys(t.vendor_orderfrom, ["id_vnd", "id_vnd_ordfm"]), ["id_vnd_ordfm"], []
    )
    # the master is met first, so that the rows of an item are together for the join and the only grouping
    named = offers.join(master, "id_vnd_ordfm", "left")
    rows = wanted.select("id_item").join(named, "id_item", "left")
    is_primary, is_other = F.col("flag_vnd_prim") == "P", F.col("flag_vnd_prim") == "S"
    unknown = F.col("id_vnd_ordfm").isNotNull() & F.col("id_vnd").isNull()
    unnamed = F.col("id_vnd").isNotNull() & (F.trim(F.coalesce("name_vnd", F.lit(""))) == "")
    label = first_rule([(unknown, fv.VENDOR_UNKNOWN), (unnamed, fv.VENDOR_UNNAMED)], F.col("name_vnd"))
    summary = rows.withColumn("label", label).groupBy("id_item").agg(
        any_of(F.col("flag_vnd_prim").isNotNull()).alias("listed"),
        any_of(is_primary).alias("has_primary"),
        any_of(is_other).alias("has_secondary"),
        any_of(is_primary & unknown).alias("primary_unknown"),
        any_of(is_primary & unnamed).alias("primary_unnamed"),
        F.max(F.when(is_primary, F.col("id_vnd"))).alias("primary_vendor_id"),
        F.max(F.when(is_primary, F.col("name_vnd"))).alias("primary_name"),
        text_list("id_vnd", condition=is_other).alias("secondary_vendor_ids"),
        text_list("label", ", ", ["id_vnd_ordfm"], is_other).alias("secondary_names"),
    )
    return summary.select(
        "id_item",
        "primary_vendor_id",
        first_rule(
            [
                (F.col("listed") == 0, fv.VENDOR_NOT_LISTED),
                (F.col("has_primary") == 0, fv.NO_PRIMARY_VENDOR),
                (F.col("primary_unknown") == 1, fv.VENDOR_UNKNOWN),
                (F.col("primary_unnamed") == 1, fv.VENDOR_UNNAMED),
            ],
            F.col("primary_name"),
        ).alias("primary_vendor_name"),
        "secondary_vendor_ids",
        F.when(F.col("has_secondary") == 0, fv.NO_SECONDARY_VENDOR)
        .otherwise(F.col("secondary_names")).alias("secondary_vendor_names"),
    )


def build_open_purchase_orders(t, location_names: Mapping[str, str] | None = None) -> DataFrame:
    """Open purchase lines.  Orders without item lines show their outside-process lines."""
    keys = ["id_po", "id_rel_ord"]
    item = t.purchase_item_line
    process = t.purchase_process_line.withColumnsRenamed({"id_item_outp": "id_item", "code_proc_op": "id_item_vnd"})
    lines = alternative_detail(item, process, keys)
    open_lines = lines.where((F.col("flag_stat_line_po") != "C") & (F.col("qty_rcv") < F.col("qty_ord")))
    header = t.purchase_header.where(~F.col("flag_stat_po").isin("C", "X"))
    places = one_per(t.location, "id_loc").select(F.col("id_loc").alias("id_loc_shipto"), F.col("descr").alias("table_name"))
    named = F.coalesce(case_map("id_loc_shipto", location_names or {}, F.lit(None).cast("string")), F.col("table_name"))
    return (
        open_lines.join(header, keys)
        .join(places, "id_loc_shipto", "left")
        .join(one_per(t.buyer, "id_buyer").withColumnRenamed("descr", "name_buyer"), "id_buyer", "left")
        .select(
            "id_po", "id_line_po", "id_vnd_payto", "id_loc_shipto",
            named.alias("loc_description"),
            first_rule(
                [(F.trim("type_po") == "", "BLANKET"), (F.col("type_rec") == 1, "NORMAL"), (F.col("type_rec") == 3, "OUTP")],
                "",
            ).alias("po_type"),
            "id_item", "id_item_vnd", "date_prom", "qty_ord", "qty_rcv",
            (F.col("qty_ord") - F.col("qty_rcv")).alias("qty_due"),
            "date_po", "cost_expect", "id_buyer", "name_buyer",
        )
    )


def build_vendor_prices(t) -> DataFrame:
    """Price list: active items of every vendor with the decoded price."""
    active = items(t).where(F.col("flag_stat_item") == "A").select(
        "id_item", F.concat(F.coalesce("descr_1", F.lit("")), F.coalesce("descr_2", F.lit(""))).alias("descr")
    )
    names = dedup_by_priority(trim_keys(t.vendor_payto, ["id_vnd"]), ["id_vnd"], [])
    offers = trim_keys(t.item_vendor, ["id_item", "id_vnd_payto"]).withColumnRenamed("id_vnd_payto", "id_vnd")
    return offers.join(names, "id_vnd").join(active, "id_item").select(
        "id_vnd", "name_vnd", "flag_vnd_prim", "id_item", "id_item_vnd", "descr",
        decode_vendor_price("price_vnd_fc_1").alias("cost"),
    )
