"""Inventory models: master, derived fields, history pipeline, primary and secondary locations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.dates import event_time
from ledgermill.functions.text import case_map, first_rule, flag_if, is_pending, norm_key, strip_pending
from ledgermill.operators import quality as q
from ledgermill.operators.aggregates import any_of, bucket_sums, listagg, rank_to_columns, summarise_log
from ledgermill.operators.dedup import dedup_by_priority, latest, prefer, qualify, ranked
from ledgermill.operators.filters import finished_goods
from ledgermill.operators.keys import trim_keys


def items(t) -> DataFrame:
    """One row per item, the newest version."""
    return latest(trim_keys(t.item_base, ["id_item"]), ["id_item"], ["rowid"])


def locations(t) -> DataFrame:
    return dedup_by_priority(trim_keys(t.item_location, ["id_item", "id_loc"]), ["id_item", "id_loc"], [])


def reorder_points(t) -> DataFrame:
    """Reorder parameters by item and home location; the plain location column is never filled."""
    rows = latest(trim_keys(t.reorder, ["id_item", "id_loc_home"]), ["id_item", "id_loc_home"], ["date_add", "rowid"])
    return rows.select("id_item", "id_loc_home", "level_rop", "qty_min_rop", "qty_mult_ord_rop", "qty_ord_econ", "lt_rop")


def shop_quantities(t) -> DataFrame:
    """Released and started quantity by item and location, pending work apart.

    A pending item's marker is stripped, so its quantity lands on the item itself.
    """
    live = t.shop_header.where(F.col("stat_rec_so").isin("R", "S"))
    keyed = live.withColumns(
        {"pending": is_pending("id_item_par"), "id_item": strip_pending("id_item_par"), "id_loc": F.trim("id_loc")}
    )
    released, pending = F.col("stat_rec_so") == "R", F.col("pending")
    return bucket_sums(
        keyed, ["id_item", "id_loc"], "qty_onord",
        {
            "qty_rel": released & ~pending, "qty_start": ~released & ~pending,
            "qty_rel_pnd": released & pending, "qty_start_pnd": ~released & pending,
        },
    )


def vendor_sources(t) -> DataFrame:
    """First and second vendor per item with their names, the primary one first.

    Names are looked up before the offers are ranked, so what is at item grain stays where it is.
    """
    names = dedup_by_priority(trim_keys(t.vendor_payto, ["id_vnd"]), ["id_vnd"], []).select(
        F.col("id_vnd").alias("vendor_id"), F.col("name_vnd").alias("vendor_name")
    )
    offers = trim_keys(t.item_vendor, ["id_item", "id_vnd_payto"]).select("id_item", F.col("id_vnd_payto").alias("vendor_id"), "flag_vnd_prim")
    top = qualify(offers, ["id_item"], [prefer(F.col("flag_vnd_prim") == "P"), "vendor_id"], 2)
    return rank_to_columns(
        top.join(names, "vendor_id", "left"), ["id_item"], [prefer(F.col("flag_vnd_prim") == "P"), "vendor_id"], ["vendor_id", "vendor_name"],
        ["primary", "secondary"],
    )


def build_inventory(
    t,
    location_names: Mapping[str, str] = fv.LOCATION_NAMES,
    plant_vendors: Mapping[str, str] = fv.PLANT_VENDORS,
) -> DataFrame:
    """Inventory master of finished goods: one row per item and location.

    What belongs to an item (the location that makes it, whether it is made at all, its vendors,
    the list of its other locations) is found first, with all its rows in one place;
    then the sums per location meet them.  An item has at most one row per location, so its
    rows are few.
    """
    of_item = Window.partitionBy("id_item")
    made = F.when(F.col("flag_source") == "M", F.struct(prefer(F.col("id_loc") == fv.HOME_LOCATION), "id_loc"))
    placed = locations(t).withColumn("primary_mfg_loc", F.min(made).over(of_item)["id_loc"])
    goods = finished_goods(placed, items(t), list(location_names), fv.FINISHED_GOODS_COST_CATEGORY, fv.PARENT_COMMODITY)
    maker = case_map("primary_mfg_loc", location_names)
    plant = case_map("primary_vendor_id", plant_vendors)
    sourced = goods.withColumn("made", F.max(F.col("flag_source") == "M").over(of_item)).join(vendor_sources(t), "id_item", "left")
    sourced = sourced.withColumn(
        "primary_source", F.coalesce(maker, plant, F.col("primary_vendor_name"), F.lit(fv.SOURCE_UNKNOWN))
    ).withColumn(
        "source_location_match_flag",
        flag_if(F.col("primary_source") == case_map("id_loc", location_names), "P", "S"),
    )
    others = F.array_sort(F.collect_list(F.when(F.col("source_location_match_flag") == "S", F.col("id_loc"))).over(of_item))
    listed = sourced.withColumn("others", others).withColumn(
        "secondary_location_list", F.when(F.size("others") > 0, F.array_join("others", ", "))
    )
    joined = listed.join(shop_quantities(t), ["id_item", "id_loc"], "left").join(
        reorder_points(t).withColumn("id_loc", F.col("id_loc_home")), ["id_item", "id_loc"], "left"
    )
    pending = (F.coalesce("qty_rel_pnd", F.lit(0)) > 0) | (F.coalesce("qty_start_pnd", F.lit(0)) > 0)
    counted = F.col("flag_stk").isin("S", "M") | (F.col("flag_source") == "P") | pending

    def when_counted(a: str, b: str):
        both = F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
        return F.when(counted, both).otherwise(0)

    derived = joined.withColumns(
        {
            "manufactured_in_house": flag_if(F.col("made")),
            "quantity_cut": when_counted("qty_start", "qty_start_pnd"),
            "quantity_released": when_counted("qty_rel", "qty_rel_pnd"),
            "sourcing_type": case_map("flag_source", fv.SOURCING, "Other"),
        }
    )
    return derived.select(
        F.col("id_item").alias("item_id_child_sku"),
        F.col("id_loc").alias("inventory_location_id"),
        "secondary_location_list", "sourcing_type", "primary_source", "manufactured_in_house",
        F.col("qty_onhd").alias("quantity_on_hand"),
        F.col("qty_alloc").alias("quantity_allocated"),
        F.col("qty_onord").alias("quantity_on_order"),
        F.col("bin_prim").alias("primary_bin"),
        F.col("flag_stk").alias("stock_flag"),
        F.col("flag_track_bin").alias("bin_tracking"),
        F.col("id_planner").alias("planned_classification"),
        "type_loc", "id_loc_home",
        F.col("level_rop").alias("reorder_point"),
        "qty_min_rop", "qty_mult_ord_rop", "qty_ord_econ", "lt_rop",
        "primary_vendor_id", "primary_vendor_name", "secondary_vendor_id", "secondary_vendor_name",
        "quantity_cut", "quantity_released", "source_location_match_flag",
    )


def in_transit(t) -> DataFrame:
    """On-hand quantity of the in-transit location per item."""
    moving = locations(t).where(F.col("id_loc") == fv.IN_TRANSIT_LOCATION)
    return moving.groupBy("id_item").agg(F.sum("qty_onhd").alias("quantity_in_transit"))


def primary_location_flag(df: DataFrame, made_at_home: DataFrame) -> DataFrame:
    """``Y`` where an item is made at home, or only elsewhere; purchased rows are never primary."""
    home = made_at_home.select("id_item").distinct().withColumn("home_made", F.lit(True))
    made, here = F.col("flag_source") == "M", F.trim("id_loc") == fv.HOME_LOCATION
    return (
        df.join(home, "id_item", "left")
        .withColumn("primary_location_flag", flag_if(made & (here | F.col("home_made").isNull())))
        .drop("home_made")
    )


def secondary_location_list(
    df: DataFrame, location_names: Mapping[str, str] = fv.LOCATION_NAMES
) -> DataFrame:
    """Match flag per row and the list of an item's other locations on each of its rows."""
    flagged = df.withColumn(
        "location_match_flag",
        flag_if(F.col("primary_source") == case_map(F.trim("id_loc"), location_names), "P", "S"),
    )
    lists = listagg(
        flagged.where(F.col("location_match_flag") == "S").select("id_item", F.trim("id_loc").alias("id_loc")).distinct(),
        ["id_item"], "id_loc", "secondary_location_list",
    )
    return flagged.join(lists, "id_item", "left")


def build_inventory_fields(t) -> DataFrame:
    """The eight derived inventory fields for every item and stocking location."""
    rows = locations(t).where(F.col("id_loc") != fv.IN_TRANSIT_LOCATION)
    made_at_home = rows.where((F.col("flag_source") == "M") & (F.col("id_loc") == fv.HOME_LOCATION))
    flagged = primary_location_flag(rows, made_at_home)
    joined = flagged.join(in_transit(t), "id_item", "left").join(shop_quantities(t), ["id_item", "id_loc"], "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("qty_rel", "qty_start", "qty_rel_pnd", "qty_start_pnd")}
    procured = (F.col("flag_source") == "P") | (zero["qty_rel_pnd"] > 0) | (zero["qty_start_pnd"] > 0)
    cut = F.col("flag_stk").isin("S", "M") | procured
    return joined.select(
        "id_item", "id_loc", "flag_source", "flag_stk",
        F.coalesce("quantity_in_transit", F.lit(0)).alias("quantity_in_transit"),
        "primary_location_flag",
        flag_if(procured).alias("procured_flag"),
        zero["qty_rel"].alias("released_quantity"),
        zero["qty_start"].alias("start_quantity"),
        zero["qty_rel_pnd"].alias("pending_release_quantity"),
        zero["qty_start_pnd"].alias("pending_start_quantity"),
        F.when(cut, zero["qty_start"] + zero["qty_start_pnd"]).otherwise(0).alias("cut_quantity"),
        "qty_onhd", "qty_alloc", "qty_onord", "qty_insp",
    )


def history_summary(t, asof: dt.date, days: int = 90) -> DataFrame:
    """The transaction log, replays removed, as one row per item and location."""
    log = trim_keys(t.inventory_history, ["id_item", "id_loc"])
    key = ["id_item", "id_loc", "date_chg_qty", "time_chg_qty", "seq_rec"]
    events = latest(log, key, ["rowversion"])
    return summarise_log(
        events.withColumn("changed_at", event_time("date_chg_qty", "time_chg_qty")),
        ["id_item", "id_loc"], ["changed_at", "seq_rec"], "date_chg_qty", "code_dtl", "flag_post_hist_im",
        "qty_onhd_chg", asof, days,
    )


def build_inventory_with_history(t, asof: dt.date) -> DataFrame:
    """Inventory pipeline with transaction history: scope, progressive joins, business rules."""
    goods = finished_goods(locations(t), items(t), list(fv.LOCATION_NAMES))
    joined = (
        goods.join(shop_quantities(t), ["id_item", "id_loc"], "left")
        .join(reorder_points(t).withColumn("id_loc", F.col("id_loc_home")), ["id_item", "id_loc"], "left")
        .join(history_summary(t, asof), ["id_item", "id_loc"], "left")
    )
    stocked = F.col("flag_stk").isin("S", "M")

    def when_stocked(a: str, b: str):
        both = F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
        return F.when(stocked, both).otherwise(0)

    return joined.select(
        F.col("id_item").alias("item_id_child_sku"),
        F.col("id_loc").alias("inventory_location_id"),
        case_map("id_loc", fv.LOCATION_NAMES).alias("location_name"),
        case_map("flag_source", fv.SOURCING, "Other").alias("sourcing_type"),
        F.coalesce("qty_onhd", F.lit(0)).alias("quantity_on_hand"),
        F.coalesce("qty_alloc", F.lit(0)).alias("quantity_allocated"),
        F.coalesce("qty_onord", F.lit(0)).alias("quantity_on_order"),
        F.col("flag_stk").alias("stock_flag"),
        F.col("level_rop").alias("reorder_point"), "lt_rop",
        when_stocked("qty_start", "qty_start_pnd").alias("quantity_cut"),
        when_stocked("qty_rel", "qty_rel_pnd").alias("quantity_released"),
        "last_change_date", "last_transaction_code", "last_post_status", "recent_change",
    )


def inventory_checks(t, out: DataFrame, asof: dt.date) -> DataFrame:
    """Quality summary of the pipeline with history; ``out`` is its stored result."""
    key = ["item_id_child_sku", "inventory_location_id"]
    goods = finished_goods(locations(t), items(t), list(fv.LOCATION_NAMES)).select("id_item", "id_loc")
    return q.run_checks(
        [
            q.check_null_keys(out, key, "INV-01", notes="keys filled"),
            q.check_duplicates(out, key, "INV-02", severity="WARN", notes="one row per item and location"),
            q.check_negative(out, ["quantity_on_hand", "quantity_on_order"], "INV-03", notes="negative quantities"),
            q.check_domain(out, "sourcing_type", list(fv.SOURCING.values()), "INV-04", notes="sourcing in scope"),
            q.check_row_stability(goods, out, "INV-05", notes="joins keep the grain"),
            q.check_coverage(goods, shop_quantities(t), ["id_item", "id_loc"], 30, "INV-06", notes="shop orders found"),
            q.check_coverage(
                goods, reorder_points(t).withColumnRenamed("id_loc_home", "id_loc"), ["id_item", "id_loc"], 50,
                "INV-07", notes="reorder points found",
            ),
            q.check_coverage(
                goods, history_summary(t, asof), ["id_item", "id_loc"], 70, "INV-08", notes="history found"
            ),
        ]
    )


def build_item_locations(t) -> DataFrame:
    """Primary location per item, manufacturing ones first, and the list of all others in rank order."""
    rows = t.item_location.where(F.col("id_item").isNotNull() & F.col("id_loc").isNotNull())
    source = F.upper(F.trim("flag_source"))
    per_location = rows.groupBy(F.trim("id_item").alias("id_item"), F.trim("id_loc").alias("id_loc")).agg(
        any_of(source == "M").alias("has_m"),
        any_of(source == "P").alias("has_p"),
        F.count(F.lit(1)).alias("row_count"),
    )
    order = [F.col("has_m").desc(), F.col("row_count").desc(), F.col("id_loc")]
    placed = ranked(per_location, ["id_item"], order, "place")
    first = placed.where(F.col("place") == 1).select("id_item", F.col("id_loc").alias("primary_location"))
    rest = listagg(placed.where(F.col("place") > 1), ["id_item"], "id_loc", "secondary_locations", ",", ["place"])
    return first.join(rest, "id_item", "left")
