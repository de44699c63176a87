"""The cached open-orders report: bill-of-material aware, stored once, read back with fresh comments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.text import case_map, first_rule, flag_if, material_flag, strip_pending
from ledgermill.operators.dedup import dedup_by_priority
from ledgermill.operators.filters import effective, still_open
from ledgermill.operators.joins import spread_null
from ledgermill.operators.keys import trim_keys
from ledgermill.operators.workdays import add_workdays
from ledgermill.plans.inventory import items, locations, reorder_points, shop_quantities
from ledgermill.plans.orders import order_comments
from ledgermill.plans.shop_orders import display_status, headers, operations

END_OF_TIME = dt.date(9999, 12, 31)


def component_matches(t, lines: DataFrame, asof: dt.date, patterns: Sequence[str]) -> DataFrame:
    """Lines of non-stock items with their finished-good components.

    The parent is the join key; which components count is a residual condition
    of the same join: the item itself without its variant mark, a name pattern, or
    an altered-stock job.
    """
    finished = items(t).where(F.col("code_comm") == "FG").select(F.col("id_item").alias("id_item_comp"))
    edges = effective(
        trim_keys(t.product_structure, ["id_item_par", "id_item_comp"]), "date_eff_start", "date_eff_end", asof
    ).join(finished, "id_item_comp", "left_semi")
    bom = edges.select(F.col("id_item_par").alias("__par"), "id_item_comp").distinct()
    wanted = (F.col("id_item_comp") == F.replace("id_item", F.lit("*"), F.lit(""))) | (F.col("so_buyer") == "AS")
    for pattern in patterns:
        wanted = wanted | F.col("id_item_comp").like(pattern)
    # the item itself is the key, so that later joins find the rows by item; lines of stock items pass unmatched
    found = (F.col("id_item") == F.col("__par")) & (F.col("flag_stk") == "N") & wanted
    return lines.join(bom, found, "left").drop("__par")


def kit_status(t) -> DataFrame:
    """Per kit ``STOCK`` where all of its open-ended components are stock at home, else ``MTO``."""
    planned = locations(t).where(F.col("id_planner").isin("1A", "AS", "KT")).select(
        F.col("id_item").alias("id_item_par")
    ).distinct()
    edges = trim_keys(t.product_structure, ["id_item_par", "id_item_comp"]).where(
        F.col("date_eff_end") == F.lit(END_OF_TIME)
    ).join(planned, "id_item_par", "left_semi")
    home = locations(t).where(F.col("id_loc") == fv.HOME_LOCATION).select(
        F.col("id_item").alias("id_item_comp"), F.col("flag_stk").alias("comp_stk")
    )
    level = reorder_points(t).where(F.col("id_loc_home") == fv.HOME_LOCATION).select(
        F.col("id_item").alias("id_item_comp"), F.col("level_rop").alias("comp_level")
    )
    state = flag_if((F.col("comp_stk") == "S") & (F.col("comp_level") > 1), "STOCK", "MTO")
    return (
        edges.join(home, "id_item_comp", "left")
        .join(level, "id_item_comp", "left")
        .groupBy(F.col("id_item_par").alias("id_item"))
        .agg(F.min(state).alias("kit_stock"))
    )


def build_cached_report(t, cal: DataFrame, asof: dt.date, patterns: Sequence[str] = ()) -> DataFrame:
    """Open order lines by component with calculated dates, stock status and shop quantities."""
    header = dedup_by_priority(trim_keys(t.order_header, ["id_cust_soldto"]), ["id_ord"], [F.col("date_ord").desc()]).select(
        "id_ord", "id_cust_soldto", "date_ord", "amt_ord_total", "flag_ackn", "code_stat_ord"
    )
    jobs = dedup_by_priority(headers(t).where(F.col("sufx_so") == 0), ["id_so"], []).select(
        "id_so", "stat_rec_so", F.col("id_buyer").alias("so_buyer"), "date_start_oper_1st"
    )
    shipped = trim_keys(t.shipment_line, ["id_loc"]).groupBy("id_ord", "seq_line_ord", "id_loc").agg(
        F.max("id_ship").alias("id_ship"), F.sum("qty_ship").alias("line_shipped"), F.max("qty_open").alias("ship_open")
    )
    lines = trim_keys(t.order_line, ["id_item", "id_loc", "id_so"]).select(
        "id_ord", "seq_line_ord", "id_item", "id_loc", "qty_open", "date_rqst", "date_prom", "date_add", "flag_stk",
        "flag_pick", "id_so", "price_net",
    )
    def status_of(oper: int, name: str) -> DataFrame:
        found = operations(t).where((F.col("id_oper") == oper) & (F.col("sufx_so") == 0))
        return dedup_by_priority(found, ["id_so"], []).select(
            F.col("id_so").alias("__so"), F.col("stat_rec_oper").alias(name)
        )

    # the rows move by order, shop order, item and stocked item in turn
    open_lines = (
        lines.join(header, "id_ord")
        .where(F.col("date_ord").isNotNull())
        .join(shipped, ["id_ord", "seq_line_ord", "id_loc"], "left")
        .where(still_open("id_ship", "line_shipped", "ship_open"))
        .join(order_comments(t).select("id_ord", material_flag("comment").alias("flag_mo")), "id_ord", "left")
        .withColumn("__so", spread_null("id_so", "id_ord", "seq_line_ord"))
        .join(jobs.withColumnRenamed("id_so", "__so").where(F.col("__so") != ""), "__so", "left")
        .join(status_of(fv.PRESEW_OPERATION, "presew_status"), "__so", "left")
        .join(status_of(fv.FINAL_OPERATION, "final_status"), "__so", "left")
        .drop("__so")
    )
    rows = component_matches(t, open_lines, asof, patterns).withColumn("stocked", F.coalesce("id_item_comp", "id_item"))

    place = locations(t)
    stock = place.select(
        F.col("id_item").alias("stocked"), "id_loc", "qty_onhd", "qty_alloc", "qty_onord", "bin_prim",
        F.col("flag_stk").alias("il_flag_stk"),
    )
    parent = place.select("id_item", "id_loc", F.col("id_planner").alias("planner"), F.col("flag_source").alias("par_source"))
    level = reorder_points(t).select(F.col("id_item").alias("stocked"), F.col("id_loc_home").alias("id_loc"), "level_rop")
    base = items(t).select("id_item", "code_comm", "code_cat_prdt", "flag_stat_item")
    quantities = shop_quantities(t).withColumnRenamed("id_item", "stocked")
    not_billed = t.shipment_line.where(F.col("flag_confirm_ship") != 1).groupBy(
        F.trim("id_item").alias("stocked"), F.trim("id_loc").alias("id_loc")
    ).agg(F.sum("qty_ship").alias("sbnb"))
    moving = place.where((F.col("id_loc") == fv.IN_TRANSIT_LOCATION) & (F.col("qty_onhd") != 0)).select(
        "id_item", F.col("qty_onhd").alias("moving")
    )

    joined = (
        rows.join(base, "id_item", "left")
        .join(moving, "id_item", "left")
        .join(kit_status(t), "id_item", "left")
        .join(parent, ["id_item", "id_loc"], "left")
        .join(stock, ["stocked", "id_loc"], "left")
        .join(level, ["stocked", "id_loc"], "left")
        .join(quantities, ["stocked", "id_loc"], "left")
        .join(not_billed, ["stocked", "id_loc"], "left")
    )
    dated = add_workdays(
        joined, {"order_3": ("date_ord", 3), "added_1": ("date_add", 1), "promised_10": ("date_prom", 10)}, cal
    )
    c, zero = F.col, F.lit(0)
    as_requested = c("date_rqst") == c("date_prom")
    final_promise = c("id_cust_soldto") == fv.PROMISE_IS_FINAL_CUSTOMER
    soon = ((c("flag_stk") == "S") | c("planner").isin(*fv.ALTERED_STOCK_PLANNERS)) & (c("order_3") >= c("date_prom"))
    rop, sbnb = F.coalesce("level_rop", zero), F.coalesce("sbnb", zero)
    pending = (F.coalesce("qty_rel_pnd", zero) > 0) | (F.coalesce("qty_start_pnd", zero) > 0)
    kept = c("qty_onhd").isNotNull() & (c("level_rop") > 1)
    return dated.select(
        "id_ord", "seq_line_ord", "id_item", "id_item_comp", "id_loc", "id_cust_soldto", "amt_ord_total", "price_net",
        "date_rqst", "date_prom", "date_ord",
        first_rule(
            [(as_requested, c("date_rqst")), (final_promise, c("date_prom")), (soon, c("added_1"))], c("date_prom")
        ).alias("date_calc_start"),
        first_rule(
            [(as_requested, c("date_rqst")), (final_promise, c("promised_10")), (soon, c("date_prom"))],
            c("promised_10"),
        ).alias("date_calc_end"),
        flag_if((c("id_item_comp").isNotNull() & (c("flag_stk") == "N")) | (c("par_source") == "P") | pending).alias("flag_show"),
        first_rule([(c("so_buyer").isin("AS", "1A") & kept, "AS"), ((c("so_buyer") == "KT") & kept, "KT")], "").alias("alt_stk"),
        F.coalesce("flag_mo", F.lit("N")).alias("flag_mo"),
        case_map("code_cat_prdt", fv.REPORT_VERTICALS, fv.DEFAULT_VERTICAL).alias("vertical"),
        first_rule(
            [
                (c("code_comm").like("RM%") | (c("code_comm") == "FAB") | (c("code_comm") == "DF"), "3-FABRIC"),
                (((c("il_flag_stk") == "S") & (c("level_rop") > 1)) | (c("kit_stock") == "STOCK"), "1-STOCK"),
            ],
            "2-MTO",
        ).alias("stock_status"),
        (c("qty_open") - F.coalesce("line_shipped", zero)).alias("qty_open"),
        F.when((c("flag_stk") == "S") & (rop == 1), "M").otherwise(c("flag_stk")).alias("flag_stk"),
        F.coalesce("qty_rel", zero).alias("qty_rel"), F.coalesce("qty_start", zero).alias("qty_started"),
        F.coalesce("qty_rel_pnd", zero).alias("qty_rel_pnd"), F.coalesce("qty_start_pnd", zero).alias("qty_start_pnd"),
        (F.coalesce("qty_onhd", zero) - sbnb).alias("qty_onhd"),
        (F.coalesce("qty_alloc", zero) - sbnb).alias("qty_alloc"),
        (F.coalesce("qty_onord", zero) + F.coalesce("moving", zero)).alias("qty_onord"),
        sbnb.alias("sbnb"), "bin_prim", rop.alias("level_rop"), "stat_rec_so",
        display_status(
            c("stat_rec_so"), c("date_start_oper_1st"), c("presew_status"), c("final_status"), c("planner"),
            missing_final_is_open=False,
        ).alias("stat_rec_so_display"),
        "id_ship", "code_stat_ord",
    )


def with_comments(t, cached: DataFrame) -> DataFrame:
    """The stored report with comments as they are now."""
    fresh = order_comments(t).select("id_ord", "comment", "date_est_ship")
    return cached.where(F.col("date_ord").isNotNull()).join(fresh, "id_ord", "left")
