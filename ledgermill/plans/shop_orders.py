"""Shop-order models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.text import describe, first_rule
from ledgermill.operators.dedup import dedup_by_priority, latest
from ledgermill.operators.joins import override
from ledgermill.operators.keys import trim_keys
from ledgermill.plans.inventory import items, locations, reorder_points

ORDER_KEY = ["id_so", "sufx_so"]


def headers(t) -> DataFrame:
    return dedup_by_priority(trim_keys(t.shop_header, ["id_loc", "id_so"]), ["id_loc", *ORDER_KEY], [])


def operations(t) -> DataFrame:
    return trim_keys(t.shop_operation, ["id_loc", "id_so"])


def operation_totals(t) -> DataFrame:
    return operations(t).groupBy("id_loc", *ORDER_KEY).agg(
        F.count(F.lit(1)).alias("oper_count"),
        F.sum("hr_labor_sf").alias("oper_labor_hrs_planned"),
        F.sum("hr_labor_actual_sf").alias("oper_labor_hrs_actual"),
        F.sum("hr_mach_sf").alias("oper_machine_hrs_planned"),
        F.min("date_start_oper").alias("oper_earliest_start_date"),
        F.max("date_due_oper").alias("oper_latest_due_date"),
    )


def material_totals(t) -> DataFrame:
    return trim_keys(t.shop_material, ["id_loc", "id_so"]).groupBy("id_loc", *ORDER_KEY).agg(
        F.count(F.lit(1)).alias("matl_line_count"),
        F.sum("qty_per").alias("matl_total_qty_per"),
        F.sum("qty_alloc").alias("matl_total_qty_allocated"),
        F.sum("qty_iss").alias("matl_total_qty_issued"),
    )


def build_shop_orders(t) -> DataFrame:
    """Shop-order master: one row per header with operation and material totals."""
    return (
        headers(t)
        .withColumns(
            {
                "so_item_description": describe("descr_item_1", "descr_item_2"),
                "qty_remaining": F.col("qty_ord") - F.col("qty_cmpl"),
            }
        )
        .drop("descr_item_1", "descr_item_2", "qty_onord", "date_start_oper_1st")
        .withColumnsRenamed(
            {
                "date_add": "so_date_created", "date_start_ord": "so_date_start_ordered",
                "date_due_ord": "so_date_due_ordered", "date_cmpl": "so_date_completed",
                "date_chg_last": "so_date_last_changed",
            }
        )
        .join(operation_totals(t), ["id_loc", *ORDER_KEY], "left")
        .join(material_totals(t), ["id_loc", *ORDER_KEY], "left")
    )


def first_approvals(t) -> DataFrame:
    return trim_keys(t.shop_approval, ["id_so"]).groupBy(*ORDER_KEY).agg(
        F.min("date_approved").alias("date_approved"), F.min("time_approved").alias("time_approved")
    )


def on_floor(t) -> DataFrame:
    return trim_keys(t.job_card, ["id_so"]).select(*ORDER_KEY).distinct().withColumn("on_floor", F.lit("Y"))


def routings(t) -> DataFrame:
    return dedup_by_priority(trim_keys(t.routing_operation, ["id_item"]), ["id_item", "id_oper"], []).select(
        F.col("id_item").alias("id_item_par"), "id_oper", "id_rte", F.col("id_wc").alias("rto_wc"), "hr_mach_sr"
    )


def _in_scope(since: dt.date) -> Column:
    return (
        F.col("stat_rec_so").isin(*fv.SHOP_ORDER_STATUSES)
        & ~F.col("id_so").like("PROD%")
        & ~F.col("id_so").like("SAMPLE%")
        & (F.col("date_add") >= F.lit(since))
    )


def _work(t, since: dt.date) -> DataFrame:
    """Header fields on every live operation, the routing's work centre winning over the operation's own.

    Headers are filtered before the join, which changes the grain to the
    operation.  The order is matched by its id and suffix as two columns.
    """
    oper = operations(t).where(F.col("stat_rec_oper").isin(*fv.OPERATION_STATUSES)).select(
        *ORDER_KEY, "id_oper", F.col("id_wc").alias("oper_wc"), "stat_rec_oper", "hr_labor_sf",
        F.col("qty_cmpl").alias("o_qty_cmpl"), F.col("qty_ord").alias("o_qty_ord"),
    )
    # all that belongs to the order is joined before the rows move on by item
    joined = (
        headers(t).where(_in_scope(since)).join(oper, ORDER_KEY)
        .join(first_approvals(t), ORDER_KEY, "left")
        .join(on_floor(t), ORDER_KEY, "left")
        .join(routings(t), ["id_item_par", "id_oper"], "left")
    )
    routed = joined.where(F.col("id_rte").isNull() | (F.col("id_rte") == fv.STANDARD_ROUTE))
    return override(
        routed, "rto_wc", {"work_center": ("rto_wc", "oper_wc"), "mach_sr_labor_sf": ("hr_mach_sr", "hr_labor_sf")}
    ).withColumn("qty_remaining", F.col("qty_ord") - F.col("qty_cmpl"))


def build_work_centers(t) -> DataFrame:
    """Minutes per work centre and location with staffing."""
    staff = dedup_by_priority(
        trim_keys(t.work_center_staff.withColumnRenamed("employee_location", "work_center_location"), ["work_center", "work_center_location"]),
        ["work_center", "work_center_location"], [],
    )
    return trim_keys(t.work_center_minutes, ["work_center", "work_center_location"]).join(staff, ["work_center", "work_center_location"], "left")


def build_shop_work(t, since: dt.date = dt.date(2020, 1, 1)) -> DataFrame:
    """Shop-order work centres: one row per operation with order totals, approvals and efficiency."""
    efficiency = build_work_centers(t).select(
        F.trim("work_center").alias("__wc"), F.trim("work_center_location").alias("__loc"),
        "sum_actual_mins", "sum_earned_mins", "sum_avail_mins", "first_shift_ft", "second_shift_ft",
    )
    rows = _work(t, since).where(~F.trim("work_center").isin(*fv.OVERHEAD_WORK_CENTERS))
    return (
        rows.join(operation_totals(t), ["id_loc", *ORDER_KEY], "left")
        .join(material_totals(t), ["id_loc", *ORDER_KEY], "left")
        .withColumns({"__wc": F.trim("work_center"), "__loc": F.trim("id_loc")})
        .join(efficiency, ["__wc", "__loc"], "left")
        .select(
            "id_loc", *ORDER_KEY, "id_item_par", "id_oper", "work_center", "oper_wc", "rto_wc", "id_rte",
            "mach_sr_labor_sf", "stat_rec_oper", "o_qty_cmpl", "o_qty_ord", "stat_rec_so", "qty_ord", "qty_cmpl",
            "qty_remaining", "date_add", "date_due_ord", "date_cmpl", "date_approved", "time_approved", "on_floor",
            "id_buyer", "code_cat_cost", "descr_item_1", "descr_item_2", "oper_count", "oper_labor_hrs_planned",
            "matl_line_count", "matl_total_qty_issued", "sum_actual_mins", "sum_earned_mins", "sum_avail_mins",
            "first_shift_ft", "second_shift_ft",
        )
    )


def build_shop_order_info(t, since: dt.date = dt.date(2020, 1, 1)) -> DataFrame:
    """Operation view with inventory, item and stock-list fields of the parent item."""
    place = locations(t).select(
        F.col("id_item").alias("id_item_par"), "id_loc", "flag_stk", "flag_source", "id_planner"
    )
    material = items(t).select(F.col("id_item").alias("id_item_par"), F.col("code_user_1_im").alias("material_code"))
    listed = trim_keys(t.stock_list, ["id_item"]).select(F.col("id_item").alias("id_item_par")).distinct().withColumn(
        "stklist_item", F.col("id_item_par")
    )
    level = reorder_points(t).select(
        F.col("id_item").alias("id_item_par"), F.col("id_loc_home").alias("id_loc"), "level_rop"
    )
    return (
        _work(t, since)
        .join(place, ["id_item_par", "id_loc"], "left")
        .join(material, "id_item_par", "left")
        .join(listed, "id_item_par", "left")
        .join(level, ["id_item_par", "id_loc"], "left")
        .select(
            "id_loc", *ORDER_KEY, F.concat("id_so", "sufx_so").alias("so_and_suffix"), "id_item_par", "id_oper",
            "work_center", "mach_sr_labor_sf", "stat_rec_so", "stat_rec_oper", "date_add", "date_due_ord",
            "date_start_oper_1st", "date_approved", "time_approved", "flag_stk", "flag_source", "material_code",
            "id_planner", "stklist_item", "level_rop", "on_floor",
        )
    )


def build_shop_orders_by_work_center(t, since: dt.date = dt.date(2020, 1, 1)) -> DataFrame:
    """The operation view with work-centre efficiency, overhead centres left out."""
    efficiency = build_work_centers(t).select(
        F.trim("work_center").alias("work_center"), F.trim("work_center_location").alias("id_loc"),
        "sum_actual_mins", "sum_earned_mins", "first_shift_ft",
    )
    info = build_shop_order_info(t, since).withColumn("work_center", F.trim("work_center"))
    return info.where(~F.col("work_center").isin(*fv.OVERHEAD_WORK_CENTERS)).join(
        efficiency, ["work_center", "id_loc"], "left"
    )


def display_status(
    header: Column, started: Column, presew: Column, final: Column, planner: Column | None,
    missing_final_is_open: bool = True,
) -> Column:
    """Display status: R released, S cut, W pre-sew complete, D done.

    W is not stored anywhere; pre-sew steps are not sequential, so a checkpoint
    operation closes them.  A missing final operation counts as not ready,
    except in the cached report, where it leaves the rule undecided.  Without
    planner the reduced rule applies.
    """
    not_ready = (F.coalesce(final, F.lit("")) if missing_final_is_open else final) != "R"
    done = final == "R"
    if planner is not None:
        done = done & (planner != "KT")
    return first_rule(
        [
            ((header == "S") & started.isNull(), "R"),
            ((presew == "C") & not_ready, "W"),
            (presew.isNull() & (header == "S") & not_ready, "W"),
            (done, "D"),
        ],
        header,
    )


def build_display_status(t, with_planner: bool = True) -> DataFrame:
    """Display status per shop order with the on-order quantity in buckets, reconciled."""
    def status_of(oper: int, name: str) -> DataFrame:
        rows = operations(t).where(F.col("id_oper") == oper)
        return dedup_by_priority(rows, ORDER_KEY, []).select(*ORDER_KEY, F.col("stat_rec_oper").alias(name))

    place = locations(t).select(F.col("id_item").alias("id_item_par"), "id_loc", "id_planner")
    joined = (
        headers(t)
        .join(status_of(fv.PRESEW_OPERATION, "presew_status"), ORDER_KEY, "left")
        .join(status_of(fv.FINAL_OPERATION, "final_status"), ORDER_KEY, "left")
        .join(place, ["id_item_par", "id_loc"], "left")
    )
    shown = joined.withColumn(
        "stat_rec_so_display",
        display_status(
            F.col("stat_rec_so"), F.col("date_start_oper_1st"), F.col("presew_status"), F.col("final_status"),
            F.col("id_planner") if with_planner else None,
        ),
    )

    def bucket(*codes: str) -> Column:
        return F.when(F.col("stat_rec_so_display").isin(*codes), F.col("qty_onord")).otherwise(0)

    buckets = shown.withColumns({"qty_released": bucket("R"), "qty_cut": bucket("S"), "qty_presew": bucket("W", "D")})
    total = F.col("qty_released") + F.col("qty_cut") + F.col("qty_presew")
    return buckets.select(
        "id_loc", *ORDER_KEY, "id_item_par", "stat_rec_so", "date_start_oper_1st", "presew_status", "final_status",
        "stat_rec_so_display", "qty_onord", "qty_released", "qty_cut", "qty_presew",
        total.alias("qty_bucket_total"),
        F.when(total == F.coalesce("qty_onord", F.lit(0)), "Y").otherwise("N").alias("qty_bucket_recon_flag"),
    )
