"""Registered queries: every operator and model over the given tables.

Each entry takes a session and the folder of the tables and returns a
DataFrame.  ``plain`` turns decimals into doubles and dates into ISO text, so
results compare across engines.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.amounts import decode_vendor_price, decode_vp, decode_vp_tail, extend
from ledgermill.functions.dates import compact, date_dimensions, event_time, fiscal_label, or_no_date
from ledgermill.functions.text import (
    blank_to_null, canonical, case_map, composite_id, describe, first_column, first_rule, flag_if, is_pending,
    material_flag, norm_key, ship_complete_flag, strip_pending,
)
from ledgermill.operators import quality as q
from ledgermill.operators.aggregates import (
    all_of, any_of, bucket_sums, listagg, most_frequent, pivot_attrs, rank_to_columns, share_of_total, split_sums,
    summarise_log,
)
from ledgermill.operators.dedup import dedup_by_priority, latest, prefer, qualify, without_replays
from ledgermill.operators.filters import (
    apply_params, between_dates, code_range, effective, lookback, not_deleted, still_open, unexpired,
)
from ledgermill.operators.joins import (
    best_match, enrich, exists_flag, full_reconcile, header_line, interval_join, join_norm, left_latest,
    lookup_default, orphans, override, pick_one, salted_join, semi,
)
from ledgermill.operators.keys import rename_by_table, select_except, trim_keys
from ledgermill.operators.profile import profile, sample_values
from ledgermill.operators.ranking import first_values, frequency, sample_failures, sorted_output, topk_values
from ledgermill.operators.reconcile import (
    cell_diff, diff_summary, duplicates, filter_funnel, overlap_audit, reconcile, run_log,
)
from ledgermill.operators.workdays import add_workdays, lead_time_range, sla_flags, workdays_between
from ledgermill.plans import (
    bookings, cached_report, customers, flagship, gold_items, inventory, open_orders, orders, products, sales,
    shipments, shop_orders, vendors,
)
from ledgermill.session import configure, own_folders, shared_folder
from ledgermill.sources.calendar import calendar, us_holidays
from ledgermill.sources.erp import Captures, stored_once
from ledgermill.sources.tables import (
    conform, inline_lookup, load_path, read_mapping, sample, stamp, tagged_union, union_all, write_table,
)
from ledgermill.streaming.latest import maintain_latest, read_snapshot
from ledgermill.streaming.tiers import DAILY, FREQUENT, Source, ingest_tier

Query = Callable[[SparkSession, str], DataFrame]

ASOF = dt.date(2001, 8, 1)
#: Days that the calendar goes beyond the first and the last date of the tables: derived dates
#: (requests, promises, closings) and added working days lie within.
CALENDAR_MARGIN = 1500
SINCE = dt.date(1996, 1, 1)

REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Portable types: decimal to double, date and timestamp to text."""
    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*(cast(f) for f in df.schema.fields))


def query(build: Callable[[SparkSession, Captures], DataFrame]) -> Callable:
    """Register a query under the name of its function."""
    @functools.wraps(build)
    def run(spark: SparkSession, directory: str) -> DataFrame:
        configure(spark)
        return plain(build(spark, Captures(spark, directory)))

    REGISTRY[build.__name__] = run
    return run


def work_calendar(spark: SparkSession, t: Captures) -> DataFrame:
    """A calendar over all dates of orders and lines, with a margin for dates derived from them."""
    ordered = t.orders.select(day("o_orderdate").alias("d"))
    shipped = t.lineitem.select(day("l_shipdate").alias("d"))
    low, high = ordered.union(shipped).agg(F.min("d"), F.max("d")).head()
    margin = dt.timedelta(days=CALENDAR_MARGIN)
    low, high = (low or ASOF) - margin, (high or ASOF) + margin
    return calendar(spark, low, high, us_holidays(low.year, high.year))


def day(column: str):
    return F.col(column).cast("date")


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


# --- flagship -------------------------------------------------------------------------------

@query
def ship_lead_times(spark, t):
    return flagship.ship_lead_times(t.orders, t.lineitem, work_calendar(spark, t))


# --- sources and sinks ----------------------------------------------------------------------

@query
def tagged_union_orders(spark, t):
    active = t.orders.where(F.col("o_orderstatus") != "F")
    archived = t.orders.where(F.col("o_orderstatus") == "F")
    both = tagged_union({"ACTIVE": active, "PERM": archived})
    return both.groupBy("source_table", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("amount")
    )


@query
def inline_lookup_status(spark, t):
    names = inline_lookup(spark, [("O", "open"), ("F", "closed")], "o_orderstatus string, status_name string")
    return t.orders.join(names, "o_orderstatus", "left").groupBy("o_orderstatus", "status_name").agg(
        F.count(F.lit(1)).alias("orders")
    )


@query
def calendar_orders(spark, t):
    dated = t.orders.withColumn("calendar_date", day("o_orderdate")).join(
        F.broadcast(work_calendar(spark, t)), "calendar_date", "left"
    )
    return dated.groupBy(
        "year", "month", "month_name", "day_of_week", "day_of_week_name", "season", "season_year",
        F.when(F.col("is_weekday").isNotNull(), flag_if(F.col("is_weekday"))).alias("weekday"), "holiday_name",
    ).agg(F.count(F.lit(1)).alias("orders"))


@query
def renamed_orders(spark, t):
    mapping = read_mapping(spark, str(Path(__file__).with_name("column_renames.csv")))
    return rename_by_table(t.orders, mapping)


@query
def conformed_orders(spark, t):
    schema = "o_orderkey bigint, o_totalprice decimal(18,2), o_orderdate date, o_orderstatus string"
    return conform(t.orders, schema)


@query
def sampled_orders(spark, t):
    return sample(t.orders, 10, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query
def written_orders(spark, t):
    path = shared_folder(spark, "written-orders")
    write_table(t.orders, path, ["o_orderstatus"])
    back = spark.read.schema(t.orders.schema).parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


# --- projections and filters ----------------------------------------------------------------

@query
def key_normalisation(spark, t):
    return t.order_header.select(
        "id_ord",
        norm_key("id_cust_soldto").alias("sold_to"),
        norm_key("id_cust_billto").alias("bill_to"),
        norm_key(F.when(F.col("type_ord_cp") > 2, F.col("id_user_add"))).alias("user_key"),
        composite_id(F.trim("id_cust_soldto"), "seq_shipto").alias("ship_to_id"),
        blank_to_null("id_user_add").alias("user_add"),
    )


@query
def text_rules(spark, t):
    lines = t.line_comment.select("id_ord", "seq_line_ord", "note", "rowid")
    return lines.select(
        "id_ord", "seq_line_ord", "rowid",
        ship_complete_flag("note").alias("ship_complete"),
        F.upper("note").alias("shouted"),
        F.length("note").alias("note_length"),
        F.replace("note", F.lit("COMPLETE"), F.lit("DONE")).alias("replaced"),
        F.split_part("note", F.lit(" "), F.lit(2)).alias("second_word"),
        F.right("note", F.lit(5)).alias("tail"),
        F.substring("note", 1, 4).alias("head"),
        F.ltrim(F.concat(F.lit("  "), "note")).alias("left_trimmed"),
        F.rtrim(F.concat("note", F.lit("  "))).alias("right_trimmed"),
    )


@query
def live_comments(spark, t):
    live = not_deleted(t.order_comment)
    return live.select("id_ord", "rowid", material_flag("comment").alias("flag_mo"), "flag_del")


@query
def pending_items(spark, t):
    return t.shop_header.select(
        "id_so", "sufx_so", "id_item_par", flag_if(is_pending("id_item_par")).alias("pending"),
        strip_pending("id_item_par").alias("item"), describe("descr_item_1", "descr_item_2").alias("description"),
        F.lit("SHOP").alias("source_tag"), F.lit(1).alias("counter"),
    )


@query
def date_filters(spark, t):
    o = t.orders.withColumn("d", day("o_orderdate"))
    window = between_dates(o, "d", dt.date(1997, 3, 1), dt.date(1997, 4, 1)).select("o_orderkey", F.lit("window").alias("rule"))
    months = lookback(o, "d", 12, "month", ASOF).select("o_orderkey", F.lit("12 months").alias("rule"))
    days = lookback(o, "d", 90, "day", ASOF).select("o_orderkey", F.lit("90 days").alias("rule"))
    return union_all([window, months, days]).groupBy("rule").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("key_sum")
    )


@query
def code_filters(spark, t):
    ranged = code_range(t.orders, "o_orderpriority", "2", "4-Z")
    listed = ranged.where(F.col("o_orderstatus").isin("O", "P") & ~F.col("o_orderpriority").like("%HIGH%"))
    return listed.select("o_orderkey", "o_orderpriority", "o_orderstatus")


PARAM_FIELDS = {
    "add_from": ("o_orderdate", ">="), "add_to": ("o_orderdate", "<"), "minimum": ("o_totalprice", ">="),
    "status": ("o_orderstatus", "in"), "customer": ("o_custkey", "="), "priority": ("o_orderpriority", "like"),
}
REPORT_PARAMS = {
    "add_from": dt.date(1998, 1, 1), "add_to": dt.date(1999, 1, 1), "minimum": 1000.0, "status": ["O", "P"],
    "customer": None, "priority": "%-%",
}


@query
def report_parameters(spark, t):
    return apply_params(t.orders, REPORT_PARAMS, PARAM_FIELDS).select("o_orderkey", "o_custkey", "o_totalprice")


@query
def validity_windows(spark, t):
    edges = t.product_structure
    valid = effective(edges, "date_eff_start", "date_eff_end", ASOF).select(F.lit("effective").alias("rule"), "rowid")
    unended = unexpired(edges, "date_eff_end", ASOF).select(F.lit("unexpired").alias("rule"), "rowid")
    return valid.unionByName(unended).groupBy("rule").agg(F.count(F.lit(1)).alias("edges"), F.sum("rowid").alias("rowids"))


@query
def open_lines(spark, t):
    shipped = t.shipment_line.groupBy("id_ord", "seq_line_ord").agg(
        F.max("id_ship").alias("id_ship"), F.sum("qty_ship").alias("shipped"), F.max("qty_open").alias("ship_open")
    )
    joined = t.order_line.join(shipped, ["id_ord", "seq_line_ord"], "left")
    return joined.where(still_open("id_ship", "shipped", "ship_open")).select(
        "id_ord", "seq_line_ord", "id_item", (F.col("qty_open") - F.coalesce("shipped", F.lit(0))).alias("net_open")
    )


@query
def packed_prices(spark, t):
    return t.order_line.select(
        "id_ord", "seq_line_ord", "rowid", "id_item",
        decode_vp("price_list_vp").alias("list_price"),
        decode_vp("price_sell_net_vp").alias("sell_price"),
        decode_vp("cost_unit_vp").alias("unit_cost"),
        extend("qty_open", decode_vp("price_sell_net_vp")).alias("open_net"),
        F.col("price_net"),
    )


@query
def packed_price_variants(spark, t):
    invoices = t.invoice_line.select(
        F.col("id_ord").alias("key"), F.col("seq_line_ord").cast("long").alias("line"), F.lit("tail").alias("variant"),
        decode_vp_tail("cost_unit_vp").cast("double").alias("value"),
    )
    offers = t.item_vendor.select(
        F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("line"), F.lit("vendor").alias("variant"),
        decode_vendor_price("price_vnd_fc_1").cast("double").alias("value"),
    )
    return invoices.unionByName(offers).groupBy("variant").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("decoded"),
        F.sum(F.col("value").cast("decimal(18,4)")).alias("total"),
    )


@query
def code_labels(spark, t):
    return t.part.select(
        "p_partkey",
        case_map("p_type", {"ECONOMY": "cheap", "PROMO": "advertised"}, "regular").alias("label"),
        first_rule(
            [(F.col("p_size") > 40, "large"), (F.col("p_size") > 10, "medium"), (F.col("p_type") == "SMALL", "tiny")],
            "small",
        ).alias("size_class"),
        flag_if(F.col("p_retailprice") > 950).alias("expensive"),
    )


@query
def schema_tolerant(spark, t):
    wide = t.item_base.select("id_item", "rowid", first_column(t.item_base, ["DESCR_3", "DESCR_2", "descr_1"], "none").alias("text"))
    return select_except(wide, ["id_item"])


@query
def canonical_values(spark, t):
    value, winner = canonical(
        {
            "CURRENT": F.col("cost_matl_va_crnt"), "STANDARD": F.col("cost_matl_va_std"),
            "LABOR": F.col("cost_labor_va_crnt"),
        }
    )
    return t.item_cost.select("rowid", value.alias("cost"), winner.alias("source"))


@query
def date_parts(spark, t):
    d = t.orders.select("o_orderkey", day("o_orderdate").alias("d"))
    return d.select(
        "o_orderkey", *(c.alias(n) for n, c in date_dimensions("d", "ord").items()), compact("d").alias("compact"),
        fiscal_label(F.year("d") * 100 + F.month("d")).alias("period"),
        or_no_date(F.when(F.month("d") > 6, F.col("d"))).alias("or_none"),
    )


@query
def event_times(spark, t):
    h = t.inventory_history
    return h.select(
        "rowversion", "id_item", event_time("date_chg_qty", "time_chg_qty").cast("string").alias("changed_at"),
    )


# --- dedup ----------------------------------------------------------------------------------

@query
def latest_line(spark, t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice")
    return latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice"])


@query
def priority_dedup(spark, t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_shipdate", "l_extendedprice")
    return dedup_by_priority(
        lines, ["l_orderkey", "l_linenumber"],
        [prefer(F.col("l_linestatus") == "O"), or_no_date("l_shipdate").desc(), F.col("l_extendedprice").desc(), "l_partkey"],
    )


@query
def top_lines_per_supplier(spark, t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return qualify(lines, ["l_suppkey"], [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"], 3)


@query
def replayed_history(spark, t):
    """Changes of stock sent again under a new version, recognised by the hash of all else."""
    log = t.inventory_history.select("id_item", "id_loc", "date_chg_qty", "time_chg_qty", "seq_rec", "code_dtl", "qty_onhd_chg", "rowversion")
    sent_again = log.where("rowversion % 3 = 0").withColumn("rowversion", F.col("rowversion") + 1_000_000_000)
    kept = without_replays(log.unionByName(sent_again), "rowversion")
    return kept.drop("row_hash")


@query
def home_location_first(spark, t):
    made = t.item_location.where(F.col("flag_source") == "M").select("id_item", "id_loc", "flag_stk")
    return dedup_by_priority(made, ["id_item"], [prefer(F.col("id_loc") == fv.HOME_LOCATION), "id_loc"])


# --- joins ----------------------------------------------------------------------------------

@query
def header_line_join(spark, t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    joined = header_line(lines, t.orders, ["o_orderkey"])
    return joined.groupBy("o_orderstatus", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).alias("amount"), F.count_distinct("o_orderkey").alias("orders")
    )


@query
def enriched_star(spark, t):
    lines = header_line(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), t.orders, ["o_orderkey"]).withColumnsRenamed(
        {"o_custkey": "c_custkey"}
    )
    joined = enrich(
        lines, (t.customer, "c_custkey"), (t.nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"),
        (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"),
    )
    return joined.groupBy("r_name", "n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).alias("amount")
    )


@query
def latest_reorder(spark, t):
    places = t.item_location.select("id_item", F.col("id_loc").alias("id_loc_home"), "qty_onhd")
    return left_latest(places, t.reorder.select("id_item", "id_loc_home", "level_rop", "rowid"), ["id_item", "id_loc_home"], ["rowid"])


@query
def normalised_join(spark, t):
    lines = t.order_line.select("id_ord", "seq_line_ord", "id_item", "rowid")
    items = t.stock_list.select("id_item", "adv")
    return join_norm(lines, items, [("id_item", "id_item")]).select("id_ord", "seq_line_ord", "rowid", "id_item", "adv")


@query
def reconcile_join(spark, t):
    ordered = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    known = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return full_reconcile(ordered, known, ["o_custkey"])


@query
def orphan_orders(spark, t):
    return orphans(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query
def semi_valid_orders(spark, t):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").withColumnRenamed("l_orderkey", "o_orderkey")
    return semi(t.orders, returned, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query
def exists_flags(spark, t):
    nations = t.nation.where(F.col("n_regionkey") == 1).select(F.col("n_nationkey").alias("s_nationkey"))
    supplied = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    inside = supplied.join(semi(t.supplier, nations, ["s_nationkey"]).select("s_suppkey"), "s_suppkey", "left_semi")
    return exists_flag(t.part.select("p_partkey", "p_brand"), inside, ["p_partkey"], "from_region")


@query
def fiscal_interval_join(spark, t):
    lines = t.order_line.select("id_ord", "seq_line_ord", "rowid", "id_item", "date_prom", "qty_open")
    return interval_join(lines, "date_prom", t.fiscal_period, "beg_date", "end_date")


@query
def two_tier_lookup(spark, t):
    lines = t.order_line.join(t.order_header.select("id_ord", "code_cust_1"), "id_ord")
    named = lookup_default(
        lines, t.product_category, "code_cat_prdt", F.col("code_cust_1"), "code_type_cust", "descr", "category_name"
    )
    return named.groupBy("code_cat_prdt", "code_cust_1", "category_name").agg(F.count(F.lit(1)).alias("lines"))


@query
def best_customer_match(spark, t):
    heads = trim_keys(t.order_header, ["id_cust_soldto"]).select("id_ord", F.col("id_cust_soldto").alias("id_cust"), "seq_shipto")
    ships = trim_keys(t.customer_shipto, ["id_cust"])
    return best_match(heads, ships, ["id_cust"], ["seq_shipto"], ["seq_shipto"], "match_")


@query
def pick_one_job(spark, t):
    heads = t.order_header.select("id_ord", F.concat(F.lit("SO"), "id_ord").alias("id_so"))
    jobs = trim_keys(t.shop_header, ["id_so"]).select("id_so", "sufx_so", "stat_rec_so", "date_chg_last", "date_add")
    return pick_one(
        heads, jobs, ["id_so"], [or_no_date("date_chg_last").desc(), or_no_date("date_add").desc(), F.col("sufx_so").desc()]
    )


@query
def salted_customer_join(spark, t):
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    joined = salted_join(facts, t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], rows_per_task=20, salts=8)
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("amount"))


@query
def max_date_version(spark, t):
    edges = trim_keys(t.product_structure, ["id_item_comp"])
    last = edges.groupBy("id_item_comp").agg(F.max("date_eff_end").alias("date_eff_end"))
    return edges.join(last, ["id_item_comp", "date_eff_end"], "left_semi").select("rowid", "id_item_par", "id_item_comp", "date_eff_end")


@query
def row_counts(spark, t):
    sides = union_all([df.select(F.lit(n).alias("side")) for n, df in (("active", t.order_header), ("perm", t.order_header_perm))])
    return sides.agg(F.count_if(F.col("side") == "active").alias("active"), F.count_if(F.col("side") == "perm").alias("perm"))


# --- aggregations ---------------------------------------------------------------------------

@query
def status_buckets(spark, t):
    return bucket_sums(
        t.lineitem, ["l_suppkey"], F.col("l_quantity").cast("long"),
        {
            "returned": F.col("l_returnflag") == "R",
            "open_new": (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"),
            "closed": F.col("l_linestatus") == "F",
        },
    )


@query
def flag_split_sums(spark, t):
    lines = t.lineitem.select("l_orderkey", F.col("l_quantity").cast("long").alias("quantity"), money("l_extendedprice").alias("amount"), "l_linestatus")
    return split_sums(lines, ["l_orderkey"], ["quantity", "amount"], "l_linestatus", {"O": "open", "F": "closed"})


@query
def eav_pivot(spark, t):
    rows = trim_keys(t.item_attribute, ["id_item"])
    return pivot_attrs(
        rows, ["id_item"], "id_attr", "val_string_attr",
        {"COLOR": "color", "SIZE": "size", "CLASS": "class", "ID_PARENT": "parent", "Z_BRAND": "brand"},
    )


@query
def secondary_location_lists(spark, t):
    places = t.item_location.select("id_item", "id_loc").distinct()
    return listagg(places, ["id_item"], "id_loc", "locations")


@query
def conditional_lists(spark, t):
    offers = t.item_vendor.withColumn("second", F.when(F.col("flag_vnd_prim") == "S", F.col("id_vnd_ordfm")))
    return listagg(offers, ["id_item"], "second", "secondary_vendors", "; ")


@query
def supplier_ranks(spark, t):
    supplied = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    return rank_to_columns(supplied, ["l_partkey"], [F.col("qty").desc(), "l_suppkey"], ["l_suppkey", "qty"], ["primary", "secondary"])


@query
def any_all_rollups(spark, t):
    return t.lineitem.groupBy("l_orderkey").agg(
        any_of(F.col("l_returnflag") == "R").alias("any_returned"),
        all_of(F.col("l_linestatus") == "F").alias("all_closed"),
        F.min(day("l_shipdate")).alias("first_shipped"),
        F.max(day("l_shipdate")).alias("last_shipped"),
        F.count_if(F.col("l_quantity") > 25).alias("large_lines"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
    )


@query
def repeated_keys(spark, t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


@query
def status_shares(spark, t):
    return share_of_total(t.orders, "o_orderstatus")


@query
def yearly_totals(spark, t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum(money("o_totalprice")), 2).alias("amount"),
        F.count_distinct("o_custkey").alias("customers"),
    )


@query
def open_totals(spark, t):
    lines = t.order_line.where(F.col("qty_open") > 0)
    return lines.agg(
        F.count_distinct("id_ord").alias("total_orders"), F.count(F.lit(1)).alias("total_line_items"),
        F.round(F.sum(extend("qty_open", decode_vp("price_sell_net_vp"))), 2).alias("total_open_net_value"),
    )


@query
def log_summary(spark, t):
    return summarise_log(
        t.events.withColumns({"seen": day("ts"), "kind": F.length("event_type"), "cents": F.round(F.col("value") * 100).cast("long")}),
        ["user_id"], ["ts", "event_id"], "seen", "kind", "event_type", "cents", dt.date(2024, 1, 31), 10,
    )


@query
def usual_event(spark, t):
    return most_frequent(t.events, ["user_id"], "event_type", "usual_type")


# --- working days ---------------------------------------------------------------------------

@query
def workdays_between_dates(spark, t):
    rows = t.order_line.select("id_ord", "seq_line_ord", "rowid", "id_item", "date_rqst", "date_prom", "date_pick_last")
    return workdays_between(
        rows, {"to_promise": ("date_rqst", "date_prom"), "to_request": ("date_prom", "date_rqst"), "since_pick": ("date_pick_last", "date_prom")},
        work_calendar(spark, t),
    )


@query
def added_workdays(spark, t):
    rows = t.orders.select("o_orderkey", day("o_orderdate").alias("d"))
    steps = {"plus_1": ("d", 1), "plus_3": ("d", 3), "plus_10": ("d", 10)}
    rolled = {"rolled_5": ("d", 5), "rolled_10": ("d", 10)}
    return add_workdays(add_workdays(rows, steps, work_calendar(spark, t)), rolled, work_calendar(spark, t), roll=True)


@query
def acknowledge_dates(spark, t):
    lines = t.order_line.join(t.order_header.select("id_ord", "date_ord"), "id_ord").select(
        "id_ord", "seq_line_ord", "rowid", "id_item", "flag_stk", "date_ord", "date_rqst", "date_prom"
    )
    dated = add_workdays(lines, {"o5": ("date_ord", 5), "p10": ("date_prom", 10)}, work_calendar(spark, t), roll=True)
    return dated.withColumn(
        "date_acknowledged",
        first_rule(
            [
                ((F.col("flag_stk") == "S") & (F.col("o5") >= F.col("date_prom")), F.col("date_prom")),
                (F.col("date_rqst") == F.col("date_prom"), F.col("date_rqst")),
            ],
            F.col("p10"),
        ),
    ).drop("o5", "p10", "flag_stk")


@query
def sla_flag_counts(spark, t):
    sold = t.sales_transaction.select("ordered_date", "invoice_date")
    counted = workdays_between(sold, {"wi": ("ordered_date", "invoice_date")}, work_calendar(spark, t))
    return counted.groupBy(lead_time_range("wi").alias("lead_time")).agg(
        F.count(F.lit(1)).alias("sales"), *(F.count_if(c == "Y").alias(n) for n, c in sla_flags("wi").items())
    )


# --- ranking and set operations -------------------------------------------------------------

@query
def sorted_customers(spark, t):
    return sorted_output(t.customer.select("c_custkey", "c_name", "c_acctbal"), [F.col("c_acctbal").desc(), "c_custkey"])


@query
def failing_sample(spark, t):
    lost = orphans(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"]).select("o_orderkey")
    return sample_failures(lost, 100, ["o_orderkey"])


@query
def first_column_values(spark, t):
    return first_values(t.customer.select("c_custkey", "c_name", "c_mktsegment"), 10)


@query
def segment_frequency(spark, t):
    return frequency(t.customer, ["c_mktsegment", "c_nationkey"])


# --- quality --------------------------------------------------------------------------------

SHOP_KEY = ["id_loc", "id_so", "sufx_so"]


@query
def shop_order_checks(spark, t):
    tables = {"header": t.shop_header, "operation": t.shop_operation, "material": t.shop_material, "target": Masters(spark, t).shop_orders}
    status = F.col("stat_rec_so")
    suite = q.KeySuite(tables, SHOP_KEY, {"odd_status": ("header", status.isNull() | ~status.isin("A", "R", "S", "C"))})
    suite.null_keys("header", "T1A", notes="header keys filled").null_keys("operation", "T1B", notes="operation keys filled")
    suite.null_keys("material", "T1C", notes="material keys filled").duplicates("header", "T2A", notes="header keys unique")
    suite.missing("operation", "header", "T2B", notes="operations have a header").missing("material", "header", "T2C", notes="materials have a header")
    suite.duplicates("target", "T3A", notes="target keys unique").key_counts("header", "target", "T3B", notes="same number of keys")
    suite.missing("header", "target", "T4A", notes="source keys in target").missing("target", "header", "T4B", notes="target keys in source")
    suite.line_counts("material", 6, "T5A", notes="many material lines").rows_where("odd_status", "T7A", notes="status in domain")
    stock = q.check_negative(t.item_location, ["qty_onhd", "qty_onord"], "T6A", notes="negative stock")
    return q.run_checks([suite.results(), stock])


@query
def ingestion_checks(spark, t):
    def suite(kind: str, key: list[str], active: DataFrame, perm: DataFrame, first: int, last: int) -> DataFrame:
        both = F.col("n_active") + F.col("n_perm")
        facts = q.KeySuite({"active": active, "perm": perm}, key).facts({
            "rows": F.sum(both), "unkeyed": F.sum(F.when(~F.col("__keyed"), both)),
            "repeated": F.count_if(F.col("__keyed") & (F.col("n_active") > 1)),
        })
        checks = [
            (f"ING-00{first}", f"{kind}s captured", "CRITICAL", ">0", "rows"),
            (f"ING-00{first + 2}", f"null {kind} keys", "CRITICAL", "0", "unkeyed"),
            (f"ING-00{last}", f"repeated {kind}s", "WARNING", "0", "repeated"),
        ]
        return q.measured_checks(facts, checks, "INGESTION", f"order_{kind}, order_{kind}_perm", "ingestion")

    rows = suite("header", ["id_ord"], t.order_header, t.order_header_perm, 1, 5).unionByName(
        suite("line", ["id_ord", "seq_line_ord"], t.order_line, t.order_line_perm, 2, 6)
    )
    return rows.select(*(c for c in q.MEASURED if c != "run_time"), flag_if(F.col("run_time").isNotNull()).alias("timed"))


@query
def duplicate_header_keys(spark, t):
    return q.duplicate_keys(tagged_union({"A": t.order_header, "P": t.order_header_perm}), ["id_ord"])


@query
def null_user_rows(spark, t):
    return q.null_keys(t.order_line, ["id_so"]).select("id_ord", "seq_line_ord", "id_item", "id_so", "rowid")


@query
def source_coverage(spark, t):
    places = t.item_location.select("id_item", "id_loc")
    made = trim_keys(t.shop_header, ["id_loc"]).select(F.col("id_item_par").alias("id_item"), "id_loc")
    levels = t.reorder.select("id_item", F.col("id_loc_home").alias("id_loc"))
    return union_all(
        [
            q.coverage(places, made, ["id_item", "id_loc"], "shop orders"),
            q.coverage(places, levels, ["id_item", "id_loc"], "reorder"),
        ]
    )


@query
def field_mismatch_counts(spark, t):
    raw = t.order_line.select("id_ord", "seq_line_ord", "id_item", "qty_open", "id_loc", "id_so")
    a = dedup_by_priority(raw, ["id_ord", "seq_line_ord"], ["id_item", "qty_open", "id_loc"])
    b = dedup_by_priority(raw, ["id_ord", "seq_line_ord"], [F.col("id_item").desc(), F.col("qty_open").desc(), F.col("id_loc").desc()])
    both = a.join(b.withColumnsRenamed({c: f"v_{c}" for c in ("id_item", "qty_open", "id_loc", "id_so")}), ["id_ord", "seq_line_ord"])
    return q.field_mismatches(
        both,
        {
            "mm_item": ("id_item", "v_id_item", ""), "mm_qty": ("qty_open", "v_qty_open", 0),
            "mm_loc": ("id_loc", "v_id_loc", ""), "mm_so": ("id_so", "v_id_so", ""),
        },
    )


@query
def rule_check(spark, t):
    stored = t.order_line.withColumn("shown", F.when(F.col("flag_pick") == 2, "P").otherwise(""))
    wrong = (F.col("date_pick_last").isNotNull()) & (F.col("shown") != "P") | (F.col("qty_bo") == 0) & (F.col("shown") == "P")
    lists = inventory.secondary_location_list(t.item_location.withColumn("primary_source", F.lit("CLE")))
    return q.run_checks(
        [
            q.check_rule(stored, wrong, "RULE-01", notes="pick flag rule"),
            q.check_single_value(lists, ["id_item"], "secondary_location_list", "RULE-02", notes="one list per item"),
            q.check_single_value(t.item_location, ["id_item"], "flag_stk", "RULE-03", notes="one stock flag per item"),
            q.check_row_stability(t.item_location, lists, "RULE-04", notes="list join keeps rows"),
        ]
    )


def _changed_orders(t) -> DataFrame:
    """Orders as a second system would hold them: some totals, texts and rows differ."""
    o = t.orders
    price = F.col("o_totalprice")
    return o.where(F.col("o_totalprice") < 450000).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", price + 5).when(F.col("o_orderpriority") == "2-HIGH", price + 0.001)
        .otherwise(price).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", F.lower("o_orderpriority")).when(F.col("o_orderstatus") == "F", F.lit(" x "))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


DIFF_FIELDS = {
    "o_totalprice": ("o_totalprice", "number"), "o_orderpriority": ("o_orderpriority", "text"),
    "o_orderdate": ("o_orderdate", "timestamp"), "o_custkey": ("o_custkey", "number"),
}


@query
def order_cell_diff(spark, t):
    return cell_diff(t.orders, _changed_orders(t), ["o_orderkey"], DIFF_FIELDS)


@query
def line_cell_diff(spark, t):
    """Keys with several rows on both sides: some rows changed, some missing."""
    first = (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R")
    second = (F.col("l_linenumber") == 2) & (F.col("l_returnflag") == "A")
    changed = t.lineitem.where("l_linenumber < 7").select(
        "l_orderkey", F.when(first, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(second, "X").otherwise(F.col("l_linestatus")).alias("status"),
    )
    return cell_diff(t.lineitem, changed, ["l_orderkey"], {"l_quantity": ("quantity", "number"), "l_linestatus": ("status", "text")})


@query
def order_diff_summary(spark, t):
    return diff_summary(cell_diff(t.orders, _changed_orders(t), ["o_orderkey"], DIFF_FIELDS))


@query
def order_run_log(spark, t):
    """The log of one comparison run, with the counts taken while its differences were written."""
    keys = ["o_orderkey"]
    with own_folders(spark) as folder:
        log = run_log(
            spark, folder("run-log"), "orders-1", ("orders", t.orders), ("changed_orders", _changed_orders(t)),
            lambda old, new: cell_diff(old, new, keys, DIFF_FIELDS), keys, folder("run-detail"),
        )
        shown = log.withColumn("timed", flag_if(F.col("run_time").isNotNull())).drop("run_time")
        return spark.createDataFrame(shown.collect(), shown.schema)


@query
def side_duplicates(spark, t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("id_ord"), F.col("l_linenumber").alias("line"))
    return duplicates(lines, t.shipment_line.select("id_ord", F.col("seq_line_ord").alias("line")), ["id_ord", "line"])


def _yearly(t, null_safe: bool) -> DataFrame:
    dims = {
        "segment": F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("5")), "year": F.year("o_orderdate"),
    }
    old = t.orders.withColumns({"amount": money("o_totalprice"), "units": F.lit(1)})
    new = _changed_orders(t).withColumns({"amount": money("o_totalprice"), "units": F.lit(1)})
    return reconcile(old, new, dims, {"sales": "amount", "units": "units"}, {"sales": 2}, null_safe)


@query
def reconcile_years(spark, t):
    return _yearly(t, True)


@query
def reconcile_years_plain_keys(spark, t):
    return _yearly(t, False)


@query
def order_overlap_audit(spark, t):
    heads = tagged_union({"ACTIVE": t.order_header, "PERM": t.order_header_perm}, "src")
    return overlap_audit(heads, ["id_ord"], "src", "ACTIVE", "PERM")


@query
def order_filter_funnel(spark, t):
    lines = t.order_line.join(t.order_header.select("id_ord", "date_ord", "amt_ord_total", "id_cust_soldto"), "id_ord")
    c = F.col
    stages = [
        ("1_ALL_ROWS", None),
        ("2_OPEN_LINES", c("qty_open") > 0),
        ("3_ADD_DATE", (c("date_ord") >= F.lit(dt.date(1997, 1, 1))) & (c("date_ord") < F.lit(dt.date(2000, 1, 1)))),
        ("4_DUE_DATE", (c("date_rqst") >= F.lit(dt.date(1997, 6, 1))) & (c("date_rqst") < F.lit(dt.date(2000, 6, 1)))),
        ("5_RANGE_FILTERS", c("code_cat_prdt").between("0", "2Z") & (c("amt_ord_total") >= 100)),
        ("6_PROMISE_CUTOFF", c("date_prom") <= F.lit(dt.date(1999, 12, 31))),
    ]
    return filter_funnel(
        lines, stages, {"total_open_net_value": extend("qty_open", decode_vp("price_sell_net_vp"))}, {"total_orders": "id_ord"},
    ).withColumn("total_open_net_value", F.round("total_open_net_value", 2))


@query
def profile_orders(spark, t):
    return profile(t.orders.withColumn("o_totalprice", money("o_totalprice")))


@query
def profile_samples(spark, t):
    seen = profile(t.customer, sample_pct=50, sample_keys=["c_custkey"])
    return seen.select("column_name", "data_type", "distinct_count", "sample_values", "value_composition")


@query
def hash_ordered_values(spark, t):
    return topk_values(t.orders.select("o_orderstatus", "o_orderpriority", "o_custkey"), 3)


@query
def refresh_stamps(spark, t):
    """Every row of a refreshed table carries the time of its refresh."""
    lines = stamp(t.order_line.select("id_ord", "seq_line_ord"))
    return lines.agg(F.count(F.lit(1)).alias("rows"), F.count("load_timestamp").alias("stamped"), F.count_distinct("load_timestamp").alias("refreshes"))


@query
def column_samples(spark, t):
    return sample_values(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), 10)


@query
def step_counts(spark, t):
    """Row counts of pipeline steps, taken while the last step is written."""
    lines, seen = q.observed(t.lineitem, "lines")
    picked, kept = q.observed(latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice"]), "kept")
    with own_folders(spark) as folder:
        write_table(picked, folder("step-counts"))
    rows = [("lines", seen.get["rows"]), ("kept", kept.get["rows"])]
    return spark.createDataFrame(rows, "step string, rows bigint")


# --- streaming ------------------------------------------------------------------------------

@query
def stream_latest(spark, t):
    feed = spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events*.parquet").parquet(t.directory)
    base = shared_folder(spark, "latest-events")
    maintain_latest(feed, f"{base}/table", f"{base}/progress", ["user_id"], ["ts", "event_id"]).awaitTermination()
    return read_snapshot(spark, f"{base}/table", t.events.schema, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query
def stream_tiers(spark, t):
    base = shared_folder(spark, "tiers")
    sources = [
        Source("orders", FREQUENT, t.directory, t.orders.schema, "orders.parquet"),
        Source("events", FREQUENT, t.directory, t.events.schema, "events.parquet"),
        Source("part", DAILY, t.directory, t.part.schema, "part.parquet"),
    ]
    stored = {}
    for tier in (FREQUENT, DAILY):
        stored |= ingest_tier(spark, tier, sources, f"{base}/bronze", f"{base}/progress")
    return union_all(
        [spark.read.parquet(path).agg(F.lit(name).alias("source"), F.count("load_timestamp").alias("rows")) for name, path in stored.items()]
    )


# --- models ---------------------------------------------------------------------------------

class Masters:
    """The silver masters, each built once per application and directory, stored and read back.

    Gold tables read stored silver tables: lineage is cut there, a lost executor
    costs no rebuild, and each table is scanned only for the columns needed.  A
    master is built anew when a file of the tables has changed.
    """

    def __init__(self, spark: SparkSession, t: Captures):
        self._spark = spark
        self._t = t

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return load_path(self._spark, stored_once(self._spark, self._t, f"masters/{name}", build))

    @property
    def orders(self):
        return self._get("orders", lambda: orders.build_orders(self._t))

    @property
    def shipments(self):
        return self._get("shipments", lambda: shipments.build_shipments(self._t))

    @property
    def inventory(self):
        return self._get("inventory", lambda: inventory.build_inventory(self._t))

    @property
    def inventory_fields(self):
        return self._get("inventory_fields", lambda: inventory.build_inventory_fields(self._t))

    @property
    def inventory_with_history(self):
        return self._get("inventory_with_history", lambda: inventory.build_inventory_with_history(self._t, ASOF))

    @property
    def products(self):
        return self._get("products", lambda: products.build_products(self._t, self.inventory, ASOF))

    @property
    def vendors(self):
        return self._get("vendors", lambda: vendors.build_item_vendors(self._t))

    @property
    def customers(self):
        return self._get("customers", lambda: customers.build_customers(self._t))

    @property
    def shop_orders(self):
        return self._get("shop_orders", lambda: shop_orders.build_shop_orders(self._t))

    @property
    def shop_work(self):
        return self._get("shop_work", lambda: shop_orders.build_shop_work(self._t, SINCE))

    @property
    def warning_flags(self):
        return self._get("warning_flags", lambda: products.build_warning_flags(self._t, ASOF))


@query
def orders_master(spark, t):
    return orders.build_orders(t)


@query
def order_valuation(spark, t):
    return orders.build_order_valuation(t)


@query
def shipment_master(spark, t):
    return shipments.build_shipments(t)


@query
def booking_history(spark, t):
    return bookings.build_bookings(t, SINCE)


@query
def customer_master(spark, t):
    return customers.build_customers(t)


@query
def inventory_master(spark, t):
    return inventory.build_inventory(t)


@query
def inventory_fields(spark, t):
    return inventory.build_inventory_fields(t)


@query
def inventory_with_history(spark, t):
    return inventory.build_inventory_with_history(t, ASOF)


@query
def inventory_checks(spark, t):
    return inventory.inventory_checks(t, Masters(spark, t).inventory_with_history, ASOF)


@query
def item_locations(spark, t):
    return inventory.build_item_locations(t)


@query
def product_master(spark, t):
    return products.build_products(t, Masters(spark, t).inventory, ASOF)


@query
def product_checks(spark, t):
    return products.product_checks(t, Masters(spark, t).products)


@query
def parent_status(spark, t):
    return products.build_parent_status(t)


@query
def parent_status_distribution(spark, t):
    return products.parent_status_distribution(t)


@query
def missing_parents(spark, t):
    return products.missing_parents(t)


@query
def warning_flags(spark, t):
    return products.build_warning_flags(t, ASOF)


@query
def warning_flag_checks(spark, t):
    return products.warning_flag_checks(Masters(spark, t).warning_flags)


@query
def item_vendors(spark, t):
    return vendors.build_item_vendors(t)


@query
def open_purchase_orders(spark, t):
    return vendors.build_open_purchase_orders(t)


@query
def vendor_prices(spark, t):
    return vendors.build_vendor_prices(t)


@query
def shop_order_master(spark, t):
    return shop_orders.build_shop_orders(t)


@query
def shop_work(spark, t):
    return shop_orders.build_shop_work(t, SINCE)


@query
def shop_order_info(spark, t):
    return shop_orders.build_shop_order_info(t, SINCE)


@query
def shop_orders_by_work_center(spark, t):
    return shop_orders.build_shop_orders_by_work_center(t, SINCE)


@query
def work_centers(spark, t):
    return shop_orders.build_work_centers(t)


@query
def display_status(spark, t):
    return shop_orders.build_display_status(t)


@query
def display_status_reduced(spark, t):
    return shop_orders.build_display_status(t, with_planner=False)


@query
def gold_item_location(spark, t):
    m = Masters(spark, t)
    return gold_items.build_gold_item_location(
        m.inventory, m.products, m.vendors, m.orders, m.shipments, m.shop_work, ASOF
    )


def _open_orders(spark, t):
    m = Masters(spark, t)
    return open_orders.build_open_orders(m.orders, m.products, m.inventory, m.customers, m.shipments, m.shop_orders)


@query
def open_orders_by_line(spark, t):
    return _open_orders(spark, t)


@query
def open_orders_view(spark, t):
    return open_orders.open_orders_view(_open_orders(spark, t))


@query
def open_orders_with_prices(spark, t):
    m = Masters(spark, t)
    return open_orders.build_open_orders_with_prices(
        m.orders, m.inventory, m.products, m.shipments, m.shop_work, work_calendar(spark, t), ASOF
    )


@query
def open_orders_by_order(spark, t):
    m = Masters(spark, t)
    return open_orders.build_open_orders_by_order(
        m.orders, m.products, m.inventory_fields, m.shipments, t.invoice_line, m.shop_orders, m.customers
    )


@query
def sales_history(spark, t):
    return sales.build_sales_history(t, Masters(spark, t).products, SINCE)


@query
def sales_service(spark, t):
    m = Masters(spark, t)
    history = sales.build_sales_history(t, m.products, SINCE)
    return sales.build_sales_service(t, history, work_calendar(spark, t), ASOF)


@query
def invoice_history(spark, t):
    return sales.build_invoice_history(t, SINCE)


@query
def cached_open_orders(spark, t):
    """The stored report is read again until a file of the tables changes."""
    path = stored_once(spark, t, "open-orders-cache", lambda: cached_report.build_cached_report(t, work_calendar(spark, t), ASOF, ["I1%"]))
    return cached_report.with_comments(t, load_path(spark, path))
