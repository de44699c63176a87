"""Sales history, service level and invoice history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.amounts import decode_vp_tail
from ledgermill.functions.text import case_map, describe, first_rule, flag_if
from ledgermill.operators.aggregates import all_of, listagg, pivot_attrs
from ledgermill.operators.dedup import dedup_by_priority, latest, one_per
from ledgermill.operators.filters import sales_scope, unexpired
from ledgermill.operators.joins import exists_flag
from ledgermill.operators.keys import trim_keys
from ledgermill.operators.workdays import (
    delivery_group, fillable, lead_time_range, on_time, sla_flags, workdays_between,
)
from ledgermill.plans.inventory import items, locations, reorder_points
from ledgermill.plans.products import descriptions


def customers_with_group(t) -> DataFrame:
    """Sold-to customers with group code and name, their own where they have no group."""
    sold = dedup_by_priority(trim_keys(t.customer_soldto, ["id_cust"]), ["id_cust"], [])
    groups = dedup_by_priority(t.customer_group, ["group_code"], []).select(
        F.col("group_code").alias("code_user_3_ar"), "group_name", F.lit(True).alias("grouped")
    )
    return sold.join(groups, "code_user_3_ar", "left").select(
        F.col("id_cust").alias("customer_id"),
        F.col("name_cust").alias("customer_name"),
        F.col("code_cust").alias("customer_type"),
        F.when(F.col("grouped"), F.col("code_user_3_ar")).otherwise(F.col("id_cust")).alias("cust_group_code"),
        F.coalesce("group_name", "name_cust").alias("cust_group_name"),
        F.col("city").alias("sold_to_city"),
        F.col("id_st").alias("sold_to_state"),
        F.col("code_user_2_ar").alias("customer_attribute_flag"),
    )


def location_label() -> Column:
    return F.concat("location_id", F.lit(" - "), "location_name")


def build_sales_history(t, products: DataFrame, since: dt.date = dt.date(2014, 1, 1)) -> DataFrame:
    """Bookings and invoices with customer, product, location and sales-rep fields.

    The condition on the customer class makes the customer join an inner one,
    so it is written as such and cuts the rows first.
    """
    sales = trim_keys(t.sales_transaction, ["customer_id", "sales_rep_id", "item_id"])
    scoped = sales_scope(sales.join(customers_with_group(t), "customer_id"), "calendar_date", since, "customer_type")
    product = products.select(
        F.col("item_id_child_sku").alias("item_id"), "item_description_child_sku", "item_cost_category",
        "item_vertical", "item_vertical_code", "item_id_parent_sku",
        "item_description_parent_sku", "item_color", "item_size", "item_brand", "item_advertised_flag", "item_prop_65", "item_status_child",
        "item_status_parent",
    )
    places = one_per(t.location, "id_loc").select(F.col("id_loc").alias("location_id"), F.col("descr").alias("location_name"))
    reps = one_per(t.sales_rep, "id_slsrep").select(F.trim("id_slsrep").alias("sales_rep_id"), F.col("name_slsrep").alias("sales_rep_name"))
    level = reorder_points(t).select(
        F.col("id_item").alias("item_id"), F.col("id_loc_home").alias("location_id"),
        F.col("level_rop").alias("reorder_point"),
    )
    planner = locations(t).select(
        F.col("id_item").alias("item_id"), F.col("id_loc").alias("location_id"),
        F.col("id_planner").alias("planned_classification"),
    )
    shipto = dedup_by_priority(trim_keys(t.customer_shipto, ["id_cust"]), ["id_cust", "seq_shipto"], []).select(
        F.col("id_cust").alias("customer_id"), "seq_shipto", F.col("name_cust").alias("ship_to_customer_name")
    )
    # joins on one key follow each other, so the rows move once by customer and once by item
    return (
        scoped.join(places, "location_id", "left")
        .join(reps, "sales_rep_id", "left")
        .join(shipto, ["customer_id", "seq_shipto"], "left")
        .join(product, "item_id", "left")
        .join(level, ["item_id", "location_id"], "left")
        .join(planner, ["item_id", "location_id"], "left")
        .withColumns(
            {
                "location_label": location_label(),
                "parent_description": F.coalesce("item_description_parent_sku", F.lit(fv.MISSING_PARENT_DESCRIPTION)),
            }
        )
        .drop("location_name", "item_description_parent_sku")
    )


def kit_stock(t, asof: dt.date) -> DataFrame:
    """Per kit: number of unexpired components and whether all of them are stock items."""
    edges = unexpired(trim_keys(t.product_structure, ["id_item_par", "id_item_comp"]), "date_eff_end", asof)
    stocked = trim_keys(t.stock_list, ["id_item"]).select(F.col("id_item").alias("id_item_comp"))
    flagged = exists_flag(edges, stocked, ["id_item_comp"], "is_stock")
    return flagged.groupBy(F.col("id_item_par").alias("item_id")).agg(
        all_of(F.col("is_stock") == "Y").alias("kit_all_components_stock"),
        F.count(F.lit(1)).alias("active_component_count"),
    )


def build_sales_service(t, history: DataFrame, cal: DataFrame, asof: dt.date) -> DataFrame:
    """Service level of every sale: working days, delivery group, SLA flags, fillable and on time."""
    dated = workdays_between(
        history,
        {
            "workdays_invoice": ("ordered_date", "invoice_date"),
            "workdays_promise": ("ordered_date", "promise_date"),
            "workdays_late": ("promise_date", "invoice_date"),
        },
        cal,
    )
    grouped = dated.withColumn(
        "delivery_group",
        delivery_group(
            "stock_flag", "item_advertised_flag", "reorder_point", "planned_classification", "item_vertical_code",
            "workdays_promise", "workdays_invoice",
        ),
    )
    with_kits = grouped.join(kit_stock(t, asof), "item_id", "left")
    return with_kits.select(
        "*",
        *(c.alias(n) for n, c in sla_flags("workdays_invoice").items()),
        lead_time_range("workdays_invoice").alias("delivery_lead_time_range"),
        fillable(
            "delivery_group", "stock_flag", "workdays_promise", "kit_all_components_stock", "active_component_count"
        ).alias("fillable"),
        on_time("delivery_group", "promise_date", "invoice_date", "workdays_late").alias("on_time_flag"),
    ).drop("workdays_late", "kit_all_components_stock", "active_component_count")


INVOICE_ATTRIBUTES = {
    code: fv.SKU_ATTRIBUTES[code]
    for code in ("CERT_NUM", "COLOR", "ID_PARENT", "LENGTH", "SIZE", "TARIFF_CODE", "UPC_CODE", "PFAS")
}
INVOICE_PARENT_ATTRIBUTES = {
    "BERRY": "par_berry", "PRODUCT TYPE": "par_product_type", "Z_BRAND": "par_brand",
    "Z_CATEGORY": "par_category", "Z_VERTICAL": "par_vertical",
}


def item_verticals(
    t, categories: Mapping[tuple[str, str], str] = fv.CATEGORY_LABELS, verticals: Mapping[str, str] = fv.VERTICALS
) -> DataFrame:
    """Vertical name and category label per item, from the codes of the parents its attributes name.

    Codes are looked up in rule tables, not in chains of conditions.
    """
    spark = t.item_base.sparkSession
    rows = trim_keys(t.item_attribute, ["id_item", "id_attr"])
    codes = pivot_attrs(
        rows.where((F.col("code_comm") == fv.PARENT_COMMODITY) & F.col("id_attr").isin("Z_VERTICAL", "Z_CATEGORY")),
        ["id_item"], "id_attr", "val_string_attr", {"Z_VERTICAL": "z_vertical", "Z_CATEGORY": "z_category"},
    ).withColumnRenamed("id_item", "val_string_attr")
    labels = F.broadcast(
        spark.createDataFrame(
            [(v, c, label) for (v, c), label in categories.items()], "z_vertical string, z_category string, label string"
        )
    )
    base = items(t).select("id_item", "code_comm")
    named = (
        base.join(rows.select("id_item", "code_comm", "val_string_attr"), ["id_item", "code_comm"])
        .join(codes, "val_string_attr")
        .join(labels, ["z_vertical", "z_category"], "left")
    )
    found = named.groupBy("id_item").agg(
        F.max("label").alias("label"), F.max("z_vertical").alias("v"), F.max("z_category").alias("c")
    )
    by_category = [
        ((F.col("v") == v) & (F.col("c") == c), name) for (v, c), name in fv.VERTICALS_BY_CATEGORY.items()
    ]
    return base.select("id_item").join(found, "id_item", "left").select(
        "id_item",
        F.coalesce("label", F.lit(fv.NOT_CATEGORIZED)).alias("category_label"),
        first_rule(by_category, case_map("v", verticals, fv.DEFAULT_VERTICAL)).alias("vertical_label"),
    )


def latest_use_flags(t) -> DataFrame:
    """Warning flag per parent from each component's last effective use, whatever its status."""
    edges = trim_keys(t.product_structure, ["id_item_par", "id_item_comp"])
    last = edges.groupBy("id_item_comp").agg(F.max("date_eff_end").alias("date_eff_end"))
    warned = descriptions(t).where(F.col("descr_addl").like(f"%{fv.WARNING_TEXT}%")).select(
        F.col("id_item").alias("id_item_comp")
    )
    hits = edges.join(last, ["id_item_comp", "date_eff_end"], "left_semi").join(warned, "id_item_comp", "left_semi")
    return exists_flag(edges.select("id_item_par").distinct(), hits, ["id_item_par"], "prop_65")


def build_invoice_history(t, since: dt.date = dt.date(2014, 1, 1)) -> DataFrame:
    """Invoice lines with customer, product, attribute, vertical and category fields."""
    lines = trim_keys(t.invoice_line, ["id_item", "id_cust_soldto"]).where(F.col("date_invc") > F.lit(since))
    header = dedup_by_priority(t.invoice_header, ["id_invc"], []).select(
        "id_invc", "seq_shipto", F.col("amt_frt").alias("freight_cost"), F.col("tax_sls").alias("sales_tax"),
        F.trim("id_slsrep_1").alias("sales_rep_id"), F.col("city").alias("ship_to_city"),
    )
    reps = one_per(t.sales_rep, "id_slsrep").select(F.trim("id_slsrep").alias("sales_rep_id"), F.col("name_slsrep").alias("sales_rep_name"))
    product = items(t).select(
        "id_item", describe("descr_1", "descr_2").alias("product_description"), "code_cat_cost", "code_cat_prdt", "key_alt"
    )
    costs = one_per(t.cost_category, "code_cat_cost").select("code_cat_cost", F.col("descr").alias("cost_name"))
    categories = one_per(t.product_category.where(F.trim("code_type_cust") == ""), "code_cat_prdt").select(
        "code_cat_prdt", F.col("descr").alias("prdt_name")
    )
    raw = trim_keys(t.item_attribute, ["id_item", "id_attr"])
    skus = items(t).where(F.col("code_comm") != fv.PARENT_COMMODITY).select("id_item", "code_comm")
    attributes = pivot_attrs(
        skus.join(raw, ["id_item", "code_comm"]), ["id_item"], "id_attr", "val_string_attr", INVOICE_ATTRIBUTES
    )
    parent_attributes = pivot_attrs(
        raw.where(F.col("code_comm") == fv.PARENT_COMMODITY), ["id_item"], "id_attr", "val_string_attr",
        INVOICE_PARENT_ATTRIBUTES,
    ).withColumnRenamed("id_item", "item_id_parent_sku")
    texts = listagg(
        descriptions(t).where(F.col("seq_descr").between(*fv.PARENT_DESCRIPTION_ROWS)),
        ["id_item"], "descr_addl", "parent_description", ", ", ["seq_descr"],
    ).withColumnRenamed("id_item", "item_id_parent_sku")
    level = reorder_points(t).select("id_item", F.col("id_loc_home").alias("id_loc"), F.col("level_rop").alias("reorder_level"))
    places = one_per(t.location, "id_loc").select("id_loc", F.col("descr").alias("location_name"))
    customers = customers_with_group(t).withColumnRenamed("customer_id", "id_cust_soldto")
    flags = latest_use_flags(t).withColumnRenamed("id_item_par", "id_item")
    # parents are found for the items, not for every line; then joins on one key follow each other
    attributes = attributes.join(parent_attributes, "item_id_parent_sku", "left").join(texts, "item_id_parent_sku", "left")
    joined = (
        lines.join(header, "id_invc", "left")
        .join(customers, "id_cust_soldto", "left")
        .join(reps, "sales_rep_id", "left")
        .join(places, "id_loc", "left")
        .join(product, "id_item", "left")
        .join(costs, "code_cat_cost", "left")
        .join(categories, "code_cat_prdt", "left")
        .join(attributes, "id_item", "left")
        .join(item_verticals(t), "id_item", "left")
        .join(flags, "id_item", "left")
        .join(level, ["id_item", "id_loc"], "left")
    )
    return joined.select(
        F.col("id_ord").alias("order_id"), F.col("seq_line_ord").alias("line_number"),
        F.col("date_book_last").alias("ordered_date"), F.col("flag_stk").alias("stock_flag"),
        F.col("id_invc").alias("invoice_id"), "freight_cost", "sales_tax", "customer_name",
        F.col("id_cust_soldto").alias("customer_id"), "customer_type", "cust_group_code", "cust_group_name",
        "ship_to_city", "seq_shipto", F.col("id_item").alias("item_id"), "product_description",
        F.coalesce(F.concat("code_cat_cost", F.lit(" - "), "cost_name"), F.lit(fv.INVALID_COST_CATEGORY)).alias("cost_category"),
        F.coalesce(F.concat("code_cat_prdt", F.lit(" - "), "prdt_name"), F.lit("INVALID PRODUCT CATEGORY")).alias("product_category"),
        "vertical_label", "category_label", *INVOICE_ATTRIBUTES.values(), *INVOICE_PARENT_ATTRIBUTES.values(),
        F.coalesce("parent_description", F.lit(fv.MISSING_PARENT_DESCRIPTION)).alias("parent_description"),
        "prop_65", F.col("date_invc").alias("invoice_date"), "reorder_level",
        F.col("date_prom").alias("promise_date"), F.col("qty_ship").alias("quantity_shipped"),
        F.col("price_net").alias("total_price"), decode_vp_tail("cost_unit_vp").alias("unit_cost"),
        "sales_rep_name", F.concat("id_loc", F.lit(" - "), "location_name").alias("location_label"),
        F.lit("Shipped").alias("booking_type"),
    )
