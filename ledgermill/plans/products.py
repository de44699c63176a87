"""Product models: product master, parent status, warning flag, layered checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import fixed_values as fv
from ledgermill.functions.amounts import cost_with_fallback, minutes, total_of_present
from ledgermill.functions.text import describe, first_rule, flag_if
from ledgermill.operators import quality as q
from ledgermill.operators.aggregates import listagg, pivot_attrs, text_list
from ledgermill.operators.dedup import dedup_by_priority, latest, one_per, prefer
from ledgermill.operators.filters import unexpired
from ledgermill.operators.keys import trim_keys
from ledgermill.plans.inventory import items


def attributes(t) -> DataFrame:
    """The newest value per commodity, item and attribute."""
    rows = trim_keys(t.item_attribute, ["id_item", "id_attr"])
    return latest(rows, ["code_comm", "id_item", "id_attr"], ["rowid"]).select(
        "code_comm", "id_item", "id_attr", "val_string_attr"
    )


def sku_attributes(t) -> DataFrame:
    """Attribute columns of every SKU; one without attributes has blanks.

    Items without commodity code drop out, as do parents.
    """
    skus = items(t).where(F.col("code_comm") != fv.PARENT_COMMODITY).select("id_item", "code_comm")
    joined = skus.join(attributes(t), ["id_item", "code_comm"], "left")
    return pivot_attrs(joined, ["id_item"], "id_attr", "val_string_attr", fv.SKU_ATTRIBUTES)


def parent_attributes(t) -> DataFrame:
    rows = attributes(t).where(F.col("code_comm") == fv.PARENT_COMMODITY)
    return pivot_attrs(rows, ["id_item"], "id_attr", "val_string_attr", fv.PARENT_ATTRIBUTES).withColumnRenamed(
        "id_item", "item_id_parent_sku"
    )


def descriptions(t) -> DataFrame:
    return latest(trim_keys(t.item_description, ["id_item"]), ["id_item", "seq_descr"], ["rowid"])


def parents(t, sep: str = "") -> DataFrame:
    """Parent items with status and description, built from its numbered rows in order."""
    heads = items(t).where(F.col("code_comm") == fv.PARENT_COMMODITY).select(
        "id_item", F.col("flag_stat_item").alias("parent_status")
    )
    rows = descriptions(t).where(F.col("seq_descr").between(*fv.PARENT_DESCRIPTION_ROWS))
    texts = listagg(rows, ["id_item"], "descr_addl", "parent_description", sep, ["seq_descr"])
    return heads.join(texts, "id_item", "left").withColumnRenamed("id_item", "item_id_parent_sku")


def build_warning_flags(t, asof: dt.date) -> DataFrame:
    """``Y`` per parent where a component's latest use is under it and carries the warning text."""
    active = items(t).where(F.col("flag_stat_item") == "A").select(F.col("id_item").alias("id_item_comp"))
    edges = unexpired(trim_keys(t.product_structure, ["id_item_par", "id_item_comp"]), "date_eff_end", asof).join(
        active, "id_item_comp", "left_semi"
    )
    newest = latest(edges, ["id_item_comp"], ["date_eff_end", "rowid"])
    warned = descriptions(t).where(F.col("descr_addl").like(f"%{fv.WARNING_TEXT}%")).select(
        F.col("id_item").alias("id_item_comp")
    )
    hits = newest.join(warned, "id_item_comp", "left_semi").select("id_item_par").distinct()
    all_parents = edges.select("id_item_par").distinct()
    return all_parents.join(hits.withColumn("hit", F.lit(True)), "id_item_par", "left").select(
        "id_item_par", flag_if(F.col("hit")).alias("prop_65")
    )


def costs(t) -> DataFrame:
    return latest(trim_keys(t.item_cost, ["id_item"]), ["id_item"], ["rowid"])


def primary_vendors(t) -> DataFrame:
    offers = trim_keys(t.item_vendor, ["id_item", "id_vnd_payto", "id_vnd_ordfm"]).where(F.col("flag_vnd_prim") == "P")
    return dedup_by_priority(offers, ["id_item"], ["id_vnd_payto"]).select(
        "id_item", F.col("id_vnd_payto").alias("primary_vendor_pay_to_id"),
        F.col("id_vnd_ordfm").alias("primary_vendor_order_from_id"),
        F.col("id_item_vnd").alias("primary_vendor_item_id"),
    )


def secondary_vendors(t) -> DataFrame:
    names = dedup_by_priority(trim_keys(t.vendor_payto, ["id_vnd"]), ["id_vnd"], []).select(
        F.col("id_vnd").alias("id_vnd_payto"), "name_vnd"
    )
    offers = trim_keys(t.item_vendor, ["id_item", "id_vnd_payto"]).where(F.col("flag_vnd_prim") == "S")
    rows = offers.select("id_item", "id_vnd_payto").join(names, "id_vnd_payto", "left")
    return rows.where(F.col("id_vnd_payto").isNotNull()).groupBy("id_item").agg(
        text_list("id_vnd_payto").alias("secondary_vendor_ids"),
        text_list("name_vnd", ", ", ["id_vnd_payto"]).alias("secondary_vendor_names"),
    )


def item_home(inventory: DataFrame) -> DataFrame:
    """One location per item: home, then any with a secondary list, then the smallest id."""
    return dedup_by_priority(
        inventory.select("item_id_child_sku", "inventory_location_id", "secondary_location_list"),
        ["item_id_child_sku"],
        [
            prefer(F.trim("inventory_location_id") == fv.HOME_LOCATION),
            F.when(F.col("inventory_location_id").isNull(), 1).otherwise(0),
            F.when(F.col("secondary_location_list").isNull(), 1).otherwise(0),
            "inventory_location_id", "secondary_location_list",
        ],
    ).select(
        F.col("item_id_child_sku").alias("id_item"),
        F.col("inventory_location_id").alias("item_primary_location"),
        F.col("secondary_location_list").alias("item_secondary_locations"),
    )


def build_products(t, inventory: DataFrame, asof: dt.date) -> DataFrame:
    """Product master: one row per SKU (parents excluded)."""
    base = items(t).where(F.col("code_comm") != fv.PARENT_COMMODITY)
    categories = dedup_by_priority(
        t.product_category.where(F.trim(F.coalesce("code_type_cust", F.lit(""))) == ""), ["code_cat_prdt"], []
    ).select(F.trim("code_cat_prdt").alias("code_cat_prdt"), F.col("descr").alias("vertical_name"))
    cost_names = one_per(t.cost_category, "code_cat_cost").select("code_cat_cost", F.col("descr").alias("cost_name"))
    stocked = dedup_by_priority(trim_keys(t.stock_list, ["id_item"]), ["id_item"], []).withColumn("listed", F.lit(True))
    joined = (
        base.join(costs(t).drop("rowid"), "id_item", "left")
        .join(cost_names, "code_cat_cost", "left")
        .join(categories, "code_cat_prdt", "left")
        .join(stocked, "id_item", "left")
        .join(sku_attributes(t), "id_item", "left")
        .join(primary_vendors(t), "id_item", "left")
        .join(secondary_vendors(t), "id_item", "left")
        .join(item_home(inventory), "id_item", "left")
        .join(parent_attributes(t), "item_id_parent_sku", "left")
        .join(parents(t), "item_id_parent_sku", "left")
        .join(
            build_warning_flags(t, asof).withColumnRenamed("id_item_par", "item_id_parent_sku"),
            "item_id_parent_sku", "left",
        )
    )
    own_text = describe("descr_1", "descr_2")
    vertical = F.upper(
        F.coalesce(F.concat("code_cat_prdt", F.lit(" - "), "vertical_name"), F.lit(fv.INVALID_VERTICAL))
    )
    fabric = vertical.contains("FABRIC") & F.col("parent_description").isNull()
    upper = [
        n for n in (*fv.SKU_ATTRIBUTES.values(), *fv.PARENT_ATTRIBUTES.values()) if n != "item_id_parent_sku"
    ]
    return joined.select(
        F.col("id_item").alias("item_id_child_sku"),
        own_text.alias("item_description_child_sku"),
        F.col("code_cat_cost").alias("item_cost_category_id"),
        F.upper(F.coalesce("cost_name", F.lit(fv.INVALID_COST_CATEGORY))).alias("item_cost_category"),
        F.upper("code_cat_prdt").alias("item_vertical_code"),
        vertical.alias("item_vertical"),
        F.col("code_comm").alias("item_commodity_code"),
        "item_id_parent_sku",
        F.upper(
            F.when(fabric, own_text).otherwise(
                F.coalesce("parent_description", F.lit(fv.MISSING_PARENT_DESCRIPTION))
            )
        ).alias("item_description_parent_sku"),
        *(F.upper(n).alias(n) for n in upper),
        cost_with_fallback("cost_matl_va_crnt", "cost_matl_va_std").alias("cost_material_calculated"),
        cost_with_fallback("cost_labor_va_crnt", "cost_labor_va_std").alias("cost_labor_calculated"),
        total_of_present("cost_matl_va_crnt", "cost_labor_va_crnt").alias("cost_total_calculated"),
        F.col("cost_total_accum_crnt").alias("cost_total_current"),
        F.col("cost_total_accum_std").alias("cost_total_standard"),
        minutes("hr_labor_va_crnt").alias("minutes_labor_current"),
        minutes("hr_mach_va_crnt").alias("minutes_machine_current"),
        F.col("code_um_price").alias("unit_of_measure_price"),
        F.col("code_user_1_im").alias("item_code_user_1"),
        F.col("key_alt").alias("item_alt_key"),
        F.col("wgt_item").alias("item_weight"),
        "primary_vendor_order_from_id", "primary_vendor_pay_to_id", "primary_vendor_item_id",
        "secondary_vendor_ids", "secondary_vendor_names",
        F.upper("adv").alias("item_advertised_flag"),
        F.upper("prop_65").alias("item_prop_65"),
        "item_primary_location", "item_secondary_locations",
        F.upper("flag_stat_item").alias("item_status_child"),
        F.upper("parent_status").alias("item_status_parent"),
        flag_if(F.col("listed")).alias("item_stocked_flag"),
    )


def build_parent_status(t) -> DataFrame:
    """Status of child and parent per SKU; a parent counts as active while any child is."""
    children = items(t).where(F.col("code_comm") != fv.PARENT_COMMODITY).select(
        "id_item", F.col("flag_stat_item").alias("child_status")
    )
    linked = children.join(sku_attributes(t).select("id_item", "item_id_parent_sku"), "id_item")
    family = linked.join(parents(t).select("item_id_parent_sku", "parent_status"), "item_id_parent_sku")
    active = family.groupBy("item_id_parent_sku").agg(F.count_if(F.col("child_status") == "A").alias("active_children"))
    return family.join(active, "item_id_parent_sku").select(
        "id_item", "child_status", "item_id_parent_sku", "parent_status", "active_children",
        F.when(F.col("active_children") > 0, "A").otherwise(F.col("parent_status")).alias("adjusted_parent_status"),
        flag_if((F.col("child_status") == "A") & (F.col("parent_status") == "O")).alias("active_under_obsolete"),
    )


def warning_flag_checks(flags: DataFrame) -> DataFrame:
    return q.run_checks(
        [
            q.check_rows_exist(flags, "P65-01", notes="rows exist"),
            q.check_duplicates(flags, ["id_item_par"], "P65-02", notes="one row per parent"),
            q.check_domain(flags, "prop_65", ["Y", "N"], "P65-03", notes="only Y or N"),
        ]
    )


def product_checks(t, products: DataFrame) -> DataFrame:
    """Quality layer of the product pipeline."""
    key = ["item_id_child_sku"]
    skus = items(t).where(F.col("code_comm") != fv.PARENT_COMMODITY).select("id_item")
    return q.run_checks(
        [
            q.check_null_keys(products, key, "PRD-01", notes="keys filled"),
            q.check_duplicates(products, key, "PRD-02", notes="one row per SKU"),
            q.check_row_stability(skus, products, "PRD-03", notes="joins keep the grain"),
            q.check_domain(products, "item_status_child", ["A", "O"], "PRD-04", notes="status in domain"),
            q.check_coverage(skus, costs(t), ["id_item"], 80, "PRD-05", notes="cost rows found"),
            q.check_coverage(skus, primary_vendors(t), ["id_item"], 90, "PRD-06", notes="primary vendor found"),
        ]
    )


def missing_parents(t) -> DataFrame:
    """SKUs without parent, with the commodity code a parent id is stored under instead."""
    lost = sku_attributes(t).where(F.col("item_id_parent_sku") == "").select("id_item")
    elsewhere = attributes(t).where(F.col("id_attr") == "ID_PARENT").select(
        "id_item", F.col("code_comm").alias("attr_code_comm"), F.col("val_string_attr").alias("stored_parent")
    )
    base = items(t).select("id_item", F.col("code_comm").alias("base_code_comm"))
    return lost.join(base, "id_item").join(elsewhere, "id_item", "left")


def parent_status_distribution(t) -> DataFrame:
    described = parents(t).where(F.col("parent_description").isNotNull())
    return described.groupBy("parent_status").agg(F.count(F.lit(1)).alias("parents"))
