"""ERP-shaped capture tables derived from the star-schema test tables.

The models of ``ledgermill.plans`` read ERP captures: order headers and lines
(active and archived), shipments, bookings, items, inventory, vendors, shop
orders.  Those captures are not available here, so each one is derived by Spark
from the given tables, over all of their rows.  The statements use only SQL
that Spark and DuckDB both accept, so a check can derive identical input.

Padded keys, repeated versions, blank and malformed text and missing rows are
put in on purpose: they are what the models have to cope with.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgermill.session import file_state, remove_folder, shared_folder, shuffles_released
from ledgermill.sources.tables import load, load_path, write_table

STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_REF = re.compile(r"\{(\w+)\}")
#: Captures that are groups of a larger table; they are stored as bronze tables are, the others are views.
#: Those that join lines with orders stay views too: a query reads them once, needs few of their columns
#: and goes on by the order they already lie by.
STORED = {
    "fiscal_period", "item_attribute", "item_base", "item_description", "item_location", "item_vendor",
    "work_center_minutes", "work_center_staff",
}
#: Stored captures whose last step is a shuffle; its partitions are brought to a good size when they are read.
GROUPED = {"fiscal_period", "item_vendor", "work_center_minutes", "work_center_staff"}


def _loc(expr: str) -> str:
    return (
        f"CASE {expr} % 5 WHEN 0 THEN '10' WHEN 1 THEN '20' WHEN 2 THEN '50' "
        f"WHEN 3 THEN '90' ELSE '130' END"
    )


_PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
_ORDERED = "CAST(o_orderdate AS DATE)"
_SHIPPED = "CAST(l_shipdate AS DATE)"
_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_TAX = "CAST(round(l_tax * 100) AS INT)"
_DISC = "CAST(round(l_discount * 100) AS INT)"
_QTY = "CAST(l_quantity AS BIGINT)"
_NET = (
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) "
    "AS DECIMAL(18,4))"
)
_COST = f"CAST(CAST(floor({_CENTS} * 6 / 10) AS BIGINT) AS DECIMAL(18,2))"
_VENDOR = "CASE s_suppkey WHEN 1 THEN '10602' WHEN 2 THEN 'D79008' ELSE concat('V', s_suppkey) END"
_LINE_VENDOR = _VENDOR.replace("s_suppkey", "l_suppkey")
_COMMODITY = (
    "CASE p_type WHEN 'ECONOMY' THEN 'FG' WHEN 'STANDARD' THEN 'RM1' WHEN 'PROMO' THEN 'FAB' "
    "WHEN 'SMALL' THEN 'DF2' ELSE 'FG' END"
)
_PARENT = "concat('PAR-', p_brand, '-', p_type)"


def _packed(cents: str) -> str:
    """Packed price text: scale digit, five filler digits, ten-digit mantissa."""
    return (
        f"CASE WHEN l_returnflag = 'A' THEN concat('000000', lpad(CAST({cents} AS STRING), 10, '0')) "
        f"ELSE concat('200000', lpad(CAST({cents} * 100 AS STRING), 10, '0')) END"
    )


def _header(where: str) -> str:
    return f"""
    SELECT o_orderkey AS id_ord, concat('  C', o_custkey) AS id_cust_soldto,
           CAST(1 + o_orderkey % 3 AS INT) AS seq_shipto, concat('B', o_custkey, ' ') AS id_cust_billto,
           concat('PO', o_orderkey) AS id_po_cust, {_PRIORITY} AS type_ord_cp,
           CASE {_PRIORITY} WHEN 1 THEN 'IC' WHEN 2 THEN 'DS' ELSE 'EU' END AS code_cust_1,
           o_orderstatus AS code_stat_ord, {_ORDERED} AS date_ord, {_ORDERED} + {_PRIORITY} AS date_add,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amt_ord_total,
           CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS cost_total,
           CAST(o_orderkey % 100 AS DECIMAL(18,2)) AS amt_frt,
           concat(' R', o_custkey % 25) AS id_slsrep_1,
           CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS flag_ackn,
           CASE WHEN o_orderstatus <> 'P' THEN {_ORDERED} + 4 END AS date_ackn_last,
           CASE {_PRIORITY} WHEN 1 THEN 'WEB' WHEN 2 THEN 'EDI ' ELSE ' USR' END AS id_user_add,
           o_orderkey AS rowid
    FROM {{orders}} WHERE {where}"""


def _line(where: str) -> str:
    return f"""
    SELECT l_orderkey AS id_ord, l_linenumber AS seq_line_ord, concat('I', l_partkey, '  ') AS id_item,
           {_loc('l_suppkey')} AS id_loc, {_QTY} AS qty_org,
           CASE WHEN l_linestatus = 'O' THEN {_QTY} ELSE 0 END AS qty_open,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS qty_bo,
           CASE WHEN l_returnflag = 'A' THEN {_QTY} ELSE 0 END AS qty_ship_total,
           CASE WHEN l_linestatus = 'O' THEN {_QTY} ELSE 0 END + {_DISC} AS qty_book,
           CASE WHEN l_returnflag = 'R' THEN {_QTY} - 1 END AS qty_rel,
           CASE WHEN {_TAX} <= 4 THEN {_DISC} ELSE 0 END AS qty_alloc,
           {_SHIPPED} AS date_rqst,
           CASE WHEN l_returnflag = 'N' THEN {_SHIPPED} WHEN {_TAX} = 1 THEN NULL
                ELSE {_SHIPPED} + 5 END AS date_prom,
           CASE WHEN l_returnflag = 'R' THEN {_SHIPPED} - 3 END AS date_pick_last,
           CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS flag_pick,
           {_SHIPPED} - 30 AS date_add, CASE WHEN {_TAX} <= 4 THEN 'S' ELSE 'N' END AS flag_stk,
           {_NET} AS price_net, {_packed(_CENTS)} AS price_list_vp,
           {_packed(f'CAST(floor({_CENTS} * 9 / 10) AS BIGINT)')} AS price_sell_net_vp,
           CASE {_TAX} WHEN 0 THEN '' WHEN 8 THEN 'N/A BAD VALUE ##'
                ELSE {_packed(f'CAST(floor({_CENTS} * 6 / 10) AS BIGINT)')} END AS cost_unit_vp,
           CASE WHEN l_returnflag <> 'A' THEN concat('SO', l_orderkey) WHEN {_TAX} = 2 THEN ''
           END AS id_so,
           0 AS sufx_so, {_loc('l_orderkey')} AS id_loc_so,
           CASE l_partkey % 6 WHEN 0 THEN '05' WHEN 1 THEN '06' WHEN 2 THEN '10' WHEN 3 THEN '20'
                WHEN 4 THEN '25' ELSE '60' END AS code_cat_prdt,
           l_orderkey * 10 + l_linenumber AS rowid
    FROM {{lineitem}} WHERE {where}"""


def _comment(version: int) -> str:
    return f"""
    SELECT o_orderkey AS id_ord,
           CASE {_PRIORITY} WHEN 1 THEN 'rush #mo fabric' WHEN 2 THEN 'hold for #MO zipper'
                WHEN 3 THEN 'ready v{version}' WHEN 4 THEN NULL ELSE 'call v{version}' END AS comment,
           {_ORDERED} + {10 + version} AS date_est_ship, {_ORDERED} + {version} AS date_add,
           {f"CASE WHEN {_PRIORITY} < 4 THEN {_ORDERED} + 2 END" if version else "CAST(NULL AS DATE)"} AS date_chg,
           CASE o_orderstatus WHEN 'F' THEN {"'D'" if version else "''"} WHEN 'P' THEN '' END AS flag_del,
           o_orderkey * 2 + {version} AS rowid
    FROM {{orders}}"""


def _ship_header(k: int) -> str:
    return f"""
    SELECT o_orderkey AS id_ord, o_orderkey * 10 + {k} AS id_ship,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderkey * 10 + {k} END AS id_invc,
           {_ORDERED} + {10 + k} AS date_ship, {_ORDERED} AS date_ord,
           CAST(o_orderkey % 50 + {k} AS DECIMAL(18,2)) AS amt_frt,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS code_stat_confirm
    FROM {{orders}}"""


def _lading(k: int, version: int) -> str:
    return f"""
    SELECT o_orderkey AS id_ord, o_orderkey * 10 + {k} AS id_ship,
           concat('CARR', {_PRIORITY} + {version}) AS id_carrier, o_orderkey % 90 + {version} AS wgt_content,
           {_ORDERED} + {11 + version} AS date_add,
           {"o_orderkey * 4 + %d" % (2 * k + version) if version else "CASE WHEN o_orderstatus = 'O' THEN o_orderkey * 4 + %d END" % (2 * k)} AS rowid
    FROM {{orders}} WHERE o_orderstatus <> 'P'"""


def _invoice_header(k: int) -> str:
    return f"""
    SELECT o_orderkey * 10 + {k} AS id_invc, o_orderkey AS id_ord, CAST(1 + o_orderkey % 3 AS INT) AS seq_shipto,
           CAST(o_orderkey % 70 + {k} AS DECIMAL(18,2)) AS amt_frt,
           CAST(o_orderkey % 30 AS DECIMAL(18,2)) AS tax_sls, concat(' R', o_custkey % 25) AS id_slsrep_1,
           concat('City', o_custkey % 40) AS city
    FROM {{orders}} WHERE o_orderstatus <> 'O'"""


def _booking_header(version: int) -> str:
    return f"""
    SELECT o_orderkey AS id_ord, concat('C', o_custkey) AS id_cust, CAST(1 + o_orderkey % 3 AS INT) AS seq_shipto,
           {_ORDERED} + {version} AS date_ord,
           CASE {_PRIORITY} WHEN 1 THEN 'IC' WHEN 2 THEN 'IP' WHEN 3 THEN 'DS' WHEN 4 THEN 'EU' END AS code_cust_1,
           CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 END AS id_invc,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amt_invc, o_orderkey * 2 + {version} AS rowid
    FROM {{orders}}"""


def _shop_header(suffix: int, where: str) -> str:
    return f"""
    SELECT {_loc('o_orderkey')} AS id_loc,
           CASE WHEN o_orderstatus = 'P' AND {_PRIORITY} = 3 THEN concat('PROD', o_orderkey)
                ELSE concat('  SO', o_orderkey) END AS id_so,
           {suffix} AS sufx_so,
           CASE WHEN {_PRIORITY} = 5 THEN concat('I', o_custkey, '#') ELSE concat('I', o_custkey) END AS id_item_par,
           concat('Item ', o_custkey) AS descr_item_1,
           CASE WHEN o_custkey % 3 > 0 THEN concat('rev ', o_custkey % 9) END AS descr_item_2,
           CASE WHEN o_orderstatus = 'F' THEN 'C' WHEN {_PRIORITY} IN (1, 5) THEN 'R'
                WHEN {_PRIORITY} = 3 THEN 'A' ELSE 'S' END AS stat_rec_so,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS qty_ord,
           CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 1000) AS BIGINT)
                ELSE o_orderkey % 9 END AS qty_cmpl,
           CASE WHEN o_orderstatus = 'F' THEN 0
                ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) + {suffix} END AS qty_onord,
           {_ORDERED} AS date_add, {_ORDERED} + 3 AS date_start_ord, {_ORDERED} + 30 AS date_due_ord,
           CASE WHEN o_orderstatus = 'F' THEN {_ORDERED} + 28 END AS date_cmpl,
           CASE WHEN o_orderkey % 4 > 0 THEN {_ORDERED} + {suffix} END AS date_chg_last,
           CASE WHEN o_orderkey % 4 > 0 THEN {_ORDERED} + 5 END AS date_start_oper_1st,
           CASE o_orderkey % 4 WHEN 0 THEN 'AS' WHEN 1 THEN '1A' WHEN 2 THEN 'KT' ELSE 'ZZ' END AS id_buyer,
           CASE WHEN o_custkey % 2 = 0 THEN '05' ELSE '10' END AS code_cat_cost
    FROM {{orders}} WHERE {where}"""


def _operation(oper: int, status: str, where: str) -> str:
    return f"""
    SELECT {_loc('o_orderkey')} AS id_loc,
           CASE WHEN o_orderstatus = 'P' AND {_PRIORITY} = 3 THEN concat('PROD', o_orderkey)
                ELSE concat('  SO', o_orderkey) END AS id_so,
           0 AS sufx_so, {oper} AS id_oper,
           CASE o_custkey % 5 WHEN 0 THEN '3300' WHEN 1 THEN '3301' WHEN 2 THEN '3302'
                WHEN 3 THEN '900' ELSE '8000' END AS id_wc,
           {status} AS stat_rec_oper,
           CAST(o_orderkey % 40 AS DECIMAL(18,2)) AS hr_labor_sf,
           CAST(o_orderkey % 37 AS DECIMAL(18,2)) AS hr_labor_actual_sf,
           CAST(o_orderkey % 23 AS DECIMAL(18,2)) AS hr_mach_sf,
           {_ORDERED} + 4 AS date_start_oper, {_ORDERED} + {oper % 97} AS date_due_oper,
           o_orderkey % 9 AS qty_cmpl, CAST(floor(o_totalprice / 1000) AS BIGINT) AS qty_ord
    FROM {{orders}} WHERE {where}"""


def _approval(version: int) -> str:
    return f"""
    SELECT concat(' SO', o_orderkey) AS id_so, 0 AS sufx_so, {_ORDERED} + {1 + version} AS date_approved,
           CAST(80000 + o_orderkey % 60 + {version} AS INT) AS time_approved
    FROM {{orders}} WHERE {_PRIORITY} <= 3"""


def _job_card(where: str) -> str:
    return f"SELECT concat('   SO', o_orderkey) AS id_so, 0 AS sufx_so FROM {{orders}} WHERE {where}"


def _item_version(version: int) -> str:
    return f"""
    SELECT concat('I', p_partkey{", ' '" if version else ""}) AS id_item, p_name AS descr_1,
           CASE WHEN p_size > 1 THEN p_brand END AS descr_2,
           CASE WHEN p_size < 50 THEN {_COMMODITY} END AS code_comm,
           CASE WHEN p_size >= 10 THEN '05' WHEN p_size >= 5 THEN '10' ELSE '99' END AS code_cat_cost,
           CASE p_partkey % 6 WHEN 0 THEN '05' WHEN 1 THEN '06' WHEN 2 THEN '10' WHEN 3 THEN '20'
                WHEN 4 THEN '25' ELSE '60' END AS code_cat_prdt,
           {"CASE WHEN p_size <= 40 THEN 'A' ELSE 'O' END" if version else "'O'"} AS flag_stat_item,
           CAST(p_size AS DECIMAL(18,2)) AS wgt_item, concat('u', p_size % 4) AS code_user_1_im,
           CASE WHEN p_size % 2 = 0 THEN 'EA' ELSE 'PR' END AS code_um_price,
           concat('ALT', p_partkey) AS key_alt, p_partkey * 2 + {version} AS rowid
    FROM {{part}}"""


def _attr(name: str, value: str, where: str = "p_size < 50", rowid: int = 1, comm: str = _COMMODITY) -> str:
    return f"""
    SELECT concat(' I', p_partkey) AS id_item, {comm} AS code_comm, '{name}' AS id_attr,
           {value} AS val_string_attr, p_partkey * 10 + {rowid} AS rowid
    FROM {{part}} WHERE {where}"""


def _parent_attr(name: str, value: str, rowid: int = 1) -> str:
    return f"""
    SELECT {_PARENT} AS id_item, 'PAR' AS code_comm, '{name}' AS id_attr, {value} AS val_string_attr,
           min(p_partkey) * 10 + {rowid} AS rowid
    FROM {{part}} GROUP BY p_brand, p_type"""


def _descr_parent(seq: int, value: str, rowid: int) -> str:
    return f"""
    SELECT {_PARENT} AS id_item, {seq} AS seq_descr, {value} AS descr_addl, min(p_partkey) * 10 + {rowid} AS rowid
    FROM {{part}} GROUP BY p_brand, p_type"""


def _reorder(home: str, level: str, version: int) -> str:
    return f"""
    SELECT concat('I', p_partkey) AS id_item, CAST(NULL AS STRING) AS id_loc, {home} AS id_loc_home,
           {level} AS level_rop, p_size % 7 AS qty_min_rop, 5 AS qty_mult_ord_rop, p_size AS qty_ord_econ,
           p_size % 11 AS lt_rop, DATE '2000-01-01' + {version} AS date_add, p_partkey * 4 + {version} AS rowid
    FROM {{part}}"""


def _inventory_side(col: str) -> str:
    return f"CASE ({col}) % 6 WHEN 0 THEN 'AS' WHEN 1 THEN 'KT' WHEN 2 THEN '1A' WHEN 3 THEN 'RM' WHEN 4 THEN 'ZZ' END"


_STATUS_3999 = "CASE o_orderkey % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'P' ELSE 'R' END"
_STATUS_9999 = "CASE o_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'P' WHEN 2 THEN 'A' ELSE 'C' END"


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


TABLES: dict[str, str] = {
    # orders
    "order_header": _header("o_orderstatus IN ('O', 'P')"),
    "order_header_perm": _header("o_orderstatus IN ('F', 'P')"),
    "order_line": _line("l_linestatus = 'O'"),
    "order_line_perm": _line("l_linestatus = 'F'"),
    "order_comment": _union(_comment(0), _comment(1)),
    "line_comment": f"""
    SELECT l_orderkey AS id_ord, l_linenumber AS seq_line_ord,
           CASE l_returnflag WHEN 'R' THEN 'Ship order complete' WHEN 'N' THEN 'SHIP LINE COMPLETE'
                ELSE 'call ahead' END AS note,
           {_SHIPPED} - 9 AS date_add, CASE WHEN l_linestatus = 'F' THEN {_SHIPPED} - 7 END AS date_chg,
           l_orderkey * 1000000 + l_partkey AS rowid
    FROM {{lineitem}}""",
    # shipments and invoices
    "shipment_header": _union(_ship_header(0), _ship_header(1)),
    "shipment_line": f"""
    SELECT l_orderkey AS id_ord, l_orderkey * 10 + l_linenumber % 2 AS id_ship, l_linenumber AS seq_line_ord,
           concat('I', l_partkey) AS id_item, {_loc('l_suppkey')} AS id_loc,
           'Part' AS descr_1, CASE WHEN l_returnflag = 'A' THEN concat('no ', l_partkey) END AS descr_2,
           CASE WHEN l_returnflag = 'R' THEN {_QTY} - 1 ELSE {_QTY} END AS qty_ship, {_QTY} AS qty_open,
           l_linenumber AS qty_carton,
           CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'O' THEN 0 END AS flag_confirm_ship,
           {_NET} AS price_net
    FROM {{lineitem}} WHERE l_returnflag IN ('A', 'R')""",
    "bill_of_lading": _union(_lading(0, 0), _lading(0, 1), _lading(1, 0)),
    "invoice_header": _union(_invoice_header(0), _invoice_header(1)),
    "invoice_line": f"""
    SELECT l_orderkey * 10 + l_linenumber % 2 AS id_invc, l_orderkey AS id_ord, l_linenumber AS seq_line_ord,
           concat('I', l_partkey) AS id_item, {_loc('l_suppkey')} AS id_loc, {_SHIPPED} + 2 AS date_invc,
           {_SHIPPED} - 20 AS date_book_last, {_SHIPPED} AS date_prom, {_QTY} AS qty_ship, {_NET} AS price_net,
           concat('C', o_custkey) AS id_cust_soldto, CASE WHEN {_TAX} <= 4 THEN 'S' ELSE 'N' END AS flag_stk,
           CASE WHEN {_TAX} = 0 THEN ' ' ELSE
                concat('000000', lpad(CAST(CAST(floor({_CENTS} * 6 / 10) AS BIGINT) * 100 AS STRING), 10, '0'))
           END AS cost_unit_vp
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'""",
    # bookings
    "booking_header": _union(_booking_header(0), _booking_header(1)),
    "booking_line": f"""
    SELECT o_orderkey AS id_ord, concat('C', o_custkey) AS id_cust, CAST(1 + o_orderkey % 3 AS INT) AS seq_shipto,
           l_linenumber AS seq_line_ord, l_suppkey AS seq_rec,
           CASE WHEN l_quantity = 1 THEN 'REWORK' ELSE concat('I', l_partkey) END AS id_item,
           {_loc('l_suppkey')} AS id_loc, 'Part' AS descr_1,
           CASE WHEN l_returnflag = 'A' THEN concat('no ', l_partkey) END AS descr_2, {_QTY} AS qty_ship,
           {_NET} AS sls, CAST({_COST} / 100 AS DECIMAL(18,4)) AS cost,
           {_SHIPPED} - 20 AS date_book_last,
           CASE WHEN l_returnflag = 'R' THEN 'RMA' WHEN l_returnflag = 'N' THEN 'WEB' ELSE 'USR' END AS id_user_add
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "sales_transaction": _union(
        *(
            f"""
    SELECT o_orderkey AS order_id, l_linenumber AS line_number, {_ORDERED} AS ordered_date,
           CASE WHEN {_TAX} <= 4 THEN 'S' ELSE 'N' END AS stock_flag,
           {"CAST(NULL AS BIGINT)" if booked else "o_orderkey * 10 + l_linenumber % 2"} AS invoice_id,
           concat('  C', o_custkey) AS customer_id, CAST(1 + o_orderkey % 3 AS INT) AS seq_shipto,
           concat(' R', o_custkey % 25) AS sales_rep_id, concat('I', l_partkey) AS item_id,
           {_loc('l_suppkey')} AS location_id,
           {"CAST(NULL AS DATE)" if booked else _SHIPPED} AS invoice_date,
           CASE WHEN {_DISC} = 0 THEN NULL ELSE {_ORDERED} + CAST(2 * {_TAX} + l_linenumber AS INT) END AS promise_date,
           {_QTY} AS unit_quantity, {_NET} AS total_price, CAST({_COST} / 100 AS DECIMAL(18,4)) AS unit_cost,
           {_ORDERED if booked else _SHIPPED} AS calendar_date, '{"Booked" if booked else "Shipped"}' AS booking_type
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE l_linestatus = '{"O" if booked else "F"}'"""
            for booked in (True, False)
        )
    ),
    # customers
    "customer_soldto": """
    SELECT concat('C', c_custkey) AS id_cust, c_name AS name_cust,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'IC' WHEN 'BUILDING' THEN 'DS' WHEN 'MACHINERY' THEN 'EU'
                WHEN 'FURNITURE' THEN NULL ELSE 'RT' END AS code_cust,
           concat('A', c_nationkey % 4) AS code_user_2_ar,
           CASE WHEN c_acctbal > 0 THEN concat('G', c_nationkey) END AS code_user_3_ar,
           concat('City', c_nationkey) AS city, concat('S', c_nationkey % 10) AS id_st,
           CAST(c_acctbal AS DECIMAL(18,2)) AS bal_ar,
           CASE WHEN c_acctbal < 0 THEN 'H' WHEN c_acctbal > 1000 THEN 'A' END AS code_stat_credit,
           concat('T', c_custkey % 3) AS code_terms
    FROM {customer}""",
    "customer_shipto": _union(
        *(
            f"""
    SELECT concat(' C', c_custkey) AS id_cust, {seq} AS seq_shipto, concat(c_name, ' dock {seq}') AS name_cust,
           concat('Dock', c_nationkey) AS city, concat('S', c_nationkey % 10) AS id_st
    FROM {{customer}} WHERE c_acctbal > {low}"""
            for seq, low in ((1, -100000), (2, 1000))
        )
    ),
    "customer_group": """
    SELECT concat('G', n_nationkey) AS group_code, n_name AS group_name FROM {nation} WHERE n_regionkey <> 2""",
    "sales_rep": "SELECT concat('R', n_nationkey) AS id_slsrep, concat('Rep ', n_name) AS name_slsrep FROM {nation}",
    "location": """
    SELECT * FROM (VALUES ('10', 'Home'), ('20', 'West'), ('50', 'South'), ('90', 'Border')) AS t(id_loc, descr)""",
    # items
    "item_base": _union(
        _item_version(0),
        _item_version(1),
        f"""
    SELECT {_PARENT} AS id_item, concat('Parent ', p_brand) AS descr_1, p_type AS descr_2, 'PAR' AS code_comm,
           '05' AS code_cat_cost, '10' AS code_cat_prdt,
           CASE WHEN count(*) % 2 = 0 THEN 'A' ELSE 'O' END AS flag_stat_item, CAST(0 AS DECIMAL(18,2)) AS wgt_item,
           'u0' AS code_user_1_im, 'EA' AS code_um_price, CAST(NULL AS STRING) AS key_alt, min(p_partkey) AS rowid
    FROM {{part}} GROUP BY p_brand, p_type""",
    ),
    "item_attribute": _union(
        _attr("ID_PARENT", _PARENT, "p_size BETWEEN 4 AND 49"),
        _attr("ID_PARENT", _PARENT, "p_size = 3", comm="'OLD'"),
        _attr("COLOR", "upper(p_name)", "p_size < 50", 2),
        _attr("COLOR", "'old colour'", "p_size < 50", 1),
        _attr("SIZE", "CAST(p_size AS STRING)", "p_size < 45"),
        _attr("CLASS", "p_type", "p_size < 30"),
        _attr("CERT_NUM", "concat('cert ', p_partkey)", "p_size < 12"),
        _attr("RBN_WC", "CASE p_size % 3 WHEN 0 THEN '3300' WHEN 1 THEN '3304' ELSE '' END", "p_size < 20"),
        _parent_attr("Z_VERTICAL", "CASE p_type WHEN 'ECONOMY' THEN 'AF' WHEN 'STANDARD' THEN 'FR' WHEN 'PROMO' "
                                   "THEN 'GV' WHEN 'SMALL' THEN 'TH' WHEN 'MEDIUM' THEN 'UL' ELSE 'CT' END"),
        _parent_attr("Z_CATEGORY", "CASE p_type WHEN 'ECONOMY' THEN 'CL' WHEN 'STANDARD' THEN 'HV' WHEN 'PROMO' "
                                   "THEN 'LE' WHEN 'SMALL' THEN 'HP' WHEN 'MEDIUM' THEN 'AD' ELSE 'ZZ' END"),
        _parent_attr("Z_BRAND", "p_brand", 3),
        _parent_attr("Z_BRAND", "'older brand'", 2),
        _parent_attr("PRODUCT LINE", "concat('line ', p_type)"),
        _parent_attr("BERRY", "CASE WHEN p_brand < 'Brand#2' THEN 'yes' ELSE 'no' END"),
    ),
    "item_description": _union(
        _descr_parent(800, "concat('Parent of ', p_brand)", 2),
        _descr_parent(800, "'stale text'", 1),
        _descr_parent(801, "concat(' / ', p_type)", 1),
        _descr_parent(700, "'not in the range'", 1),
        """
    SELECT concat('I', p_partkey) AS id_item, 900 AS seq_descr,
           CASE WHEN p_size % 9 = 0 THEN 'WARNING PROP 65 LABEL' ELSE 'plain' END AS descr_addl,
           p_partkey AS rowid FROM {part}""",
    ),
    "item_cost": """
    SELECT concat(' I', p_partkey) AS id_item,
           CASE WHEN p_size % 4 > 0 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS cost_matl_va_crnt,
           CASE WHEN p_size % 3 > 0 THEN CAST(p_retailprice AS DECIMAL(18,2)) + 1 END AS cost_matl_va_std,
           CASE WHEN p_size % 5 > 0 THEN CAST(p_size AS DECIMAL(18,2)) END AS cost_labor_va_crnt,
           CASE WHEN p_size % 2 > 0 THEN CAST(p_size + 1 AS DECIMAL(18,2)) END AS cost_labor_va_std,
           CAST(p_size AS DECIMAL(18,2)) AS hr_labor_va_crnt, CAST(p_size % 8 AS DECIMAL(18,2)) AS hr_mach_va_crnt,
           CAST(p_retailprice AS DECIMAL(18,2)) + p_size AS cost_total_accum_crnt,
           CAST(p_retailprice AS DECIMAL(18,2)) + 2 AS cost_total_accum_std, p_partkey AS rowid
    FROM {part}""",
    "stock_list": """
    SELECT concat('I', p_partkey) AS id_item, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'y' ELSE 'n' END AS adv
    FROM {part} WHERE p_size <= 25""",
    "cost_category": "SELECT * FROM (VALUES ('05', 'Finished goods'), ('10', 'Raw goods')) AS t(code_cat_cost, descr)",
    "product_category": """
    SELECT * FROM (VALUES ('05', '', 'Clothing'), ('05', 'DS', 'Clothing dist'), ('06', '', 'Fabric'),
        ('10', '', 'Arc'), ('20', 'EU', 'Industrial end user'), ('25', '', 'Field')) AS t(code_cat_prdt, code_type_cust, descr)""",
    "product_structure": _union(
        *(
            f"""
    SELECT concat('I', p_partkey) AS id_item_par, concat('I', p_partkey + {k}, ' ') AS id_item_comp,
           CASE WHEN p_size % 7 = 0 THEN NULL ELSE DATE '1996-01-01' END AS date_eff_start,
           CASE WHEN (p_size + {k}) % 5 = 0 THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS date_eff_end,
           p_partkey * 10 + {k} AS rowid
    FROM {{part}} WHERE p_size <= 30"""
            for k in (1, 2)
        ),
        f"""
    SELECT {_PARENT} AS id_item_par, concat('I', p_partkey) AS id_item_comp, DATE '1996-01-01' AS date_eff_start,
           CASE WHEN p_size % 5 = 0 THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS date_eff_end,
           p_partkey * 10 + 3 AS rowid
    FROM {{part}}""",
    ),
    # inventory
    "item_location": f"""
    SELECT concat('I', l_partkey) AS id_item, {_loc('l_suppkey')} AS id_loc,
           CASE (l_partkey + l_suppkey % 5) % 4 WHEN 0 THEN 'P' WHEN 3 THEN 'X' ELSE 'M' END AS flag_source,
           CASE l_partkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'M' ELSE 'S' END AS flag_stk,
           {_inventory_side('l_partkey + l_suppkey % 5')} AS id_planner,
           CASE WHEN l_partkey % 3 = 0 THEN concat('BIN', l_partkey % 17) END AS bin_prim,
           'Y' AS flag_track_bin, 'S' AS type_loc,
           CAST(sum(CASE WHEN l_returnflag = 'A' THEN {_QTY} ELSE 0 END) - 40 AS BIGINT) AS qty_onhd,
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN {_QTY} ELSE 0 END) AS BIGINT) AS qty_alloc,
           CAST(count(*) AS BIGINT) AS qty_onord,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS qty_insp
    FROM {{lineitem}} GROUP BY l_partkey, l_suppkey % 5
    UNION ALL
    SELECT concat('I', p_partkey), 'INTR', 'P', 'N', CAST(NULL AS STRING), CAST(NULL AS STRING), 'N', 'T',
           CAST(p_size AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    FROM {{part}} WHERE p_size > 30""",
    "reorder": _union(
        _reorder("'10'", "p_size % 4", 0),
        _reorder(_loc("p_partkey"), "p_size % 3", 1),
        _reorder("'20'", "1", 2),
    ),
    "inventory_history": f"""
    SELECT concat('I', l_partkey, ' ') AS id_item, {_loc('l_suppkey')} AS id_loc, {_SHIPPED} AS date_chg_qty,
           CAST((l_orderkey % 24) * 10000 + (l_partkey % 60) * 100 + l_suppkey % 60 AS INT) AS time_chg_qty,
           l_linenumber AS seq_rec, CAST(10 * (1 + l_orderkey % 5) AS INT) AS code_dtl,
           CASE WHEN l_returnflag = 'R' THEN {_QTY} ELSE -{_QTY} END AS qty_onhd_chg,
           CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'P' END AS flag_post_hist_im,
           l_orderkey * 100 + l_linenumber AS rowversion
    FROM {{lineitem}}""",
    # vendors and purchasing
    "item_vendor": f"""
    SELECT DISTINCT concat('I', l_partkey) AS id_item,
           CASE WHEN l_suppkey % 4 = l_partkey % 4 THEN 'P' ELSE 'S' END AS flag_vnd_prim,
           concat(' ', {_LINE_VENDOR}) AS id_vnd_payto, {_LINE_VENDOR} AS id_vnd_ordfm,
           concat('VI', l_partkey, '-', l_suppkey) AS id_item_vnd,
           CASE WHEN l_partkey % 50 = 7 THEN '    bad text  ' ELSE
                concat('0000', lpad(CAST(l_partkey * 7 + l_suppkey * 13 AS STRING), 8, '0'), '00') END AS price_vnd_fc_1
    FROM {{lineitem}}""",
    "vendor_payto": f"""
    SELECT {_VENDOR} AS id_vnd, CASE WHEN s_acctbal >= 0 THEN s_name WHEN s_nationkey > 12 THEN '  ' END AS name_vnd
    FROM {{supplier}} WHERE s_nationkey <> 24""",
    "vendor_orderfrom": f"""
    SELECT concat(' ', {_VENDOR}) AS id_vnd, {_VENDOR} AS id_vnd_ordfm,
           CASE WHEN s_acctbal >= 0 THEN s_name WHEN s_nationkey > 12 THEN '  ' END AS name_vnd
    FROM {{supplier}} WHERE s_nationkey <> 24""",
    "purchase_header": f"""
    SELECT concat('P', o_orderkey) AS id_po, 0 AS id_rel_ord, concat('V', o_custkey) AS id_vnd_payto,
           {_loc('o_custkey')} AS id_loc_shipto, CASE WHEN {_PRIORITY} = 1 THEN ' ' ELSE 'N' END AS type_po,
           CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'P' THEN 'P' ELSE 'O' END AS flag_stat_po, {_ORDERED} AS date_po,
           CASE o_orderkey % 3 WHEN 0 THEN 'B1' WHEN 1 THEN 'B2' ELSE 'B3' END AS id_buyer
    FROM {{orders}}""",
    "purchase_item_line": f"""
    SELECT concat('P', l_orderkey) AS id_po, 0 AS id_rel_ord, l_linenumber AS id_line_po, 1 AS type_rec,
           concat('I', l_partkey) AS id_item, concat('VI', l_partkey, '-', l_suppkey) AS id_item_vnd,
           {_SHIPPED} AS date_prom, {_QTY} AS qty_ord, CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE {_QTY} END AS qty_rcv,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS cost_expect, 'O' AS flag_stat_line_po
    FROM {{lineitem}} WHERE l_returnflag = 'N'""",
    "purchase_process_line": f"""
    SELECT concat('P', l_orderkey) AS id_po, 0 AS id_rel_ord, l_linenumber AS id_line_po, 3 AS type_rec,
           concat('I', l_partkey) AS id_item_outp, concat('PR', l_suppkey % 9) AS code_proc_op,
           {_SHIPPED} AS date_prom, {_QTY} AS qty_ord, CAST(0 AS BIGINT) AS qty_rcv,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS cost_expect,
           CASE WHEN l_linestatus = 'F' THEN 'C' ELSE 'O' END AS flag_stat_line_po
    FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "buyer": "SELECT * FROM (VALUES ('B1', 'Buyer one'), ('B2', 'Buyer two')) AS t(id_buyer, descr)",
    # shop orders
    "shop_header": _union(_shop_header(0, "o_orderkey >= 0"), _shop_header(1, "o_orderstatus = 'P'")),
    "shop_operation": _union(
        _operation(1000, "'C'", "o_orderkey >= 0"),
        _operation(3999, _STATUS_3999, f"{_PRIORITY} IN (1, 2, 5)"),
        _operation(9999, _STATUS_9999, f"{_PRIORITY} <> 3"),
    ),
    "shop_material": f"""
    SELECT {_loc('l_orderkey')} AS id_loc, concat('  SO', l_orderkey) AS id_so, 0 AS sufx_so,
           l_linenumber AS qty_per, {_QTY} AS qty_alloc,
           CASE WHEN l_linestatus = 'F' THEN {_QTY} ELSE 0 END AS qty_iss
    FROM {{lineitem}}""",
    "shop_approval": _union(_approval(0), _approval(1)),
    "job_card": _union(_job_card("o_orderstatus = 'P'"), _job_card("o_orderstatus = 'P'")),
    "routing_operation": """
    SELECT concat('I', p_partkey) AS id_item, 1000 AS id_oper,
           CASE WHEN p_size % 3 = 0 THEN 'ALT' ELSE 'TSS' END AS id_rte,
           CASE WHEN p_size % 5 = 0 THEN '950' ELSE '3303' END AS id_wc, CAST(p_size AS DECIMAL(18,2)) AS hr_mach_sr
    FROM {part} WHERE p_size > 20""",
    "work_center_minutes": f"""
    SELECT concat('330', l_linenumber % 6) AS work_center, {_loc('l_suppkey')} AS work_center_location,
           CAST(sum({_QTY}) AS BIGINT) AS sum_actual_mins, CAST(sum({_QTY} * l_linenumber) AS BIGINT) AS sum_earned_mins,
           CAST(count(*) AS BIGINT) AS sum_avail_mins
    FROM {{lineitem}} GROUP BY l_linenumber % 6, l_suppkey % 5""",
    "work_center_staff": f"""
    SELECT concat('330', s_nationkey % 4) AS work_center, {_loc('s_suppkey')} AS employee_location,
           CAST(count(*) AS BIGINT) AS first_shift_ft, CAST(count(DISTINCT s_nationkey) AS BIGINT) AS second_shift_ft
    FROM {{supplier}} GROUP BY s_nationkey % 4, s_suppkey % 5""",
    # periods
    "fiscal_period": f"""
    SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS beg_date,
           CAST(last_day({_SHIPPED}) AS DATE) AS end_date,
           CAST(year(l_shipdate) AS INT) AS fiscal_year,
           CAST(year(l_shipdate) * 100 + quarter(l_shipdate) AS INT) AS fiscal_quarter,
           CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS fiscal_period
    FROM {{lineitem}}""",
}


def references(statement: str) -> list[str]:
    """Names of the tables a statement reads, in order of first use."""
    return list(dict.fromkeys(_REF.findall(statement)))


class Captures:
    """The capture tables of one directory: ``captures.order_line``.

    A capture that is a projection of one table stays a view, so column pruning
    and filters reach the given files.  Those of ``STORED`` are written once per
    application and state of the input files to the shared folder and read from
    there, as bronze tables are.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._schemas: dict[str, StructType] = {}
        self._state: tuple | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name in STAR:
            frame = load(self.spark, self.directory, name, self._schemas.get(name))
            self._schemas[name] = frame.schema
            return frame
        if name not in TABLES:
            raise AttributeError(name)
        if name not in STORED:
            return self.derive(name)
        path = stored_once(
            self.spark, self, f"captures/{name}", lambda: self.derive(name) if name in GROUPED else self.derive(name).hint("rebalance")
        )
        frame = load_path(self.spark, path, self._schemas.get(name))
        self._schemas[name] = frame.schema
        return frame

    def state(self) -> tuple:
        """Files of the given tables with their modification times, read once per object."""
        if self._state is None:
            self._state = tuple(file_state(self.spark, f"{self.directory}/{name}.parquet") for name in STAR)
        return self._state

    def derive(self, name: str) -> DataFrame:
        """The capture as a lazy derivation of the given tables."""
        statement = TABLES[name]
        return self.spark.sql(statement, **{ref: getattr(self, ref) for ref in references(statement)})


_PATHS: dict[tuple[str, str, str], tuple[tuple, str]] = {}


def stored_once(spark: SparkSession, t: Captures, purpose: str, build: Callable[[], DataFrame]) -> str:
    """Path of a stored table, written once per application and state of the input files.

    When an input has changed the table is written anew, and the one it replaces is removed.
    """
    key = (spark.sparkContext.applicationId, t.directory, purpose)
    state, path = _PATHS.get(key, (None, None))
    if state != t.state():
        new = shared_folder(spark, purpose)
        with shuffles_released(spark):
            write_table(build(), new, compression="zstd")
        _PATHS[key] = (t.state(), new)
        if path:
            remove_folder(spark, path)
        path = new
    return path
