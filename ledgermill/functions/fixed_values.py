"""Business code tables and thresholds.

Fixed values: results depend on them exactly as they stand.  Where a site uses
other codes, the models take the table as a parameter.
"""

# Location code to short location name.
LOCATION_NAMES = {"10": "CLE", "20": "CHI", "50": "ARK", "90": "SAT", "130": "DR"}

# Vendor id of an own plant to its short location name.
PLANT_VENDORS = {"10602": "CLE", "D79008": "CHI", "10932": "SAT", "D79010": "ARK"}

HOME_LOCATION = "10"
IN_TRANSIT_LOCATION = "INTR"

SOURCING = {"M": "Manufactured", "P": "Purchased"}

FINISHED_GOODS_COST_CATEGORY = "05"
PARENT_COMMODITY = "PAR"

VENDOR_NOT_LISTED = "Item Vendor not setup"
NO_PRIMARY_VENDOR = "No Primary Vendor"
NO_SECONDARY_VENDOR = "No Secondary Vendor"
VENDOR_UNKNOWN = "Vendor not setup"
VENDOR_UNNAMED = "Vendor Name Needs Updated"
SOURCE_UNKNOWN = "Vendor needs to be setup"

INVALID_COST_CATEGORY = "INVALID COST CATEGORY"
INVALID_VERTICAL = "INVALID PRODUCT VERTICAL"
MISSING_PARENT_DESCRIPTION = "MISSING DESCRIPTION"

OPEN_ORDER_STATUSES = ("O", "A", "B", "R", "S", "P")
ALTERED_STOCK_PLANNERS = ("AS", "1A", "KT", "A ")
PROMISE_IS_FINAL_CUSTOMER = "102340"

SHOP_ORDER_STATUSES = ("A", "R", "S", "U")
OPERATION_STATUSES = ("P", "R", "A", "C")
STANDARD_ROUTE = "TSS"
OVERHEAD_WORK_CENTERS = (
    "900", "950", "1100", "1200", "1300", "1400", "7699", "7950", "8000", "7990",
)
PRESEW_OPERATION, FINAL_OPERATION = 3999, 9999

# Working days to ship (counted from the day after the order): flag name, upper bound.
SHIP_THRESHOLDS = (
    ("shipped_same_day", 0), ("shipped_next_day", 1), ("shipped_2_days", 2), ("shipped_1_week", 5),
    ("shipped_7_days", 7), ("shipped_10_days", 10), ("shipped_15_days", 15), ("shipped_20_days", 20),
    ("shipped_25_days", 25), ("shipped_30_days", 30), ("shipped_35_days", 35), ("shipped_40_days", 40),
)
SHIPPED_LATER = "shipped_greater_than_40"

FABRIC_CATEGORIES = ("06", "26", "60")
WORKDAY_GRACE_GROUPS = (
    "Standard", "Made To Order", "Fabrics and Raw Materials", "Other Stock", "Advertised Out-of-Stock",
)

# Product vertical code to name; a missing or other code is industrial.
VERTICALS = {"AF": "ARC FLASH PPE", "CT": "INDUSTRIAL PPE", "IS": "INDUSTRIAL PPE", "FR": "FR CLOTHING",
             "GV": "MILITARY", "TH": "THERMAL"}
VERTICALS_BY_CATEGORY = {("UL", "AD"): "AD SPECIALTY", ("UL", "USPS"): "USPS"}
DEFAULT_VERTICAL = "INDUSTRIAL PPE"

# (vertical, category) to label.  Labels that carry a brand come from the site's own table.
CATEGORY_LABELS = {
    ("AF", "CL"): "CLOTHING & KITS", ("AF", "KT"): "CLOTHING & KITS", ("AF", "ES"): "ELECTRICAL SAFETY",
    ("AF", "FSB"): "FACESHIELDS & BALACLAVAS", ("AF", "VG"): "VOLTAGE RATED GLOVES",
    ("FR", "AC"): "FR ACCESSORIES", ("FR", "HV"): "FR HI-VIS", ("FR", "IDC"): "FR INFECTIOUS DISEASE CONTROL",
    ("FR", "IND"): "INDUSTRIAL FR UNIFORMS", ("FR", "MSC"): "MISC", ("FR", "FABRC"): "FR FABRIC",
    ("FR", "RW"): "FR RAINWEAR", ("FR", "WW"): "FR WORK WEAR",
    ("GV", "FRML"): "FR MILITARY", ("GV", "MISC"): "GOVERNMENT (NON-MILITARY)", ("GV", "LE"): "LAW ENFORCEMENT",
    ("GV", "FABRC"): "FR MILITARY FABRIC",
    ("CT", "CR"): "CRYOGENIC PPE", ("IS", "CR"): "CRYOGENIC PPE",
    ("CT", "IDC"): "INFECTIOUS DISEASE CONTROL", ("IS", "IDC"): "INFECTIOUS DISEASE CONTROL",
    ("CT", "CP"): "MISC", ("IS", "CP"): "MISC", ("CT", "HV"): "MISC", ("IS", "HV"): "MISC",
    ("CT", "MISC"): "MISC", ("IS", "MISC"): "MISC",
    ("CT", "MC"): "MECHANICAL/CUT PROTECTION", ("IS", "MC"): "MECHANICAL/CUT PROTECTION",
    ("TH", "CL"): "CLOTHING", ("TH", "FSB"): "FACESHIELDS & BALACLAVAS", ("TH", "HP"): "HAND PROTECTION",
    ("TH", "MAC"): "MACHINERY PROTECTION", ("TH", "FABRC"): "THERMAL FABRIC",
    ("TH", "MSC"): "MISC/THERMAL PROTECTION",
}
NOT_CATEGORIZED = "#NOT CATEGORIZED"

# Product category code to vertical, as the cached report names it.
REPORT_VERTICALS = {
    "05": "FR CLOTHING", "06": "FR CLOTHING", "10": "ARC FLASH PPE", "15": "THERMAL", "20": "INDUSTRIAL PPE",
    "25": "MILITARY", "26": "MILITARY", "30": "USPS", "35": "AD SPECIALTY", "40": "LAW ENFORCEMENT",
    "45": "GOVERNMENT - NON MILITARY",
}

# Item attributes kept as columns: attribute id to column name.
SKU_ATTRIBUTES = {
    "ID_PARENT": "item_id_parent_sku", "CERT_NUM": "item_certificate_number", "COLOR": "item_color",
    "SIZE": "item_size", "LENGTH": "item_length", "TARIFF_CODE": "item_tariff_code",
    "UPC_CODE": "item_upc_code", "PFAS": "item_pfas", "CLASS": "item_class", "PPC": "item_ppc",
    "PRICE_LIST": "item_price_list", "PRICE_LIST_DESC": "item_price_list_description",
    "PRICE_LIST_ID": "item_price_list_id", "PRICE_LIST_PT": "item_price_list_pt",
    "PRIOR COMMODITY": "item_commodity_code_prior", "RBN_WC": "item_routing_work_center",
    "REASON": "item_status_obsolete_reason", "REPLACEMENT": "item_replaced_by",
    "REQUESTOR": "item_status_obsolete_requestor", "SF_XREF": "item_sf_xref",
}
PARENT_ATTRIBUTES = {
    "BERRY": "item_berry", "CARE": "item_care", "HEAT TRANSFER": "item_heat_transfer", "OTHER": "item_other",
    "PAD PRINT": "item_pad_print", "PRODUCT LINE": "item_product_line", "PRODUCT TYPE": "item_product_type",
    "PRODUCT_APP": "item_product_application", "TRACKING": "item_tracking", "Z_BRAND": "item_brand",
    "Z_CATEGORY": "item_product_category", "Z_GENDER": "item_gender",
}
PARENT_DESCRIPTION_ROWS = (800, 810)
WARNING_TEXT = "PROP 65"
