"""Fixed values. These define the results, so they are stated as they are."""

# Outcome codes counted as a death and as a serious injury.
DEATH_CODES = ["D"]
SERIOUS_CODES = ["L", "H", "S"]

# Full-text outcomes and the one-letter code each stands for.
OUTCOME_CODES = {
    "death": "D",
    "life threatening": "L",
    "hospitalization": "H",
    "disability": "S",
    "congenital anomaly": "S",
    "required intervention": "R",
    "other": "O",
}

# Legal-form words dropped from company names.
LEGAL_WORDS = (
    "INC LLC LTD CORP CORPORATION CO COMPANY LP LLP GMBH AG SA BV NV PLC PTY INTERNATIONAL INTL HOLDINGS GROUP "
    "ENTERPRISES ENTERPRISE INDUSTRIES INDUSTRY LIMITED INCORPORATED"
).split()

# Noise in product descriptions, removed in this order. The second item tells whether case is ignored.
DESCRIPTION_NOISE = [
    (r"\(0[1-9]\)\d{10,}(?:\(\d{2}\)\S+)*", False),
    (r"(?:REF|RPN|GPN|SKU|P/?N|Catalog\s*No\.?)\s*(?:\([^)]*\)\s*:?\s*)?:?\s*\S+", True),
    (r"(?:Item|Part|Serial)\s*(?:Number|No\.?|#)\s*:?\s*\S+", True),
    (r"Model\s*(?:Number|No\.?|#)?\s*:?\s*\S+", True),
    (r"Lot\s*(?:Number|No\.?|#)\s*:?\s*\S+", True),
    (r"\d+\.?\d*(?:[-x×]\d+\.?\d*)+\s*(?:mm|cm|ml|cc|g)\b", True),
    (r"\b\d+\.?\d*\s*(?:mm|cm|ml|cc)\b", True),
    (r"\b[A-Z]{1,4}\d[\w.-]*\d\w*\b", False),
    (r"(?:Version|Ver\.?|V)\s*\d+[\.\d]*", True),
]

# Recall class in classification text.
RECALL_CLASS = r"Class\s+(I{1,3})"

# Mapping tiers of a recall.
TIER_EXACT = "exact_product_code_match"
TIER_HIGH = "high_confidence_text_match"
TIER_LOW = "low_confidence_text_match"
TIER_NONE = "unmapped"

# Tables of the layers and what is asked of them: layer, table, file, key, columns with few nulls, setting that caps the rows.
LAYER_TABLES = [
    ("clean", "events", "clean_event_device_level.parquet", ["event_record_id"], ["product_code", "event_year"], None),
    ("clean", "recalls", "clean_recall.parquet", ["recall_number"], ["product_code", "recall_year"], None),
    ("clean", "clearances", "clean_510k.parquet", ["k_number"], ["product_code", "decision_year"], None),
    ("clean", "dim_product_code", "dim_product_code.parquet", ["product_code"], ["review_panel", "device_class"], None),
    ("mart", "mart_panel_year", "mart_panel_year.parquet", ["review_panel", "year"], [], None),
    ("mart", "mart_product_code_year", "mart_product_code_year.parquet", ["product_code", "year"], [], None),
    ("mart", "mart_firm_product_year", "mart_firm_product_year.parquet", ["manufacturer", "product_code", "year"], [], None),
    ("app", "app_overview", "app_overview.csv", [], [], "overview_rows"),
    ("app", "app_category_product", "app_category_product.csv", [], [], "category_rows"),
    ("app", "app_manufacturer", "app_manufacturer.csv", [], [], "manufacturer_rows"),
]

# Checks between the stages: least rows of a table, and most nulls of its columns.
STAGE_TABLES = {
    "dim_product_code": (100, {"device_name": 0.05, "device_class": 0.05}),
    "clean_events_latest": (1000, {"product_code": 0.30, "date_received": 0.01, "manufacturer_d_name": 0.10}),
    "manufacturer_alias": (10, {}),
    "clean_recall": (100, {"recall_initiation_date": 0.05, "product_code": 0.30, "recall_class": 0.05}),
    "clean_510k": (100, {"decision_date": 0.05, "product_code": 0.05}),
}
