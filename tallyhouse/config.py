"""Configuration as data: schemas, mappings, rules and thresholds.

The tables in this module are fixed values: names, codes, formats, predicates, thresholds
and weights that results depend on. Everything is also accepted as a DataFrame or a list of
the same shape, so a deployment can keep its own rows (see ``operators.setup``).
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: entities and their canonical columns (type, role) --------------------

ENTITIES = ("customers", "orders", "transactions", "returns", "products", "vendors")

SCHEMAS: dict[str, dict[str, tuple[str, str]]] = {
    "customers": {
        "customer_id": ("string", "primary_key"),
        "customer_email": ("string", "optional"),
        "customer_name": ("string", "required"),
        "segment": ("string", "required"),
        "country": ("string", "optional"),
        "city": ("string", "optional"),
        "state": ("string", "optional"),
        "postal_code": ("string", "optional"),
        "region": ("string", "optional"),
    },
    "orders": {
        "order_id": ("string", "primary_key"),
        "customer_id": ("string", "foreign_key"),
        "vendor_id": ("string", "foreign_key"),
        "ship_mode": ("string", "optional"),
        "order_status": ("string", "required"),
        "order_purchase_timestamp": ("timestamp", "required"),
        "order_approved_timestamp": ("timestamp", "optional"),
        "order_delivered_carrier_timestamp": ("timestamp", "optional"),
        "order_delivered_customer_timestamp": ("timestamp", "optional"),
        "order_estimated_delivery_timestamp": ("timestamp", "optional"),
    },
    "transactions": {
        "order_id": ("string", "foreign_key"),
        "product_id": ("string", "foreign_key"),
        "sales": ("decimal(10,3)", "required"),
        "quantity": ("int", "required"),
        "discount": ("decimal(12,5)", "optional"),
        "profit": ("decimal(10,3)", "optional"),
        "payment_type": ("string", "optional"),
        "payment_installments": ("int", "optional"),
    },
    "returns": {
        "order_id": ("string", "foreign_key"),
        "refund_amount": ("decimal(10,2)", "required"),
        "return_date": ("date", "required"),
        "return_reason": ("string", "optional"),
        "return_status": ("string", "required"),
    },
    "products": {
        "product_id": ("string", "primary_key"),
        "product_name": ("string", "required"),
        "brand": ("string", "optional"),
        "categories": ("string", "optional"),
        "colors": ("string", "optional"),
        "manufacturer": ("string", "optional"),
        "dimension": ("string", "optional"),
        "sizes": ("string", "optional"),
        "upc": ("string", "optional"),
        "weight": ("string", "optional"),
        "product_photos_qty": ("bigint", "optional"),
        "date_added": ("timestamp", "optional"),
        "date_updated": ("timestamp", "optional"),
    },
    "vendors": {
        "vendor_id": ("string", "primary_key"),
        "vendor_name": ("string", "required"),
    },
}

# --- fixed values: codes, formats, placeholders ------------------------------------------

SEGMENT_CODES = {"CONS": "Consumer", "Cosumer": "Consumer", "CORP": "Corporate", "HO": "Home Office"}
RETURN_STATUS_CODES = {"PENDG": "Pending", "APPRVD": "Approved", "RJCTD": "Rejected"}
REGION_CODES = {"S": "South", "C": "Central", "W": "West", "E": "East", "N": "North"}
PLACEHOLDER = "?"
TIMESTAMP_FORMATS = ("MM/dd/yyyy HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd H:mm")
DATE_FORMATS = ("yyyy-MM-dd", "MM-dd-yyyy")
LINEAGE_COLUMNS = ("_source_file", "_load_timestamp", "_rescued_data")

# --- fixed values: file contracts (key variants, required columns, least column count) ----


@dataclass(frozen=True)
class Contract:
    entity: str
    key_variants: tuple[str, ...]
    required: tuple[str, ...]
    min_cols: int


CONTRACTS = (
    Contract("customers", ("customer_id", "customerid", "cust_id", "customer_identifier"), ("country", "region"), 7),
    Contract("orders", ("order_id",), ("order_status",), 9),
    Contract("transactions", ("order_id",), ("quantity", "discount"), 6),
    Contract("returns", ("order_id", "orderid"), (), 4),
    Contract("products", ("product_id",), ("product_name",), 5),
    Contract("vendors", ("vendor_id",), ("vendor_name",), 2),
)

# --- fixed values: source column -> canonical column, with the cleaner to apply ----------


@dataclass(frozen=True)
class Mapping:
    """``transformation`` is None, the name of a cleaner, or SQL text with ``{col}``."""

    entity: str
    source_column: str
    canonical_column: str
    transformation: str | None = None


def _maps(entity: str, *rows: tuple) -> list[Mapping]:
    return [Mapping(entity, *row) for row in rows]


MAPPINGS: tuple[Mapping, ...] = tuple(
    _maps(
        "customers",
        ("customer_id", "customer_id"),
        ("customerid", "customer_id"),
        ("cust_id", "customer_id"),
        ("customer_identifier", "customer_id"),
        ("customer_email", "customer_email"),
        ("email_address", "customer_email"),
        ("customer_name", "customer_name"),
        ("full_name", "customer_name"),
        ("segment", "segment", "segment"),
        ("customer_segment", "segment", "segment"),
        ("country", "country"),
        ("city", "city"),
        ("state", "state"),
        ("postal_code", "postal_code"),
        ("region", "region", "region"),
    )
    + _maps(
        "orders",
        ("order_id", "order_id"),
        ("customer_id", "customer_id"),
        ("vendor_id", "vendor_id"),
        ("ship_mode", "ship_mode"),
        ("order_status", "order_status"),
        ("order_purchase_date", "order_purchase_timestamp", "timestamp"),
        ("order_approved_at", "order_approved_timestamp", "timestamp"),
        ("order_delivered_carrier_date", "order_delivered_carrier_timestamp", "timestamp"),
        ("order_delivered_customer_date", "order_delivered_customer_timestamp", "timestamp"),
        ("order_estimated_delivery_date", "order_estimated_delivery_timestamp", "timestamp"),
    )
    + _maps(
        "transactions",
        ("order_id", "order_id"),
        ("product_id", "product_id"),
        ("sales", "sales", "currency"),
        ("quantity", "quantity", "integer"),
        ("discount", "discount", "discount"),
        ("profit", "profit", "currency"),
        ("payment_type", "payment_type", "placeholder"),
        ("payment_installments", "payment_installments", "integer"),
    )
    + _maps(
        "returns",
        ("order_id", "order_id"),
        ("orderid", "order_id"),
        ("refund_amount", "refund_amount", "refund"),
        ("amount", "refund_amount", "refund"),
        ("return_date", "return_date", "date"),
        ("date_of_return", "return_date", "date"),
        ("return_reason", "return_reason", "placeholder"),
        ("reason", "return_reason", "placeholder"),
        ("return_status", "return_status", "return_status"),
        ("status", "return_status", "return_status"),
    )
    + _maps(
        "products",
        ("product_id", "product_id"),
        ("product_name", "product_name"),
        ("brand", "brand"),
        ("categories", "categories"),
        ("colors", "colors"),
        ("manufacturer", "manufacturer"),
        ("dimension", "dimension"),
        ("sizes", "sizes"),
        ("upc", "upc"),
        ("weight", "weight"),
        ("product_photos_qty", "product_photos_qty"),
        ("dateadded", "date_added", "iso_timestamp"),
        ("dateupdated", "date_updated", "iso_timestamp"),
    )
    + _maps("vendors", ("vendor_id", "vendor_id"), ("vendor_name", "vendor_name"))
)

# --- fixed values: quality rules ----------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    rule_id: str
    entity: str
    rule_name: str
    rule_expression: str
    severity: str
    consequence: str
    issue_type: str
    failure_reason: str


_C, _W = "CRITICAL", "WARNING"

RULES: tuple[Rule, ...] = (
    Rule("CU-001", "customers", "customer_id_not_null", "customer_id IS NOT NULL", _C, "drop", "null_primary_key", "no customer id under any of its names"),
    Rule("CU-002", "customers", "valid_customer_email", "customer_email IS NOT NULL", _W, "warn", "missing_optional_field", "no e-mail address"),
    Rule("CU-003", "customers", "valid_customer_name", "customer_name IS NOT NULL", _W, "warn", "missing_optional_field", "no customer name"),
    Rule("CU-004", "customers", "valid_segment", "segment IN ('Consumer', 'Corporate', 'Home Office')", _W, "warn", "invalid_category", "segment outside the known three"),
    Rule("CU-005", "customers", "detect_location_swap", "(state RLIKE '^[A-Z]{2}$') OR (LENGTH(state) > 2 AND state NOT LIKE '% %' AND state RLIKE '^[A-Z][a-z]+$')", _W, "quarantine", "structural_anomaly", "state looks like a city, columns may be swapped"),
    Rule("OR-001", "orders", "order_id_not_null", "order_id IS NOT NULL", _C, "drop", "null_primary_key", "no order id"),
    Rule("OR-002", "orders", "valid_purchase_date", "order_purchase_timestamp IS NOT NULL", _W, "warn", "format_error", "purchase date missing or unreadable"),
    Rule("OR-003", "orders", "valid_ship_mode", "ship_mode IS NOT NULL", _W, "warn", "missing_optional_field", "no ship mode"),
    Rule("OR-004", "orders", "valid_delivery_customer", "order_delivered_customer_timestamp IS NOT NULL", _W, "warn", "missing_optional_field", "not delivered to the customer yet"),
    Rule("OR-005", "orders", "valid_delivery_carrier", "order_delivered_carrier_timestamp IS NOT NULL", _W, "warn", "missing_optional_field", "not handed to the carrier yet"),
    Rule("TR-001", "transactions", "order_id_not_null", "order_id IS NOT NULL", _C, "drop", "null_foreign_key", "line without order"),
    Rule("TR-002", "transactions", "product_id_not_null", "product_id IS NOT NULL", _C, "drop", "null_foreign_key", "line without product"),
    Rule("TR-003", "transactions", "valid_sales", "sales > 0 AND sales IS NOT NULL", _W, "warn", "format_error", "sales amount missing, unreadable or not positive"),
    Rule("TR-004", "transactions", "valid_profit", "profit IS NOT NULL", _W, "warn", "missing_optional_field", "no readable profit"),
    Rule("TR-005", "transactions", "valid_discount", "discount IS NOT NULL AND discount >= 0 AND discount < 1", _W, "warn", "missing_optional_field", "discount is not a fraction below one"),
    Rule("TR-006", "transactions", "valid_payment_type", "payment_type IS NOT NULL", _W, "warn", "invalid_category", "payment type unknown"),
    Rule("TR-007", "transactions", "valid_quantity", "quantity IS NOT NULL", _W, "warn", "missing_optional_field", "no readable quantity"),
    Rule("TR-008", "transactions", "valid_profit_value", "profit >= 0", _W, "warn", "format_error", "line sold at a loss"),
    Rule("RE-001", "returns", "order_id_not_null", "order_id IS NOT NULL", _C, "drop", "null_foreign_key", "return without order"),
    Rule("RE-002", "returns", "valid_return_status", "return_status IN ('Pending', 'Approved', 'Rejected')", _W, "warn", "invalid_category", "return status outside the known three"),
    Rule("RE-003", "returns", "valid_return_reason", "return_reason IS NOT NULL", _W, "warn", "missing_optional_field", "no return reason"),
    Rule("RE-004", "returns", "valid_refund_amount", "refund_amount > 0", _W, "warn", "format_error", "refund is not positive"),
    Rule("PR-001", "products", "product_id_not_null", "product_id IS NOT NULL", _C, "drop", "null_primary_key", "no product id"),
    Rule("PR-002", "products", "valid_product_name", "product_name IS NOT NULL", _W, "warn", "missing_optional_field", "no product name"),
    Rule("PR-003", "products", "valid_brand", "brand IS NOT NULL", _W, "warn", "missing_optional_field", "no brand"),
    Rule("VE-001", "vendors", "vendor_id_not_null", "vendor_id IS NOT NULL", _C, "drop", "null_primary_key", "no vendor id"),
    Rule("VE-002", "vendors", "valid_vendor_name", "vendor_name IS NOT NULL", _W, "warn", "missing_optional_field", "no vendor name"),
)


def rules_for(entity: str) -> list[Rule]:
    return [r for r in RULES if r.entity == entity]


def mappings_for(entity: str) -> list[Mapping]:
    return [m for m in MAPPINGS if m.entity == entity]


# --- fixed values: survivorship -----------------------------------------------------------


@dataclass(frozen=True)
class Survivorship:
    entity: str
    canonical_column: str
    strategy: str
    source_priority_order: tuple[str, ...] = ()


CUSTOMER_SOURCES = tuple(f"customers_{i}" for i in range(1, 7))

SURVIVORSHIP: tuple[Survivorship, ...] = (
    Survivorship("customers", "customer_email", "most_complete"),
    Survivorship("customers", "customer_name", "source_priority", CUSTOMER_SOURCES),
    Survivorship("customers", "segment", "source_priority", CUSTOMER_SOURCES),
    Survivorship("customers", "city", "most_recent"),
    Survivorship("customers", "state", "most_recent"),
    Survivorship("customers", "postal_code", "most_recent"),
    Survivorship("customers", "region", "source_priority", CUSTOMER_SOURCES),
    Survivorship("customers", "country", "source_priority", CUSTOMER_SOURCES),
)

# --- fixed values: fraud rules (signal, threshold, weight), cutoff and bands ---------------


@dataclass(frozen=True)
class FraudRule:
    rule_name: str
    signal: str
    threshold: float
    weight: float
    is_active: bool = True
    description: str = ""
    human_reasoning: str = ""


FRAUD_RULES: tuple[FraudRule, ...] = (
    FraudRule("high_return_volume", "total_returns", 5, 20, True, "Many returns by one customer", "Five returns and more are rarely a run of bad luck"),
    FraudRule("high_refund_value", "total_refund_value", 1000, 10, True, "Large sum of refunds", "A thousand in refunds is worth the time of an investigator"),
    FraudRule("high_order_return_rate", "order_return_rate", 0.3, 10, True, "Large share of orders sent back", "Most customers keep more than two of three orders"),
    FraudRule("refund_inflation", "total_refund_inflation", 500, 20, True, "Refunds above what was paid", "A refund can't be due beyond the price of the goods"),
    FraudRule("return_before_delivery", "return_before_delivery_count", 1, 10, True, "Return filed before the goods arrived", "Nobody can judge goods that are still on their way"),
    FraudRule("duplicate_order_reason", "duplicate_order_count", 1, 10, True, "Duplicate order given as the reason", "The reason is easy to state and hard to check"),
    FraudRule("same_day_ship_return", "same_day_ship_return_count", 1, 5, True, "Return of an order with same-day shipping", "The dearest shipping is odd for goods that go back"),
    FraudRule("no_matching_order", "no_matching_order_count", 1, 15, True, "Return without any order", "Goods that were never sold can't come back"),
)
FLAG_THRESHOLD = 40.0
#: The row of the rule table that holds the threshold; it has no weight and fires for nobody.
FLAG_ROW = "flag_threshold"
FRAUD_CONFIG = (*FRAUD_RULES, FraudRule(FLAG_ROW, "anomaly_score", FLAG_THRESHOLD, 0, True, "Score from which a customer is looked into", "Two strong signals, or one with several weak ones"))
# Upper ends of refund to sale, with the name of the band; the last one is open.
RATIO_BANDS = ((1.5, "up to 1.5"), (5, "over 1.5"), (20, "over 5"), (None, "over 20"))
NO_RATIO = "no sale"
PRIORITY_BANDS = ((80, "EXTREME"), (65, "HIGH"), (50, "MODERATE"))

# --- fixed values: severity classes and business impact -----------------------------------

CRITICAL_ISSUES = ("missing_value", "null_primary_key", "missing_customer_id", "missing_order_id", "invalid_category")
HIGH_ISSUES = ("invalid_reference", "negative_amount", "orphaned_record", "duplicate_primary_key", "format_error")
CRITICAL_COUNT, HIGH_COUNT = 100, 30

IMPACT: dict[tuple[str, str], str] = {
    ("customers", "null_primary_key"): "Sales and returns cannot be credited to a customer.",
    ("customers", "missing_optional_field"): "Contact lists and the investigation queue have gaps.",
    ("customers", "invalid_category"): "The customer is missing from the split by segment.",
    ("orders", "null_primary_key"): "The order cannot be tied to sales, so fulfilment figures drop.",
    ("orders", "format_error"): "Without a date the order is missing from every monthly trend.",
    ("orders", "missing_optional_field"): "The order is missing from delivery performance.",
    ("transactions", "null_foreign_key"): "The line is missing from revenue and profit totals.",
    ("transactions", "format_error"): "Revenue and margin are understated.",
    ("transactions", "missing_optional_field"): "Margin cannot be worked out for the line.",
    ("transactions", "invalid_category"): "The line is missing from the split by payment type.",
    ("returns", "null_foreign_key"): "The return counts against no sale, so return rates are off.",
    ("returns", "invalid_category"): "The return is invisible to the returns queue.",
    ("returns", "missing_optional_field"): "The return is missing from the split by reason.",
    ("returns", "format_error"): "Refund totals are understated.",
    ("products", "null_primary_key"): "Sales of the product cannot be reported.",
    ("products", "missing_optional_field"): "The product shows up blank in product reports.",
    ("vendors", "null_primary_key"): "Returns cannot be charged to the vendor.",
    ("vendors", "missing_optional_field"): "The vendor shows up blank in the scorecard.",
}
ENTITY_REPORTS = {
    "customers": "the customer revenue report",
    "orders": "the order trend report",
    "transactions": "the revenue and margin totals",
    "returns": "the return rate and refund totals",
    "products": "the product and inventory reports",
    "vendors": "the vendor scorecard",
}

# --- fixed values: checks of generated text -------------------------------------------------

REFUSAL_PHRASES = ("i cannot", "as an ai", "i don't have", "i'm unable", "i am unable")
JARGON_PHRASES = ("silver layer", "bronze layer", "harmonization process", "the analytics layer", "the pipeline", "dlt", "delta table")
REPORT_SECTIONS = ("WHAT IS THE PROBLEM:", "WHY THIS RECORD TYPE CANNOT BE ACCEPTED:", "WHAT IS AT RISK:")
FAILED_CALL_PREFIX = "LLM_UNAVAILABLE"

# --- fixed values: market-basket thresholds -------------------------------------------------

MIN_PAIR_COUNT, MIN_CONFIDENCE, MIN_LIFT = 2, 0.2, 1.0
STRONG_LIFT, MODERATE_LIFT = 3.0, 1.5
MIN_VENDOR_ORDERS = 50

# --- fixed values: other thresholds ---------------------------------------------------------

EXACT_MATCH_TOLERANCE = "0.01"
REFUND_LIMIT_FACTOR = 5
SLOW_DAYS = 90
VENDOR_RISK_PCT = 20.0
VENDOR_CONCERN_PCT = 15.0
MOM_SWING_PCT = 5.0
HOT_SCORE, WARM_SCORE = 65, 35
