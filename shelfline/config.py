"""Entity contracts: keys, mandatory columns, rename maps, limits and labels."""

from __future__ import annotations

import os

ENTITIES = ("products", "customers", "sales", "stock")

# ── Fixed values: these must equal the behaviour being reproduced ────────────
# Reject-rate limit; a rate strictly above it fails the gate.
DEFAULT_REJECT_LIMIT = 0.05
# Age bands: (exclusive upper bound, label), checked in order; anything older is "60+".
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (60, "45-59")]
AGE_BAND_TOP = "60+"
# Label for products without a brand in the brand dimension.
DEFAULT_BRAND_LABEL = "Sem marca"
# Calendar names, January..December and Monday..Sunday (ISO order).
MONTH_NAMES = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho",
               "agosto", "setembro", "outubro", "novembro", "dezembro"]
WEEKDAY_NAMES = ["segunda", "terça", "quarta", "quinta", "sexta", "sábado", "domingo"]
# Record-list key inside each source envelope, per entity.
ENVELOPE_KEYS = {"products": "products", "customers": "users", "carts": "carts"}
# Fields requested for customers at the source; nothing else may land (privacy).
CUSTOMER_SOURCE_FIELDS = ["id", "firstName", "lastName", "email", "age", "gender",
                          "birthDate", "address"]
# Keys, mandatory columns and field names below: names and sets given by the source contract.
# Source field -> silver column.  Only mapped fields go on, in this order.
RENAME = {
    "products": {
        "id": "product_id", "title": "product_name", "description": "description",
        "category": "category", "brand": "brand", "sku": "sku", "price": "price",
        "discountPercentage": "discount_pct", "rating": "rating",
        "stock": "stock", "availabilityStatus": "availability",
    },
    "customers": {
        "id": "customer_id", "firstName": "first_name", "lastName": "last_name",
        "email": "email", "age": "age", "gender": "gender", "birthDate": "birth_date",
        "address.city": "city", "address.state": "state",
        "address.stateCode": "state_code", "address.country": "country",
    },
}

# Cart line item field -> sales column (4.1).
CART_LINE_FIELDS = {
    "id": "product_id", "title": "product_name", "price": "price", "quantity": "quantity",
    "total": "gross_amount", "discountPercentage": "discount_pct",
    "discountedTotal": "net_amount",
}

KEYS = {
    "products": ["product_id"],
    "customers": ["customer_id"],
    "sales": ["cart_id", "product_id"],
    "stock": ["product_id", "reference_date"],
}
MANDATORY = {
    "products": ["product_id", "product_name", "category", "price"],
    "customers": ["customer_id", "first_name", "email"],
    "sales": ["cart_id", "customer_id", "product_id", "quantity", "price"],
    "stock": ["product_id", "reference_date", "quantity"],
}
# ── end of fixed values ───────────────────────────────────────────────────────

def reject_limit() -> float:
    return float(os.getenv("SHELFLINE_REJECT_LIMIT", DEFAULT_REJECT_LIMIT))
