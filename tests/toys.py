"""Small hand-made inputs."""

import datetime as dt
import json
from decimal import Decimal

from meterbook.sources.schemas import RULE_ROW, SOURCES, PROPERTIES, _struct

MONTH = dt.date(2025, 5, 1)


def dec(value):
    return None if value is None else Decimal(str(value))


def linear(price, percent):
    return json.dumps({"pricingType": "LINEAR", "pricePerUnit": str(price), "isPricePercentage": percent})


def tiered(kind, *tiers):
    """Tiers as (price, bound, percent, fee)."""
    return json.dumps({"pricingType": kind, "tiers": [
        {"price": str(p), "fee": str(fee), "isPricePercentage": percent, **({"upperBound": str(b)} if b is not None else {})}
        for p, b, percent, fee in tiers
    ]})


def rule_rows(spark, rows):
    """Charged rule rows from dicts; what is left out has a plain default."""
    full = []
    for n, row in enumerate(rows):
        values = {
            "mm_id": f"mm{n:04d}", "amount": 100, "client_id": "c1", "sequence_customer_id": "seq_1", "group_id": "g1",
            "local_created_at": dt.datetime(2025, 5, 1) + dt.timedelta(minutes=n), "matched_product_name": "P",
            "price_structure_json": linear(1, False), "consumes_saas": False, "should_be_charged": True,
            "currency": "USD", "transaction_month": MONTH, "local_updated_at": dt.datetime(2025, 5, 1), **row,
        }
        values.setdefault("hash_match", f"h{values['mm_id']}{values['matched_product_name']}")
        values["amount"] = dec(values["amount"])
        values["price_minimum_amount"] = dec(values.get("price_minimum_amount"))
        full.append(tuple(values.get(f) for f in RULE_ROW.fieldNames()))
    return spark.createDataFrame(full, RULE_ROW)


def by_id(df, *columns):
    """Rows ordered by mm_id, as tuples with floats for decimals."""
    picked = df.orderBy("mm_id", "matched_product_name").select(*columns).collect()
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in picked]


_MOVEMENT = _struct(
    "mm_id:string client_id:string " + " ".join(f"{p}:string" for p in PROPERTIES)
    + " amount:money updated_at:time local_created_at:time event_month:date"
)
_LINE = _struct(
    "client_id:string sequence_customer_id:string group_id:string product_name:string price_structure_json:string"
    " price_minimum_amount:money consumes_saas:boolean property_filters_json:string properties_to_negate:string"
    " price_structure_month:date currency:string"
)


def movements(spark, *rows):
    time = dt.datetime(2025, 5, 3)
    full = [
        {"mm_id": f"mm{n}", "client_id": "c1", "amount": Decimal(10), "updated_at": time, "local_created_at": time,
         "event_month": MONTH, **row}
        for n, row in enumerate(rows)
    ]
    return spark.createDataFrame([tuple(r.get(f) for f in _MOVEMENT.fieldNames()) for r in full], _MOVEMENT)


def usage_rules(spark, *rows):
    full = [
        {"client_id": "c1", "sequence_customer_id": "seq_1", "product_name": f"P{n}", "price_structure_json": linear(1, False),
         "consumes_saas": False, "price_structure_month": MONTH, "currency": "USD", **row}
        for n, row in enumerate(rows)
    ]
    return spark.createDataFrame([tuple(r.get(f) for f in _LINE.fieldNames()) for r in full], _LINE)


def source_tables(spark, **tables):
    """Source tables from lists of dicts; absent columns are NULL, absent tables empty."""
    return {
        name: spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in tables.get(name, [])], schema)
        for name, schema in SOURCES.items()
    }
