"""Declared column types of the source tables and of the two row shapes the pipeline passes along."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)
REVENUE = T.DecimalType(28, 8)
LINE_PRICE = T.DecimalType(28, 2)

_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "bigint": T.LongType(), "date": T.DateType(),
    "time": T.TimestampNTZType(), "money": MONEY, "rate": RATE, "revenue": REVENUE, "line": LINE_PRICE,
    "total": T.DecimalType(28, 2), "running": T.DecimalType(38, 8),
}


def _struct(columns: str) -> T.StructType:
    """A row type from words `name:type`."""
    pairs = [word.split(":") for word in columns.split()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_FEED = (
    "id:string client_id:string client_id_edit:string total_amount:money utc_created_at:time"
    " updated_at:time eventtype:string eventtimestamp:time flow:string transaction_type:string"
    " origination_system:string source_account_type:string transfer_method:string destination_bank:string"
    " origin_bank:string country:string status:string"
)

SOURCES: dict[str, T.StructType] = {
    "invoices": _struct(
        "id:string customer_id:string billing_period_start:time billing_period_end:time"
        " calculated_at:time status:string"
    ),
    "invoice_line_items": _struct(
        "id:string invoice_id:string price_id:string billing_schedule_id:string title:string currency:string"
        " net_total:money gross_total:money quantity:money rate:rate"
        " calculated_at:time modified_at:time deleted_at:time"
        " billing_period_start:time"
    ),
    "prices": _struct("id:string product_name:string"),
    "billing_schedule_phase_prices": _struct(
        "price_id:string billing_schedule_id:string status:string price_minimum_amount:money"
        " price_structure:string phase_start_date:date phase_end_date:date phase_archived_at:time"
    ),
    "usage_metrics": _struct("id:string name:string property_filters:string properties_to_negate:string"),
    "customers": _struct("id:string legal_name:string customer_aliases:string"),
    "sales_customers": _struct("sequence_id:string group_id:string"),
    "payout_transactions": _struct(_FEED),
    "payin_transactions": _struct(_FEED),
    "dac_transactions": _struct(_FEED),
    "balance_recharges": _struct(_FEED),
    "money_movements": _struct(
        "id:string client_id:string type:string status_state:string source_geography:string origin_channel:string"
        " supplier:string source_account_provider_id:string source_account_institution_code:string"
        " source_account_institution_name:string destination_account_institution_code:string"
        " destination_account_institution_name:string underlying_institution:string amount:money"
        " created_at:time"
    ),
}

# The eight movement properties a rule may filter on.
PROPERTIES = [
    "flow", "transaction_type", "origination_system", "source_account_type",
    "country", "origin_bank", "destination_bank", "status",
]

def _nested(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _FLAG = T.StringType(), T.BooleanType()

# Values stay text here, since sources write numbers both as JSON numbers and as strings.
PRICE_STRUCTURE = _nested(
    pricingType=_TEXT, pricePerUnit=_TEXT, isPricePercentage=_TEXT, price=_TEXT, usageMetricId=_TEXT,
    tiers=T.ArrayType(_nested(fee=_TEXT, isPricePercentage=_TEXT, price=_TEXT, upperBound=_TEXT)),
)

# Parsed once per rule, carried next to the JSON text so that no movement row ever parses JSON.
PRICING = _nested(
    pricing_type=_TEXT, unit_price=RATE, is_percentage=_FLAG, line_price=_TEXT,
    tiers=T.ArrayType(_nested(price=RATE, fee=RATE, upper_bound=T.LongType(), is_percentage=_FLAG)),
)

RULE_ROW = _struct(
    "mm_id:string amount:money client_id:string sequence_customer_id:string group_id:string"
    " local_created_at:time matched_product_name:string price_structure_json:string"
    " price_minimum_amount:money consumes_saas:boolean should_be_charged:boolean currency:string"
    " flow:string transaction_type:string origination_system:string source_account_type:string country:string"
    " origin_bank:string destination_bank:string status:string property_filters_json:string"
    " properties_to_negate:string transaction_month:date local_updated_at:time hash_match:string"
)

REVENUE_ROW = _struct(
    "mm_id:string client_id:string sequence_customer_id:string group_id:string matched_product_name:string"
    " local_created_at:time transaction_month:date transaction_count:bigint amount:money"
    " cumulative_amount:total cumulative_amount_before:total price_structure_json:string"
    " price_minimum_revenue:line pricing_type:string consumes_saas:boolean should_be_charged:boolean"
    " is_percentage:boolean price_per_unit:rate tier_application_basis:string currency:string"
    " revenue:revenue cumulative_revenue:running cumulative_revenue_before:running"
    " saas_revenue:revenue not_saas_revenue:revenue revenue_type:string"
    " remaining_minimum:revenue flow:string transaction_type:string origination_system:string"
    " source_account_type:string country:string origin_bank:string destination_bank:string status:string"
    " property_filters_json:string properties_to_negate:string local_updated_at:time"
    " platform_fee_share:revenue remaining_minimum_saas_share:revenue"
    " revenue_total_adjusted:revenue"
)


def conform(df: DataFrame, row: T.StructType, *extra: str) -> DataFrame:
    """Project `df` to the declared row: cast what it has, pad with NULL what it lacks, append `extra` columns."""
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in row.fields
    ]
    return df.select(*columns, *extra)


def _readable(have: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of the type `have` means the same after a cast to the declared type."""
    if have == declared:
        return True
    whole = isinstance(have, T.IntegralType)
    if isinstance(declared, T.StringType):
        return whole or isinstance(have, (T.StringType, T.VarcharType, T.CharType, T.BooleanType, T.DateType))
    if isinstance(declared, T.LongType):
        return whole or (isinstance(have, T.DecimalType) and have.scale == 0)
    if isinstance(declared, T.DecimalType):
        return whole or (isinstance(have, T.DecimalType) and have.scale <= declared.scale)
    if isinstance(declared, T.TimestampNTZType):
        return isinstance(have, (T.TimestampType, T.DateType))
    return False


def problems(df: DataFrame, row: T.StructType) -> list[str]:
    """What keeps `df` from being read as the declared row: its missing columns and those of other types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = [f"{f.name} is missing ({f.dataType.simpleString()})" for f in row.fields if f.name not in have]
    return out + [
        f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}"
        for f in row.fields if f.name in have and not _readable(have[f.name], f.dataType)
    ]
