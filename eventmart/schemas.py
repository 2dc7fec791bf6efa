"""Table schemas: the wide attribution event, the canonical engagement event, side tables."""

from __future__ import annotations

from pyspark.sql import types as T

MAX_BYTES = "max_bytes"

# ---------------------------------------------------------------------------------------
# Column names, types and byte lengths of the wide attribution-event table,
# in table order. A bare number is a string column of that many bytes.
# ---------------------------------------------------------------------------------------
ATTRIBUTION_COLUMNS = """
appsflyer_id 255
event_name 255
event_time timestamp
event_time_selected_timezone timestamp
customer_user_id 255
idfa 255
idfv 255
advertising_id 255
android_id 255
oaid 255
amazon_aid 255
imei 255
app_id 255
app_name 255
app_version 255
bundle_id 255
platform 50
sdk_version 100
api_version 50
device_type 255
device_model 255
device_category 100
os_version 100
language 50
user_agent text
country_code 10
region 100
state 100
city 255
postal_code 50
dma 100
ip 45
carrier 255
operator 255
wifi boolean
media_source 255
campaign 500
campaign_type 255
af_channel 255
af_keywords 500
af_ad 500
af_ad_id 255
af_ad_type 255
af_adset 500
af_adset_id 255
af_c_id 255
af_siteid 255
af_sub_siteid 255
af_sub1 500
af_sub2 500
af_sub3 500
af_sub4 500
af_sub5 500
attributed_touch_type 255
attributed_touch_time timestamp
attributed_touch_time_selected_timezone timestamp
match_type 255
engagement_type 255
af_prt 255
af_attribution_lookback 255
af_reengagement_window 255
is_primary_attribution boolean
is_retargeting boolean
retargeting_conversion_type 255
install_time timestamp
install_time_selected_timezone timestamp
install_app_store 255
device_download_time timestamp
device_download_time_selected_timezone timestamp
store_reinstall boolean
contributor_1_media_source 255
contributor_1_campaign 500
contributor_1_touch_type 255
contributor_1_touch_time timestamp
contributor_1_match_type 255
contributor_1_engagement_type 255
contributor_1_af_prt 255
contributor_2_media_source 255
contributor_2_campaign 500
contributor_2_touch_type 255
contributor_2_touch_time timestamp
contributor_2_match_type 255
contributor_2_engagement_type 255
contributor_2_af_prt 255
contributor_3_media_source 255
contributor_3_campaign 500
contributor_3_touch_type 255
contributor_3_touch_time timestamp
contributor_3_match_type 255
contributor_3_engagement_type 255
contributor_3_af_prt 255
event_type 255
event_source 100
event_value variant
event_revenue decimal(18,6)
event_revenue_usd decimal(18,6)
event_revenue_currency 10
revenue_in_selected_currency decimal(18,6)
selected_currency 10
is_receipt_validated boolean
conversion_type 255
af_cost_model 255
af_cost_value decimal(18,6)
af_cost_currency 10
cost_in_selected_currency decimal(18,6)
gp_referrer text
gp_click_time timestamp
gp_install_begin timestamp
gp_broadcast_referrer text
http_referrer text
original_url text
deeplink_url text
custom_data text
custom_dimension 500
keyword_id 255
keyword_match_type 255
network_account_id 255
store_product_page text
is_lat boolean
gdpr_applies boolean
ad_personalization_enabled boolean
ad_user_data_enabled boolean
raw_consent_data text
selected_timezone 100
"""

# The canonical engagement event, in table order.
CANONICAL_COLUMNS = """
event_date date
event_ts timestamp
user_id 64
event_name 128
source_file 512
attributes variant
"""

# Set by the load, not by the input.
LOAD_TIME_COLUMNS = ["created_at", "updated_at"]

_TYPES = {
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "variant": T.VariantType(),
    "decimal(18,6)": T.DecimalType(18, 6),
    "text": T.StringType(),
}


def _struct(listing: str) -> T.StructType:
    fields = []
    for line in listing.split("\n"):
        if not line:
            continue
        name, kind = line.split(" ")
        if kind.isdigit():
            fields.append(T.StructField(name, T.StringType(), True, {MAX_BYTES: int(kind)}))
        else:
            fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


ATTRIBUTION = _struct(ATTRIBUTION_COLUMNS)
CANONICAL = _struct(CANONICAL_COLUMNS)
ATTRIBUTION_TABLE = T.StructType(
    ATTRIBUTION.fields + [T.StructField(c, T.TimestampNTZType()) for c in LOAD_TIME_COLUMNS]
)

REQUIRED = ["appsflyer_id", "event_name", "event_time"]  # fixed values

_SIDE_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampNTZType(),
}


def _side_table(listing: str) -> T.StructType:
    pairs = [column.split(" ") for column in listing.split(", ")]
    return T.StructType([T.StructField(name, _SIDE_TYPES[kind]) for name, kind in pairs])


LEDGER = _side_table(
    "path string, batch_id string, status string, attempts int, loaded_at timestamp, attempt string"
)
INGEST_LOG = _side_table(
    "batch_id string, worker_id string, target string, msg string, started_at timestamp, "
    "ended_at timestamp, processed bigint, failed bigint, error string"
)


def landing_schema(table: T.StructType) -> T.StructType:
    """The schema to read landed JSON with: text for every column, except semi-structured
    ones, which keep their nesting. Casting is the load's work, so a bad value costs one
    reject and not a null that nobody sees."""
    return T.StructType(
        [
            T.StructField(
                f.name, f.dataType if isinstance(f.dataType, T.VariantType) else T.StringType()
            )
            for f in table.fields
        ]
    )
