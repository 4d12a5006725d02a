"""Values fixed by the data this library serves; results depend on them literally.

They are defaults only: every function that uses one takes it as an argument.
"""

# The six transaction types, and the order in which a phone is looked up in them.
TX_TYPES = ("act", "reno", "dct", "cnr", "ppd", "rfnd")
PHONE_LOOKUP_ORDER = ("ACT", "RENO", "DCT", "PPD")

# Fixed value: the channel that marks an upgrade in activations and deactivations.
UPGRADE_CHANNEL = "UPGRADE"

# Tokens that mean null in the daily extracts.
NULL_TOKENS = ("", "NULL", "null")

# Sort codes of the two types that carry no transaction type of their own.
CNR_SORT_CODE = 99
RFND_SORT_CODE = 100

# A service whose name contains one of these is left out of the service reports.
EXCLUDED_SERVICE_KEYWORDS = ("nubico", "challenge arena", "movistar apple music", "juegos onmo")

# Categories merged in the user-base rollups (lower-case name -> merged name).
CATEGORY_GROUPS = {
    "education": "Edu_Ima",
    "images": "Edu_Ima",
    "news": "News_Sport",
    "sports": "News_Sport",
}

# First word of the subscription model -> charging period in days.
PERIOD_DAYS = {
    "Monthly": 30,
    "Weekly": 7,
    "Trimonthly": 90,
    "Bimontly": 60,
    "One": 1,
    "3": 3,
    "45": 45,
    "0": 0,
    "Other": 0,
    "Sesion": 0,
    "PPD": 99999,
}

# Fixed value: country code put in front of a phone number that lacks it.
COUNTRY_CODE = "34"

# Transaction type codes of the operational source.
SOURCE_TYPE_CODES = {"act": 1, "reno": 2, "dct": 3, "ppd": 4}

# Columns of the counter tables, in file order.
COUNT_COLUMNS = (
    "act_count", "act_free", "act_pay", "upg_count", "reno_count",
    "dct_count", "upg_dct_count", "cnr_count", "ppd_count", "rfnd_count",
)
AMOUNT_COLUMNS = ("rfnd_amount", "rev")
COUNTER_COLUMNS = ("date", "cpc") + COUNT_COLUMNS + AMOUNT_COLUMNS
SERVICE_COLUMNS = ("date", "service_name", "tme_category", "cpc", "cpc_period", "cpc_price") + COUNT_COLUMNS + AMOUNT_COLUMNS

# The 34 columns of the lifecycle table, in file order.
LIFECYCLE_COLUMNS = (
    "subscription_id", "tmuserid", "msisdn", "cpc_list", "cpc_count", "first_cpc", "current_cpc",
    "has_upgraded", "upgrade_date", "upgraded_to_cpc", "activation_date", "activation_trans_date",
    "missing_act_record", "activation_campaign", "activation_channel", "activation_revenue",
    "activation_month", "renewal_count", "renewal_revenue", "last_renewal_date",
    "first_renewal_date", "last_activity_date", "deactivation_date", "deactivation_mode",
    "cancellation_date", "cancellation_mode", "refund_count", "total_refunded", "last_refund_date",
    "total_revenue", "total_revenue_with_upgrade", "subscription_status", "lifetime_days", "end_date",
)
