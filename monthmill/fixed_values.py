"""Codes, names and ranges that have to be exactly these for results to agree."""

# Payment codes and their descriptions.
PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
CARD = 1

# Rate codes and their descriptions (code 99 differs between the two variants).
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
RATE_CODE_99 = {"lakehouse": "Null/unknown", "notebook": "Unknown"}

# Years and months that the trip table declares. Scans are not limited to them; the calendar
# covers these years at least.
TRIP_YEARS = (2021, 2026)
TRIP_MONTHS = (1, 12)

# Columns whose type is the same in every monthly file.
STABLE_COLUMNS = """
    tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
    trip_distance double, pulocationid bigint, dolocationid bigint, payment_type bigint,
    fare_amount double, tip_amount double, total_amount double
"""

# Columns that are double in the older files and bigint in the newer ones.
DRIFT_COLUMNS = ["ratecodeid", "passenger_count"]

# Eras of one drift type each (name, years, months, type of the drift columns). The last one
# has no end.
ERA_RANGES = [
    ("2021_2022", (2021, 2022), (1, 12), "double"),
    ("2023_jan", (2023, 2023), (1, 1), "double"),
    ("2023_rest", (2023, 2023), (2, 12), "bigint"),
    ("2024_onward", (2024, None), (1, 12), "bigint"),
]

# Columns that are missing together in incomplete rows of a monthly file.
MISSING_TOGETHER = [
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "Airport_fee",
]

# Amounts whose negative marks a refund. The match is by exact case, so the files'
# own "Airport_fee" is not among them.
REFUND_AMOUNTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
]

# Boroughs that stand for "no borough", text read as missing, and its replacement.
NO_BOROUGH = ["Unknown", "N/A"]
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
FILL_TEXT = "Unknown"

# The columns of the wide fact, the type each is pinned to (None keeps the source's; a
# date becomes its key) and the names it may come from.
WIDE_COLUMNS = [
    ("vendor_id", "int", ["VendorID", "vendorid", "vendor_id"]),
    ("pickup_date_key", "date", ["Pickup_date", "pickup_date"]),
    ("dropoff_date_key", "date", ["Dropoff_date", "dropoff_date"]),
    ("pickup_location_id", "int", ["PULocationID", "pulocationid", "pu_location_id"]),
    ("dropoff_location_id", "int", ["DOLocationID", "dolocationid", "do_location_id"]),
    ("rate_code_id", "int", ["RatecodeID", "ratecodeid", "rate_code_id"]),
    ("payment_type", "int", ["payment_type", "paymenttype"]),
    ("store_and_fwd_flag", "string", ["store_and_fwd_flag"]),
    ("pickup_time", None, ["Pickup_time", "pickup_time"]),
    ("dropoff_time", None, ["Dropoff_time", "dropoff_time"]),
    ("passenger_count", "int", ["passenger_count"]),
    ("trip_distance", None, ["trip_distance"]),
    ("fare_amount", None, ["fare_amount"]),
    ("extra", None, ["extra"]),
    ("mta_tax", None, ["mta_tax"]),
    ("tip_amount", None, ["tip_amount"]),
    ("tolls_amount", None, ["tolls_amount"]),
    ("improvement_surcharge", None, ["improvement_surcharge"]),
    ("congestion_surcharge", None, ["congestion_surcharge"]),
    ("airport_fee", None, ["Airport_fee", "airport_fee"]),
    ("cbd_congestion_fee", None, ["cbd_congestion_fee"]),
    ("total_amount", None, ["total_amount"]),
]
