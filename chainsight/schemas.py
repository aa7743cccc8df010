"""Schemas of the raw inputs and their mapping onto the role tables."""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES: names and types of the source files.
# Order-line export: 53 columns, bound by position (the header row is skipped,
# its text is not checked).
SHIPPING_CSV_COLUMNS = [
    ("Type", "string"), ("Days_for_shipping_real", "int"), ("Days_for_shipment_scheduled", "int"),
    ("Benefit_per_order", "double"), ("Sales_per_customer", "double"), ("Delivery_Status", "string"),
    ("Late_delivery_risk", "int"), ("Category_Id", "int"), ("Category_Name", "string"), ("Customer_City", "string"),
    ("Customer_Country", "string"), ("Customer_Email", "string"), ("Customer_Fname", "string"), ("Customer_Id", "int"),
    ("Customer_Lname", "string"), ("Customer_Password", "string"), ("Customer_Segment", "string"),
    ("Customer_State", "string"), ("Customer_Street", "string"), ("Customer_Zipcode", "string"),
    ("Department_Id", "int"), ("Department_Name", "string"), ("Latitude", "double"), ("Longitude", "double"),
    ("Market", "string"), ("Order_City", "string"), ("Order_Country", "string"), ("Order_Customer_Id", "int"),
    ("Order_Date", "string"), ("Order_Id", "int"), ("Order_Item_Cardprod_Id", "int"), ("Order_Item_Discount", "double"),
    ("Order_Item_Discount_Rate", "double"), ("Order_Item_Id", "int"), ("Order_Item_Product_Price", "double"),
    ("Order_Item_Profit_Ratio", "double"), ("Order_Item_Quantity", "int"), ("Sales", "double"),
    ("Order_Item_Total", "double"), ("Order_Profit_Per_Order", "double"), ("Order_Region", "string"),
    ("Order_State", "string"), ("Order_Status", "string"), ("Order_Zipcode", "string"), ("Product_Card_Id", "int"),
    ("Product_Category_Id", "int"), ("Product_Description", "string"), ("Product_Image", "string"),
    ("Product_Name", "string"), ("Product_Price", "double"), ("Product_Status", "int"), ("Shipping_Date", "string"),
    ("Shipping_Mode", "string"),
]
SHIPPING_CSV = ", ".join(f"{name} {kind}" for name, kind in SHIPPING_CSV_COLUMNS)

# FIXED VALUES: personal columns, which silver never selects.
SHIPPING_PERSONAL = ["Customer_Email", "Customer_Fname", "Customer_Lname", "Customer_Password",
                     "Customer_Street"]

# Raw column -> role-table column (see sources.tables for the role schema).
SHIPPING_ROLES = {
    "Order_Id": "order_id",
    "Order_Item_Id": "line_number",
    "Order_Date": "order_date",
    "Shipping_Date": "shipping_date",
    "Days_for_shipping_real": "days_real",
    "Days_for_shipment_scheduled": "days_scheduled",
    "Late_delivery_risk": "late_delivery_risk",
    "Delivery_Status": "delivery_status",
    "Shipping_Mode": "shipping_mode",
    "Market": "market",
    "Order_Country": "order_country",
    "Order_Region": "order_region",
    "Customer_Segment": "customer_segment",
    "Customer_State": "customer_state",
    "Product_Name": "product_name",
    "Sales": "sales",
    "Order_Profit_Per_Order": "order_profit",
}

# FIXED VALUES.  Storm event files: the columns kept, their target names and types.
STORM_COLUMNS = [
    ("BEGIN_YEARMONTH", "begin_yearmonth", "string"), ("BEGIN_DAY", "begin_day", "int"),
    ("BEGIN_TIME", "begin_time", "string"), ("END_YEARMONTH", "end_yearmonth", "string"),
    ("END_DAY", "end_day", "int"), ("EPISODE_ID", "episode_id", "string"),
    ("EVENT_ID", "event_id", "string"), ("STATE", "state", "string"),
    ("EVENT_TYPE", "event_type", "string"), ("CZ_NAME", "county_zone", "string"),
    ("INJURIES_DIRECT", "injuries_direct", "int"), ("INJURIES_INDIRECT", "injuries_indirect", "int"),
    ("DEATHS_DIRECT", "deaths_direct", "int"), ("DAMAGE_PROPERTY", "damage_property_raw", "string"),
    ("DAMAGE_CROPS", "damage_crops_raw", "string"), ("BEGIN_LAT", "begin_lat", "double"),
    ("BEGIN_LON", "begin_lon", "double"), ("EPISODE_NARRATIVE", "episode_narrative", "string"),
    ("EVENT_NARRATIVE", "event_narrative", "string"),
]

SUPPLIERS = T.StructType([
    T.StructField("supplier_id", T.StringType(), False),
    T.StructField("supplier_name", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("country_code", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("industry", T.StringType(), False),
    T.StructField("tier", T.IntegerType(), False),
    T.StructField("lead_time_days", T.IntegerType(), False),
    T.StructField("contract_value_usd", T.DoubleType(), False),
    T.StructField("quality_score", T.DoubleType(), False),
    T.StructField("esg_score", T.DoubleType(), False),
    T.StructField("risk_notes", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
])

COUNTRY_SCORES = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("lpi_score", T.DoubleType()),
    T.StructField("customs_score", T.DoubleType()),
    T.StructField("infrastructure_score", T.DoubleType()),
    T.StructField("international_shipments_score", T.DoubleType()),
    T.StructField("logistics_quality_score", T.DoubleType()),
    T.StructField("timeliness_score", T.DoubleType()),
])

PRICE_OBSERVATIONS = T.StructType([
    T.StructField("observations", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

# Every field of a feed item is text; a title such as "007" stays one.
NEWS_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("pubDate", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("_VALUE", T.StringType()),
                                          T.StructField("_url", T.StringType())])),
])
