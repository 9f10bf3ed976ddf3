"""Target schemas. A mart or staging table is always cast to one of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


LONG, INT, STRING, TIME = LongType(), IntegerType(), StringType(), TimestampNTZType()


def columns(**types: DataType) -> StructType:
    """A schema of nullable columns in the order given."""
    return StructType([StructField(name, kind) for name, kind in types.items()])


POSTS = columns(
    id=LONG, user_id=LONG, creation_date=TIME, views_count=DecimalType(14, 2),
    post_type_id=STRING,
)
USERS = columns(
    id=LONG, display_name=STRING, creation_date=TIME,
)

ORDERS = columns(
    user_id=LONG, order_id=LONG, order_ts=TIME, cost=DecimalType(14, 2), status=INT,
)
RFM_SEGMENTS = columns(
    user_id=LONG, recency=INT, frequency=INT, monetary_value=INT,
)

SHIPPING_LOG = columns(
    id=LONG, shippingid=LONG, vendorid=LONG, payment_amount=DecimalType(14, 2),
    state_datetime=TIME, status=STRING, state=STRING, shipping_plan_datetime=TIME,
    shipping_transfer_description=STRING, shipping_transfer_rate=DecimalType(14, 3),
    shipping_country=STRING, shipping_country_base_rate=DecimalType(14, 3),
    vendor_agreement_description=STRING,
)
SHIPPING_COUNTRY_RATES = columns(
    shipping_country_id=LONG, shipping_country=STRING,
    shipping_country_base_rate=DecimalType(14, 3),
)
SHIPPING_AGREEMENT = columns(
    agreementid=LONG, agreement_number=STRING, agreement_rate=DecimalType(14, 2),
    agreement_commission=DecimalType(14, 3),
)
SHIPPING_TRANSFER = columns(
    transfer_type_id=LONG, transfer_type=STRING, transfer_model=STRING,
    shipping_transfer_rate=DecimalType(14, 3),
)
SHIPPING_INFO = columns(
    shippingid=LONG, vendorid=LONG, payment_amount=DecimalType(14, 2),
    shipping_plan_datetime=TIME, transfer_type_id=LONG, shipping_country_id=LONG,
    agreementid=LONG,
)

USER_ORDER_LOG = columns(
    date_time=TIME, city_id=INT, city_name=STRING, customer_id=LONG, first_name=STRING,
    last_name=STRING, item_id=LONG, item_name=STRING, quantity=LONG,
    payment_amount=DecimalType(14, 2),
)
CUSTOMER_RESEARCH = columns(
    date_id=TIME, category_id=INT, geo_id=INT, sales_qty=INT, sales_amt=DecimalType(18, 2),
)
USER_ACTIVITY_LOG = columns(
    date_time=TIME, action_id=LONG, customer_id=LONG, quantity=LONG,
)
DIM_CITY = columns(
    city_id=INT, city_name=STRING,
)
DIM_ITEM = columns(
    item_id=LONG, item_name=STRING,
)
DIM_CUSTOMER = columns(
    customer_id=LONG, first_name=STRING, last_name=STRING, city_id=INT,
)
SALES_FACT = columns(
    date_id=INT, item_id=LONG, customer_id=LONG, city_id=INT, quantity=LONG,
    payment_amount=DecimalType(14, 2),
)
CUSTOMER_RETENTION = columns(
    new_customers_count=LONG, returning_customers_count=LONG, refunded_customer_count=LONG,
    period_id=INT, new_customers_revenue=DecimalType(18, 2),
    returning_customers_revenue=DecimalType(18, 2), customers_refunded=LONG,
)


def conform(df: DataFrame, schema: StructType, *extra: str | Column) -> DataFrame:
    """Select exactly the columns of ``schema`` by name, cast to its types.

    ``extra`` columns are passed through after them. Under ANSI mode a value
    that does not fit raises instead of turning into NULL.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], *extra)
