"""Schemas of the logs, the dimensions and the shared tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
MONEY, DATE, TIME, FLAG = DecimalType(10, 2), DateType(), TimestampNTZType(), BooleanType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


SALES = _table(store_id=TEXT, item_id=TEXT, quantity=INT, price=MONEY, created_at=TIME)
WASTE = _table(store_id=TEXT, item_id=TEXT, quantity=INT, reason=TEXT, created_at=TIME)
STOCKOUTS = _table(store_id=TEXT, item_id=TEXT, quantity_requested=INT, created_at=TIME)
LOGS = {"sales": SALES, "waste": WASTE, "stockouts": STOCKOUTS}

STORES = _table(store_id=TEXT, name=TEXT, region=TEXT, level=INT, hours=TEXT, active=FLAG)
# In the CSV file, sale_days is the text of a list.
MENU_CSV = _table(
    item_id=TEXT, name=TEXT, price=DOUBLE, sale_price=DOUBLE, sale_days=TEXT, cost=DOUBLE,
    time_of_day=TEXT, category=TEXT, hold_time=DOUBLE, popularity=INT, active=FLAG, added=DATE,
)
MENU = _table(
    item_id=TEXT, name=TEXT, price=DOUBLE, sale_price=DOUBLE, sale_days=ArrayType(INT),
    cost=DOUBLE, time_of_day=TEXT, category=TEXT, hold_time=DOUBLE, cook_time=INT, batch=INT,
    popularity=INT, active=FLAG, added=DATE,
)
WEATHER = _table(region=TEXT, sale_date=DATE, temp_f=DOUBLE, precip=FLAG)

ARM = _table(
    units_sold=LONG, stockouts=LONG, units_wasted=LONG, waste_cost=DOUBLE, sales_revenue=DOUBLE
)
RESULTS = _table(
    cumulative=_table(
        days_run=LONG, ml_avg_waste_pct=DOUBLE, baseline_avg_waste_pct=DOUBLE,
        ml_avg_service_level=DOUBLE, base_avg_service_level=DOUBLE,
    ),
    daily=ArrayType(_table(date=TEXT, ml=ARM, baseline=ARM)),
)
DAILY_RESULTS = StructType([StructField("arm", TEXT), *ARM.fields, StructField("date", DATE)])
