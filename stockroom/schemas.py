"""Input and output contracts (column names, Spark types, nullability)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCTS = T.StructType(
    [
        T.StructField("ProductRootCode", T.IntegerType()),
        T.StructField("ProductId", T.IntegerType()),
        T.StructField("SupplierPrice", T.FloatType()),
        T.StructField("RetailPrice", T.FloatType()),
        T.StructField("Family", T.StringType()),
    ]
)

SALES = T.StructType(
    [
        T.StructField("StoreId", T.IntegerType()),
        T.StructField("ProductId", T.IntegerType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Quantity", T.IntegerType()),
    ]
)

STOCK_MOVEMENTS = T.StructType(
    [
        T.StructField("StoreId", T.IntegerType()),
        T.StructField("ProductId", T.IntegerType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Quantity", T.IntegerType()),
    ]
)

INPUTS = {"products": PRODUCTS, "sales": SALES, "stock_movements": STOCK_MOVEMENTS}

# Published output tables. Dates are timestamps in the published contract; the engine keeps
# DateType internally and converts only when a table is written with timestamp_output=True.
INTERVAL_STOCK = T.StructType(
    [
        T.StructField("ProductRootCode", T.IntegerType()),
        T.StructField("StoreId", T.IntegerType()),
        T.StructField("StartDate", T.TimestampType()),
        T.StructField("EndDate", T.TimestampType()),
        T.StructField("Stock", T.LongType()),
    ]
)

DAILY_STOCK = T.StructType(
    [
        T.StructField("ProductRootCode", T.IntegerType()),
        T.StructField("StoreId", T.IntegerType()),
        T.StructField("Date", T.TimestampType(), nullable=False),
        T.StructField("Stock", T.LongType()),
    ]
)


def _kpi(by: str, by_type: T.DataType, measure: str, nullable: bool) -> T.StructType:
    return T.StructType(
        [
            T.StructField("Year", T.IntegerType()),
            T.StructField(by, by_type),
            T.StructField(measure, T.DoubleType(), nullable=nullable),
        ]
    )


STORE_BENEFITS = _kpi("StoreId", T.IntegerType(), "Profit", nullable=False)
FAMILY_BENEFITS = _kpi("Family", T.StringType(), "Profit", nullable=False)
STORE_ROTATION = _kpi("StoreId", T.IntegerType(), "Turnover", nullable=True)
FAMILY_ROTATION = _kpi("Family", T.StringType(), "Turnover", nullable=True)

OUTPUTS = {
    "interval_stock": INTERVAL_STOCK,
    "daily_stock": DAILY_STOCK,
    "store_benefits": STORE_BENEFITS,
    "family_benefits": FAMILY_BENEFITS,
    "store_rotation": STORE_ROTATION,
    "family_rotation": FAMILY_ROTATION,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract columns in contract order, cast to the contract types.

    Only the listed columns are selected, so the Parquet scan reads nothing else. Nothing is rounded or
    cut: a price keeps a DOUBLE, DECIMAL or integer type, a LONG Quantity stays LONG, and a value that is
    no whole number, or outside the contract's integer range, raises (NaN counts as NULL). A timestamp
    becomes its day.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input is missing columns {missing}; has {df.columns}")
    return df.select(
        [
            _wide(f.name, df.schema[f.name].dataType, f.dataType).alias(f.name) for f in schema.fields
        ]
    )


_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _wide(name: str, actual: T.DataType, wanted: T.DataType) -> Column:
    """The column in the contract's type, or in a wider one of the input; never a narrowed value."""
    col = F.col(name)
    if actual == wanted:
        return col
    if isinstance(wanted, T.FloatType) and isinstance(actual, (*_FRACTIONAL, *_WHOLE)):
        return col.cast("decimal(20,0)") if isinstance(actual, _WHOLE) else col
    if not isinstance(wanted, T.IntegerType) or not isinstance(actual, (*_FRACTIONAL, *_WHOLE)):
        return col.cast(wanted)
    if name == "Quantity" and isinstance(actual, _WHOLE):
        return col.cast("long") if isinstance(actual, T.LongType) else col.cast(wanted)
    target = T.LongType() if name == "Quantity" else wanted
    whole = col.try_cast(target)
    problem = F.raise_error(F.concat(F.lit(f"{name} "), col.cast("string"), F.lit(f" is no {target.simpleString()}")))
    missing = (col.isNull() | F.isnan(name)) if isinstance(actual, (T.FloatType, T.DoubleType)) else col.isNull()
    return F.when(missing, F.lit(None).cast(target)).when(F.coalesce(whole.cast(actual) == col, F.lit(False)), whole).otherwise(problem)


def with_dates(schema: T.StructType) -> T.StructType:
    """A published contract for output whose dates are not converted to timestamps."""
    return T.StructType(
        [T.StructField(f.name, T.DateType() if isinstance(f.dataType, T.TimestampType) else f.dataType, f.nullable) for f in schema.fields]
    )


def schema_mismatches(df: DataFrame, schema: T.StructType, check_nullability: bool = True) -> list[str]:
    """Differences between a frame's schema and a contract; empty when they agree."""
    problems: list[str] = []
    actual = {f.name: f for f in df.schema.fields}
    if [f.name for f in df.schema.fields] != [f.name for f in schema.fields]:
        problems.append(f"columns {list(actual)} != {[f.name for f in schema.fields]}")
    for f in schema.fields:
        a = actual.get(f.name)
        if a is None:
            continue
        if a.dataType != f.dataType:
            problems.append(f"{f.name}: {a.dataType.simpleString()} != {f.dataType.simpleString()}")
        # A column the contract declares NOT NULL must not be nullable; the reverse is harmless.
        if check_nullability and not f.nullable and a.nullable:
            problems.append(f"{f.name}: nullable, contract says not null")
    return problems
