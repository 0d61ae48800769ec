"""Text to typed values, and projection through a declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def typed(column: str, data_type: T.DataType) -> Column:
    """The value in its declared type, NULL where it cannot be read.

    Columns without a rule may hold anything, and a matching pattern does not
    make a date exist, so no cast here may abort the job. Values lost this way
    are counted by the `cast_losses` control.
    """
    c = F.col(column)
    match data_type:
        case T.StringType():
            return F.trim(c)
        case T.DateType():
            by_format = F.try_to_date(c, DATE_FORMAT)
            return F.when(_laid_out(c, "yyyy-mm-dd"), c.try_cast(data_type)).otherwise(by_format)
        case T.TimestampType():
            by_format = F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))
            # Without the Z: the format takes it for a letter, a cast for a zone.
            local = F.left(c, F.lit(19)).try_cast(data_type)
            return F.when(_laid_out(c, "yyyy-mm-ddThh:mm:ssZ"), local).otherwise(by_format)
        case T.DecimalType() | T.IntegerType() | T.LongType() | T.BooleanType():
            return c.try_cast(data_type)
    raise ValueError(f"{column}: no cast to {data_type.simpleString()}")


def _laid_out(c: Column, layout: str) -> Column:
    """Whether it is as long as the layout, with its signs in place and a digit at the end.

    Of such text a cast reads what the format reads, and is several times as fast:
    what a cast alone would take is shorter or longer, or has a blank or sign at an end.
    """
    signs = [i for i, letter in enumerate(layout, start=1) if letter in "-T:Z"]
    last = F.substring(c, len(layout.rstrip("Z")), 1)
    fits = (F.length(c) == len(layout)) & last.between("0", "9")
    return reduce(Column.__and__, [F.substring(c, i, 1) == layout[i - 1] for i in signs], fits)


def conform(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Exactly the declared columns, in order and type; a missing one raises."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: declared columns were not produced: {missing}")
    return df.select(
        *[
            (
                F.col(f.name)
                if isinstance(f.dataType, T.StringType)
                else F.col(f.name).cast(f.dataType)
            ).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )
