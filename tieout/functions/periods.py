"""Fiscal periods as numbers.

An aggregate buffer can hold a number in place but not a string: min() of a
string makes Spark sort all rows by the key before it can combine them. A
period that the contract has checked to be yyyy-mm is therefore compared as
yyyymm and written back as text once per key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(period: Column) -> Column:
    return F.substring(period, 1, 4).cast("int") * 100 + F.substring(period, 6, 2).cast("int")


def to_text(number: Column) -> Column:
    digits = F.lpad(number.cast("string"), 6, "0")
    return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2))
