"""GL and AP as views of the `orders` and `customer` tables.

Each order is one invoice. Its key modulo 97 plants its fate, its key divided
by 97 selects the defect, so a view needs no state and grows with `orders`.
The column rules are those of FIXTURES.md section 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import schemas
from tieout.contract import ACCOUNT_CODES, PAYMENT_STATUSES

FATES = 97
GL_ABSENT = (40, 41, 42, 53)
AP_ABSENT = (30, 31, 32)
GL_DEFECTIVE = 31
AP_DEFECTIVE = 41
GL_SPLIT = 54
AP_PAIRS = (50, 52, 53)
AP_TRIPLETS = (51,)


def _pick(options: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def _padded(value: Column, width: int) -> Column:
    """Zero-padded, never cut: lpad alone truncates what is longer."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def _cents(value: Column) -> Column:
    return (value.cast("decimal(16,0)") * F.expr("0.01BD")).cast("decimal(18,2)")


def _year(written: Column) -> Column:
    return F.left(written, F.length(written) - len("-mm-dd"))


def _month(written: Column) -> Column:
    return F.left(written, F.length(written) - len("-dd"))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the shared derived columns.

    The day is written out once; its month and year are cut from that text.
    """
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    day, written = F.col("day"), F.col("written")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    dated = orders.withColumn("day", F.col("o_orderdate").cast("date"))
    return dated.withColumn("written", day.cast("string")).select(
        key.alias("k"),
        (key % FATES).alias("f"),
        F.expr(f"o_orderkey div {FATES}").alias("g"),
        customer.alias("customer"),
        "day",
        "written",
        _month(written).alias("period"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        _pick(ACCOUNT_CODES, customer % len(ACCOUNT_CODES)).alias("account"),
        F.concat(F.lit("V"), _padded(customer % 10000, 4)).alias("vendor"),
        F.concat(
            F.lit("INV-"), _year(written), F.lit("-"), _padded(key % 1000000, 6)
        ).alias("invoice"),
    )


def gl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, g, k, c = F.col("f"), F.col("g"), F.col("k"), F.col("copy")
    defect = F.when(f == GL_DEFECTIVE, g % 7)
    department = k % 5 + 1
    lines = (
        invoices(spark, sf_dir)
        .where(~f.isin(*GL_ABSENT))
        .withColumn("copy", F.explode(F.expr(f"if(f = {GL_SPLIT}, array(0, 1), array(0))")))
    )
    columns = {
        "gl_entry_id": F.concat(F.lit("GL"), _padded(k * 2 + c, 9)),
        "posting_date": F.col("written"),
        "fiscal_period": F.when(defect == 2, F.translate("period", "-", "/")).otherwise(
            F.col("period")
        ),
        "account_code": F.when(defect == 3, "9999").otherwise(F.col("account")),
        "account_name": F.concat(F.lit("Account "), "account"),
        "department_code": F.when(defect == 4, "d100 ").otherwise(
            F.concat(F.lit("D"), (department * 100).cast("string"))
        ),
        "department_name": F.concat(F.lit("Department "), department.cast("string")),
        "vendor_code": F.col("vendor"),
        "invoice_number": F.col("invoice"),
        "amount": F.when(defect.isin(0, 5), "")
        .when(defect == 1, "0.00")
        .otherwise(F.col("price").cast("string")),
        "currency": F.when(defect == 5, "USDD").otherwise("USD"),
        "source_system": F.lit("GLCORE"),
        "extract_ts": F.lit("2026-08-01T02:15:00Z"),
    }
    return lines.select(*[columns[n].alias(n) for n in schemas.GL_SOURCE.fieldNames()])


def ap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, g, k, c = F.col("f"), F.col("g"), F.col("k"), F.col("copy")
    defect = F.when(f == AP_DEFECTIVE, g % 10)
    copies = F.expr(
        f"CASE WHEN f IN {AP_PAIRS} THEN array(0, 1)"
        f" WHEN f = {AP_TRIPLETS[0]} THEN array(0, 1, 2) ELSE array(0) END"
    )
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("customer"), F.col("c_name")
    )
    lines = (
        invoices(spark, sf_dir)
        .where(~f.isin(*AP_ABSENT))
        .join(names, "customer", "left")
        .withColumn("copy", F.explode(copies))
    )
    terms = _pick((30, 45, 60), k % 3)
    sign = F.when(k % 2 == 0, 1).otherwise(-1)
    delta = (
        F.when(f.between(1, 6), _cents((k % 99 + 1) * sign))
        .when(f == 7, _cents(F.lit(-100)))
        .when(f == 8, _cents(F.lit(101)))
        .when(f.between(10, 12), _cents((k % 500 + 2) * 100))
        .when((f == 52) & (c == 1), _cents((k % 195 + 5) * 100))
        .when(f == GL_SPLIT, F.col("price"))
        .otherwise(_cents(F.lit(0)))
    )
    columns = {
        "ap_line_id": F.when(defect.isin(8, 9), "AP000000000").otherwise(
            F.concat(F.lit("AP"), _padded(k * 4 + c + 1, 9))
        ),
        "invoice_date": F.col("written"),
        "due_date": F.date_add("day", terms).cast("string"),
        "fiscal_period": F.when(f.isin(10, 20, 21), _month(F.add_months("day", 1).cast("string")))
        .when(defect == 5, F.substring("period", 3, 5))
        .otherwise(F.col("period")),
        "vendor_code": F.when(defect == 4, "v12").otherwise(F.col("vendor")),
        "vendor_name": F.coalesce("c_name", F.lit("")),
        "account_code": F.col("account"),
        "invoice_number": F.col("invoice"),
        "amount": F.when(defect == 0, "")
        .when(defect == 1, "0.00")
        .when(defect == 2, "N/A")
        .when(defect == 6, "999000000000.00")
        .otherwise((F.col("price") + delta).cast("decimal(18,2)").cast("string")),
        "currency": F.when(defect == 3, "US$").otherwise("USD"),
        "payment_status": F.when(defect == 7, "CLOSED").otherwise(_pick(PAYMENT_STATUSES, k % 4)),
        "payment_terms_days": terms.cast("string"),
        "source_system": F.lit("APHUB"),
        "extract_ts": F.lit("2026-08-01T02:41:00Z"),
    }
    return lines.select(*[columns[n].alias(n) for n in schemas.AP_SOURCE.fieldNames()])


LINES = {"gl": gl_lines, "ap": ap_lines}
