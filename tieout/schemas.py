"""Declared schemas. Nothing is inferred; every table is written through one."""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()
INT = T.IntegerType()
LONG = T.LongType()
MONEY = T.DecimalType(18, 2)
# Sums of MONEY. The width Spark's own sum() gives, so that a total over any
# number of rows is stored as computed instead of overflowing.
TOTAL = T.DecimalType(28, 2)
PERCENT = T.DecimalType(7, 4)


def _struct(*columns: tuple) -> T.StructType:
    """Columns as (name, type, nullable, comment)."""
    return T.StructType(
        [T.StructField(n, t, null, {"comment": text}) for n, t, null, text in columns]
    )


_PERIOD_NOTE = "Accounting period yyyy-mm; decides reporting, whatever the dates say."

GL_SOURCE = _struct(
    ("gl_entry_id", STRING, True, "Id of the posting within a load."),
    ("posting_date", STRING, True, "Day the entry was booked."),
    ("fiscal_period", STRING, True, _PERIOD_NOTE),
    ("account_code", STRING, True, "Account; part of the business key."),
    ("account_name", STRING, True, "Account label."),
    ("department_code", STRING, True, "Cost centre."),
    ("department_name", STRING, True, "Cost centre label."),
    ("vendor_code", STRING, True, "Vendor; part of the business key."),
    ("invoice_number", STRING, True, "Vendor's invoice; part of the business key."),
    ("amount", STRING, True, "Posted amount."),
    ("currency", STRING, True, "ISO currency."),
    ("source_system", STRING, True, "System the row was taken from."),
    ("extract_ts", STRING, True, "When the extract was taken."),
)

AP_SOURCE = _struct(
    ("ap_line_id", STRING, True, "Id of the line within a load."),
    ("invoice_date", STRING, True, "Day the vendor issued the invoice."),
    ("due_date", STRING, True, "Day payment falls due."),
    ("fiscal_period", STRING, True, _PERIOD_NOTE),
    ("vendor_code", STRING, True, "Vendor; part of the business key."),
    ("vendor_name", STRING, True, "Vendor label."),
    ("account_code", STRING, True, "Account; part of the business key."),
    ("invoice_number", STRING, True, "Vendor's invoice; part of the business key."),
    ("amount", STRING, True, "Invoiced amount."),
    ("currency", STRING, True, "ISO currency."),
    ("payment_status", STRING, True, "Step of the payment workflow."),
    ("payment_terms_days", STRING, True, "Agreed days to pay."),
    ("source_system", STRING, True, "System the row was taken from."),
    ("extract_ts", STRING, True, "When the extract was taken."),
)

LINEAGE = _struct(
    ("_ingested_at", TIMESTAMP, False, "When the row was landed."),
    ("_source_file", STRING, False, "File the row came from."),
    ("_batch_id", STRING, False, "Load the row belongs to."),
)

REJECTION = _struct(
    ("_quarantined_at", TIMESTAMP, False, "When the row was rejected."),
    ("_dataset", STRING, False, "gl or ap."),
    ("_failed_rule_ids", STRING, False, "Breached rule ids in order, pipe-separated."),
    ("_failed_rule_count", INT, False, "How many rules the row breached."),
)

_TYPED = {
    "posting_date": DATE,
    "invoice_date": DATE,
    "due_date": DATE,
    "amount": MONEY,
    "payment_terms_days": INT,
    "extract_ts": TIMESTAMP,
}
_REQUIRED = {"account_code", "vendor_code", "invoice_number", "amount", "fiscal_period"}


def bronze(source: T.StructType) -> T.StructType:
    return T.StructType(source.fields + LINEAGE.fields)


def silver(source: T.StructType) -> T.StructType:
    typed = [
        T.StructField(f.name, _TYPED.get(f.name, STRING), f.name not in _REQUIRED, f.metadata)
        for f in source.fields
    ]
    return T.StructType(typed + LINEAGE.fields)


def quarantine(source: T.StructType) -> T.StructType:
    return T.StructType(source.fields + LINEAGE.fields + REJECTION.fields)


_SIDES = (
    ("gl_amount", TOTAL, True, "GL total of the key; NULL when the GL has no row."),
    ("ap_amount", TOTAL, True, "AP total of the key; NULL when AP has no row."),
    ("amount_difference", TOTAL, False, "GL minus AP, an absent side counting as zero."),
    ("abs_amount_difference", TOTAL, False, "Size of the difference: the exposure."),
    ("gl_fiscal_period", STRING, True, "Earliest GL period of the key."),
    ("ap_fiscal_period", STRING, True, "Earliest AP period of the key."),
    ("gl_row_count", LONG, False, "GL rows of the key, 0 when none."),
    ("ap_row_count", LONG, False, "AP rows of the key; above one is a duplicate."),
)

RECON_DETAIL = _struct(
    ("fiscal_period", STRING, False, "GL period, else AP period."),
    ("account_code", STRING, False, "Business key."),
    ("vendor_code", STRING, False, "Business key."),
    ("invoice_number", STRING, False, "Business key."),
    ("break_status", STRING, False, "One of the six statuses."),
    *_SIDES,
)

RECON_SUMMARY = _struct(
    ("fiscal_period", STRING, False, "Reporting period."),
    ("break_status", STRING, False, "One of the six statuses."),
    ("key_count", LONG, False, "Keys in this cell, 0 when none."),
    ("gl_amount", TOTAL, False, "GL total of the cell."),
    ("ap_amount", TOTAL, False, "AP total of the cell."),
    ("net_amount_difference", TOTAL, False, "Signed differences summed; they cancel."),
    ("abs_amount_difference", TOTAL, False, "Sizes summed; nothing cancels."),
)

RECON_EXCEPTIONS = _struct(
    ("exception_rank", LONG, False, "1 for the largest exposure; ties by business key."),
    ("fiscal_period", STRING, False, "Reporting period."),
    ("break_status", STRING, False, "One of the five unmatched statuses."),
    ("account_code", STRING, False, "Business key."),
    ("account_name", STRING, True, "Account label."),
    ("vendor_code", STRING, False, "Business key."),
    ("vendor_name", STRING, True, "Vendor label."),
    ("invoice_number", STRING, False, "Business key."),
    *_SIDES,
)

DQ_SCORECARD = _struct(
    ("dataset", STRING, False, "gl or ap."),
    ("label", STRING, False, "Name of the dataset."),
    ("rows_received", LONG, False, "Rows landed."),
    ("rows_passed", LONG, False, "Rows that breached no rule."),
    ("rows_quarantined", LONG, False, "Rows rejected."),
    ("rule_violations", LONG, False, "Breaches; a row may hold several."),
    ("dq_score_pct", PERCENT, False, "Passed share of received, in percent."),
)

DQ_RULE_SCORECARD = _struct(
    ("rule_id", STRING, False, "Rule id, never reused."),
    ("dataset", STRING, False, "gl or ap."),
    ("column_name", STRING, False, "Column under test."),
    ("check_type", STRING, False, "Kind of check."),
    ("severity", STRING, False, "reject or warn."),
    ("description", STRING, False, "What the rule asks for."),
    ("predicate_sql", STRING, False, "Expression evaluated, TRUE where breached."),
    ("rows_rejected", LONG, False, "Rows that breached the rule, 0 when none."),
)

RULE_CATALOGUE = T.StructType(
    [f for f in DQ_RULE_SCORECARD.fields if f.name != "rows_rejected"]
)

SOURCES = {"gl": GL_SOURCE, "ap": AP_SOURCE}

# Tables by (layer, table).
TABLES = {
    ("bronze", "gl"): bronze(GL_SOURCE),
    ("bronze", "ap_subledger"): bronze(AP_SOURCE),
    ("silver", "gl"): silver(GL_SOURCE),
    ("silver", "ap_subledger"): silver(AP_SOURCE),
    ("quarantine", "gl"): quarantine(GL_SOURCE),
    ("quarantine", "ap_subledger"): quarantine(AP_SOURCE),
    ("gold", "recon_detail"): RECON_DETAIL,
    ("gold", "recon_summary"): RECON_SUMMARY,
    ("gold", "recon_exceptions"): RECON_EXCEPTIONS,
    ("gold", "dq_scorecard"): DQ_SCORECARD,
    ("gold", "dq_rule_scorecard"): DQ_RULE_SCORECARD,
}

# Lines that could not be landed, beside the tables of the pipeline.
REJECTED_LINES = _struct(
    ("_source_file", STRING, False, "File the line is in."),
    ("line_offset", LONG, True, "Its first byte in the file; NULL if records span lines."),
    ("line", STRING, False, "The line as it is."),
    ("reason", STRING, False, "Why it is no row."),
    ("_dataset", STRING, False, "gl or ap."),
    ("_ingested_at", TIMESTAMP, False, "When the load ran."),
    ("_batch_id", STRING, False, "Load the line belongs to."),
)
REJECTS = {
    ("bronze", f"{table}_rejected"): REJECTED_LINES
    for layer, table in TABLES
    if layer == "bronze"
}


def declared(layer: str, table: str) -> T.StructType:
    return (TABLES | REJECTS)[layer, table]


def ddl(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE statement; StructType.fromDDL reads it back."""
    return ",\n".join(
        f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
