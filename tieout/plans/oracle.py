"""The registered queries once more, as SQL for DuckDB.

Written against the given tables, without using the engine: its own fixture
views, rules, join and ladder. Only published texts (rule ids, descriptions,
predicates) are taken from the contract, as VALUES.
"""

from __future__ import annotations

from tieout.contract import BUSINESS_KEY, DEFAULT, STATUSES
from tieout.functions.predicates import predicate

KEY = ", ".join(BUSINESS_KEY)

# --- fixture views ----------------------------------------------------------------

FIXTURES = """
inv AS (
  SELECT o_orderkey AS k, o_orderkey % 97 AS f, o_orderkey // 97 AS g, o_custkey AS cust,
         CAST(o_orderdate AS DATE) AS d,
         strftime(o_orderdate, '%Y-%m') AS p,
         strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS p1,
         CAST(o_totalprice AS DECIMAL(18,2)) AS m,
         ['5010','6010','6020','6030','6040','6050','7010'][CAST(o_custkey % 7 + 1 AS INT)] AS acc,
         printf('V%04d', o_custkey % 10000) AS ven,
         'INV-' || strftime(o_orderdate, '%Y') || printf('-%06d', o_orderkey % 1000000) AS num
  FROM orders),
gl AS MATERIALIZED (
  SELECT printf('GL%09d', k * 2 + c) AS gl_entry_id,
         strftime(d, '%Y-%m-%d') AS posting_date,
         CASE WHEN f = 31 AND g % 7 = 2 THEN replace(p, '-', '/') ELSE p END AS fiscal_period,
         CASE WHEN f = 31 AND g % 7 = 3 THEN '9999' ELSE acc END AS account_code,
         'Account ' || acc AS account_name,
         CASE WHEN f = 31 AND g % 7 = 4 THEN 'd100 ' ELSE 'D' || (k % 5 + 1) * 100 END
           AS department_code,
         'Department ' || (k % 5 + 1) AS department_name,
         ven AS vendor_code, num AS invoice_number,
         CASE WHEN f = 31 AND g % 7 IN (0, 5) THEN '' WHEN f = 31 AND g % 7 = 1 THEN '0.00'
              ELSE CAST(m AS VARCHAR) END AS amount,
         CASE WHEN f = 31 AND g % 7 = 5 THEN 'USDD' ELSE 'USD' END AS currency,
         'GLCORE' AS source_system, '2026-08-01T02:15:00Z' AS extract_ts
  FROM inv CROSS JOIN (VALUES (0), (1)) AS t(c)
  WHERE f NOT IN (40, 41, 42, 53) AND (c = 0 OR f = 54)),
ap AS MATERIALIZED (
  SELECT CASE WHEN f = 41 AND g % 10 IN (8, 9) THEN 'AP000000000'
              ELSE printf('AP%09d', k * 4 + c + 1) END AS ap_line_id,
         strftime(d, '%Y-%m-%d') AS invoice_date,
         strftime(d + CAST([30, 45, 60][CAST(k % 3 + 1 AS INT)] AS INT), '%Y-%m-%d') AS due_date,
         CASE WHEN f IN (10, 20, 21) THEN p1 WHEN f = 41 AND g % 10 = 5 THEN p[3:] ELSE p END
           AS fiscal_period,
         CASE WHEN f = 41 AND g % 10 = 4 THEN 'v12' ELSE ven END AS vendor_code,
         coalesce(c_name, '') AS vendor_name,
         acc AS account_code, num AS invoice_number,
         CASE WHEN f = 41 AND g % 10 = 0 THEN '' WHEN f = 41 AND g % 10 = 1 THEN '0.00'
              WHEN f = 41 AND g % 10 = 2 THEN 'N/A'
              WHEN f = 41 AND g % 10 = 6 THEN '999000000000.00'
              ELSE CAST(CAST(m + CASE
                WHEN f BETWEEN 1 AND 6
                  THEN CAST(k % 99 + 1 AS DECIMAL(9,2)) / 100 * CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END
                WHEN f = 7 THEN -1.00 WHEN f = 8 THEN 1.01
                WHEN f IN (10, 11, 12) THEN k % 500 + 2
                WHEN f = 52 AND c = 1 THEN k % 195 + 5
                WHEN f = 54 THEN m ELSE 0 END AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CASE WHEN f = 41 AND g % 10 = 3 THEN 'US$' ELSE 'USD' END AS currency,
         CASE WHEN f = 41 AND g % 10 = 7 THEN 'CLOSED'
              ELSE ['OPEN','PAID','PARTIAL','ON_HOLD'][CAST(k % 4 + 1 AS INT)] END AS payment_status,
         CAST([30, 45, 60][CAST(k % 3 + 1 AS INT)] AS VARCHAR) AS payment_terms_days,
         'APHUB' AS source_system, '2026-08-01T02:41:00Z' AS extract_ts
  FROM inv CROSS JOIN (VALUES (0), (1), (2)) AS t(c) LEFT JOIN customer ON c_custkey = cust
  WHERE f NOT IN (30, 31, 32)
    AND (c = 0 OR (c = 1 AND f IN (50, 51, 52, 53)) OR (c = 2 AND f = 51)))"""

# --- rules ------------------------------------------------------------------------

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _present(c: str) -> str:
    return f"trim(coalesce({c}, ''), {BLANKS}) <> ''"


def _missing(c: str) -> str:
    return f"trim(coalesce({c}, ''), {BLANKS}) = ''"


def _repeated(c: str) -> str:
    return f"{_present(c)} AND count(*) OVER (PARTITION BY {c}) > 1"


def _misspelt(c: str, pattern: str) -> str:
    return f"{_present(c)} AND NOT regexp_full_match({c}, '{pattern}')"


def _foreign(c: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{_present(c)} AND {c} NOT IN ({listed})"


_NUMBER = "TRY_CAST(amount AS DECIMAL(18,2))"
_TEXT_AMOUNT = f"{_present('amount')} AND {_NUMBER} IS NULL"
_ZERO_AMOUNT = f"coalesce({_NUMBER} = 0, false)"
_HUGE_AMOUNT = f"coalesce({_NUMBER} NOT BETWEEN -1000000000 AND 1000000000, false)"
_ACCOUNTS = ("5010", "6010", "6020", "6030", "6040", "6050", "7010")
_DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_PERIOD = "[0-9]{4}-(0[1-9]|1[0-2])"
_INVOICE = "INV-[0-9]{4}-[0-9]{6}"

# (id, check type, column, condition)
GL_RULES = [
    ("GL_DOM_ACCOUNT_CODE", "allowed_values", "account_code", _foreign("account_code", *_ACCOUNTS)),
    ("GL_DOM_CURRENCY", "allowed_values", "currency", _foreign("currency", "USD")),
    ("GL_DOM_DEPARTMENT_CODE", "allowed_values", "department_code",
     _foreign("department_code", "D100", "D200", "D300", "D400", "D500")),
    ("GL_FMT_DEPARTMENT_CODE", "regex", "department_code",
     _misspelt("department_code", "D[0-9]{3}")),
    ("GL_FMT_FISCAL_PERIOD", "regex", "fiscal_period", _misspelt("fiscal_period", _PERIOD)),
    ("GL_FMT_INVOICE_NUMBER", "regex", "invoice_number", _misspelt("invoice_number", _INVOICE)),
    ("GL_FMT_POSTING_DATE", "regex", "posting_date", _misspelt("posting_date", _DATE)),
    ("GL_FMT_VENDOR_CODE", "regex", "vendor_code", _misspelt("vendor_code", "V[0-9]{4}")),
    ("GL_NN_ACCOUNT_CODE", "not_null", "account_code", _missing("account_code")),
    ("GL_NN_AMOUNT", "not_null", "amount", _missing("amount")),
    ("GL_NN_ENTRY_ID", "not_null", "gl_entry_id", _missing("gl_entry_id")),
    ("GL_NN_FISCAL_PERIOD", "not_null", "fiscal_period", _missing("fiscal_period")),
    ("GL_NN_INVOICE_NUMBER", "not_null", "invoice_number", _missing("invoice_number")),
    ("GL_NN_POSTING_DATE", "not_null", "posting_date", _missing("posting_date")),
    ("GL_NN_VENDOR_CODE", "not_null", "vendor_code", _missing("vendor_code")),
    ("GL_NONZERO_AMOUNT", "non_zero", "amount", _ZERO_AMOUNT),
    ("GL_NUM_AMOUNT", "numeric", "amount", _TEXT_AMOUNT),
    ("GL_RANGE_AMOUNT", "numeric_range", "amount", _HUGE_AMOUNT),
    ("GL_UNIQ_ENTRY_ID", "unique", "gl_entry_id", _repeated("gl_entry_id")),
]
AP_RULES = [
    ("AP_DOM_ACCOUNT_CODE", "allowed_values", "account_code", _foreign("account_code", *_ACCOUNTS)),
    ("AP_DOM_CURRENCY", "allowed_values", "currency", _foreign("currency", "USD")),
    ("AP_DOM_PAYMENT_STATUS", "allowed_values", "payment_status",
     _foreign("payment_status", "OPEN", "PAID", "PARTIAL", "ON_HOLD")),
    ("AP_FMT_FISCAL_PERIOD", "regex", "fiscal_period", _misspelt("fiscal_period", _PERIOD)),
    ("AP_FMT_INVOICE_DATE", "regex", "invoice_date", _misspelt("invoice_date", _DATE)),
    ("AP_FMT_INVOICE_NUMBER", "regex", "invoice_number", _misspelt("invoice_number", _INVOICE)),
    ("AP_FMT_VENDOR_CODE", "regex", "vendor_code", _misspelt("vendor_code", "V[0-9]{4}")),
    ("AP_NN_ACCOUNT_CODE", "not_null", "account_code", _missing("account_code")),
    ("AP_NN_AMOUNT", "not_null", "amount", _missing("amount")),
    ("AP_NN_FISCAL_PERIOD", "not_null", "fiscal_period", _missing("fiscal_period")),
    ("AP_NN_INVOICE_DATE", "not_null", "invoice_date", _missing("invoice_date")),
    ("AP_NN_INVOICE_NUMBER", "not_null", "invoice_number", _missing("invoice_number")),
    ("AP_NN_LINE_ID", "not_null", "ap_line_id", _missing("ap_line_id")),
    ("AP_NN_VENDOR_CODE", "not_null", "vendor_code", _missing("vendor_code")),
    ("AP_NONZERO_AMOUNT", "non_zero", "amount", _ZERO_AMOUNT),
    ("AP_NUM_AMOUNT", "numeric", "amount", _TEXT_AMOUNT),
    ("AP_RANGE_AMOUNT", "numeric_range", "amount", _HUGE_AMOUNT),
    ("AP_UNIQ_LINE_ID", "unique", "ap_line_id", _repeated("ap_line_id")),
]
RULES = {"gl": GL_RULES, "ap": AP_RULES}
ROW_ID = {"gl": "gl_entry_id", "ap": "ap_line_id"}


def _annotated(side: str) -> str:
    hits = ",\n    ".join(f"CASE WHEN {c} THEN '{i}' END" for i, _, _, c in RULES[side])
    return f"""
{side}_a AS MATERIALIZED (
  SELECT *, len(list_filter(string_split(_failed_rule_ids, '|'), lambda x: x <> ''))::INT
              AS _failed_rule_count
  FROM (SELECT *, concat_ws('|', {hits}) AS _failed_rule_ids FROM {side}))"""


# --- layers -----------------------------------------------------------------------

ANNOTATED = FIXTURES + "," + _annotated("gl") + "," + _annotated("ap")

SILVER = ANNOTATED + """,
gl_s AS (
  SELECT gl_entry_id, CAST(posting_date AS DATE) AS posting_date, fiscal_period, account_code,
         account_name, department_code, department_name, vendor_code, invoice_number,
         CAST(amount AS DECIMAL(18,2)) AS amount, currency, source_system,
         strptime(extract_ts, '%Y-%m-%dT%H:%M:%SZ') AS extract_ts
  FROM gl_a WHERE _failed_rule_count = 0),
ap_s AS (
  SELECT ap_line_id, CAST(invoice_date AS DATE) AS invoice_date, CAST(due_date AS DATE) AS due_date,
         fiscal_period, vendor_code, vendor_name, account_code, invoice_number,
         CAST(amount AS DECIMAL(18,2)) AS amount, currency, payment_status,
         CAST(payment_terms_days AS INT) AS payment_terms_days, source_system,
         strptime(extract_ts, '%Y-%m-%dT%H:%M:%SZ') AS extract_ts
  FROM ap_a WHERE _failed_rule_count = 0),
gl_q AS (SELECT *, 'gl' AS _dataset FROM gl_a WHERE _failed_rule_count > 0),
ap_q AS (SELECT *, 'ap' AS _dataset FROM ap_a WHERE _failed_rule_count > 0),
q AS (SELECT _dataset, _failed_rule_ids, _failed_rule_count FROM gl_q
      UNION ALL SELECT _dataset, _failed_rule_ids, _failed_rule_count FROM ap_q)"""


def _side(side: str) -> str:
    return (
        f"SELECT {KEY}, CAST(sum(amount) AS DECIMAL(28,2)) AS {side}_amount,"
        f" min(fiscal_period) AS {side}_fiscal_period, count(*) AS {side}_row_count"
        f" FROM {side}_s GROUP BY {KEY}"
    )


RECON = SILVER + f""",
gl_k AS ({_side("gl")}),
ap_k AS ({_side("ap")}),
joined AS (SELECT * FROM gl_k FULL OUTER JOIN ap_k USING ({KEY})),
derived AS (
  SELECT * REPLACE (coalesce(gl_row_count, 0) AS gl_row_count,
                    coalesce(ap_row_count, 0) AS ap_row_count),
         CAST(coalesce(gl_amount, 0) - coalesce(ap_amount, 0) AS DECIMAL(28,2))
           AS amount_difference,
         CAST(abs(coalesce(gl_amount, 0) - coalesce(ap_amount, 0)) AS DECIMAL(28,2))
           AS abs_amount_difference
  FROM joined),
recon AS MATERIALIZED (
  SELECT *, CASE
    WHEN ap_row_count > 1 THEN 'DUPLICATE_IN_SUBLEDGER'
    WHEN ap_row_count = 0 THEN 'MISSING_FROM_SUBLEDGER'
    WHEN gl_row_count = 0 THEN 'MISSING_FROM_GL'
    WHEN abs_amount_difference > 1.00 THEN 'AMOUNT_MISMATCH'
    WHEN gl_fiscal_period <> ap_fiscal_period THEN 'TIMING_DIFFERENCE'
    ELSE 'MATCHED' END AS break_status
  FROM derived),
detail AS (
  SELECT coalesce(gl_fiscal_period, ap_fiscal_period) AS fiscal_period, {KEY}, break_status,
         gl_amount, ap_amount, amount_difference, abs_amount_difference,
         gl_fiscal_period, ap_fiscal_period, gl_row_count, ap_row_count
  FROM recon),
statuses(break_status) AS (VALUES {", ".join(f"('{s}')" for s in STATUSES)})"""

GOLD = RECON + """,
periods AS (SELECT DISTINCT fiscal_period FROM detail),
summary AS MATERIALIZED (
  SELECT p.fiscal_period, s.break_status, count(d.break_status) AS key_count,
         CAST(coalesce(sum(d.gl_amount), 0) AS DECIMAL(28,2)) AS gl_amount,
         CAST(coalesce(sum(d.ap_amount), 0) AS DECIMAL(28,2)) AS ap_amount,
         CAST(coalesce(sum(d.amount_difference), 0) AS DECIMAL(28,2)) AS net_amount_difference,
         CAST(coalesce(sum(d.abs_amount_difference), 0) AS DECIMAL(28,2)) AS abs_amount_difference
  FROM periods p CROSS JOIN statuses s
  LEFT JOIN detail d ON d.fiscal_period = p.fiscal_period AND d.break_status = s.break_status
  GROUP BY ALL),
acct AS (SELECT account_code, min(account_name) AS account_name FROM gl_s GROUP BY 1),
vend AS (SELECT vendor_code, min(vendor_name) AS vendor_name FROM ap_s GROUP BY 1),
exc AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY abs_amount_difference DESC, d.account_code, d.vendor_code,
                                     invoice_number) AS exception_rank,
         fiscal_period, break_status, d.account_code,
         coalesce(account_name, '(unlabelled)') AS account_name, d.vendor_code,
         coalesce(vendor_name, '(unlabelled)') AS vendor_name, invoice_number,
         gl_amount, ap_amount, amount_difference, abs_amount_difference,
         gl_fiscal_period, ap_fiscal_period, gl_row_count, ap_row_count
  FROM detail d LEFT JOIN acct a ON a.account_code = d.account_code
                LEFT JOIN vend v ON v.vendor_code = d.vendor_code
  WHERE break_status <> 'MATCHED')"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _catalogue() -> str:
    rows = [
        (r.id, d.name, r.column, r.check, r.severity, r.description, predicate(r))
        for d in DEFAULT.datasets.values()
        for r in d.rules
    ]
    values = ",\n  ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in rows)
    return f"""
cat(rule_id, dataset, column_name, check_type, severity, description, predicate_sql) AS (VALUES
  {values})"""


SCORES = """,
fired AS (SELECT rule_id, count(*) AS rows_rejected
          FROM (SELECT unnest(string_split(_failed_rule_ids, '|')) AS rule_id FROM q) GROUP BY 1),
""" + _catalogue().lstrip() + """,
rules AS (SELECT cat.*, coalesce(rows_rejected, 0) AS rows_rejected
          FROM cat LEFT JOIN fired USING (rule_id)),
score AS (
  SELECT dataset, label, received AS rows_received, passed AS rows_passed,
         received - passed AS rows_quarantined, CAST(violations AS BIGINT) AS rule_violations,
         CAST(round(100.0::DOUBLE * passed / received, 4) AS DECIMAL(7,4)) AS dq_score_pct
  FROM (SELECT 'gl' AS dataset, 'General Ledger' AS label, count(*) AS received,
               count(*) FILTER (_failed_rule_count = 0) AS passed,
               sum(_failed_rule_count) AS violations FROM gl_a
        UNION ALL
        SELECT 'ap', 'AP Subledger', count(*), count(*) FILTER (_failed_rule_count = 0),
               sum(_failed_rule_count) FROM ap_a))"""

_SCORE = "round(100.0::DOUBLE * sum(rows_passed)::BIGINT / sum(rows_received)::BIGINT, 4)"


def _checks_of(kind: str) -> str:
    """Rows breaching any rule of one type, one row per breach."""
    inner, parts = [], []
    for side in ("gl", "ap"):
        of_kind = [r for r in RULES[side] if r[1] == kind]
        # Windows are evaluated in a subquery of their own.
        columns = ", ".join(f"({c}) AS x{n}" for n, (_, _, _, c) in enumerate(of_kind))
        inner.append(f"{side}_x AS (SELECT *, {columns} FROM {side})")
        parts += [
            f"SELECT '{side}' AS dataset, '{i}' AS rule_id, {ROW_ID[side]} AS row_id,"
            f" {column} AS value FROM {side}_x WHERE x{n}"
            for n, (i, _, column, _) in enumerate(of_kind)
        ]
    return f"WITH {FIXTURES}, {', '.join(inner)}\n" + "\nUNION ALL ".join(parts)


def _flags(side: str, key: str) -> str:
    columns = ",\n".join(f"({c}) AS flag_{i}" for i, _, _, c in RULES[side])
    return f"WITH {FIXTURES} SELECT {key}, {columns} FROM {side}"


def _violation_counts() -> str:
    parts = [
        f"SELECT '{i}' AS rule_id,"
        f" count(*) FILTER (list_contains(string_split(_failed_rule_ids, '|'), '{i}'))"
        f" AS violations FROM {side}_a"
        for side in ("gl", "ap")
        for i, _, _, _ in RULES[side]
    ]
    return f"WITH {ANNOTATED}\n" + "\nUNION ALL ".join(parts)


# --- expected counts of the verification --------------------------------------------

# Metric and the number of rows the fixture plants for it, over `inv`.
_SHARED = "count(*) FILTER (f = 41 AND g % 10 IN (8, 9))"
_SHARED_REJECTED = f"(CASE WHEN {_SHARED} > 1 THEN {_SHARED} ELSE 0 END)"
_GL_IN = "count(*) FILTER (f NOT IN (40,41,42,53)) + count(*) FILTER (f = 54)"
_AP_IN = (
    "count(*) FILTER (f NOT IN (30,31,32)) + count(*) FILTER (f BETWEEN 50 AND 53)"
    " + count(*) FILTER (f = 51)"
)
_GL_OUT = "count(*) FILTER (f = 31 AND g % 7 <> 6)"
_AP_OUT = f"(count(*) FILTER (f = 41 AND g % 10 < 8) + {_SHARED_REJECTED})"


def _gl_planted(*which: int) -> str:
    return f"count(*) FILTER (f = 31 AND g % 7 IN ({', '.join(map(str, which))}))"


def _ap_planted(which: int) -> str:
    return f"count(*) FILTER (f = 41 AND g % 10 = {which})"


_PLANTED_RULES = {
    "GL_NN_AMOUNT": _gl_planted(0, 5),
    "GL_NONZERO_AMOUNT": _gl_planted(1),
    "GL_FMT_FISCAL_PERIOD": _gl_planted(2),
    "GL_DOM_ACCOUNT_CODE": _gl_planted(3),
    "GL_FMT_DEPARTMENT_CODE": _gl_planted(4),
    "GL_DOM_DEPARTMENT_CODE": _gl_planted(4),
    "GL_DOM_CURRENCY": _gl_planted(5),
    "AP_NN_AMOUNT": _ap_planted(0),
    "AP_NONZERO_AMOUNT": _ap_planted(1),
    "AP_NUM_AMOUNT": _ap_planted(2),
    "AP_DOM_CURRENCY": _ap_planted(3),
    "AP_FMT_VENDOR_CODE": _ap_planted(4),
    "AP_FMT_FISCAL_PERIOD": _ap_planted(5),
    "AP_RANGE_AMOUNT": _ap_planted(6),
    "AP_DOM_PAYMENT_STATUS": _ap_planted(7),
    "AP_UNIQ_LINE_ID": _SHARED_REJECTED,
}
_EXPECTED = {
    "gl raw rows": _GL_IN,
    "ap raw rows": _AP_IN,
    "gl rows quarantined": _GL_OUT,
    "ap rows quarantined": _AP_OUT,
    "total rows quarantined": f"{_GL_OUT} + {_AP_OUT}",
    "total rule violations": f"{_GL_OUT} + {_gl_planted(4, 5)} + {_AP_OUT}",
    "gl rows in silver": f"{_GL_IN} - {_GL_OUT}",
    "ap rows in silver": f"{_AP_IN} - {_AP_OUT}",
    **{f"rule {i}": _PLANTED_RULES.get(i, "0") for i, *_ in GL_RULES + AP_RULES},
    "break MATCHED": "count(*) FILTER (f NOT IN (8,10,11,12,20,21,30,31,32,40,41,42,50,51,52,53))",
    "break AMOUNT_MISMATCH": "count(*) FILTER (f IN (8,10,11,12))",
    "break TIMING_DIFFERENCE": "count(*) FILTER (f IN (20,21))",
    "break MISSING_FROM_SUBLEDGER": "count(*) FILTER (f IN (30,32) OR (f = 31 AND g % 7 = 6))",
    "break MISSING_FROM_GL": f"count(*) FILTER (f IN (40,42)) + {_SHARED} - {_SHARED_REJECTED}",
    "break DUPLICATE_IN_SUBLEDGER": "count(*) FILTER (f BETWEEN 50 AND 53)",
    "business keys": f"count(*) - {_GL_OUT} - {_AP_OUT}",
    "keys with a known status": f"count(*) - {_GL_OUT} - {_AP_OUT}",
    "unknown statuses": "0",
    "edge matched_within_tolerance": "count(*) FILTER (f BETWEEN 1 AND 7)",
    "edge mismatch_with_period_shift": "count(*) FILTER (f = 10)",
    "edge duplicate_triplets": "count(*) FILTER (f = 51)",
    "edge duplicate_unequal_amounts": "count(*) FILTER (f = 52)",
    "edge matched_beyond_tolerance": "0",
    "quarantined rows without a rule": "0",
    "dq score": f"round(100.0::DOUBLE * ({_GL_IN} - {_GL_OUT} + {_AP_IN} - {_AP_OUT})"
    f" / ({_GL_IN} + {_AP_IN}), 4)",
}
_ACTUAL = {
    "gl raw rows": "SELECT count(*) FROM gl",
    "ap raw rows": "SELECT count(*) FROM ap",
    "gl rows quarantined": "SELECT count(*) FROM gl_q",
    "ap rows quarantined": "SELECT count(*) FROM ap_q",
    "total rows quarantined": "SELECT count(*) FROM q",
    "total rule violations": "SELECT sum(_failed_rule_count) FROM q",
    "gl rows in silver": "SELECT count(*) FROM gl_s",
    "ap rows in silver": "SELECT count(*) FROM ap_s",
    **{
        f"rule {i}": f"SELECT coalesce((SELECT rows_rejected FROM fired WHERE rule_id = '{i}'), 0)"
        for i, *_ in GL_RULES + AP_RULES
    },
    **{f"break {s}": f"SELECT count(*) FROM recon WHERE break_status = '{s}'" for s in STATUSES},
    "business keys": "SELECT count(*) FROM recon",
    "keys with a known status": "SELECT count(*) FROM recon SEMI JOIN statuses USING (break_status)",
    "unknown statuses": "SELECT count(*) FROM recon ANTI JOIN statuses USING (break_status)",
    "quarantined rows without a rule": "SELECT count(*) FROM q WHERE _failed_rule_ids = ''",
    "edge matched_within_tolerance": "SELECT count(*) FROM recon"
    " WHERE break_status = 'MATCHED' AND abs_amount_difference > 0",
    "edge mismatch_with_period_shift": "SELECT count(*) FROM recon"
    " WHERE break_status = 'AMOUNT_MISMATCH' AND gl_fiscal_period <> ap_fiscal_period",
    "edge duplicate_triplets": "SELECT count(*) FROM recon"
    " WHERE break_status = 'DUPLICATE_IN_SUBLEDGER' AND ap_row_count = 3",
    "edge duplicate_unequal_amounts": "SELECT count(*) FROM recon"
    " WHERE break_status = 'DUPLICATE_IN_SUBLEDGER' AND ap_amount <> gl_amount * ap_row_count",
    "edge matched_beyond_tolerance": "SELECT count(*) FROM recon"
    " WHERE break_status = 'MATCHED' AND abs_amount_difference > 1",
    "dq score": f"SELECT {_SCORE} FROM score",
}


def _checks() -> str:
    expected = ", ".join(
        f"{e} AS e{n}" for n, e in enumerate(_EXPECTED.values())
    )
    rows = "\nUNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST(e{n} AS DECIMAL(24,4)) AS expected,"
        f" CAST(({_ACTUAL[m]}) AS DECIMAL(24,4)) AS actual FROM planted"
        for n, m in enumerate(_EXPECTED)
    )
    return (
        f"{GOLD}{SCORES},\nplanted AS MATERIALIZED (SELECT {expected} FROM inv),\n"
        f"checks AS (SELECT *, expected IS NOT DISTINCT FROM actual AS passed FROM ({rows}))"
    )


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    gold_scores = GOLD + SCORES
    checks = _checks()
    rank_columns = (
        "exception_rank, break_status, fiscal_period, vendor_name, account_name, invoice_number,"
        " gl_amount, ap_amount, abs_amount_difference AS exposure"
    )
    per_status = (
        "SELECT break_status, sum(key_count)::BIGINT AS keys, {net}"
        " CAST(sum(abs_amount_difference) AS DECIMAL(38,2)) AS gross_exposure"
        " FROM summary {where} GROUP BY 1"
    )
    net = "CAST(sum(net_amount_difference) AS DECIMAL(38,2)) AS {},"
    broken = "WHERE break_status <> 'MATCHED'"
    rules_columns = "rule_id, dataset, column_name, check_type, rows_rejected"
    unrecorded = (
        "SELECT fiscal_period, key_count AS unrecorded_invoices,"
        " abs_amount_difference AS unrecorded_liability"
        " FROM summary WHERE break_status = 'MISSING_FROM_GL'"
    )
    identical = "ap_amount = gl_amount * ap_row_count AS copies_were_identical"
    all_rows = "SELECT 'gl' AS dataset, gl_entry_id AS row_id, invoice_number, {0} FROM gl_a" \
               " UNION ALL SELECT 'ap', ap_line_id, invoice_number, {0} FROM ap_a"
    conserved = """
SELECT dataset, bronze_rows, silver_rows, quarantine_rows,
       silver_rows + quarantine_rows = bronze_rows AS conserved
FROM (SELECT 'gl' AS dataset, (SELECT count(*) FROM gl) AS bronze_rows,
             (SELECT count(*) FROM gl_s) AS silver_rows, (SELECT count(*) FROM gl_q) AS quarantine_rows
      UNION ALL
      SELECT 'ap', (SELECT count(*) FROM ap), (SELECT count(*) FROM ap_s), (SELECT count(*) FROM ap_q))"""
    opposite = """
SELECT '{0}' AS dataset, count(*) AS rejected_rows,
       count(*) FILTER ((account_code, vendor_code, invoice_number) IN
         (SELECT (account_code, vendor_code, invoice_number) FROM {1})) AS rows_on_opposite_side
FROM {0}_q"""
    complete = (
        "SELECT '{0}' AS dataset, count(*) AS source_rows, count(*) AS bronze_rows,"
        " true AS complete FROM {0}"
    )
    controls = "SELECT '{}' AS control, ({})::BIGINT AS expected, ({})::BIGINT AS actual"
    count_where = "SELECT count(*) FROM recon WHERE {}"

    return {
        # landing
        "csv_roundtrip_gl": _with(FIXTURES, "SELECT * FROM gl"),
        "csv_roundtrip_ap": _with(FIXTURES, "SELECT * FROM ap"),
        "bronze_lineage": _with(
            FIXTURES,
            "SELECT gl_entry_id AS row_id, 'gl' AS source_folder, 'fixture-load' AS _batch_id FROM gl"
            " UNION ALL SELECT ap_line_id, 'ap', 'fixture-load' FROM ap",
        ),
        "bronze_gl": _with(FIXTURES, "SELECT *, 'fixture-load' AS _batch_id FROM gl"),
        "bronze_ap": _with(FIXTURES, "SELECT *, 'fixture-load' AS _batch_id FROM ap"),
        "ingest_completeness": _with(
            FIXTURES, complete.format("gl") + " UNION ALL " + complete.format("ap")
        ),
        "bronze_peek": _with(FIXTURES, "SELECT * FROM gl ORDER BY gl_entry_id LIMIT 10"),
        "bronze_defect_scan": _with(
            FIXTURES,
            "SELECT ap_line_id, invoice_number, amount, currency, fiscal_period, payment_status"
            " FROM ap WHERE amount IN ('', 'N/A') OR currency <> 'USD'"
            f" OR NOT regexp_full_match(fiscal_period, '{_PERIOD}') ORDER BY ap_line_id",
        ),
        # contract checks
        **{
            f"check_{kind}": _checks_of(kind)
            for kind in sorted({r[1] for r in GL_RULES + AP_RULES})
        },
        "failed_rule_ids": _with(ANNOTATED, all_rows.format("_failed_rule_ids")),
        "failed_rule_count": _with(ANNOTATED, all_rows.format("_failed_rule_count")),
        "rule_flags_gl": _flags("gl", "gl_entry_id"),
        "rule_flags_ap": _flags("ap", "ap_line_id"),
        "rule_violation_counts": _violation_counts(),
        # silver and quarantine
        "annotate_gl": _with(ANNOTATED, "SELECT *, 'fixture-load' AS _batch_id FROM gl_a"),
        "annotate_ap": _with(ANNOTATED, "SELECT *, 'fixture-load' AS _batch_id FROM ap_a"),
        "silver_gl": _with(SILVER, "SELECT *, 'fixture-load' AS _batch_id FROM gl_s"),
        "silver_ap": _with(SILVER, "SELECT *, 'fixture-load' AS _batch_id FROM ap_s"),
        "quarantine_gl": _with(SILVER, "SELECT *, 'fixture-load' AS _batch_id FROM gl_q"),
        "quarantine_ap": _with(SILVER, "SELECT *, 'fixture-load' AS _batch_id FROM ap_q"),
        "row_conservation": _with(SILVER, conserved),
        "dq_score_overall": _with(
            SILVER,
            "SELECT r AS rows_received, p AS rows_passed,"
            " round(100.0::DOUBLE * p / r, 4) AS dq_score_pct"
            " FROM (SELECT (SELECT count(*) FROM gl) + (SELECT count(*) FROM ap) AS r,"
            " (SELECT count(*) FROM gl_s) + (SELECT count(*) FROM ap_s) AS p)",
        ),
        "quarantine_listing": _with(
            SILVER,
            "SELECT _failed_rule_ids, _failed_rule_count, ap_line_id, invoice_number, amount,"
            " currency, fiscal_period, vendor_code, payment_status FROM ap_q"
            " ORDER BY _failed_rule_count DESC, _failed_rule_ids",
        ),
        "rule_combinations": _with(
            SILVER,
            "SELECT _failed_rule_ids AS rule_combination, count(*) AS rows_rejected"
            " FROM q GROUP BY 1 ORDER BY 2 DESC",
        ),
        # reconciliation
        "aggregate_gl": _with(RECON, "SELECT * FROM gl_k"),
        "aggregate_ap": _with(RECON, "SELECT * FROM ap_k"),
        "recon_full_outer": _with(RECON, "SELECT * FROM joined"),
        "recon_derived": _with(RECON, "SELECT * FROM derived"),
        "recon_classified": _with(RECON, "SELECT * FROM recon"),
        "status_counts": _with(
            RECON,
            "SELECT break_status, count(k) AS key_count FROM statuses LEFT JOIN"
            " (SELECT break_status, 1 AS k FROM recon) USING (break_status) GROUP BY 1",
        ),
        "recon_controls": _with(
            RECON,
            " UNION ALL ".join(
                controls.format(*c)
                for c in (
                    ("keys with a null part", "0",
                     count_where.format(
                         "account_code IS NULL OR vendor_code IS NULL OR invoice_number IS NULL")),
                    ("statuses form a partition", "SELECT count(*) FROM recon",
                     "SELECT count(*) FROM recon SEMI JOIN statuses USING (break_status)"),
                    ("exceptions are keys less matched",
                     "SELECT count(*) - count(*) FILTER (break_status = 'MATCHED') FROM recon",
                     count_where.format("break_status <> 'MATCHED'")),
                    ("matched beyond tolerance", "0",
                     count_where.format("break_status = 'MATCHED' AND abs_amount_difference > 1")),
                )
            ),
        ),
        "recon_edge_cases": _with(
            RECON,
            "SELECT count(*) FILTER (break_status = 'MATCHED' AND abs_amount_difference > 0)"
            " AS matched_within_tolerance,"
            " count(*) FILTER (break_status = 'AMOUNT_MISMATCH'"
            " AND gl_fiscal_period <> ap_fiscal_period) AS mismatch_with_period_shift,"
            " count(*) FILTER (break_status = 'DUPLICATE_IN_SUBLEDGER' AND ap_row_count = 3)"
            " AS duplicate_triplets,"
            " count(*) FILTER (break_status = 'DUPLICATE_IN_SUBLEDGER'"
            " AND ap_amount <> gl_amount * ap_row_count) AS duplicate_unequal_amounts,"
            " count(*) FILTER (break_status = 'MATCHED' AND abs_amount_difference > 1)"
            " AS matched_beyond_tolerance FROM recon",
        ),
        "quarantine_single_sided": _with(
            SILVER, opposite.format("gl", "ap") + " UNION ALL " + opposite.format("ap", "gl")
        ),
        "gl_key_uniqueness": _with(
            FIXTURES,
            f"SELECT {KEY}, count(*) AS row_count FROM gl GROUP BY {KEY} HAVING count(*) > 1",
        ),
        # gold
        "recon_detail": _with(RECON, "SELECT * FROM detail"),
        "recon_summary": _with(GOLD, "SELECT * FROM summary"),
        "label_accounts": _with(GOLD, "SELECT * FROM acct"),
        "label_vendors": _with(GOLD, "SELECT * FROM vend"),
        "recon_exceptions": _with(GOLD, "SELECT * FROM exc"),
        "exception_rank": _with(
            GOLD, f"SELECT exception_rank, {KEY}, abs_amount_difference FROM exc"
        ),
        "gold_controls": _with(
            GOLD,
            " UNION ALL ".join(
                controls.format(*c)
                for c in (
                    ("summary keys equal detail keys", "SELECT count(*) FROM detail",
                     "SELECT sum(key_count) FROM summary"),
                    ("exceptions are keys less matched",
                     count_where.format("break_status <> 'MATCHED'"), "SELECT count(*) FROM exc"),
                    ("ranks run to the number of exceptions", "SELECT count(*) FROM exc",
                     "SELECT max(exception_rank) FROM exc"),
                )
            ),
        ),
        # scorecards
        "rule_violations": _with(SILVER + SCORES, "SELECT * FROM fired"),
        "dq_rule_scorecard": _with(SILVER + SCORES, "SELECT * FROM rules"),
        "dq_scorecard": _with(SILVER + SCORES, "SELECT * FROM score"),
        "scorecard_conservation": _with(
            SILVER + SCORES,
            "SELECT 'passed and quarantined make up received' AS control,"
            " sum(rows_received)::BIGINT AS expected,"
            " sum(rows_passed + rows_quarantined)::BIGINT AS actual FROM score",
        ),
        "silent_rules": _with(
            SILVER + SCORES,
            "SELECT count(*) AS rules_that_fired_zero_times FROM rules WHERE rows_rejected = 0",
        ),
        "overall_from_scorecard": _with(
            SILVER + SCORES,
            "SELECT sum(rows_received)::BIGINT AS rows_received,"
            f" sum(rows_passed)::BIGINT AS rows_passed, {_SCORE} AS dq_score_pct FROM score",
        ),
        "top_rules_with_predicate": _with(
            SILVER + SCORES,
            f"SELECT {rules_columns}, predicate_sql FROM rules WHERE rows_rejected > 0",
        ),
        # reports
        "tile_headline": _with(
            gold_scores,
            "SELECT (SELECT count(*) FROM detail) AS business_keys,"
            " (SELECT count(*) FROM exc) AS exceptions,"
            " (SELECT CAST(sum(abs_amount_difference) AS DECIMAL(38,2)) FROM exc) AS gross_exposure,"
            f" (SELECT {_SCORE} FROM score) AS dq_score_pct",
        ),
        "tile_break_mix": _with(GOLD, per_status.format(net="", where="")),
        "tile_break_mix_exceptions": _with(GOLD, per_status.format(net="", where=broken)),
        "tile_breaks_by_period": _with(
            GOLD,
            "SELECT fiscal_period, break_status, key_count, abs_amount_difference AS gross_exposure"
            f" FROM summary {broken}",
        ),
        "tile_net_vs_gross": _with(
            GOLD, per_status.format(net=net.format("net_effect_on_books"), where=broken)
        ),
        "tile_unrecorded_liability": _with(GOLD, unrecorded),
        "tile_top_exceptions": _with(
            GOLD, f"SELECT {rank_columns} FROM exc WHERE exception_rank <= 25"
        ),
        "top_exceptions_20": _with(
            GOLD, f"SELECT {rank_columns} FROM exc WHERE exception_rank <= 20"
        ),
        "tile_duplicates": _with(
            RECON,
            "SELECT invoice_number, vendor_code, account_code, ap_row_count AS subledger_rows,"
            f" gl_amount, ap_amount, {identical} FROM detail"
            " WHERE break_status = 'DUPLICATE_IN_SUBLEDGER'",
        ),
        "duplicates_evidence": _with(
            RECON,
            "SELECT invoice_number, vendor_code, account_code, gl_row_count, ap_row_count,"
            f" gl_amount, ap_amount, amount_difference, {identical} FROM detail"
            " WHERE break_status = 'DUPLICATE_IN_SUBLEDGER'",
        ),
        "tile_dq_by_dataset": _with(SILVER + SCORES, "SELECT * FROM score ORDER BY dataset"),
        "tile_most_violated": _with(
            SILVER + SCORES, f"SELECT {rules_columns} FROM rules WHERE rows_rejected > 0"
        ),
        "tile_rule_catalogue": _with(
            SILVER + SCORES,
            f"SELECT {rules_columns}, severity, description, predicate_sql FROM rules",
        ),
        "tile_multi_rule_rows": _with(
            SILVER,
            "SELECT _dataset AS dataset, _failed_rule_ids AS rules_breached,"
            " _failed_rule_count AS rules_count, count(*) AS rows FROM q GROUP BY 1, 2, 3",
        ),
        "period_filter": _with(GOLD, "SELECT DISTINCT fiscal_period FROM summary"),
        "break_mix_value": _with(
            GOLD, per_status.format(net=net.format("net_difference"), where="")
        ),
        "period_status_grid": _with(
            GOLD,
            "SELECT fiscal_period, break_status, key_count, abs_amount_difference FROM summary",
        ),
        "unrecorded_detail": _with(
            GOLD,
            "SELECT fiscal_period, vendor_name, invoice_number, ap_amount, gl_amount FROM exc"
            " WHERE break_status = 'MISSING_FROM_GL'",
        ),
        "unrecorded_by_period": _with(GOLD, unrecorded),
        # verification
        "control_checks": _with(checks, "SELECT * FROM checks"),
        "control_failures": _with(checks, "SELECT * FROM checks WHERE NOT passed"),
        "fate_vs_status": _with(
            RECON,
            "SELECT f AS fate, coalesce(break_status, 'REJECTED') AS break_status,"
            " count(*) AS invoices FROM inv LEFT JOIN recon ON account_code = acc"
            " AND vendor_code = ven AND invoice_number = num GROUP BY 1, 2",
        ),
    }
