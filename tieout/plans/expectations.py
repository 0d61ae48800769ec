"""What the fixture plants, as metrics to hold against the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.contract import DEFAULT, MATCHED, STATUSES, Contract
from tieout.functions.scores import dq_score
from tieout.operators.controls import melt
from tieout.sources import fixtures as fx


def expected_metrics(invoices: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """What the fixture plants, from the fates alone: no ledger row is read.

    `invoices` is `fixtures.invoices`. One pass of conditional counts.
    """
    f, gl_defect, ap_defect = F.col("f"), F.col("g") % 7, F.col("g") % 10

    def fate(*values: int) -> Column:
        return f.isin(*values)

    planted = {
        "orders": F.lit(True),
        "gl_absent": fate(*fx.GL_ABSENT),
        "gl_split": fate(fx.GL_SPLIT),
        "ap_absent": fate(*fx.AP_ABSENT),
        "ap_pairs": fate(*fx.AP_PAIRS),
        "ap_triplets": fate(*fx.AP_TRIPLETS),
        "gl_bad": fate(fx.GL_DEFECTIVE) & gl_defect.between(0, 5),
        "gl_good": fate(fx.GL_DEFECTIVE) & (gl_defect == 6),
        **{f"gl_{i}": fate(fx.GL_DEFECTIVE) & (gl_defect == i) for i in range(6)},
        "ap_bad": fate(fx.AP_DEFECTIVE),
        **{f"ap_{i}": fate(fx.AP_DEFECTIVE) & (ap_defect == i) for i in range(8)},
        "ap_shared_id": fate(fx.AP_DEFECTIVE) & ap_defect.isin(8, 9),
        "mismatch": fate(8, 10, 11, 12),
        "tolerated": f.between(1, 7),
        "mismatch_shifted": fate(10),
        "unequal": fate(52),
        "timing": fate(20, 21),
        "gl_only": fate(30, 32),
        "ap_only": fate(40, 42),
        "duplicate": fate(50, 51, 52, 53),
    }
    n = invoices.agg(*[F.count_if(c).alias(m) for m, c in planted.items()])
    c = {m: F.col(m) for m in planted}
    # The shared line id repeats only when at least two rows carry it.
    shared = F.when(c["ap_shared_id"] > 1, c["ap_shared_id"]).otherwise(0)
    unshared = c["ap_shared_id"] - shared

    gl_rows = c["orders"] - c["gl_absent"] + c["gl_split"]
    ap_rows = c["orders"] - c["ap_absent"] + c["ap_pairs"] + 2 * c["ap_triplets"]
    gl_out, ap_out = c["gl_bad"], c["ap_bad"] - unshared
    breaks = {
        "AMOUNT_MISMATCH": c["mismatch"],
        "TIMING_DIFFERENCE": c["timing"],
        "MISSING_FROM_SUBLEDGER": c["gl_only"] + c["gl_good"],
        "MISSING_FROM_GL": c["ap_only"] + unshared,
        "DUPLICATE_IN_SUBLEDGER": c["duplicate"],
    }
    # Every order is one key, less those whose only row is rejected.
    keys = c["orders"] - gl_out - ap_out
    matched = keys - sum(breaks.values(), F.lit(0))
    by_rule = {
        "GL_NN_AMOUNT": c["gl_0"] + c["gl_5"],
        "GL_NONZERO_AMOUNT": c["gl_1"],
        "GL_FMT_FISCAL_PERIOD": c["gl_2"],
        "GL_DOM_ACCOUNT_CODE": c["gl_3"],
        "GL_FMT_DEPARTMENT_CODE": c["gl_4"],
        "GL_DOM_DEPARTMENT_CODE": c["gl_4"],
        "GL_DOM_CURRENCY": c["gl_5"],
        "AP_NN_AMOUNT": c["ap_0"],
        "AP_NONZERO_AMOUNT": c["ap_1"],
        "AP_NUM_AMOUNT": c["ap_2"],
        "AP_DOM_CURRENCY": c["ap_3"],
        "AP_FMT_VENDOR_CODE": c["ap_4"],
        "AP_FMT_FISCAL_PERIOD": c["ap_5"],
        "AP_RANGE_AMOUNT": c["ap_6"],
        "AP_DOM_PAYMENT_STATUS": c["ap_7"],
        "AP_UNIQ_LINE_ID": shared,
    }
    passed = gl_rows - gl_out + ap_rows - ap_out
    metrics = {
        "gl raw rows": gl_rows,
        "ap raw rows": ap_rows,
        "gl rows quarantined": gl_out,
        "ap rows quarantined": ap_out,
        "total rows quarantined": gl_out + ap_out,
        "total rule violations": sum(by_rule.values(), F.lit(0)),
        "gl rows in silver": gl_rows - gl_out,
        "ap rows in silver": ap_rows - ap_out,
        **{
            f"rule {r.id}": by_rule.get(r.id, F.lit(0))
            for d in contract.datasets.values()
            for r in d.active_rules
        },
        **{f"break {s}": matched if s == MATCHED else breaks[s] for s in STATUSES},
        "business keys": keys,
        "keys with a known status": keys,
        "unknown statuses": F.lit(0),
        "edge matched_within_tolerance": c["tolerated"],
        "edge mismatch_with_period_shift": c["mismatch_shifted"],
        "edge duplicate_triplets": c["ap_triplets"],
        "edge duplicate_unequal_amounts": c["unequal"],
        "edge matched_beyond_tolerance": F.lit(0),
        "quarantined rows without a rule": F.lit(0),
        "dq score": dq_score(passed, gl_rows + ap_rows),
    }
    return melt(n, metrics, "expected")
