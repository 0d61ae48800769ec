"""Rule semantics on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tieout import contract as c
from tieout.functions import predicates
from tieout.functions.predicates import predicate
from tieout.operators.annotate import annotate, breaches, clean, flags, rejected, violation_counts
from tieout.operators.uniqueness import repeated_values

PERIOD = c.FISCAL_PERIOD


def rule(check, **parameters):
    return c.Rule("R", "v", check, **parameters)


def fired(spark, scratch, checked, values):
    """Whether the rule fires on each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.flag_R for r in flags(df, [checked], scratch, ["i"]).orderBy("i").collect()]


CASES = {
    "blank": (rule("not_null"), ["10.00", "", "   ", "0.00", None, "\t", "\f\v\r\n"],
              [False, True, True, False, True, True, True]),
    "letters are not blank": (rule("not_null"), ["f", "v", "n"], [False, False, False]),
    "blank is skipped by numeric": (rule("numeric"), ["", "   ", None], [False] * 3),
    "blank is skipped by non_zero": (rule("non_zero"), ["", "   ", None], [False] * 3),
    "blank is skipped by range": (rule("numeric_range", minimum=1), ["", " ", None], [False] * 3),
    "blank is skipped by regex": (rule("regex", pattern=PERIOD), ["", "  ", None], [False] * 3),
    "blank is skipped by domain": (rule("allowed_values", values=("A",)), ["", " ", None],
                                   [False] * 3),
    "text is numeric's finding": (rule("numeric"), ["N/A", "1", "-1.5"], [True, False, False]),
    "text is skipped by non_zero": (rule("non_zero"), ["N/A", "0", "0.00", "1"],
                                    [False, True, True, False]),
    "text is skipped by range": (rule("numeric_range", minimum=0, maximum=1), ["N/A"], [False]),
    "cents decide zero": (rule("non_zero"), ["0.001", "0.005"], [True, False]),
    "too wide is not numeric": (rule("numeric"), ["inf", "NaN", "99999999999999999999"],
                                [True] * 3),
    "all copies": (rule("unique"), ["A", "B", "A", "C"], [True, False, True, False]),
    "blank copies": (rule("unique"), ["", "", "A", None, None, " ", " "], [False] * 7),
    "whole value": (rule("regex", pattern=PERIOD),
                    ["2026-03", "2026-03-extra", "x2026-03", "2026-13", "2026-03\n"],
                    [False, True, True, True, True]),
    "domain is exact": (rule("allowed_values", values=("D100", "it's")),
                        ["D100", "D100 ", "d100", "it's"], [False, True, True, False]),
    "inclusive bounds": (rule("numeric_range", minimum=0, maximum=100),
                         ["0", "100", "-0.01", "100.01"], [False, False, True, True]),
    "one bound below": (rule("numeric_range", minimum=0), ["-1", "1e9"], [True, False]),
    "one bound above": (rule("numeric_range", maximum=0), ["-1", "1"], [False, True]),
}


@pytest.mark.parametrize("case", CASES)
def test_check(spark, scratch, case):
    checked, values, expected = CASES[case]
    assert fired(spark, scratch, checked, values) == expected


TWO = [
    c.Rule("R_NN", "amount", "not_null"),
    c.Rule("R_DOM", "currency", "allowed_values", values=("USD",)),
    c.Rule("R_WARN", "currency", "not_null", severity="warn"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, amount string, currency string")


def test_all_breaches_are_listed_in_id_order(spark, scratch):
    df = frame(spark, [("a", "", "USDD"), ("b", "1", "USD"), ("c", "1", "EUR")])
    rows = {r.id: (r._failed_rule_ids, r._failed_rule_count)
            for r in annotate(df, TWO, scratch).collect()}
    assert rows == {"a": ("R_DOM|R_NN", 2), "b": ("", 0), "c": ("R_DOM", 1)}


def test_split_conserves_rows(spark, scratch):
    done = annotate(frame(spark, [("a", "", "USD"), ("b", "1", "USD")]), TWO, scratch)
    assert [r.id for r in clean(done).collect()] == ["b"]
    assert [r.id for r in rejected(done).collect()] == ["a"]


def test_warn_rules_are_not_evaluated(spark, scratch):
    done = annotate(frame(spark, [("a", "1", "")]), TWO, scratch)
    assert rejected(done).count() == 0
    assert "flag_R_WARN" not in flags(frame(spark, []), TWO, scratch).columns


def test_no_rules_reject_nothing(spark, scratch):
    assert rejected(annotate(frame(spark, [("a", "", "")]), [], scratch)).count() == 0


def test_empty_input(spark, scratch):
    empty = frame(spark, [])
    done = annotate(empty, TWO, scratch)
    assert clean(done).count() == rejected(done).count() == 0
    counts = {r.rule_id: r.violations for r in violation_counts(empty, TWO, scratch).collect()}
    assert counts == {"R_DOM": 0, "R_NN": 0}


def test_violations_count_breaches_not_rows(spark, scratch):
    df = frame(spark, [("a", "", "USDD"), ("b", "", "USD")])
    counts = {r.rule_id: r.violations for r in violation_counts(df, TWO, scratch).collect()}
    assert counts == {"R_DOM": 1, "R_NN": 2}


def test_breaches_show_the_value(spark, scratch):
    df = frame(spark, [("a", "", "USDD"), ("b", "1", "USD")])
    rows = breaches(df, TWO, "allowed_values", "id", scratch).collect()
    assert [tuple(r) for r in rows] == [("R_DOM", "a", "USDD")]


def test_uniqueness_equals_the_window(spark, scratch):
    """A third of all rows share one id, a third are blank."""
    n = F.col("id")
    df = spark.range(3000).select(
        F.when(n % 3 == 0, "HOT").when(n % 3 == 1, "").otherwise(n.cast("string")).alias("v")
    )
    df = df.unionByName(spark.createDataFrame([("2",), ("5",)], "v string"))
    got = flags(df, [rule("unique")], scratch, ["v"]).groupBy("v", "flag_R").count().collect()
    want = spark.sql(
        "SELECT v, flag_R, count(*) AS count FROM (SELECT v, trim(v) <> '' AND"
        " count(*) OVER (PARTITION BY v) > 1 AS flag_R FROM {df}) GROUP BY v, flag_R", df=df
    ).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {r.v for r in repeated_values(df, "v").collect()} == {"HOT", "2", "5"}


# --- the contract itself -------------------------------------------------------------


def test_default_contract_is_valid():
    c.DEFAULT.validate()
    assert [len(d.rules) for d in c.DEFAULT.datasets.values()] == [19, 18]
    assert c.DEFAULT.checks_periods


@pytest.mark.parametrize("bad", [
    c.Rule("R", "v", "no_such_check"),
    c.Rule("R", "v", "numeric_range"),
    c.Rule("R", "v", "allowed_values"),
    c.Rule("R", "v", "regex"),
    c.Rule("R", "v", "regex", pattern="[0-9]+"),
    c.Rule("R", "v", "regex", pattern="^([0-9]+$"),
])
def test_unusable_rules_are_refused(bad):
    dataset = c.DatasetContract("d", "D", "d", "v", (bad,))
    with pytest.raises(c.ContractError):
        c.Contract({"d": dataset}).validate()
    with pytest.raises(c.ContractError):
        predicate(bad)


def test_rule_ids_are_unique_across_datasets():
    one = c.DatasetContract("a", "A", "a", "v", (c.Rule("R", "v", "not_null"),))
    two = c.DatasetContract("b", "B", "b", "v", (c.Rule("R", "v", "not_null"),))
    with pytest.raises(c.ContractError, match="more than once: R"):
        c.Contract({"a": one, "b": two}).validate()


CONFIG = {
    "recon": {"amount_tolerance_abs": 2.5},
    "patterns": {"code": "^C$"},
    "reference": {"units": ["USD", 7]},
    "datasets": {
        "gl": {
            "label": "Ledger",
            "primary_key": "id",
            "rules": [
                {"id": "A", "column": "amount", "check": "regex", "pattern_ref": "code"},
                {"id": "B", "column": "currency", "check": "allowed_values", "values_ref": "units"},
                {"id": "C", "column": "amount", "check": "numeric_range", "min": -1, "severity": "warn"},
            ],
        }
    },
}


def test_contract_from_mapping():
    read = c.from_mapping(CONFIG)
    a, b, w = read.datasets["gl"].rules
    assert (a.pattern, b.values, w.minimum, w.severity) == ("^C$", ("USD", "7"), -1, "warn")
    assert read.business_key == c.BUSINESS_KEY and str(read.tolerance) == "2.5"
    assert [r.id for r in read.datasets["gl"].active_rules] == ["A", "B"]
    assert not read.checks_periods


def test_what_cannot_run_is_refused_before_any_write():
    with pytest.raises(c.ContractError, match="business key must be"):
        c.from_mapping({**CONFIG, "recon": {"business_key": ["account_code"]}})
    for dataset, column, message in (("gl", "nope", "'nope' is not declared"), ("xx", "amount", "no dataset 'xx'")):
        rules = [{"id": "A", "column": column, "check": "not_null"}]
        with pytest.raises(c.ContractError, match=message):
            c.from_mapping({"datasets": {dataset: {"rules": rules}}})


@pytest.mark.parametrize("pattern, fine", [
    (r"^US\$", False), (r"^US\\$", True), (r"^US\$$", True), ("^A|B$", True), ("A$", False), ("^A", False), ("^", False),
])
def test_only_a_real_anchor_counts(pattern, fine):
    assert (c.rule_problem(c.Rule("R", "amount", "regex", pattern=pattern)) is None) == fine


def test_patterns_test_the_whole_value(spark):
    rows = spark.createDataFrame([(v,) for v in ("A", "B", "Axx", "xxB", "A\n", "US$", "US")], "v string")
    def passing(pattern):
        rule = c.Rule("R", "v", "regex", pattern=pattern)
        return {r.v for r in rows.where(~predicates.breached(rule)).collect()}
    assert passing("^A|B$") == {"A", "B"}
    assert passing(r"^US\$$") == {"US$"}


def test_unknown_reference_is_refused():
    rules = [{"id": "A", "column": "amount", "check": "regex", "pattern_ref": "none"}]
    with pytest.raises(c.ContractError, match="no shared pattern"):
        c.from_mapping({"datasets": {"gl": {"rules": rules}}})


@pytest.mark.parametrize("ladder, message", [
    (c.PRECEDENCE[::-1], "rung 1 is"),
    (c.PRECEDENCE[1:], "rung 1 is"),
    (c.PRECEDENCE + ("OTHER",), "rung 7 is None, declared as OTHER"),
])
def test_ladder_is_fixed(ladder, message):
    with pytest.raises(c.ContractError, match=message):
        c.check_precedence(ladder)
