"""Contract rules as Spark SQL text, TRUE where a row breaches the rule.

A rule is rendered once. The same text is evaluated on the rows and published
in the scorecard, so what a reader sees is what ran.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tieout.contract import ContractError, Rule, rule_problem

SEPARATOR = "|"
IDS = "_failed_rule_ids"
COUNT = "_failed_rule_count"
PARSED_TYPE = "DECIMAL(18,2)"
# Blank, tab, line feed, vertical tab, form feed, carriage return.
WHITESPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def quote(text: object) -> str:
    """A SQL string literal; backslash is an escape inside one."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    return column if column.isidentifier() else "`" + column.replace("`", "``") + "`"


def copies_column(column: str) -> str:
    """Rows sharing this row's value; attached by `operators.uniqueness`."""
    return f"_copies_{column}"


def blank(column: str) -> str:
    c = name(column)
    return f"({c} IS NULL OR btrim({c}, {WHITESPACE}) = '')"


def parsed(column: str) -> str:
    return f"try_cast({name(column)} AS {PARSED_TYPE})"


def whole_value(pattern: str) -> str:
    """An anchored pattern that tests all of the value.

    The group keeps alternatives together, and \\z, unlike $, refuses a trailing
    line feed.
    """
    return rf"^(?:{pattern[1:-1]})\z"


def predicate(rule: Rule) -> str:
    problem = rule_problem(rule)
    if problem:
        raise ContractError(f"{rule.id}: {problem}")
    c = name(rule.column)
    present = f"NOT {blank(rule.column)}"
    value = parsed(rule.column)
    match rule.check:
        case "not_null":
            return blank(rule.column)
        case "unique":
            # NULL copies: the value is not among the repeated ones.
            return f"({present} AND coalesce({name(copies_column(rule.column))}, 1) > 1)"
        case "regex":
            return f"({present} AND NOT {c} RLIKE {quote(whole_value(rule.pattern))})"
        case "allowed_values":
            domain = ", ".join(quote(v) for v in rule.values)
            return f"({present} AND {c} NOT IN ({domain}))"
        case "numeric":
            return f"({present} AND {value} IS NULL)"
        case "non_zero":
            return f"coalesce({value} = 0, false)"
        case "numeric_range":
            sides = []
            if rule.minimum is not None:
                sides.append(f"{value} < {rule.minimum}")
            if rule.maximum is not None:
                sides.append(f"{value} > {rule.maximum}")
            return f"coalesce({' OR '.join(sides)}, false)"
    raise ContractError(f"{rule.id}: unknown check '{rule.check}'")


def breached(rule: Rule) -> Column:
    return F.expr(predicate(rule))


def failed_ids(rules: Iterable[Rule]) -> Column:
    """All breached rule ids in id order; every rule is evaluated."""
    hits = [F.when(breached(r), F.lit(r.id)) for r in sorted(rules, key=lambda r: r.id)]
    return F.concat_ws(SEPARATOR, *hits) if hits else F.lit("")


def split_ids(ids: str | Column = IDS) -> Column:
    return F.split(ids, f"[{SEPARATOR}]")


def failed_count(ids: str = IDS) -> Column:
    """Taken from the id list, so the two cannot disagree."""
    return F.when(F.col(ids) == "", 0).otherwise(F.size(split_ids(ids)))
