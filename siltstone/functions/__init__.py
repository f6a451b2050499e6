"""Column builders: nothing here touches a DataFrame or starts a job."""

from siltstone.functions.grading import percent_valid, status
from siltstone.functions.predicates import (
    any_null,
    blank,
    broken_rule,
    literal,
    named,
    negative,
    null_names,
    quoted,
    zero,
)

__all__ = [
    "any_null",
    "blank",
    "broken_rule",
    "literal",
    "named",
    "negative",
    "null_names",
    "percent_valid",
    "quoted",
    "status",
    "zero",
]
