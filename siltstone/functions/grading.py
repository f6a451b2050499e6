"""Quality percentage and the status derived from it.

Arguments are expressions over the frame the result is added to.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest percentage of each graded status.
WARNING_FROM = 99
ERROR_FROM = 95


def percent_valid(valid: str, total: str) -> Column:
    """``valid / total`` in percent with two decimals, 0.0 for no rows.

    Spark rounds ties away from zero (0.125 gives 0.13), Python's ``round``
    to the even digit (0.12). The guard also keeps ANSI mode from raising.
    """
    return F.expr(f"IF({total} > 0, round(({valid}) / {total} * 100, 2), 0.0D)")


def status(duplicates: str, invalid: str, quality: str) -> Column:
    """SUCCESS when nothing was found, else graded by percentage alone.

    Duplicates do not lower the percentage, so they alone give WARNING; an
    empty input has nothing to report and is SUCCESS at 0.0.
    """
    return F.expr(
        f"CASE WHEN {duplicates} = 0 AND {invalid} = 0 THEN 'SUCCESS' "
        f"WHEN {quality} >= {WARNING_FROM} THEN 'WARNING' "
        f"WHEN {quality} >= {ERROR_FROM} THEN 'ERROR' ELSE 'CRITICAL' END"
    )
