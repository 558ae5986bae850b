"""P3 behaviour aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas as S
from ..operators.sequences import aggregate_behaviour
from ..operators.ordering import sort_by


def aggregate_log(df: DataFrame, user: str = S.COMP_MEMBER_ID, ts: str = S.TIMESTAMP, item: str = S.PRODUCT_NO,
                  tiebreak: list[str] | None = None, sort: bool = True) -> DataFrame:
    """W1 (one row per user and time) -> W2 (no consecutive repeats) -> O3 sort.

    The sort is a range-partitioned ``orderBy(user, ts)``, so a hot user is
    spread over several output files.
    """
    out = aggregate_behaviour(df, user, ts, item, tiebreak)
    return sort_by(out, user, [ts]) if sort else out
