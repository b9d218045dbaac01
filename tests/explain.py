"""The physical plan of a DataFrame as text, for checks of shuffles, pruning and pushdown."""

import contextlib
import io

from pyspark.sql import DataFrame


def plan_of(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
