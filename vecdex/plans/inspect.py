"""Plan inspection helpers (public ``explain`` output only)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` lines of every scan in the physical plan."""
    return [ln.split(":", 1)[1].strip() for ln in plan(df).splitlines()
            if ln.strip().startswith("ReadSchema")]


def pushed_filters(df: DataFrame) -> list[str]:
    return [ln.split(":", 1)[1].strip() for ln in plan(df).splitlines()
            if ln.strip().startswith("PushedFilters")]
