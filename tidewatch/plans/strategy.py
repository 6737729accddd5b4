"""Physical-strategy helpers: size-checked broadcast, plan inspection."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# A lookup side is broadcast only when it has at most this many rows.
DEFAULT_BROADCAST_ROWS = 100_000


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Bounded work: reads at
    most ``max_rows + 1`` rows of ``df`` whatever its size."""
    return df.limit(max_rows + 1).count() <= max_rows


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """Number of physical operators called ``name`` (e.g. ``Exchange``) in the
    formatted plan's operator tree (AQE's final plan not forced)."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n(1)")[0]
    return len(re.findall(rf"\b{name}\b", tree))
