"""First-order recurrences ``y[t] = q * y[t-1] + b[t]`` as Spark windows.

Exponential averages and the smoothing recurrence cannot be written as a single frame.  Inside a
block of 256 rows the recurrence is a scaled running sum, ``q^j * sum(b * q^-j)``; what earlier
blocks contribute is the value at their last row times a power of q, and blocks further back
than ``q^256m < 1e-16`` no longer change a double.  All of it runs inside the chunks of
:func:`tidewick.operators.chunks.with_halo`, so a scan adds no shuffle.
"""

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewick.operators.chunks import BLOCK_ROWS, halo_window
from tidewick.schema import SERIES

# log(1e-17): a factor below it is lost in a double
_NEGLIGIBLE = 39.2


def blocks_needed(q: float) -> int:
    """Preceding blocks that still matter for decay ``q``."""
    return max(1, math.ceil(_NEGLIGIBLE / (-math.log(q) * BLOCK_ROWS)))


def rows_needed(q: float) -> int:
    """Halo rows that a scan with decay ``q`` needs before a chunk."""
    return BLOCK_ROWS * (blocks_needed(q) + 1)


def is_first(keys: Sequence[str] = SERIES) -> Column:
    """True on a series' first row: nothing precedes it although the halo reaches further back."""
    return (F.row_number().over(halo_window(keys)) == 1) & F.col("_head")


def affine_scan(df: DataFrame, columns: Mapping[str, tuple[str, float]], keys: Sequence[str] = SERIES) -> DataFrame:
    """Add ``{new: (b, q)}`` solved over each chunk; ``b``, an SQL expression, must not be null; 1/3 <= q < 1."""
    by = ", ".join(keys)
    in_block = f"(partition by {by}, _chunk, _block order by _pos rows between unbounded preceding and current row)"
    j, last = f"(_pos % {BLOCK_ROWS})", BLOCK_ROWS - 1
    power = {q: f"_q{i}" for i, q in enumerate(dict.fromkeys(q for _, q in columns.values()))}
    powers = {name: f"pow({q!r}D, {j})" for q, name in power.items()}
    local, ends, solved = {}, {}, {}
    for new, (b, q) in columns.items():
        local[f"_l_{new}"] = f"{power[q]} * sum(({b}) / {power[q]}) over {in_block}"
        carried = []
        for m in range(1, blocks_needed(q) + 1):
            at = f"(partition by {by}, _chunk order by _block range between {m} preceding and {m} preceding)"
            ends[f"_e{m}_{new}"] = f"max(case when {j} = {last} then _l_{new} end) over {at}"
            carried.append(f"coalesce(_e{m}_{new}, 0D) * {q ** (BLOCK_ROWS * (m - 1))!r}D")
        solved[new] = f"_l_{new} + {power[q]} * {q!r}D * ({' + '.join(carried)})"
    d = df
    for step in (powers, local, ends, solved):
        d = d.selectExpr("*", *[f"{e} as {name}" for name, e in step.items()])
    return d.drop(*powers, *local, *ends)


def ema(df: DataFrame, columns: Mapping[str, tuple[str, float]], keys: Sequence[str] = SERIES) -> DataFrame:
    """Exponential averages ``{new: (source, alpha)}`` seeded with the series' first value.

    Needs the boolean ``_first`` (see :func:`is_first`).
    """
    seeded = {
        new: (f"case when _first then {src} else {src} * {alpha!r}D end", 1.0 - alpha)
        for new, (src, alpha) in columns.items()
    }
    return affine_scan(df, seeded, keys)


def span(n: int) -> float:
    """Smoothing factor of an n-period exponential average."""
    return 2.0 / (n + 1)


def wilder(n: int) -> float:
    """Smoothing factor of Wilder's n-period average."""
    return 1.0 / n
