"""Look-back sums of every account at many cutoffs, from one fold of the facts.

Cutoffs are numbered by date. A row of day d counts in the windows of the cutoffs from the first one on or after d to the last one
within the window's length, so it adds its amounts at the first number and takes them away again after the last. These changes are
folded to one row per account and number before the shuffle; running sums over the numbers then give every window, as prefix sums do.
The work on a row does not depend on the number of cutoffs, and an account has no more rows than there are cutoffs, however hot it is.

Amounts must be whole numbers (BIGINT or DECIMAL), so that taking away leaves no residue.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _numbers(day: str, first: date, cutoffs: Sequence[date], last: date, shift: int = 0) -> Column:
    """Number of the first cutoff on or after the day (plus ``shift`` days), by a table over all days of the span."""
    table = [bisect_left(cutoffs, first + timedelta(days=k)) for k in range((last - first).days + 1)]
    return F.element_at(F.lit(table), F.datediff(day, F.lit(first)) + (1 + shift))


def panel_sums(
    facts: DataFrame,
    day: str,
    cutoffs: Sequence[date],
    windows: tuple[int, int],
    sums: Mapping[str, tuple[str, tuple[int, ...]]],
    last_days: Mapping[str, str] | None = None,
    on_cutoff: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row for each account and cutoff with a fact in the longer window.

    ``cutoffs`` ascend. ``sums`` maps a name to an expression and its windows, and gives ``<name>_<window>``. ``last_days`` maps a name to a
    condition and gives the last day up to the cutoff on which it held. ``on_cutoff`` gives the largest value dated on the cutoff.
    """
    last_days, on_cutoff = last_days or {}, on_cutoff or {}
    short, long = windows
    first, last, m = cutoffs[0] - timedelta(days=long), cutoffs[-1] + timedelta(days=long + 1), len(cutoffs)
    dates = F.lit(list(cutoffs))
    amounts = {"rows": ("1L", (long,)), **sums}
    values = facts.where(F.col(day).between(F.lit(first), F.lit(cutoffs[-1]))).select(
        "account_id",
        F.col(day).alias("_day"),
        *(F.coalesce(F.expr(e), F.lit(0)).alias(f"_v_{n}") for n, (e, _) in amounts.items()),
        *(F.expr(f"({e})").alias(f"_l_{n}") for n, e in last_days.items()),
        *(F.expr(f"({e})").alias(f"_c_{n}") for n, e in on_cutoff.items()),
        *(_numbers(day, first, cutoffs, last, shift).alias(f"_at_{shift}") for shift in (0, short + 1, long + 1)),
    )
    change = lambda shift, in_short, in_long: F.struct(
        F.col(f"_at_{shift}").alias("_at"), F.lit(in_short).alias(f"_s_{short}"), F.lit(in_long).alias(f"_s_{long}")
    )
    three = F.inline(F.array(change(0, 1, 1), change(short + 1, -1, 0), change(long + 1, 0, -1)))
    changes = values.select("*", three).where(F.col("_at") < m)
    starts = F.col(f"_s_{long}") == 1
    folded = changes.groupBy("account_id", "_at").agg(
        *(F.sum(F.col(f"_v_{n}") * F.col(f"_s_{w}")).alias(f"{n}_{w}") for n, (_, ws) in amounts.items() for w in ws),
        *(F.max(F.when(starts & F.col(f"_l_{n}"), F.col("_day"))).alias(n) for n in last_days),
        *(F.max(F.when(starts & (F.col("_day") == F.element_at(dates, F.col("_at") + 1)), F.col(f"_c_{n}"))).alias(n) for n in on_cutoff),
    )
    order = Window.partitionBy("account_id").orderBy("_at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = folded.select(
        "account_id",
        "_at",
        F.coalesce(F.lead("_at").over(order), F.lit(m)).alias("_next"),
        *(F.sum(f"{n}_{w}").over(so_far).alias(f"{n}_{w}") for n, (_, ws) in amounts.items() for w in ws),
        *(F.max(n).over(so_far).alias(n) for n in last_days),
        *on_cutoff,
    )
    # A row's sums hold until the account's next change.
    dense = running.where(F.col(f"rows_{long}") > 0).select("*", F.explode(F.sequence("_at", F.col("_next") - 1)).alias("_number"))
    return dense.select(
        "account_id",
        F.element_at(dates, F.col("_number") + 1).alias("cutoff_date"),
        *(f"{n}_{w}" for n, (_, ws) in sums.items() for w in ws),
        *last_days,
        *(F.when(F.col("_number") == F.col("_at"), F.col(n)).alias(n) for n in on_cutoff),
    )
