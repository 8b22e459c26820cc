"""Current entity view: hub joined with the newest row of each satellite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.operators.latest import latest_per_key

ColumnOrName = Column | str


@dataclass(frozen=True)
class SatelliteView:
    """One satellite in the view.

    ``columns`` maps output names to expressions over the satellite's newest
    row (e.g. a default for a blank code); ``how`` is ``"inner"`` (entities
    without a row in this satellite are left out) or ``"left"``.
    """

    frame: DataFrame
    columns: Mapping[str, ColumnOrName]
    how: str = "inner"
    order_by: Sequence[Column] = field(default_factory=tuple)


def current_entity_view(
    hub: DataFrame,
    satellites: Sequence[SatelliteView],
    bk_cols: Sequence[str],
    hk_col: str = "hk",
    load_col: str = "load_ts",
    hd_col: str = "hd",
    keep_hk: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """One row per hub key with the newest state of every satellite.

    Each satellite is reduced to its newest row per ``hk`` (load time DESC,
    smaller diff hash first on ties).  The window leaves every reduced
    satellite hash-partitioned on ``hk``, so the chain of joins on ``hk``
    shuffles the hub once and re-uses that partitioning for every satellite.

    ``only`` (distinct hash keys, such as those of the last loads) limits the view to
    these keys: a semi join below the windows, so neither the windows nor the joins
    see any other key's history.
    """
    def wanted(df: DataFrame) -> DataFrame:
        return df if only is None else df.join(only.select(hk_col), hk_col, "left_semi")

    view = wanted(hub.select(hk_col, *bk_cols))
    for sat in satellites:
        if sat.how not in ("inner", "left"):
            raise ValueError("SatelliteView.how must be 'inner' or 'left'")
        order = list(sat.order_by) or [F.col(load_col).desc(), F.col(hd_col).asc()]
        newest = latest_per_key(wanted(sat.frame), [hk_col], order)
        newest = newest.select(
            hk_col,
            *[(F.col(e) if isinstance(e, str) else e).alias(name) for name, e in sat.columns.items()],
        )
        view = view.join(newest, on=hk_col, how=sat.how)
    return view if keep_hk else view.drop(hk_col)
