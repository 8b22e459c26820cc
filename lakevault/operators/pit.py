"""Point-in-time table: for each hash key the newest row of every satellite.

The table is kept up to date by every load: the new rows of the load and the
stored rows of just these keys are compared, so no window runs over the
satellites' history.  The current entity view is then a projection.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators.latest import latest_per_key
from lakevault.sources.tables import ColumnSpec, TableSpec


@dataclass(frozen=True)
class PitLayout:
    """Which columns are kept.  ``satellites`` maps a short name to the payload
    columns of that satellite; they are stored as ``<name>_<column>``, next to
    ``<name>_<load_col>`` and ``<name>_<hd_col>``."""

    name: str
    hk: ColumnSpec
    bk: tuple[ColumnSpec, ...]
    satellites: Mapping[str, tuple[ColumnSpec, ...]]
    load_col: str
    hd: ColumnSpec

    def stored(self, satellite: str) -> dict[str, T.DataType]:
        """Satellite column -> type, load time and diff hash first."""
        out = {self.load_col: T.TimestampType(), self.hd.name: self.hd.dtype}
        return out | {c.name: c.dtype for c in self.satellites[satellite]}

    @property
    def spec(self) -> TableSpec:
        cols = [ColumnSpec(self.hk.name, self.hk.dtype), *[ColumnSpec(c.name, c.dtype, nullable=True) for c in self.bk]]
        for s in self.satellites:
            cols += [ColumnSpec(f"{s}_{c}", t, nullable=True) for c, t in self.stored(s).items()]
        return TableSpec(self.name, tuple(cols), comment="newest satellite rows per key")


def pit_rows(stored: DataFrame, hub_new: DataFrame, new: Mapping[str, DataFrame], keys: DataFrame, layout: PitLayout) -> DataFrame:
    """The table's rows of ``keys`` after a load.

    ``stored``: their rows so far; ``hub_new`` and ``new``: the load's hub and
    satellite rows.  Newest is the latest load time, the smaller diff hash on
    ties, as in ``current_entity_view``.
    """
    hk = layout.hk.name
    bks = [c.name for c in layout.bk]
    known = stored.filter(F.col(bks[0]).isNotNull()).select(hk, *bks)
    out = keys.select(hk).join(hub_new.select(hk, *bks).unionByName(known).distinct(), hk, "left")
    for s, rows in new.items():
        names = layout.stored(s)
        load, hd = f"{s}_{layout.load_col}", f"{s}_{layout.hd.name}"
        fresh = rows.select(hk, *[F.col(c).cast(t).alias(f"{s}_{c}") for c, t in names.items()])
        before = stored.filter(F.col(load).isNotNull()).select(hk, *[f"{s}_{c}" for c in names])
        newest = latest_per_key(fresh.unionByName(before), [hk], [F.col(load).desc(), F.col(hd).asc()])
        out = out.join(newest, hk, "left")
    return out


def pit_view(pit: DataFrame, layout: PitLayout, columns: Mapping[str, Column], required: tuple[str, ...], keep_hk: bool = False) -> DataFrame:
    """The current entity view: keys in the hub that have a row in every required satellite."""
    present = F.col(layout.bk[0].name).isNotNull()
    for s in required:
        present = present & F.col(f"{s}_{layout.load_col}").isNotNull()
    head = [layout.hk.name] if keep_hk else []
    return pit.filter(present).select(*head, *[c.name for c in layout.bk], *[e.alias(n) for n, e in columns.items()])
