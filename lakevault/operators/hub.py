"""Hub load: every business key once, with its hash key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.functions.columns import hash_key
from lakevault.operators.context import LoadContext
from lakevault.sources.tables import materialize

ColumnOrName = Column | str
_LINEAGE = "__lineage"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def insert_only_merge(new_rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new_rows`` whose ``keys`` are absent from ``state``.

    The ``WHEN NOT MATCHED THEN INSERT`` half of a MERGE: appending the result
    to the table gives the merged table.  A ``left_anti`` join (not an outer
    join + IS NULL, which Catalyst keeps as a full outer-join output).
    """
    return new_rows.join(state.select(*keys), on=list(keys), how="left_anti")


def selective_probe(state: DataFrame, keys: DataFrame, key: str, most_values: int = 500) -> DataFrame:
    """The rows of ``state`` that can have one of ``keys`` (a stored frame with few, numeric keys).

    One small job gets the least and the greatest key and, if there are at
    most ``most_values``, the keys themselves.  As literals they reach the
    scan: row groups outside the range are skipped, and those whose Bloom filters
    (``TableSpec.bloom``) hold none of the values.  A join with the result is the same as with ``state``.
    """
    seen = keys.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).first()
    if seen["low"] is None:
        return state.filter(F.lit(False))
    near = state.filter(F.col(key).between(seen["low"], seen["high"]))
    if seen["n"] > most_values:
        return near
    values = [r[0] for r in keys.select(key).distinct().collect()]
    return near.filter(F.col(key).isin([v for v in values if v is not None]))


def hub_new_rows(
    snapshot: DataFrame,
    hub: DataFrame,
    keys: Mapping[str, ColumnOrName],
    ctx: LoadContext,
    hk_col: str = "hk",
    load_col: str = "load_ts",
    source_col: str = "record_source",
    hash_bits: int = 256,
    hash_form: str = "hex_binary",
    lineage: ColumnOrName | None = None,
    selective: bool = False,
) -> DataFrame:
    """New hub rows from one snapshot.

    ``keys`` maps the hub's business-key column names to expressions over the
    snapshot.  Rows with a NULL key part are dropped, keys are de-duplicated
    (a partial aggregation, so duplicate-heavy keys collapse map-side), keys
    already in ``hub`` are removed with an anti join on the business key, and
    only the surviving keys are hashed.  ``lineage`` is a text over the
    snapshot that tells where a row came from (its file, for instance); the
    record source of a key is then its smallest one instead of the run's.
    ``selective`` is for small extracts with one numeric key: the keys are
    stored first and the hub is probed for them only (``selective_probe``).
    """
    if not keys:
        raise ValueError("hub_new_rows needs at least one business-key column")
    names = list(keys)
    own = [] if lineage is None else [_col(lineage).alias(_LINEAGE)]
    staged = snapshot.select(*[_col(expr).alias(name) for name, expr in keys.items()], *own)
    not_null = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    staged = staged.filter(not_null)
    staged = staged.distinct() if lineage is None else staged.groupBy(*names).agg(F.min(_LINEAGE).alias(_LINEAGE))
    if selective:
        if len(names) != 1:
            raise ValueError("a selective probe needs a single business key")
        staged = materialize(staged, "hub-keys")
        hub = selective_probe(hub, staged, names[0])
    new = insert_only_merge(staged, hub, names)
    return new.select(
        hash_key(*names, bits=hash_bits, form=hash_form, key_not_null=True).alias(hk_col),
        *names,
        ctx.load_ts_col().alias(load_col),
        (ctx.source_col() if lineage is None else F.coalesce(_LINEAGE, ctx.source_col())).alias(source_col),
    )
