"""Type-1 slowly-changing dimension with dense surrogate keys.

One full outer join of the dimension with the current entity view, on the
business key, labels every key as

* ``kept``    -- only in the dimension (never deleted),
* ``same``    -- in both, no attribute changed (row untouched),
* ``changed`` -- in both, some attribute changed (same id, attributes
  overwritten, load time refreshed),
* ``new``     -- only in the source (gets the next dense ids, key order).

All four outputs (changed rows, new rows, delta, new full state) are
projections of that single classification.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakevault.functions.columns import changed_any
from lakevault.operators.context import LoadContext
from lakevault.operators.surrogate import assign_surrogate_keys
from lakevault.sources.tables import scratch_table, write_observed

STATUS = "__status"
KEPT, SAME, CHANGED, NEW = "kept", "same", "changed", "new"
_IN_DIM, _IN_SRC, _DUP = "__in_dim", "__in_src", "__dup"


@dataclass(frozen=True)
class DimensionSpec:
    """Column roles of a Type-1 dimension.

    ``attrs`` maps dimension attribute names to the source (entity view)
    column names.  ``unknown`` is the full "unknown" member row (id -1).
    """

    id_col: str
    bk_cols: tuple[str, ...]
    attrs: Mapping[str, str]
    load_col: str
    source_bk_cols: tuple[str, ...] = ()
    unknown: Mapping[str, object] = field(default_factory=dict)
    unknown_id: int = -1

    @property
    def source_keys(self) -> tuple[str, ...]:
        return self.source_bk_cols or self.bk_cols

    @property
    def columns(self) -> list[str]:
        return [self.id_col, *self.bk_cols, *self.attrs, self.load_col]


def _old(name: str) -> str:
    return f"__old_{name}"


def _new(name: str) -> str:
    return f"__new_{name}"


def max_surrogate_key(dim: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row: the largest real id (``id >= 1``), 0 for an empty dimension."""
    return dim.filter(F.col(spec.id_col) >= 1).agg(
        F.coalesce(F.max(spec.id_col).cast("long"), F.lit(0).cast("long")).alias("max_id")
    )


def max_surrogate_value(dim: DataFrame, spec: DimensionSpec) -> int:
    return int(max_surrogate_key(dim, spec).first()["max_id"])


def unknown_member(spark: SparkSession, dim: DataFrame, spec: DimensionSpec, ctx: LoadContext) -> DataFrame:
    """The one-row unknown member, typed like ``dim``."""
    values = dict(spec.unknown)
    values[spec.id_col] = spec.unknown_id
    exprs = []
    for f in dim.schema.fields:
        if f.name == spec.load_col:
            exprs.append(ctx.load_ts_col().cast(f.dataType).alias(f.name))
        elif f.name in values:
            exprs.append(F.lit(values[f.name]).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"unknown member has no value for column {f.name!r}")
    return spark.range(1).select(*exprs)


def ensure_unknown_member(dim: DataFrame, spec: DimensionSpec, ctx: LoadContext) -> DataFrame:
    """``dim`` plus the unknown member if it is not there yet (idempotent).

    Lazy and join-free: the one-row member is kept only when an uncorrelated
    ``NOT EXISTS`` over the dimension's unknown id holds; Spark evaluates it
    once as a ``LIMIT 1`` subquery (a pruned, filter-pushed scan of the id
    column), no driver round trip and no join.
    """
    spark = dim.sparkSession
    member = unknown_member(spark, dim, spec, ctx)
    present = dim.filter(F.col(spec.id_col) == F.lit(spec.unknown_id)).select(spec.id_col)
    return dim.unionByName(member.where(~present.exists()))


def scd1_classify(dim: DataFrame, current: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Full outer join on the business key + status label.

    Output columns: id, business keys, ``__old_<attr>``, ``__new_<attr>``
    (= coalesce(source, old): a NULL never overwrites), old load time and
    ``__status``.  A business key that occurs twice in ``current`` fails the
    job (a MERGE would refuse multiple matches too); the duplicate check is a
    window on the same key the join shuffles on, so it adds no exchange.
    """
    keys = list(spec.bk_cols)
    d = dim.select(
        spec.id_col,
        *keys,
        *[F.col(a).alias(_old(a)) for a in spec.attrs],
        F.col(spec.load_col).alias(_old(spec.load_col)),
        F.lit(True).alias(_IN_DIM),
    )
    src_keys = list(spec.source_keys)
    c = current.select(
        *[F.col(s).alias(k) for s, k in zip(src_keys, keys)],
        *[F.col(src).alias(_new(a)) for a, src in spec.attrs.items()],
        F.lit(True).alias(_IN_SRC),
    )
    dup = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    c = c.withColumn(_DUP, dup).withColumn(
        _IN_SRC,
        F.when(F.col(_DUP) > 1, F.raise_error(F.lit("duplicate business key in the dimension source")).cast("boolean"))
        .otherwise(F.col(_IN_SRC)),
    ).drop(_DUP)
    j = d.join(c, on=keys, how="full_outer")
    new_vals = [F.coalesce(F.col(_new(a)), F.col(_old(a))) for a in spec.attrs]
    old_vals = [F.col(_old(a)) for a in spec.attrs]
    status = (
        F.when(F.col(_IN_SRC).isNull(), F.lit(KEPT))
        .when(F.col(_IN_DIM).isNull(), F.lit(NEW))
        .when(changed_any(new_vals, old_vals), F.lit(CHANGED))
        .otherwise(F.lit(SAME))
    )
    return j.select(
        spec.id_col,
        *keys,
        *old_vals,
        *[v.alias(_new(a)) for v, a in zip(new_vals, spec.attrs)],
        F.col(_old(spec.load_col)),
        status.alias(STATUS),
    )


def _changed_rows(classified: DataFrame, spec: DimensionSpec, ctx: LoadContext) -> DataFrame:
    return classified.filter(F.col(STATUS) == CHANGED).select(
        F.col(spec.id_col).cast("long").alias(spec.id_col),
        *spec.bk_cols,
        *[F.col(_new(a)).alias(a) for a in spec.attrs],
        ctx.load_ts_col().alias(spec.load_col),
    )


def _new_rows(
    classified: DataFrame,
    spec: DimensionSpec,
    ctx: LoadContext,
    start_after: int,
    total: int | None = None,
) -> DataFrame:
    fresh = classified.filter(F.col(STATUS) == NEW).select(
        *spec.bk_cols, *[F.col(_new(a)).alias(a) for a in spec.attrs]
    )
    numbered = assign_surrogate_keys(
        fresh, list(spec.bk_cols), spec.id_col, start_after, total=total
    )
    return numbered.select(
        spec.id_col, *spec.bk_cols, *spec.attrs, ctx.load_ts_col().alias(spec.load_col)
    )


def scd1_changed(dim: DataFrame, current: DataFrame, spec: DimensionSpec, ctx: LoadContext) -> DataFrame:
    """Existing members whose attributes changed: same id, new attributes."""
    return _changed_rows(scd1_classify(dim, current, spec), spec, ctx)


@dataclass(frozen=True)
class Classified:
    """A stored classification and what its one write saw: the greatest real
    id, and how many keys are new and changed (see ``write_observed``)."""

    rows: DataFrame
    max_id: int
    n_new: int
    n_changed: int

    @property
    def differs(self) -> bool:
        return self.n_new + self.n_changed > 0


def classify_once(dim: DataFrame, current: DataFrame, spec: DimensionSpec, differences_only: bool = False) -> Classified:
    """The classification, run and written once.

    The write's job also yields the greatest id and the counts, over all rows,
    even if only the changed and new ones are stored.  The branches that
    follow read stored rows instead of running the join again.
    """
    rows = scd1_classify(dim, current, spec)
    status = F.col(STATUS)
    path = scratch_table(dim.sparkSession, "scd1")

    def write(observed: DataFrame) -> None:
        kept = observed.filter(status.isin(CHANGED, NEW)) if differences_only else observed
        kept.hint("rebalance").write.parquet(path)

    seen = write_observed(
        write,
        rows,
        max_id=F.max(F.when((status != NEW) & (F.col(spec.id_col) >= 1), F.col(spec.id_col).cast("long"))),
        n_new=F.count(F.when(status == NEW, F.lit(1))),
        n_changed=F.count(F.when(status == CHANGED, F.lit(1))),
    )
    stored = dim.sparkSession.read.schema(rows.schema).parquet(path)
    return Classified(stored, int(seen["max_id"] or 0), int(seen["n_new"]), int(seen["n_changed"]))


def scd1_new(
    dim: DataFrame,
    current: DataFrame,
    spec: DimensionSpec,
    ctx: LoadContext,
    start_after: int | None = None,
) -> DataFrame:
    """Source keys not in the dimension, with ids ``max_id + 1 ..`` by key."""
    found = classify_once(dim, current, spec, differences_only=True)
    return _new_rows(found.rows, spec, ctx, found.max_id if start_after is None else start_after, found.n_new)


def delta_of(found: Classified, spec: DimensionSpec, ctx: LoadContext, start_after: int | None = None) -> DataFrame:
    """Changed and new rows of a stored classification, with their ids."""
    start = found.max_id if start_after is None else start_after
    return _changed_rows(found.rows, spec, ctx).unionByName(_new_rows(found.rows, spec, ctx, start, found.n_new))


def scd1_delta(
    dim: DataFrame,
    current: DataFrame,
    spec: DimensionSpec,
    ctx: LoadContext,
    start_after: int | None = None,
) -> DataFrame:
    """Changed rows followed by new rows (what a MERGE would upsert)."""
    found = classify_once(dim, current, spec, differences_only=True)
    return delta_of(found, spec, ctx, start_after)


def scd1_merge(
    dim: DataFrame,
    current: DataFrame,
    spec: DimensionSpec,
    ctx: LoadContext,
    start_after: int | None = None,
    classified: Classified | None = None,
) -> DataFrame:
    """The dimension's new full state after an upsert of ``current``.

    Untouched and source-less rows keep their values and load time; changed
    rows are overwritten in place (same id); new keys get dense ids after the
    current maximum.  The join is evaluated once (``classify_once``); pass its
    result as ``classified`` if it is at hand.
    """
    found = classified or classify_once(dim, current, spec)
    start = found.max_id if start_after is None else start_after
    is_changed = F.col(STATUS) == CHANGED
    existing = found.rows.filter(F.col(STATUS) != NEW).select(
        F.col(spec.id_col).cast("long").alias(spec.id_col),
        *spec.bk_cols,
        *[F.when(is_changed, F.col(_new(a))).otherwise(F.col(_old(a))).alias(a) for a in spec.attrs],
        F.when(is_changed, ctx.load_ts_col()).otherwise(F.col(_old(spec.load_col))).alias(spec.load_col),
    )
    return existing.unionByName(_new_rows(found.rows, spec, ctx, start, found.n_new))
