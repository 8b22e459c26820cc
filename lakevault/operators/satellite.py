"""Satellite load: one row per distinct descriptive state of a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.functions.columns import FIELD_SEPARATOR, hash_diff, hash_key
from lakevault.operators.context import LoadContext
from lakevault.operators.latest import latest_per_key

ColumnOrName = Column | str

MODES = ("ever_seen", "latest")
_BK = "__bk"
_PAYLOAD = "__payload"
LINEAGE = "__lineage"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def satellite_stage(
    snapshot: DataFrame,
    key: ColumnOrName,
    payload: Mapping[str, ColumnOrName],
    diff_cols: Sequence[ColumnOrName] | None = None,
    row_filter: Column | None = None,
    null_key: str | int = "drop",
    hk_col: str = "hk",
    hd_col: str = "hd",
    key_bits: int = 256,
    diff_bits: int = 512,
    sep: str = FIELD_SEPARATOR,
    hash_form: str = "hex_binary",
    dedupe: bool = True,
    lineage: ColumnOrName | None = None,
) -> DataFrame:
    """Hash and clean one snapshot into satellite candidates.

    * ``payload``: stored columns, name -> expression over the snapshot;
    * ``diff_cols``: what the change hash covers after the key text (default:
      the payload expressions in order); may include unstored expressions;
    * ``row_filter``: rows to keep (e.g. a null-token check);
    * ``null_key``: ``"drop"`` removes rows without a key, a value replaces
      the missing key (such rows never join a hub row later);
    * ``dedupe``: keep one candidate per (hk, hd) (a partial aggregation);
    * ``lineage``: where a row came from, stored as the record source of the
      state (the smallest one of its candidates) in place of the run's.

    Output: ``hk``, ``hd`` and the payload columns -- all narrow operations
    except the optional de-duplication.
    """
    rows = snapshot if row_filter is None else snapshot.filter(row_filter)
    key_col = _col(key)
    if null_key == "drop":
        rows = rows.filter(key_col.isNotNull())
    else:
        key_col = F.coalesce(key_col, F.lit(null_key))
    diffs = list(payload.values()) if diff_cols is None else list(diff_cols)
    diff_names = [f"__d{i}" for i in range(len(diffs))]
    own = [] if lineage is None else [_col(lineage).alias(LINEAGE)]
    staged = rows.select(
        key_col.alias(_BK),
        *[_col(expr).alias(name) for name, expr in payload.items()],
        *[_col(expr).alias(name) for name, expr in zip(diff_names, diffs)],
        *own,
    )
    staged = staged.select(
        hash_key(_BK, bits=key_bits, form=hash_form, key_not_null=True).alias(hk_col),
        hash_diff(_BK, *diff_names, bits=diff_bits, sep=sep, form=hash_form).alias(hd_col),
        *payload.keys(),
        *([LINEAGE] if own else []),
    )
    if not dedupe:
        return staged
    names = list(payload.keys())
    if not names and not own:
        return staged.distinct()
    sources = [F.min(LINEAGE).alias(LINEAGE)] if own else []
    if not names:
        return staged.groupBy(hk_col, hd_col).agg(*sources)
    # One candidate per (hk, hd).  Grouping on the two hash columns (not on
    # every column) keeps the map-side partial aggregation -- copies of a hot
    # pair collapse before the shuffle -- and leaves the result partitioned
    # and sorted on (hk, hd), which the anti join then uses without a second
    # exchange.  min(struct) makes the payload choice deterministic should
    # two payloads ever share a diff hash.
    best = F.min(F.struct(*[F.col(n) for n in names])).alias(_PAYLOAD)
    return staged.groupBy(hk_col, hd_col).agg(best, *sources).select(
        hk_col, hd_col, *[F.col(_PAYLOAD).getField(n).alias(n) for n in names], *([LINEAGE] if own else [])
    )


def satellite_history_keys(
    satellite: DataFrame,
    mode: str = "ever_seen",
    hk_col: str = "hk",
    hd_col: str = "hd",
    load_col: str = "load_ts",
) -> DataFrame:
    """The (hk, hd) pairs a candidate is compared with.

    ``ever_seen``: every pair ever stored, so a value that returns to an
    earlier state is not stored again.  ``latest``: only the newest row per
    key (ties broken by the smaller diff hash), so a return is stored.
    """
    if mode == "ever_seen":
        # distinct: a pair that fills a third of the history is one row per task before the shuffle
        return satellite.select(hk_col, hd_col).distinct()
    if mode == "latest":
        newest = latest_per_key(
            satellite.select(hk_col, hd_col, load_col),
            [hk_col],
            [F.col(load_col).desc(), F.col(hd_col).asc()],
        )
        return newest.select(hk_col, hd_col)
    raise ValueError(f"unknown satellite mode {mode!r}; use one of {MODES}")


def satellite_new_rows(
    staged: DataFrame,
    satellite: DataFrame,
    ctx: LoadContext,
    mode: str = "ever_seen",
    hk_col: str = "hk",
    hd_col: str = "hd",
    load_col: str = "load_ts",
    source_col: str = "record_source",
    granularity: str = "second",
) -> DataFrame:
    """Candidates not yet in the satellite under ``mode``, stamped with the
    run's load time and record source (append them to load the satellite).

    The comparison is an anti join on (hk, hd) in both modes; only the two
    hash columns of the history are read.  In ``latest`` mode the history is
    one newest row per key, so "the newest row has another diff hash" and "no
    newest row with this diff hash" are the same.  The candidates keep the
    (hk, hd) partitioning of their de-duplication: they aren't shuffled again,
    and the states of a hot key are spread by their diff hash.
    """
    history = satellite_history_keys(satellite, mode, hk_col, hd_col, load_col)
    new = staged.join(history, on=[hk_col, hd_col], how="left_anti")
    payload = [c for c in staged.columns if c not in (hk_col, hd_col, LINEAGE)]
    source = F.coalesce(LINEAGE, ctx.source_col()) if LINEAGE in staged.columns else ctx.source_col()
    return new.select(
        hk_col,
        ctx.load_ts_col(granularity).alias(load_col),
        hd_col,
        *payload,
        source.alias(source_col),
    )
