"""Pure Column functions: hashing, cleaning, null handling, phone split.

Every function here returns a ``Column`` built from ``pyspark.sql.functions``
only, so it is evaluated JVM-side inside whole-stage codegen; none of them
adds a shuffle or an action.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Default separator between hashed fields (ASCII unit separator).  Without a
# separator ("ab","c") and ("a","bc") hash alike; ``sep=""`` reproduces that
# older behaviour on purpose.
FIELD_SEPARATOR = "\u001f"

HASH_FORMS = ("hex", "hex_binary", "digest")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_text(c: ColumnOrName) -> Column:
    return _col(c).cast("string")


def _finish_hash(hex_digest: Column, form: str, not_null: bool = False) -> Column:
    if not_null:
        # The input is known non-null, so the digest is too; saying so keeps
        # Catalyst from inferring an ``isnotnull(sha2(..))`` filter for join
        # keys, which would evaluate every hash twice (filter + projection).
        hex_digest = F.coalesce(hex_digest, F.lit(""))
    if form == "hex":
        return hex_digest
    if form == "hex_binary":
        # the text bytes of the hex digest (64 bytes for SHA-256)
        return hex_digest.cast("binary")
    if form == "digest":
        # the raw digest (32 bytes for SHA-256): half the key size in joins
        return F.unhex(hex_digest)
    raise ValueError(f"unknown hash form {form!r}; use one of {HASH_FORMS}")


def hash_key(
    *cols: ColumnOrName,
    bits: int = 256,
    sep: str = FIELD_SEPARATOR,
    form: str = "hex_binary",
    key_not_null: bool = False,
) -> Column:
    """Hash of a business key.

    One column: ``sha2(CAST(key AS STRING), bits)`` exactly.  Several columns
    (composite key): the texts joined by ``sep``, NULL parts as ''.
    A NULL single key gives NULL (callers drop or default it first; pass
    ``key_not_null=True`` when they have, so the result is typed non-null).
    """
    if not cols:
        raise ValueError("hash_key needs at least one column")
    if len(cols) == 1:
        material = _as_text(cols[0])
    else:
        material = F.concat_ws(sep, *[F.coalesce(_as_text(c), F.lit("")) for c in cols])
    return _finish_hash(F.sha2(material, bits), form, not_null=key_not_null or len(cols) > 1)


def hash_diff(
    *cols: ColumnOrName,
    bits: int = 512,
    sep: str = FIELD_SEPARATOR,
    form: str = "hex_binary",
) -> Column:
    """Change hash over key + payload columns, in the given order.

    Each value is cast to text, NULL becomes '', parts are joined by ``sep``.
    With non-null inputs and ``sep=""`` this is ``sha2(a || b || ..., bits)``.
    """
    if not cols:
        raise ValueError("hash_diff needs at least one column")
    parts = [F.coalesce(_as_text(c), F.lit("")) for c in cols]
    material = parts[0] if len(parts) == 1 else F.concat_ws(sep, *parts)
    return _finish_hash(F.sha2(material, bits), form, not_null=True)


def clean_text(c: ColumnOrName, default: str) -> Column:
    """``COALESCE(NULLIF(TRIM(c), ''), default)``: blank or NULL -> default.

    ``trim`` removes spaces only, so a lone TAB is kept.
    """
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(default))


def clean_positive_int(c: ColumnOrName, default: int = -1) -> Column:
    """Values <= 0 or NULL become ``default``."""
    value = _col(c)
    return F.coalesce(F.when(value <= 0, F.lit(None)).otherwise(value), F.lit(default))


def default_if_null(c: ColumnOrName, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def default_if_blank(c: ColumnOrName, default: str) -> Column:
    """Empty text -> ``default`` (NULL stays NULL)."""
    value = _col(c)
    return F.when(value == F.lit(""), F.lit(default)).otherwise(value)


def drop_null_tokens(c: ColumnOrName, tokens: Iterable[str] = ("NULL",)) -> Column:
    """Row predicate: value is not NULL and not one of the text tokens.

    ``tokens=()`` keeps everything non-null (the OR-variant of the check is
    exactly ``IS NOT NULL``).
    """
    value = _col(c)
    tokens = tuple(tokens)
    pred = value.isNotNull()
    if tokens:
        pred = pred & ~value.isin(list(tokens))
    return pred


def split_phone(c: ColumnOrName, rest_length: int = 25) -> tuple[Column, Column, Column]:
    """Split ``'(916) 381-6003'`` into area code, digits text and number.

    Returns ``(area_code, rest_text, number)``:
    * area code: everything up to and including the first ')' ('' if none);
    * rest text: up to ``rest_length`` characters after it, dashes removed;
    * number: rest text as INT, -1 when it is not a valid INT (letters,
      blanks, overflow) -- ``try_cast`` so ANSI mode never raises.
    A NULL phone is treated as ''.
    """
    phone = F.coalesce(_col(c), F.lit(""))
    pos = F.instr(phone, ")")
    area = phone.substr(F.lit(1), pos)
    rest = F.replace(phone.substr(pos + F.lit(1), F.lit(rest_length)), F.lit("-"), F.lit(""))
    number = F.coalesce(rest.try_cast("int"), F.lit(-1))
    return area, rest, number


def changed_any(new_cols: Sequence[Column], old_cols: Sequence[Column]) -> Column:
    """True when any ``coalesce(new, old)`` differs null-safely from ``old``.

    A NULL on the new side never counts as a change (it never overwrites).
    """
    if len(new_cols) != len(old_cols) or not new_cols:
        raise ValueError("changed_any needs two equally long, non-empty column lists")
    diffs = [~F.coalesce(n, o).eqNullSafe(o) for n, o in zip(new_cols, old_cols)]
    return reduce(lambda a, b: a | b, diffs)


def require_not_null(df: DataFrame, cols: Sequence[str], table: str = "table") -> DataFrame:
    """Enforce NOT NULL lazily: the check runs inside the write job itself.

    Plain Parquet accepts NULL in a NOT NULL column, so the loaders assert it;
    ``raise_error`` fails the task on the first offending row without a
    separate validation pass over the data.
    """
    checked = []
    for name in df.columns:
        if name in cols:
            msg = f"NULL in NOT NULL column {table}.{name}"
            checked.append(
                F.when(F.col(name).isNull(), F.raise_error(F.lit(msg)).cast(df.schema[name].dataType))
                .otherwise(F.col(name))
                .alias(name)
            )
        else:
            checked.append(F.col(name))
    return df.select(*checked)


def timestamp_literal(ts: str) -> Column:
    """A pinned timestamp parsed in the session time zone (one value per run)."""
    return F.to_timestamp(F.lit(ts))


def timestamp_text(c: ColumnOrName) -> Column:
    """Timestamp rendered as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")
