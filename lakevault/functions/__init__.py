from lakevault.functions.columns import (
    FIELD_SEPARATOR,
    changed_any,
    clean_positive_int,
    clean_text,
    default_if_blank,
    default_if_null,
    drop_null_tokens,
    hash_diff,
    hash_key,
    require_not_null,
    split_phone,
    timestamp_literal,
    timestamp_text,
)

__all__ = [
    "FIELD_SEPARATOR",
    "changed_any",
    "clean_positive_int",
    "clean_text",
    "default_if_blank",
    "default_if_null",
    "drop_null_tokens",
    "hash_diff",
    "hash_key",
    "require_not_null",
    "split_phone",
    "timestamp_literal",
    "timestamp_text",
]
