from holdfast.functions.exprs import (
    class_name,
    currency_text,
    cut,
    cut_ordinal,
    floor_days,
    fraction,
    from_units,
    hash_unit,
    key_hash,
    money_units,
    months_before,
    percent_text,
    safe_ratio,
    sigmoid,
)

__all__ = [
    "class_name",
    "currency_text",
    "cut",
    "cut_ordinal",
    "floor_days",
    "fraction",
    "from_units",
    "hash_unit",
    "key_hash",
    "money_units",
    "months_before",
    "percent_text",
    "safe_ratio",
    "sigmoid",
]
