from martwise.functions.columns import (  # noqa: F401
    USD_TO_VND_RATE, as_of_literal, blank_to_null, code_status, conform, count_if, date_key,
    has_real_id, is_holiday, key_part, line_total, parse_utc_timestamp,
    recency_days, rename_existing, standardize_columns, standardize_name, surrogate_key,
    to_double_or_zero, to_long_or_zero, to_nullable_long, usd_to_vnd_fill,
    usd_to_vnd_rounded, whole_days, whole_hours, zalopay_method,
)
