from abono.functions.columns import (
    as_date,
    as_ts,
    current_only,
    days_between,
    has_tenure,
    in_window,
    int_or_zero,
    is_email,
    last_day_before,
    moment,
    months_before,
    paid_plan,
    text_or_empty,
    valid_at,
    yyyymmdd,
)
