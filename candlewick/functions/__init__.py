from candlewick.functions.exprs import (  # noqa: F401
    bucket_start,
    epoch_millis,
    flag,
    is_finite,
    nullif0,
    parse_utc,
    ratio,
    ratio0,
    sign3,
    time_range,
    ts_literal,
)
