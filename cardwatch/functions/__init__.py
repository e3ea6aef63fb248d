from cardwatch.functions.dialect import (  # noqa: F401
    concat_nullable,
    differs_null_safe,
    empty_as_null,
    epoch_us,
    from_epoch_us,
    is_true,
    minus_days,
    plus_days,
    plus_years,
    ts_lit,
    window_us,
)
