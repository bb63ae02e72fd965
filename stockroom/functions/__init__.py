from stockroom.functions.columns import (  # noqa: F401
    ITEM_UUID_SEP,
    as_text,
    avg_to_bigint,
    day_of_week0,
    epoch_to_date,
    epoch_to_timestamp,
    item_uuid,
    month_abbr,
    month_end,
    non_blank,
    path_level,
    percent,
    to_whole_number,
    typed_null,
    week_ending,
)
