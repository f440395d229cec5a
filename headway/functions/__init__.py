from headway.functions.delays import (  # noqa: F401
    delay_change_is_extreme,
    is_late,
    is_on_time,
    is_very_late,
    seconds_apart,
)
from headway.functions.modes import history_mode, live_mode  # noqa: F401
from headway.functions.text import (  # noqa: F401
    age_text,
    clean_text,
    clock_text,
    delay_text,
    destination_text,
    moment_text,
    route_sort_key,
)
from headway.functions.times import (  # noqa: F401
    clock_hour,
    compact_date,
    service_hour,
    service_seconds,
    utc_date,
    utc_digits,
    utc_hour,
    wall_time,
    weekday_name,
    weekday_number,
)
