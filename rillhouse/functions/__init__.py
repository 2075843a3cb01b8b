"""Column expressions shared by all layers.  No Python runs per row."""

from rillhouse.functions.jsontext import (  # noqa: F401
    is_json_object, is_object_text, json_field, json_put, json_string, json_value, keep_numbers,
    plain_member_put, restore_numbers,
)
from rillhouse.functions.numbers import (  # noqa: F401
    amount_or_zero, is_valid_amount, is_valid_integer, parse_amount, parse_integer, round_money,
    sum_whole,
)
from rillhouse.functions.once import add_once, parse_once  # noqa: F401
from rillhouse.functions.text import (  # noqa: F401
    clean_tsv_field, default_if_blank, equals_ignore_case, first_non_blank, is_blank,
    split_and_trim, string_max, trim_control, tsv_line,
)
from rillhouse.functions.timestamps import (  # noqa: F401
    date_label, hour_label, millis_to_timestamp, now_millis, parse_event_time, second_label,
    to_label,
)
