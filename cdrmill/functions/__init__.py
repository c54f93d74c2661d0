from cdrmill.functions.parse import (  # noqa: F401
    base_name,
    blank_to_null,
    date_from_name,
    duration_seconds,
    hhmiss,
    parent_name,
    parse_fixed_width,
    parse_yyyymmdd,
    sentinel,
    slice_field,
)
