"""Column expressions shared by the operators."""

from scoreline.functions.expr import (  # noqa: F401
    DEFAULT_ICON,
    EVENT_ICONS,
    FINISHED,
    event_icon,
    event_line,
    flag,
    has_class,
    instant,
    lenient_int,
    match_result,
    ntz,
    points,
    round_ratio,
    side_outcome,
    spaced,
    strip_marker,
)
