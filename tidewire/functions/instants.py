"""UTC wall times against instants, as SQL text.

Event times are ``timestamp_ntz`` in UTC; topic records carry ``timestamp``
instants as the broker does. A plain cast between the two would read the wall
time in the session's zone, so none is used.
"""

from tidewire.functions.sql import cases

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _since_epoch(seconds: str) -> str:
    return f"{_EPOCH} + make_dt_interval(0, 0, 0, {seconds})"


def to_wall(instant: str) -> str:
    """The UTC wall time of an instant."""
    return _since_epoch(f"CAST(unix_micros({instant}) / 1000000BD AS DECIMAL(18, 6))")


def to_instant(wall: str) -> str:
    """The instant of a UTC wall time."""
    return f"CAST(concat(CAST({wall} AS STRING), 'Z') AS TIMESTAMP)"


def instant_text(wall: str) -> str:
    """ISO-8601 text of a UTC wall time."""
    return f"concat(translate(CAST({wall} AS STRING), ' ', 'T'), 'Z')"


def parse_instant(text: str) -> str:
    """UTC wall time from ISO-8601 text or from epoch seconds with a fraction; null if neither.

    A number may have an exponent, as in JSON. Digits beyond microseconds are cut off; a number of a trillion seconds
    or more is no time and gives null.
    """
    number = f"try_cast({text} AS DECIMAL(38, 12))"
    seconds = f"try_cast({number} - {number} % 0.000001BD AS DECIMAL(18, 6))"
    return cases({
        f"endswith({text}, 'Z')": f"try_cast({text} AS TIMESTAMP_NTZ)",
        rf"rlike({text}, r'^-?\d+(\.\d+)?([eE][+-]?\d+)?$')": _since_epoch(seconds),
        rf"rlike({text}, r'[+-]\d{{2}}:?\d{{2}}$')": to_wall(f"try_cast({text} AS TIMESTAMP)"),
    })
