"""ISO dates and date-times, independent of the session time zone."""

from __future__ import annotations

from siltgate.functions.text import lit, matches, strip

# Fixed patterns: an ISO date, and an ISO date-time with optional time and offset.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_MOMENT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(.\d{2}(:\d{2}(:\d{2}(\.(\d{3}|\d{6}))?)?)?([+-]\d{2}:\d{2}(:\d{2})?)?)?$"
)
FIRST_YEAR = "0001"
MIDNIGHT = "00:00:00.000000"


def iso_date(text: str) -> str:
    """date for YYYY-MM-DD after strip, else NULL."""
    day = strip(text)
    ok = f"{matches(day, ISO_DATE)} and {day} >= {lit(FIRST_YEAR)}"
    return f"case when {ok} then try_cast({day} as date) end"


def spelled(text: str) -> str:
    """Stripped, with ``Z`` spelled +00:00."""
    return f"replace({strip(text)}, 'Z', '+00:00')"


def when_iso(text: str) -> str:
    """The text when it has the ISO shape, else NULL."""
    return f"case when {matches(text, ISO_MOMENT)} and {text} >= {lit(FIRST_YEAR)} then {text} end"


def offset_of(iso: str) -> str:
    """The offset, '' when there is none. It ends the text, after at least the hour."""
    return (
        f"case when length({iso}) >= 19 and substring({iso}, -6, 1) in ('+', '-') then right({iso}, 6)"
        f" when length({iso}) >= 22 and substring({iso}, -9, 1) in ('+', '-') then right({iso}, 9)"
        f" when {iso} is not null then '' end"
    )


def clock_of(iso: str, offset: str) -> str:
    """HH:MM:SS.ffffff. The parts have fixed widths, so what lacks is the end of midnight."""
    given = f"substring({iso}, 12, greatest(length({iso}) - 11 - length({offset}), 0))"
    return f"overlay({lit(MIDNIGHT)} placing {given} from 1 for length({given}))"


def instant(iso: str, clock: str, offset: str) -> str:
    """timestamp; a value without offset is taken as UTC."""
    zone = f"case when {offset} = '' then '+00:00' else {offset} end"
    return f"try_cast(concat(substring({iso}, 1, 10), 'T', {clock}, {zone}) as timestamp)"


def shown(iso: str, clock: str, offset: str) -> str:
    """``YYYY-MM-DD HH:MM:SS[.ffffff][+hh:mm]`` in the value's own offset."""
    short = f"case when endswith({clock}, '.000000') then left({clock}, 8) else {clock} end"
    return f"concat(substring({iso}, 1, 10), ' ', {short}, {offset})"


def iso_moment(text: str) -> str:
    """timestamp for ISO text, else NULL. Offsets beyond 18 hours are not read."""
    iso = f"({when_iso(spelled(text))})"
    offset = f"({offset_of(iso)})"
    return instant(iso, clock_of(iso, offset), offset)
