"""Column expressions for study-day labels and times of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions.text import NUMBER, strip, whole

# How a time of day is usually written, and how else it may be.
USUAL_TIME = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
FULL_TIME = r"^([01]?\d|2[0-3]):([0-5]?\d):([0-5]?\d)$"
SHORT_TIME = r"^([01]?\d|2[0-3]):([0-5]?\d)(:([0-5]?\d))?$"

# Expressions below test the usual spelling of the bare cell first. What any other spelling
# needs sits in a branch of its own, so that ordinary rows never pay for it.


def full_time(time: Column) -> Column:
    """The time without blanks around it, and with seconds when it had only hour and minute.

    A cell that starts and ends with a digit and has two colons or more stays as it is, and needs no pattern.
    """
    text = strip(time)
    colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))
    other = F.when(colons == 1, F.concat(text, F.lit(":00"))).otherwise(text)
    digits = (time >= "0") & (time < ":") & F.substr(time, F.lit(-1)).between("0", "9")
    stays = digits & (F.substring_index(time, ":", 2) != time)
    return F.when(stays | time.rlike(USUAL_TIME), time).otherwise(other)


def is_time(time: Column, short: bool = False) -> Column:
    """Whether the cell is a time HH:MM:SS; with ``short`` also HH:MM. Null stays null."""
    return time.rlike(USUAL_TIME) | strip(time).rlike(SHORT_TIME if short else FULL_TIME)


def minute_guess(time: Column) -> Column:
    """The minute of the day by the digits read as one number, which minute_of_day holds against the text."""
    digits = F.replace(time, F.lit(":"), F.lit("")).try_cast("int")
    return (digits / 10000).cast("int") * 60 + (digits / 100).cast("int") % 100


def minute_of_day(time: Column, short: bool = False, guess: Column | None = None) -> Column:
    """0 to 1439 from HH:MM:SS, seconds dropped; with ``short`` also from HH:MM. Else null.

    In the usual spelling the text starts with the hour and minute that were guessed, as they are usually written.
    ``guess`` is minute_guess of the time where a frame holds it already; it is read twice here.
    """
    guess = minute_guess(time) if guess is None else guess
    texts = lambda cells: F.split(F.lit(",".join(cells)), ",")
    minutes = texts(f"{minute // 60:02d}:{minute % 60:02d}:" for minute in range(1440))
    # The second's text is named once: what is named twice is computed ahead, for every row.
    seconds = texts(f"{second:02d}" for second in range(60))
    is_second = F.endswith(time, F.lit("00")) | F.array_contains(seconds, F.substr(time, F.lit(7), F.lit(2)))
    is_usual = (F.substr(time, F.lit(1), F.lit(6)) == F.get(minutes, guess)) & (F.octet_length(time) == 8) & is_second
    text, pattern = strip(time), SHORT_TIME if short else FULL_TIME
    hour = F.regexp_extract(text, pattern, 1).try_cast("int")
    minute = F.regexp_extract(text, pattern, 2).try_cast("int")
    return F.when(is_usual, guess).otherwise(hour * 60 + minute)


def is_day(date: Column) -> Column:
    """Whether the cell is a label dayN."""
    return day_index(date).isNotNull()


def day_index(date: Column) -> Column:
    """N from a label dayN in any case, null when N is no whole number."""
    usual = F.when(date.startswith("day"), F.substr(date, F.lit(4)).try_cast("bigint"))
    # As number() reads it, by its pattern alone: the short code is compiled, the long one was not.
    text = F.lower(strip(date))
    rest = strip(F.substr(text, F.lit(4)))
    other = F.when(text.startswith("day"), whole(F.when(rest.rlike(NUMBER), rest.try_cast("double"))))
    return F.coalesce(usual, other)


def day_label(day: Column) -> Column:
    return F.concat(F.lit("day"), day.cast("string"))
