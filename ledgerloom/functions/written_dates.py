"""Dates as people write them: the text is cut into tokens, and a small automaton gives each token its meaning.

The automaton is a fold over the tokens of a cell, all built-in functions. It collects up to three numbers and a month
name, one clock time and one zone; afterwards the numbers must make a day of the calendar in some usual order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of written dates.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
LONG_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = (
    "mon", "tue", "tues", "wed", "thu", "thur", "thurs", "fri", "sat", "sun",
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
)
ZONES = ("z", "utc", "gmt", "est", "edt", "cst", "cdt", "mst", "mdt", "pst", "pdt", "bst", "cet", "cest", "eet", "eest", "jst")
LINK_WORDS = ("at", "on", "of", "and", "the")
ORDINAL_ENDINGS = ("st", "nd", "rd", "th")
SEPARATORS = (",", "/", "-", ".")

_WORDS = {*MONTHS, *LONG_MONTHS, *WEEKDAYS, *ZONES, *LINK_WORDS, *ORDINAL_ENDINGS, "sept", "t", "am", "pm"}
# What can be a date at all: known words, digits and signs, but no plain year, month and day, which the calendar of the
# usual forms has settled. Most other cells fall here, before any token is looked at.
_POSSIBLE = (
    r"^(?![0-9]{4}[-/. ][0-9]{1,2}[-/. ][0-9]{1,2}$)(?:[0-9\s,/.:+-]|(?:"
    + "|".join(sorted(_WORDS, key=lambda w: (-len(w), w)))
    + r")(?![a-z]))++$"
)
_TOKEN = r"([0-9]+(?::[0-9]+)+(?:[.,][0-9]+)?|[0-9]+|[a-z]+|[^\sa-z0-9])"
_CLOCK = r"^(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:[.,][0-9]+)?)?$"
_OFFSET = r"^(?:[01]?[0-9]|2[0-3])(?::?[0-5][0-9])?$"
_SHORT_CLOCK = r"^(?:[01][0-9]|2[0-3])(?:[0-5][0-9]){0,2}$"
# A two-digit number above every day is a year.
_MOST_DAYS = 31

# What the automaton holds: numbers with their written widths, month by name, what of a time was seen, and the kind of
# the last token. ``zone`` is 2 while an offset is due.
_STATE = "ok boolean, numbers array<int>, widths array<int>, month int, clock boolean, zone int, last string"


def _leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def _days(year: Column, month: Column) -> Column:
    """Days of a month; a null year counts as a leap year."""
    short = F.when(F.coalesce(_leap(year), F.lit(True)), 29).otherwise(28)
    return F.when(month == 2, short).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def _is_day(year: Column, month: Column, day: Column) -> Column:
    return month.between(1, 12) & (day >= 1) & (day <= _days(year, month))


def _full_year(number: Column, width: Column) -> Column:
    """Two-digit years from 69 on belong to the previous century."""
    return F.when(width <= 2, number + F.when(number >= 69, 1900).otherwise(2000)).otherwise(number)


def _changed(state: Column, **fields: Column) -> Column:
    names = ("ok", "numbers", "widths", "month", "clock", "zone", "last")
    return F.struct(*[fields.get(n, state[n]).alias(n) for n in names])


def _number(digits: Column) -> Column:
    return F.coalesce(digits.try_cast("int"), F.lit(-1))


def _pushed(state: Column, *parts: tuple[Column, int]) -> dict[str, Column]:
    """The state's numbers with further ones of given widths."""
    return {
        "numbers": F.concat(state["numbers"], F.array(*[_number(p) for p, _ in parts])),
        "widths": F.concat(state["widths"], F.array(*[F.lit(w) for _, w in parts])),
    }


def _digits(state: Column, token: Column) -> Column:
    """A run of digits: an offset, a time after ``t``, a date without separators, or a number."""
    width = F.length(token)
    none = (F.size(state["numbers"]) == 0) & (state["month"] == 0)
    year4, compact = F.substring(token, 1, 4), [F.substring(token, k, 2) for k in (1, 3, 5, 7)]
    dated = _pushed(state, (year4, 4), (compact[2], 2), (compact[3], 2))
    small = _pushed(state, (compact[0], 2), (compact[1], 2), (compact[2], 2))
    num = F.lit("number")
    bad = _changed(state, ok=F.lit(False))
    timed = F.substring(token, 9, 6).rlike(_SHORT_CLOCK)
    none_yet = state["ok"] & none & _is_day(_number(year4), _number(compact[2]), _number(compact[3]))
    return (
        F.when(state["zone"] == 2, _changed(state, ok=state["ok"] & token.rlike(_OFFSET), zone=F.lit(1), last=num))
        .when(state["last"] == "t", _changed(state, ok=state["ok"] & ~state["clock"] & token.rlike(_SHORT_CLOCK), clock=F.lit(True), last=F.lit("clock")))
        .when(width.isin(12, 14), _changed(state, ok=none_yet & ~state["clock"] & timed, clock=F.lit(True), last=F.lit("clock"), **dated))
        .when(width == 8, _changed(state, ok=none_yet, last=num, **dated))
        .when(width == 6, _changed(state, ok=state["ok"] & none, last=num, **small))
        .when(width == 4, _changed(state, last=num, **_pushed(state, (token, 4))))
        .when(width == 2, _changed(state, last=num, **_pushed(state, (token, 2))))
        .when(width == 1, _changed(state, last=num, **_pushed(state, (token, 1))))
        .otherwise(bad)
    )


def _word(state: Column, token: Column) -> Column:
    month = F.greatest(
        F.array_position(F.array(*map(F.lit, MONTHS)), token), F.array_position(F.array(*map(F.lit, LONG_MONTHS)), token)
    ).cast("int")
    month = F.when(token == "sept", 9).otherwise(month)
    held = F.size(state["numbers"])
    after_number = state["last"] == "number"
    # "10 pm": the number before is an hour, not part of the date.
    hour = F.get(state["numbers"], held - 1)
    taken = _changed(
        state, ok=state["ok"] & after_number & hour.between(1, 12), numbers=F.slice(state["numbers"], 1, F.greatest(held - 1, F.lit(0))),
        widths=F.slice(state["widths"], 1, F.greatest(held - 1, F.lit(0))), clock=F.lit(True), last=F.lit("clock"),
    )
    half = F.when(state["clock"], _changed(state, ok=state["ok"] & (state["last"] == "clock"), last=F.lit("word"))).otherwise(taken)
    return (
        F.when(month > 0, _changed(state, ok=state["ok"] & (state["month"] == 0), month=month, last=F.lit("word")))
        .when(token.isin(*WEEKDAYS) | token.isin(*LINK_WORDS), _changed(state, last=F.lit("word")))
        .when(token.isin(*ORDINAL_ENDINGS), _changed(state, ok=state["ok"] & after_number, last=F.lit("word")))
        .when(token == "t", _changed(state, ok=state["ok"] & after_number, last=F.lit("t")))
        .when(token.isin("am", "pm"), half)
        .when(token.isin(*ZONES), _changed(state, ok=state["ok"] & state["clock"] & (state["zone"] == 0), zone=F.lit(1), last=F.lit("word")))
        .otherwise(_changed(state, ok=F.lit(False)))
    )


def _sign(state: Column, token: Column) -> Column:
    timed = state["clock"] & (state["last"] == "clock")
    offset = token.isin("+", "-") & timed & (state["zone"] == 0)
    return F.when(offset, _changed(state, zone=F.lit(2), last=F.lit("sign"))).otherwise(
        _changed(state, ok=state["ok"] & token.isin(*SEPARATORS), last=F.lit("sign"))
    )


def _step(state: Column, token: Column) -> Column:
    offset = state["zone"] == 2
    clock = F.when(offset, _changed(state, ok=state["ok"] & token.rlike(_OFFSET), zone=F.lit(1), last=F.lit("number"))).otherwise(
        _changed(state, ok=state["ok"] & ~state["clock"] & token.rlike(_CLOCK), clock=F.lit(True), last=F.lit("clock"))
    )
    return (
        F.when(token.contains(":") & (F.length(token) > 1), clock)
        .when(token.rlike("^[0-9]"), _digits(state, token))
        .when(token.rlike("^[a-z]"), _word(state, token))
        .otherwise(_sign(state, token))
    )


def _calendar(state: Column) -> Column:
    """Whether the numbers and the month name are a date, a month, a year, or nothing beside a time."""
    many, name = F.size(state["numbers"]), state["month"]
    n = [F.get(state["numbers"], F.lit(k)) for k in range(3)]
    w = [F.get(state["widths"], F.lit(k)) for k in range(3)]
    year = [_full_year(n[k], w[k]) for k in range(3)]
    # A number that can only be a year.
    is_year = [(w[k] == 4) | (n[k] > _MOST_DAYS) for k in range(3)]
    with_name = (
        F.when(many == 0, F.lit(True))
        .when(many == 1, is_year[0] | _is_day(F.lit(None).cast("int"), name, n[0]))
        .when(many == 2, F.when(is_year[0], _is_day(year[0], name, n[1])).otherwise(_is_day(year[1], name, n[0])))
    )
    leap = F.lit(None).cast("int")
    pair = (
        F.when(is_year[0], n[1].between(1, 12) & (w[1] <= 2))
        .when(is_year[1], n[0].between(1, 12) & (w[0] <= 2))
        .otherwise(_is_day(leap, n[0], n[1]) | _is_day(leap, n[1], n[0]))
    )
    orders = [_is_day(year[a], n[b], n[c]) for a, b, c in ((2, 0, 1), (2, 1, 0), (0, 1, 2), (0, 2, 1))]
    triple = F.when(is_year[0], orders[2]).when(is_year[2], orders[0] | orders[1]).otherwise(reduce(lambda x, y: x | y, orders))
    plain = (
        F.when(many == 0, state["clock"])
        .when(many == 1, w[0] == 4)
        .when(many == 2, pair)
        .when(many == 3, triple & (F.array_size(F.filter(state["widths"], lambda x: x == 4)) <= 1))
    )
    return F.coalesce(F.when(name > 0, with_name).otherwise(plain), F.lit(False))


def is_written_date(c: Column) -> Column:
    """Whether a text is a date, a day and month, a year, a month, or a time, with time and zone optional.

    Understood are numbers with or without separators, month names, weekdays, ordinal endings and linking words, in the
    usual orders, and the calendar with its leap years. A lone day is no date. Plain years, months and days as in
    2020-01-31 are left to ``DATE_REGEX`` and false here. Null for null text.
    """
    text = F.lower(F.trim(c))
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(1))
    start = F.struct(
        F.lit(True).alias("ok"), F.array().cast("array<int>").alias("numbers"), F.array().cast("array<int>").alias("widths"),
        F.lit(0).alias("month"), F.lit(False).alias("clock"), F.lit(0).alias("zone"), F.lit("").alias("last"),
    ).cast(f"struct<{', '.join(x.replace(' ', ':', 1) for x in _STATE.split(', '))}>")
    read = F.aggregate(tokens, start, _step, lambda s: s["ok"] & (s["zone"] != 2) & (s["last"] != "t") & _calendar(s))
    return F.when(text.rlike(_POSSIBLE), read).when(text.isNotNull(), F.lit(False))
