"""Date masks and the permissive date check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.written_dates import is_written_date

# Format codes of date masks and the Spark pattern letters they stand for.
_CODES = {
    "d": "d",
    "m": "M",
    "Y": "yyyy",
    "y": "yy",
    "b": "MMM",
    "B": "MMMM",
    "H": "H",
    "I": "h",
    "M": "m",
    "S": "s",
    "p": "a",
    "j": "D",
    "f": "SSSSSS",
}
_NUMERIC_CODES = set("dmYyHIMSj")
_FIXED_WIDTH = {"d": "dd", "m": "MM", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "j": "DDD"}
_TWO_DIGIT_PIVOT = 2069
# Codes that are checked and cut out before parsing, since they do not change the written time.
_CUT_CODES = {
    "a": "(?i:mon|tue|wed|thu|fri|sat|sun)",
    "A": "(?i:monday|tuesday|wednesday|thursday|friday|saturday|sunday)",
    "z": "(?:[+-][0-9]{2}:?[0-9]{2}(?::?[0-9]{2})?|Z)",
    "Z": "(?i:utc|gmt)",
}

def spark_pattern(mask: str) -> str:
    """Spark datetime pattern of a ``%``-style mask; raises on codes without a counterpart."""
    tokens: list[tuple[str, str]] = []
    position = 0
    while position < len(mask):
        char = mask[position]
        code = mask[position + 1 : position + 2] if char == "%" else None
        if code in (None, "%"):
            # Neighbouring characters share one quoted run.
            if tokens and tokens[-1][0] == "text":
                char = tokens.pop()[1] + char
            tokens.append(("text", char))
            position += 2 if code else 1
            continue
        if code in _CODES:
            tokens.append(("code", code))
        else:
            raise ValueError(f"date mask code %{code} is not supported")
        position += 2
    return "".join(_render(tokens, index) for index in range(len(tokens)))


def _render(tokens: list[tuple[str, str]], index: int) -> str:
    kind, value = tokens[index]
    if kind == "text":
        return "'" + value.replace("'", "''") + "'"
    neighbours = tokens[max(index - 1, 0) : index] + tokens[index + 1 : index + 2]
    glued = any(k == "code" and v in _NUMERIC_CODES for k, v in neighbours)
    return _FIXED_WIDTH[value] if glued and value in _FIXED_WIDTH else _CODES[value]


def _without_cut_codes(c: Column, mask: str) -> tuple[Column, str]:
    """Cell and mask without weekday names and zones; the cell is null where one of them is missing.

    A code at either end of the mask is looked for at that end of the cell.
    """
    for code, form in _CUT_CODES.items():
        plain = mask.replace("%%", "\0\0")
        at = plain.find(f"%{code}")
        if at < 0:
            continue
        form = ("^" if at == 0 else "") + form + ("$" if at + 2 == len(mask) else "")
        c = F.when(c.rlike(form), F.regexp_replace(c, f"^(.*?){form.removeprefix('^')}" if at else form, "$1" if at else ""))
        mask = mask[:at] + mask[at + 2 :]
    return c, mask


def masked_timestamp(c: Column, mask: str) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text of a cell read with ``mask``; null when blank or not in that form.

    Two-digit years from 69 on belong to the previous century. The zone letter is literal: no zone conversion takes
    place, whatever the session's zone or a zone in the cell.
    """
    c, mask = _without_cut_codes(c, mask)
    instant = F.try_to_timestamp(F.concat(c, F.lit("Z")), F.lit(spark_pattern(mask) + "X"))
    # Read as UTC and kept without a zone, so that no session zone can shift it.
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(instant).cast("decimal(18,6)"))
    parsed = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + seconds
    if "%y" in mask.replace("%%", ""):
        shifted = parsed - F.expr("interval 100 years")
        parsed = F.when(F.year(parsed) >= _TWO_DIGIT_PIVOT, shifted).otherwise(parsed)
    return F.concat(F.replace(parsed.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def _any(*choices: str) -> str:
    return "(?:" + "|".join(choices) + ")"


def date_regex() -> str:
    """Regular expression of real calendar dates in the usual exported forms, with an optional time.

    Month lengths and leap years are part of it, so telling a date from other text needs no parse attempt
    (failed ones are costly).
    """
    short_days, most_days, all_days = r"(?:0?[1-9]|1\d|2[0-8])", r"(?:0?[1-9]|[12]\d|30)", r"(?:0?[1-9]|[12]\d|3[01])"
    long_months, mid_months, february = r"(?:0?[13578]|1[02])", r"(?:0?[469]|11)", "0?2"
    leap_end = r"(?:0[48]|[2468][048]|[13579][26])"
    year, leap = r"(?:\d{4}|\d{2})", _any(r"\d\d" + leap_end, "(?:[02468][048]|[13579][26])00", leap_end, "00")
    year4, leap4 = r"\d{4}", _any(r"\d\d" + leap_end, "(?:[02468][048]|[13579][26])00")
    long_names = "(?:jan(?:uary)?|mar(?:ch)?|may|july?|aug(?:ust)?|oct(?:ober)?|dec(?:ember)?)"
    mid_names, feb_name = "(?:apr(?:il)?|june?|sept?(?:ember)?|nov(?:ember)?)", "feb(?:ruary)?"
    sign, gap = "[-/. ]", "(?:[-/. ]|, ?)"

    def days_of(months: tuple[str, str, str], join) -> tuple[str, str]:
        """Month and day in the order of ``join``: in any year, and in leap years only."""
        long, mid, feb = months
        return _any(join(long, all_days), join(mid, most_days), join(feb, short_days)), join(feb, "29")

    numbers, names = (long_months, mid_months, february), (long_names, mid_names, feb_name)
    month_day, leap_month_day = days_of(numbers, lambda m, d: m + sign + d)
    day_month, leap_day_month = days_of(numbers, lambda m, d: d + sign + m)
    day_name, leap_day_name = days_of(names, lambda m, d: d + sign + m)
    name_day, leap_name_day = days_of(names, lambda m, d: m + sign + d)
    compact = days_of(("(?:0[13578]|1[02])", "(?:0[469]|11)", "02"), lambda m, d: m + d.replace("0?", "0"))
    forms = [
        year4 + sign + month_day, leap4 + sign + leap_month_day,
        month_day + sign + year, leap_month_day + sign + leap,
        day_month + sign + year, leap_day_month + sign + leap,
        year4 + compact[0], leap4 + compact[1],
        day_name + gap + year, leap_day_name + gap + leap,
        name_day + gap + year4, leap_name_day + gap + leap4,
        year4, year4 + "[-/](?:0?[1-9]|1[0-2])", _any(*names) + gap + year4,
    ]
    weekday = "(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,? )?"
    clock = r"(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d+)?)?(?: ?[ap]m)?"
    return f"(?i)^{weekday}{_any(*forms)}(?:[T ]{clock}(?: ?(?:Z|UTC|[+-][01]\\d:?[0-5]\\d))?)?$"


DATE_REGEX = date_regex()


def is_date(c: Column) -> Column:
    """True for null cells, for text that ``DATE_REGEX`` recognises and for other written dates.

    The expression settles nearly all exported dates at once; what it does not know is read token by token.
    """
    return F.when(c.isNull() | c.rlike(DATE_REGEX), F.lit(True)).otherwise(is_written_date(c))
