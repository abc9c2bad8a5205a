"""Numbers written the way ledgers are exported: currency signs, commas, parentheses for negatives."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

def parse_number(c: Column) -> Column:
    """Double value of a text cell; null when the cell is null or not a number.

    Digits are taken as they are. Other purely alphanumeric text is no number. From anything else the
    characters ``0-9 . -`` are kept, and a pair of parentheses anywhere flips the sign.
    """
    sign = F.when(c.contains("(") & c.contains(")"), F.lit(-1.0)).otherwise(F.lit(1.0))
    kept = F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")
    return (
        F.when(c.rlike("^[0-9]+$"), c.try_cast("double"))
        .when(c.rlike("^[a-zA-Z0-9]+$"), F.lit(None).cast("double"))
        .otherwise(kept * sign)
    )


def is_number(c: Column) -> Column:
    """Null cells count as valid numbers."""
    return c.isNull() | parse_number(c).isNotNull()


# Parts in which amounts are added: units below it, and above it for amounts beyond 28 digits.
_LOW, _HIGH = "100000000000000", "1000000000000000000000000"
# The same for doubles, by magnitude: whole numbers of the unit of their band.
_MIDDLE, _TOP = 1e22, 1e30
_MIDDLE_UNIT, _TOP_UNIT = 4, 12
# Sums from here on do not fit ``decimal(38,8)``.
_MOST = 1e29


def _amount_parts(c: Column) -> dict[str, Column]:
    """Amounts in decimal parts of at most 24 digits, so that sums of any number of rows stay within 38.

    An amount counts as written, to ten places; from 1e28 on, where a double holds no places, to the unit.
    """
    # Nearly all amounts are small and need no division.
    small = F.abs(c.try_cast("double")) < float(_LOW)
    plain, wide = c.try_cast("decimal(38,10)"), c.try_cast("decimal(38,0)")
    low, high = F.lit(_LOW).cast("decimal(15,0)"), F.lit(_HIGH).cast("decimal(25,0)")
    beyond = F.when(~small & plain.isNull(), wide)

    def over(value: Column, unit: Column) -> Column:
        return F.call_function("div", value, unit).cast("decimal(28,0)")

    return {
        "rest": F.when(small, c.try_cast("decimal(28,10)")).otherwise((plain % low).cast("decimal(28,10)")),
        "lows": F.when(~small, over(plain, low)),
        "wide_rest": (beyond % high).cast("decimal(28,0)"),
        "highs": over(beyond, high),
    }


def _double_parts(c: Column) -> dict[str, Column]:
    """The same for doubles. None is written with more than 18 digits, so each fits one band of eight powers of ten as it
    is, in at most 26 digits: one cast a cell that never fails, and no division.
    """
    value = c.try_cast("double")
    size = F.abs(value)

    def over(kind: str, places: int) -> Column:
        unit = F.lit(Decimal(1).scaleb(-places))
        return (value.try_cast(kind) * unit).cast("decimal(26,0)")

    return {
        "rest": F.when(size < float(_LOW), value.try_cast("decimal(28,10)")),
        "large": F.when((size >= float(_LOW)) & (size < _MIDDLE), value.try_cast("decimal(26,4)")),
        "middle": F.when((size >= _MIDDLE) & (size < _TOP), over("decimal(30,0)", _MIDDLE_UNIT)),
        "top": F.when((size >= _TOP) & (size < 1e38), over("decimal(38,0)", _TOP_UNIT)),
    }


def _sums(parts: dict[str, Column]) -> dict[str, Column]:
    def zero(name: str) -> Column:
        return F.lit(0).cast({"rest": "decimal(38,10)", "large": "decimal(36,4)"}.get(name, "decimal(38,0)"))

    return {name: F.coalesce(F.sum(part), zero(name)) for name, part in parts.items()}


def _of_units(value: Column, places: int) -> Column:
    """Units of a band as a decimal, null where it does not fit."""
    return F.try_multiply(value, F.lit(10**places).cast(f"decimal({places + 1},0)"))


def _as_double(value: Column, places: int) -> Column:
    """Units of a band, taken apart at the upper unit as the parts of other types are."""
    step = len(_HIGH) - 1 - places
    below = value % F.lit(str(10**step)).cast(f"decimal({step + 1},0)")
    highs = (value - below) * F.lit(f"1E-{step}").cast(f"decimal({step},{step})")
    return highs.cast("double") * float(_HIGH) + below.cast("double") * float(10**places)


def _by_type(c: Column, doubles: Column, others: Column) -> Column:
    """Settled while the query is planned."""
    return F.when(F.typeof(F.max(c)) == "double", doubles).otherwise(others)


def money_sum(c: Column) -> Column:
    """Sum of amounts as ``decimal(38,8)``, null from 1e29 on, where only ``money_total`` gives it.

    Every amount counts as it is written, to ten places, so the sum depends neither on row order nor on retries, and
    huge amounts cancel exactly. Null and NaN cells count as nothing, and so do cells that ``uncounted_amounts`` counts;
    an empty column sums to zero.
    """

    def with_rest(whole: Column, rest: Column) -> Column:
        fitting = whole.try_cast("decimal(37,8)")
        return F.when(F.abs(fitting) < _MOST, fitting + rest.cast("decimal(37,8)"))

    doubles, others = _sums(_double_parts(c)), _sums(_amount_parts(c))
    wide = F.try_add(_of_units(doubles["middle"], _MIDDLE_UNIT), _of_units(doubles["top"], _TOP_UNIT))
    whole = F.try_add(
        F.try_add(F.try_multiply(others["lows"], F.lit(_LOW).cast("decimal(15,0)")), others["wide_rest"]),
        F.try_multiply(others["highs"], F.lit(_HIGH).cast("decimal(25,0)")),
    )
    held = F.try_add(doubles["large"], wide)
    # What lies below the unit of 1e14 is rounded together with the rest.
    below = held % F.lit(_LOW).cast("decimal(15,0)")
    rest = doubles["rest"].cast("decimal(37,10)") + below.cast("decimal(24,10)")
    return _by_type(c, with_rest(F.try_subtract(held, below), rest), with_rest(whole, others["rest"]))


def money_total(c: Column) -> Column:
    """The same sum as a double, of any size."""
    doubles, others = _sums(_double_parts(c)), _sums(_amount_parts(c))
    middle, top = doubles["middle"], doubles["top"]
    wide = F.try_add(_of_units(middle, _MIDDLE_UNIT), _of_units(top, _TOP_UNIT))
    beyond = F.coalesce(_as_double(wide, 0), _as_double(middle, _MIDDLE_UNIT) + _as_double(top, _TOP_UNIT))
    of_doubles = beyond + doubles["large"].cast("double") + doubles["rest"].cast("double")
    plain = {name: total.cast("double") for name, total in others.items()}
    of_others = plain["highs"] * float(_HIGH) + plain["lows"] * float(_LOW) + plain["wide_rest"] + plain["rest"]
    return _by_type(c, of_doubles, of_others)


def uncounted_amounts(c: Column) -> Column:
    """Number of cells that no sum holds: infinite, of 1e38 and more, or no number. Null and NaN cells are none."""
    value = c.try_cast("double")
    odd = F.when(F.typeof(c) == "double", F.abs(value) >= 1e38).otherwise(c.try_cast("decimal(38,0)").isNull())
    return F.count_if(c.isNotNull() & odd & ~F.coalesce(F.isnan(value), F.lit(False)))


def round_binary(c: Column, places: int = 4) -> Column:
    """Rounds a double half to even, judging ties by its exact binary value rather than its printed form.

    The value is split into two halves whose products with the power of ten are exact, so the sign of the
    distance to the tie is exact too. Doubles too large to hold decimals are returned as they are.
    """
    scale = float(10**places)
    shifted = c * 134217729.0
    high = shifted - (shifted - c)
    low = c - high
    whole = F.floor(high * scale + low * scale).cast("double")
    beyond_tie = (high * scale - whole - 0.5) + low * scale
    up = (beyond_tie > 0) | ((beyond_tie == 0) & (F.pmod(whole, F.lit(2.0)) == 1))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when(F.abs(c) < 2.0**53 / scale, rounded).otherwise(c)
