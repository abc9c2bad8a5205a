"""Account codes embedded in account names, and name clean-up for grouping keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def code_inside(c: Column, opening: str, closing: str) -> Column:
    """The code between the delimiters; null when the opening delimiter does not occur.

    Text with a dash yields what follows the last dash. Otherwise the pieces between opening delimiters
    are searched from the right for a numeric one; without any, the leftmost piece is returned.
    """
    pieces = F.transform(
        F.reverse(F.split(c, _literal(opening), -1)),
        lambda piece: F.replace(piece, F.lit(closing), F.lit("")) if closing else piece,
    )
    ranked = F.transform(
        pieces,
        lambda piece, i: F.when(
            F.when(i == 0, piece.rlike("^[0-9]+$")).otherwise(piece.rlike(r"^\s*[0-9]+\s*$")), piece
        ),
    )
    numeric = F.get(F.array_compact(ranked), F.lit(0))
    scanned = F.coalesce(numeric, F.element_at(pieces, -1))
    after_dash = F.element_at(F.split(c, "-", -1), -1)
    return F.when(c.contains(opening), F.when(c.contains("-"), after_dash).otherwise(scanned))


def code_outside(c: Column, opening: str, closing: str) -> Column:
    """The text without its code; null when the opening delimiter does not occur.

    Text with a dash loses its last piece. Otherwise the first delimited group is removed, provided it
    holds nothing but digits.
    """
    pieces = F.split(c, _literal(opening), -1)
    before_last = F.array_join(F.slice(pieces, F.lit(1), F.size(pieces) - 1), "")
    if opening == closing:
        removed = F.lit(opening)
    else:
        o, e = re.escape(opening), re.escape(closing)
        group = f"^[^{o}{e}]*({o}[^{e}]*{e}?)" if closing else f"^[^{o}]*({o}.*)"
        removed = F.regexp_replace(F.regexp_extract(c, group, 1), f"[^0-9{o}{e}]", "")
    without = F.replace(c, removed, F.lit(""))
    return F.when(c.contains(opening), F.when(c.contains("-"), before_last).otherwise(without))


def numeric_pieces(c: Column, opening: str) -> Column:
    """All numeric pieces of a dashed text, trimmed; null when the delimiter or a dash is missing."""
    pieces = F.transform(F.split(c, _literal(opening), -1), lambda piece: F.trim(piece))
    found = F.filter(pieces, lambda piece: piece.rlike("^[0-9]+$"))
    return F.when(c.contains(opening) & c.contains("-"), found)


def trimmed_account_name(c: Column) -> Column:
    """Account name without surrounding blanks and without one leading dash."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), "^-( )?", "")
