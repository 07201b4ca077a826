"""Text-to-typed expressions for raw fields, as SQL text.

Each helper takes the name of a text column and returns an expression for
``selectExpr`` or ``F.expr``; wide projections are then built in one call. Text
that cannot be read becomes NULL; nothing here raises.
"""

from __future__ import annotations

MONEY = "decimal(18,2)"
RATE = "decimal(9,3)"

# Java's `$` also matches before a trailing line feed, hence \A and \z.
TWO_DIGITS = r"\A[0-9]{2}\z"
YEAR_MONTH = r"\A(?!0000)[0-9]{6}\z"


def text(field: str) -> str:
    """Blank text becomes NULL."""
    return f"nullif({field}, '')"


def month(field: str) -> str:
    """``yyyyMM`` (exactly six digits) as the first day of that month."""
    # A cast from "yyyy-MM" costs a fraction of a parse by format pattern.
    dashed = f"concat(left({field}, 4), '-', right({field}, 2))"
    return f"if({field} RLIKE r'{YEAR_MONTH}', try_cast({dashed} AS date), NULL)"


def number(field: str, type_name: str) -> str:
    """Decimal text in the given decimal type."""
    # Text that is no number costs an exception in a cast to decimal, and most amounts are blank.
    return f"try_cast({text(field)} AS {type_name})"


def whole(field: str, type_name: str = "smallint") -> str:
    """Integer text; a fractional literal is rounded half away from zero."""
    rounded = f"round({number(field, 'decimal(38,6)')})"
    return f"coalesce(try_cast({field} AS {type_name}), try_cast({rounded} AS {type_name}))"


def whole_unless(field: str, missing_code: str) -> str:
    """Integer text in which one code stands for "not available"."""
    return f"if({field} <> '{missing_code}', {whole(field)}, NULL)"


def missing_reason(field: str, missing_code: str) -> str:
    """Why a coded value is absent: by code, by blank, or NULL if present."""
    by_code = f"if({field} = '{missing_code}', 'NOT_AVAILABLE', NULL)"
    return f"if(coalesce({field}, '') = '', 'BLANK', {by_code})"


def two_digit_number(field: str) -> str:
    """Value of a text that is exactly two digits."""
    return f"if({field} RLIKE r'{TWO_DIGITS}', try_cast({field} AS smallint), NULL)"


def is_valid_month(field: str) -> str:
    """True or false, never NULL: six digits that name a calendar month."""
    return f"({month(field)}) IS NOT NULL"


# Decimal digits with optional sign, point and exponent, or infinity and not-a-number
# by name; white space around it and single underscores between digits do not matter.
_DIGITS = "[0-9](_?[0-9])*"
NUMBER = (
    rf"(?i)\A\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan)\s*\z"
)


def is_number(field: str) -> str:
    """True or false, never NULL: non-blank text that spells a number.

    A cast would not do: it also reads suffixes such as ``5F`` and hexadecimal forms.
    """
    return f"coalesce({field} RLIKE r'{NUMBER}', false)"
