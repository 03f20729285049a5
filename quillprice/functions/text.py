"""String helpers with T-SQL meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the five characters the reference strips from part numbers.
PART_NUMBER_PUNCTUATION = " -\\/."


def clean_part_number(c: Column) -> Column:
    """Strip blank, '-', '\\', '/', '.' in one pass (five nested REPLACEs)."""
    return F.translate(c, PART_NUMBER_PUNCTUATION, "")


def sql_trim(c: Column) -> Column:
    """LTRIM(RTRIM(c)); both engines strip U+0020 only."""
    return F.trim(c)


def sql_len(c: Column) -> Column:
    """LEN(c): length without trailing blanks."""
    return F.length(F.rtrim(c))




def strip_prefix(c: Column, n: int = 3) -> Column:
    """RIGHT(c, LEN(c) - n): drop the first n characters (J12 key)."""
    return F.right(c, sql_len(c) - F.lit(n))


def not_blank(c: Column) -> Column:
    """c <> '' with T-SQL's padded comparison: blanks-only equals ''."""
    return F.rtrim(c) != F.lit("")




# Characters that T-SQL converts to the integer 0 when a one-character string
# is compared with a number; digits 1-9 compare as non-zero.
_ZERO_LIKE = ("0", " ", "", "+", "-")
_NONZERO_DIGITS = tuple("123456789")


def item_code_parts(item: Column):
    """Split an ERP item code into (brand, base part, valid) (F14, SURVEY Q4).

    Brand is the first three characters (left-trimmed); a fourth character
    that counts as numeric zero is a filler and is skipped. Any other
    non-digit would make T-SQL's comparison fail: such rows are invalid.
    """
    brand = F.ltrim(F.substring(item, 1, 3))
    fourth = F.substring(item, 4, 1)
    base = (F.when(fourth.isin(*_ZERO_LIKE), F.rtrim(F.substring(item, 5, 25)))
            .when(fourth.isin(*_NONZERO_DIGITS), F.rtrim(F.substring(item, 4, 25))))
    valid = fourth.isin(*(_ZERO_LIKE + _NONZERO_DIGITS))
    return brand, base, valid


def tag(open_: bool, name: Column) -> Column:
    """'<' + name + '>' or '</' + name + '>' (NULL name gives NULL)."""
    return F.concat(F.lit("<" if open_ else "</"), name, F.lit(">"))
