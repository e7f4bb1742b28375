"""Column expressions that rules and rule tables need beyond a plain ``F`` call."""

from pyspark.sql import functions as F


#: The whole-number types with their highest value.
_WHOLE = {"tinyint": 2**7 - 1, "smallint": 2**15 - 1, "int": 2**31 - 1, "bigint": 2**63 - 1}


def _if_it_fits(tried, exact):
    """``tried``, not even computed where ``exact``, in decimals, is outside its whole-number type.

    A try_ function raises and catches an error for each row that overflows, which takes far
    longer than the sum. Other types, as ``typeof`` knows before any row, are just tried. The
    operands are cast by way of text because a date, say, has no cast to a decimal.
    """
    kind = F.typeof(tried)
    return F.coalesce(*[
        F.when(kind == name, F.when(exact.between(F.lit(-highest - 1), F.lit(highest)), tried))
        for name, highest in _WHOLE.items()
    ], F.when(~kind.isin(*_WHOLE), tried))


def _exact(column):
    return F.col(column).cast("string").cast("decimal(19,0)")


def add(left, right, on_overflow="fail"):
    if on_overflow == "null":
        return _if_it_fits(F.try_add(left, right), _exact(left) + _exact(right))
    return F.col(left) + F.col(right)


def subtract(left, right, on_overflow="fail"):
    if on_overflow == "null":
        return _if_it_fits(F.try_subtract(left, right), _exact(left) - _exact(right))
    return F.col(left) - F.col(right)


def multiply(left, right, on_overflow="fail"):
    if on_overflow == "null":
        return _if_it_fits(F.try_multiply(left, right), _exact(left) * _exact(right))
    return F.col(left) * F.col(right)


def text_or_empty(name):
    """A column as text, with an empty text for NULL."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def date_text(column):
    return F.date_format(column, "yyyy-MM-dd")


def text_date(column, pattern="yyyyMMdd"):
    return F.to_date(column, pattern)
