"""Column expressions over texts. White space is the six ASCII characters everywhere."""

from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: The place after a word's last character, unless the text ends there.
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text):
    """The text; empty for null."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text):
    """The runs of characters that aren't white space, as an array; empty for null."""
    return F.array_remove(F.split(whole(text), SPACE_RUN), "")


def ascii_lower(column):
    """A to Z in lower case, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def same(left, right):
    """Equality that holds for two nulls too; Spark still joins it by key."""
    return left.eqNullSafe(right)
