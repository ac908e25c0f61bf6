"""Parsing and rendering of event text (PRJ-1, PRJ-5, PRJ-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as blanks at either end of a text (ASCII blanks and
# separators, next line, no-break space, and the Unicode space characters), the key of a
# message that cannot be parsed, the separator of a message and the form of an integer, around
# which the separators among the blanks are not allowed.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
INTEGER_BLANKS = "".join(c for c in BLANKS if not "\x1c" <= c <= "\x1f")
UNKNOWN_KEY = "unknown"
SEPARATOR = ":"
INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"


def strip(text: Column) -> Column:
    """Remove blanks, Unicode ones included, from both ends; plain ``trim`` knows spaces only."""
    return F.btrim(text, F.lit(BLANKS))


def event_key(message: Column) -> Column:
    """Key of a message: the stripped text before the first separator, or all of it (PRJ-1).

    Nearly every key begins and ends with a visible ASCII character, which comparing its
    first and last byte tells at a fraction of the cost of stripping it.
    """
    key = F.substring_index(message, SEPARATOR, 1)
    last_byte = F.substring(key.cast("binary"), -1, 1)
    clean = key.between("!", "\x7f") & last_byte.between(F.lit(b"!"), F.lit(b"~"))
    return F.coalesce(F.when(clean, key).otherwise(strip(key)), F.lit(UNKNOWN_KEY))


def event_sequence(message: Column) -> Column:
    """Sequence number after the first separator; null where there is none."""
    at = F.instr(message, SEPARATOR)
    return F.when(at > 0, to_integer(F.substr(message, at + F.lit(1))))


def to_integer(text: Column) -> Column:
    """Integer value of a text, null if it is not an integer of 64 bits."""
    bare = F.btrim(text, F.lit(INTEGER_BLANKS))
    return F.when(bare.rlike(INTEGER), F.replace(bare, F.lit("_"), F.lit("")).try_cast("bigint"))


def render_line(*columns: Column, sep: str = "\t") -> Column:
    """One text line of several columns; nulls become empty fields (PRJ-5)."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def escaped_line(*columns: Column, sep: str = ",") -> Column:
    """One text line from which each column's text can be told, for digests of any table.

    A null is ``\\N``; backslashes and separators inside a value get a backslash in front.
    """
    def field(c: Column) -> Column:
        text = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))
        return F.coalesce(text, F.lit("\\N"))

    return F.concat_ws(sep, *map(field, columns))


def escaped_row(rows: DataFrame, names: Sequence[str] | None = None, sep: str = ",") -> Column:
    """``escaped_line`` of columns of a table; numbers and times have nothing to escape."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

    def field(name: str) -> Column:
        if isinstance(rows.schema[name].dataType, plain):
            return F.coalesce(F.col(name).cast("string"), F.lit("\\N"))
        return escaped_line(F.col(name), sep=sep)

    return F.concat_ws(sep, *map(field, names or rows.columns))


def message(key: Column, sequence: Column) -> Column:
    """The message form of an event: ``key:sequence``."""
    return F.concat(key, F.lit(SEPARATOR), sequence.cast("string"))


def scenario_id(text: Column) -> Column:
    """Numeric ids are padded to two digits, any other id is left as it is (PRJ-6)."""
    bare = F.regexp_replace(text, "^0+(?=[0-9])", "")
    return F.when(text.rlike("^[0-9]+$"), F.when(F.length(bare) < 2, F.lpad(bare, 2, "0")).otherwise(bare)).otherwise(text)
