"""JVM string rules as Column expressions.

The reference splits and trims with ``java.lang.String`` methods, which differ
from Spark SQL's ``split`` and ``trim``. These helpers rebuild the JVM rules
from built-in functions so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

# Fixed value: String.trim removes every char up to U+0020 at both ends.
_JVM_BLANKS = "".join(map(chr, range(0x21)))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_regex(separator: str) -> str:
    """Regex matching ``separator`` literally."""
    return re.escape(separator)


def char_class(chars) -> str:
    """Regex matching any one of ``chars`` (Java ``split(Array[Char])``)."""
    return "[" + "".join(re.escape(c) for c in chars) + "]"


def _drop_trailing_empty(pieces: Column) -> Column:
    """``pieces`` up to its last non-empty string."""
    def cut(found: Column) -> Column:
        from_end = F.array_position(F.reverse(F.transform(found, lambda p: p != "")), True)
        return (F.when(F.element_at(found, -1) != "", found)
                .when(from_end == 0, F.array().cast("array<string>"))
                .otherwise(F.slice(found, F.lit(1), (F.size(found) - from_end + 1).cast("int"))))

    # The one-element array binds the pieces, so that they are split once.
    return F.transform(F.array(pieces), cut)[0]


def java_split(c, pattern: str = " ") -> Column:
    """``String.split(pattern)`` with the JVM's limit-0 rule.

    Leading and inner empty strings are kept, trailing ones are dropped; an
    empty input gives ``[""]``; an input made only of separators gives ``[]``.
    ``pattern`` is a regex (use ``literal_regex`` for plain text). Linear in
    the text, however long a run of separators is.
    """
    s = _col(c)
    return F.when(s == "", F.array(F.lit(""))).otherwise(
        F.when(s.isNotNull(), _drop_trailing_empty(F.split(s, pattern, -1))))


def split_quoted(c) -> Column:
    """Split a CSV line on commas outside double quotes; quotes stay in the
    field, trailing empty fields are dropped. A comma is outside where an even
    number of quotes follows. Linear: the line is cut at its quotes, and the
    commas of the outer pieces become a marker that the text cannot hold."""
    s = _col(c)
    safe = F.replace(s, F.lit("\x01"), F.lit("\x01\x02"))
    pieces = F.split(safe, '"', -1)

    def mark(found: Column) -> Column:
        last = F.size(found) - 1
        return F.array_join(F.transform(found, lambda p, i: F.when(
            (last - i) % 2 == 0, F.replace(p, F.lit(","), F.lit("\x01\x03"))).otherwise(p)), '"')

    marked = F.transform(F.array(pieces), mark)[0]
    fields = F.transform(java_split(marked, "\x01\x03"),
                         lambda f: F.replace(f, F.lit("\x01\x02"), F.lit("\x01")))
    return F.when(s.isNotNull(), fields)


def split_head(c, pattern: str) -> Column:
    """First piece of ``String.split(pattern)(0)``."""
    return java_split(c, pattern)[0]


def jvm_trim(c) -> Column:
    """``String.trim``: strips spaces, tabs, newlines and control chars."""
    return F.btrim(_col(c), F.lit(_JVM_BLANKS))


def parse_double(c) -> Column:
    """String to double; a bad number gives NULL instead of failing the job."""
    return _col(c).try_cast("double")


def round_to_float(c, digits: int = 4) -> Column:
    """Round half-up to ``digits`` decimals, then narrow to a 32-bit float."""
    return F.round(_col(c), digits).cast(FloatType())
