"""Hash keys and hash-diffs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text that stands for NULL in a hash-diff. A backslash in data is doubled, so no
#: stored string can look like it.
NULL_MARK = r"\N"


def hash_key(*names: str) -> Column:
    """MD5 over the business keys' text, joined by ``|``.

    Dates read ``yyyy-MM-dd`` and zone-free timestamps ``yyyy-MM-dd HH:mm:ss``, so
    the key is the same in every session time zone. Keys must be non-null: run
    the key gate first.
    """
    return F.md5(F.concat_ws("|", *[F.col(n).cast("string") for n in names]))


def short_digest(name: str | Column) -> Column:
    """An MD5 text's 16 bytes, for moves; what is no hexadecimal text stays as it is."""
    digest = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.unhex(digest), digest.cast("binary"))


def stable_text(name: str, dtype: T.DataType) -> Column:
    """One text per value, different for different values; NULL gets its own mark.

    A number's text is its shortest exact form. Adding 0.0 makes -0.0 and 0.0 one value.
    """
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = (c + F.lit(0.0).cast(dtype)).cast("string")
    elif isinstance(dtype, T.StringType):
        text = F.regexp_replace(c, r"([\\|])", r"\\$1")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def hash_diff(schema: T.StructType, names: Iterable[str]) -> Column:
    """Change-detection hash over ``names``; never NULL, never ambiguous."""
    return F.md5(F.concat_ws("|", *[stable_text(n, schema[n].dataType) for n in names]))


def hash_diff_json(names: Iterable[str]) -> Column:
    """Change-detection hash over the JSON form of the attributes."""
    return F.md5(F.to_json(F.struct(*names)))
