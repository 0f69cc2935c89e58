"""Text expressions. All stay in the JVM except Unicode NFKC."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: every character that counts as whitespace. Java's \s is ASCII only.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Fixed value: control characters replaced by a space when queries are normalised.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.trim(_c(col), F.lit(SPACES))


def strip_or_empty(col: Column | str) -> Column:
    return strip(F.coalesce(_c(col), F.lit("")))


def words(col: Column | str) -> Column:
    """Whitespace tokens; an empty text has none.

    A one-character separator splits without a regular expression, which is
    several times faster than a class of all whitespace characters.
    """
    spaced = F.translate(_c(col), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def full_text(title: Column | str = "title", text: Column | str = "text") -> Column:
    """``title + ' ' + text`` where a title exists, else ``text``."""
    title = _c(title)
    return F.concat_ws(" ", F.when(title != "", title), _c(text))


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def normalize_query(col: Column | str) -> Column:
    """NFKC, lower case, control characters to spaces, single spaces, stripped.

    Pure ASCII text is its own NFKC form, so only other rows carry a value into
    the Python worker; the rest of the chain is native.
    """
    col = F.coalesce(_c(col), F.lit(""))
    ascii_only = col.rlike(r"\A\p{ASCII}*\z")
    folded = F.coalesce(_nfkc(F.when(~ascii_only, col)), col)
    spaced = F.regexp_replace(F.lower(folded), CONTROL, " ")
    return strip(F.regexp_replace(spaced, f"{WS}+", " "))


def strip_chunk_suffix(col: Column | str) -> Column:
    """``x__chunkN`` to ``x``, cutting at the last ``__chunk``."""
    return F.regexp_replace(_c(col), r"(?s)\A(.*)__chunk.*\z", "$1")


def preview(col: Column | str, width: int) -> Column:
    """One line of at most ``width`` characters, with an ellipsis when cut."""
    col = _c(col)
    line = F.translate(F.substring(col, 1, width), "\n", " ")
    return F.when(F.length(col) > width, F.concat(line, F.lit("…"))).otherwise(line)


def sentences(col: Column | str, min_len: int = 25) -> Column:
    """Array of sentences: cut after ``.``, ``!`` or ``?`` plus whitespace."""
    marked = F.regexp_replace(_c(col), rf"([.!?]){WS}+", "$1\u0001")
    parts = F.transform(F.split(marked, "\u0001"), strip)
    return F.filter(parts, lambda s: F.length(s) >= min_len)


def md5_of(*parts: Column | str | int) -> Column:
    """md5 hex of the parts joined by ``|``; strings here are column names."""
    cols = [F.lit(p) if isinstance(p, int) else _c(p) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def hex_int(md5_hex: Column, start: int, length: int = 8) -> Column:
    """Integer value of a slice of a hex string (1-based start)."""
    return F.conv(F.substring(md5_hex, start, length), 16, 10).cast("long")


def md5_mod10(col: Column | str) -> Column:
    """``int(md5(x), 16) % 10`` without big integers: 2**32 is 6 modulo 10."""
    h = F.md5(_c(col))
    high = hex_int(h, 1) + hex_int(h, 9) + hex_int(h, 17)
    return (high * 6 + hex_int(h, 25)) % 10


def is_train_query(col: Column | str) -> Column:
    return md5_mod10(col) < 7
