"""Text repair without leaving the JVM.

Song and artist names reach us as UTF-8 bytes that were read as Latin-1 and,
partly, written as backslash escapes. The repair undoes both and is total:
text it cannot repair passes unchanged instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values: the escape forms and what the short ones stand for ------
ESCAPE_TOKENS = (
    r"""(?s)(\\[0-7]{1,3}|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}"""
    r"""|\\[abfnrtv\\"'""" + "\n" + r"""]|[^\\]+|\\)"""
)
SHORT_ESCAPES = {
    "\\a": "\x07", "\\b": "\b", "\\f": "\f", "\\n": "\n", "\\r": "\r", "\\t": "\t",
    "\\v": "\x0b", "\\\\": "\\", '\\"': '"', "\\'": "'", "\\\n": "",
}
# Characters an encoding can hold.
REACH = {"ISO-8859-1": r"\A[\x00-\xFF]*\z", "US-ASCII": r"\A[\x00-\x7F]*\z"}
WHOLE_ESCAPES = r"""(?s)\\([0-3][0-7]{0,2}|[4-7][0-7]?(?![0-7])|x[0-9a-fA-F]{2}|u00[0-9a-fA-F]{2}|U000000[0-9a-fA-F]{2}|[^xuUN0-7])"""
BROKEN_ESCAPE = r"\\"
# ---------------------------------------------------------------------------


def _unescape_token(token: Column) -> Column:
    """One token: a short escape, a numeric escape below 256, or plain text."""
    short = F.create_map(*[F.lit(x) for pair in SHORT_ESCAPES.items() for x in pair])
    kind = F.substring(token, 2, 1)
    octal = F.conv(F.substring(token, 2, 3), 8, 10).cast("int")
    hexa = F.conv(F.substring(token, 3, 8), 16, 10).cast("bigint")
    char = lambda code: F.when(code < 256, F.char(code)).otherwise(token)
    return (
        F.when(~F.startswith(token, F.lit("\\")) | (F.length(token) == 1), token)
        .when(kind.between("0", "7"), char(octal))
        .when(kind.isin("x", "u", "U"), char(hexa))
        .otherwise(F.coalesce(short[token], token))
    )


def unescape(c: Column) -> Column:
    tokens = F.regexp_extract_all(c, F.lit(ESCAPE_TOKENS), F.lit(1))
    decoded = F.array_join(F.transform(tokens, _unescape_token), "")
    # Most names hold no backslash; they skip the tokens altogether.
    return F.when(F.contains(c, F.lit("\\")), decoded).otherwise(c)


def encoded(c: Column, encoding: str = "ISO-8859-1") -> Column:
    """Read the characters of an encoding back as the UTF-8 bytes they were; null where that fails."""
    wide = F.encode(F.when(c.rlike(REACH[encoding]), c), encoding)
    return F.try_validate_utf8(wide.cast("string"))


def repair_text(c: str | Column, encoding: str = "ISO-8859-1") -> Column:
    """Unescape, re-read as UTF-8, strip outer double quotes: all of it or nothing.

    Text with a character beyond ``encoding``, a broken escape, or bytes that
    are no UTF-8 comes back as it is.
    """
    column = F.col(c) if isinstance(c, str) else c
    # An escape is broken where no token but a lone backslash matches it, or x, u, U, N have no value.
    sound = ~F.regexp_replace(column, WHOLE_ESCAPES, "").rlike(BROKEN_ESCAPE)
    plain = ~F.contains(column, F.lit("\\"))
    # Characters beyond the encoding survive the unescaping, and fail there.
    text = F.when(plain | sound, encoded(unescape(column), encoding))
    return F.when(text.isNotNull(), F.btrim(text, F.lit('"'))).otherwise(column)
