"""Surrogate keys.

One builder serves dimensions and fact, so both sides of a join always agree.
md5 is the default: a 32-bit hash already collides near 77 000 keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from listenhouse.schemas import ARTIST_KEY, LOCATION_KEY, SONG_KEY


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(columns: Iterable[str | Column], algo: str = "md5") -> Column:
    """Key over ``columns``.

    ``md5``       text of every part joined by '-', a null part counts as '';
    ``exact``     like md5, but different parts never give the same text: each
                  part has its length before it, and null differs from '';
    ``xxhash64``  64-bit hash of the md5 text;
    ``hash``      32-bit Murmur3 of the parts joined by '_', null parts left
                  out, widened to bigint (may collide; for parity only).
    """
    texts = [_column(c).cast("string") for c in columns]
    if algo == "hash":
        return F.hash(F.concat_ws("_", *texts)).cast("bigint")
    if algo == "exact":
        parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
        return F.md5(F.concat(*parts))
    joined = F.concat_ws("-", *[F.coalesce(t, F.lit("")) for t in texts])
    if algo == "md5":
        return F.md5(joined)
    if algo == "xxhash64":
        return F.xxhash64(joined)
    raise ValueError(f"unknown key algorithm: {algo}")


def song_key(algo: str = "md5") -> Column:
    return surrogate_key(SONG_KEY, algo)


def artist_key(algo: str = "md5") -> Column:
    return surrogate_key(ARTIST_KEY, algo)


def location_key(algo: str = "md5") -> Column:
    return surrogate_key(LOCATION_KEY, algo)


def filled_location_key() -> Column:
    """32-bit location key with nulls filled, longitude before latitude.

    Numbers are turned to text before the fill, so a missing coordinate is
    '0' whatever the ANSI mode.
    """
    words = [F.coalesce(F.col(c), F.lit("Unknown")) for c in ("city", "zip", "state")]
    numbers = [F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in ("lon", "lat")]
    return F.hash(F.concat_ws("_", *words, *numbers)).cast("bigint")
