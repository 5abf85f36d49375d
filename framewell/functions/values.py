"""Missing values, lenient casts, dates and small formulas (F01-F13, F30 of the survey).

NULL stands for "not available". NaN and the infinities are turned into NULL before any aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that count as empty in text tables. "nan" is a number here, not empty.
EMPTY_LIKE = ("", "none", "null", "na", "n/a", "-", "—")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite(x: Column | str) -> Column:
    """x as a double, NULL unless it is a finite number."""
    d = _c(x).cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def empty_like(x: Column | str) -> Column:
    return _c(x).isNull() | F.lower(F.trim(_c(x))).isin(*EMPTY_LIKE)


def lenient_double(x: Column | str) -> Column:
    """Text to a double: spaces out, comma as point, empty tokens and junk NULL; nan and inf are read as such."""
    return F.when(~empty_like(x), F.replace(F.replace(F.trim(_c(x)), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"))


def lenient_finite(x: Column | str) -> Column:
    """As lenient_double, non-finite values NULL (the training-matrix reading)."""
    return finite(lenient_double(x))


def lenient_bigint(x: Column | str) -> Column:
    """Text to an integer; a fraction is no integer."""
    t = F.trim(_c(x))
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))


def truncated_bigint(x: Column | str) -> Column:
    """A number to an integer towards zero (F08, numeric path)."""
    return finite(x).cast("bigint")


def parse_stamp(x: Column | str) -> Column:
    """Y_m_d_H_M with or without seconds, UTC."""
    return F.coalesce(F.try_to_timestamp(_c(x), F.lit("yyyy_MM_dd_HH_mm_ss")), F.try_to_timestamp(_c(x), F.lit("yyyy_MM_dd_HH_mm")))


def parse_iso(x: Column | str) -> Column:
    """ISO-8601 with Z, an offset or none (UTC)."""
    return F.try_to_timestamp(_c(x))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))) / F.lit(1e6)


def age_hours(later: Column | str, earlier: Column | str, clip: bool = True) -> Column:
    """Hours between two times, not below 0 if clip (F11: both readings exist)."""
    h = seconds_between(later, earlier) / 3600
    return F.when(h.isNotNull(), F.greatest(h, F.lit(0.0))) if clip else h


def log1p_delta(later: Column | str, first: Column | str, integers: bool = False) -> Column:
    """ln(1 + growth, at least 0); NULL unless both are finite (F01). With integers both are cut to whole numbers first (V1)."""
    h, z = finite(later), finite(first)
    if integers:
        h, z = h.cast("bigint").cast("double"), z.cast("bigint").cast("double")
    return F.when(h.isNotNull() & z.isNotNull(), F.log1p(F.greatest(h - z, F.lit(0.0))))


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b where b > 0, else NULL."""
    return F.when(_c(b) > 0, _c(a).cast("double") / _c(b))


def close(a: Column | str, b: Column | str, absolute: float = 1e-5, relative: float = 1e-4) -> Column:
    """|a - b| within absolute + relative * |b|."""
    return F.abs(_c(a) - _c(b)) <= F.lit(absolute) + F.lit(relative) * F.abs(_c(b))


def first_truthy(*columns: Column | str) -> Column:
    """The first value that is neither NULL, 0 nor empty."""
    out = []
    for x in columns:
        c = _c(x)
        text = c.cast("string")
        out.append(F.when(text.isNotNull() & ~text.isin("", "0", "0.0", "false"), c))
    return F.coalesce(*out)


def sha_slot(key: Column | str, slots: int) -> Column:
    """First eight bytes of SHA-256 modulo slots."""
    return (F.conv(F.substring(F.sha2(_c(key), 256), 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(slots)).cast("bigint")


def unit_hash(key: Column | str) -> Column:
    """First eight bytes of SHA-256 as a share of 2**64."""
    return F.conv(F.substring(F.sha2(_c(key), 256), 1, 16), 16, 10).cast("double") / F.lit(2.0**64)


def channel_key(channel_id: Column | str, title: Column | str, video_id: Column | str) -> Column:
    """The channel id, else a hash of its title, else the video."""
    return F.coalesce(
        F.nullif(F.trim(_c(channel_id)), F.lit("")),
        F.concat(F.lit("ch_"), F.substring(F.sha1(F.nullif(F.trim(_c(title)), F.lit(""))), 1, 12)),
        F.concat(F.lit("vid_"), _c(video_id)),
    )


def softmax_over(score: Column, window, temperature: float = 1.0) -> Column:
    """Softmax within a window, shifted by its maximum."""
    z = score / F.lit(temperature)
    e = F.exp(z - F.max(z).over(window))
    return e / F.sum(e).over(window)
