"""Column expressions. Everything here is built from JVM-side functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a cell holding exactly one whitespace character (Unicode-aware) counts as blank.
BLANK_PATTERN = r"(?U)^\s$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null_value(c) -> Column:
    c = _col(c)
    return F.when(~c.rlike(BLANK_PATTERN), c)


def hash_text(seed, *keys) -> Column:
    """md5 of ``seed:key1:key2``; a layout-independent random order over rows."""
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash_uniform(seed, *keys) -> Column:
    """Deterministic uniform in [0, 1): first 32 bits of :func:`hash_text`."""
    return F.conv(F.substring(hash_text(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ms_to_ts(c) -> Column:
    return F.timestamp_millis(_col(c))


def ts_to_ms(c) -> Column:
    """Epoch milliseconds, microseconds cut off."""
    return F.unix_millis(_col(c).cast("timestamp"))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def run_suffix(ts) -> Column:
    return F.date_format(_col(ts), "ddMMyyyyHHmmss")


def processing_ms(start, end) -> Column:
    """Elapsed milliseconds between two timestamps."""
    return F.floor((F.unix_micros(_col(end)) - F.unix_micros(_col(start))) / F.lit(1000)).cast("long")


def processing_time_compat(start, end) -> Column:
    """Only the sub-second part of the elapsed time, in nanoseconds (kept for users of the old column)."""
    micros = F.unix_micros(_col(end)) - F.unix_micros(_col(start))
    return F.pmod(micros, F.lit(1_000_000).cast("long")) * F.lit(1000).cast("long")


def threshold_label(p, threshold: float = 0.5, tie: bool = True) -> Column:
    """Positive when ``p`` reaches the threshold; ``tie`` says whether equality counts."""
    return _col(p) >= F.lit(threshold) if tie else _col(p) > F.lit(threshold)


def label_bool(c, positive: str = "Yes") -> Column:
    return _col(c) == F.lit(positive)


def quantize(c, lo, hi, n: int = 7) -> Column:
    """Index of one of ``n`` equal bins over [lo, hi]; values outside are clamped to the end bins.

    An empty domain (lo = hi) puts a value at or above it in the last bin and one below it in the first.
    """
    c, lo, hi = _col(c), _as_col(lo), _as_col(hi)
    width = hi - lo
    raw = F.floor((c - lo) / F.when(width != 0, width) * F.lit(n)).cast("int")
    flat = F.when(c >= lo, F.lit(n - 1)).otherwise(F.lit(0))
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(n - 1), F.coalesce(raw, flat)))
    )


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def url_params(url) -> Column:
    """Decoded query parameters of a URL as a map; a URL without a query gives an empty map.

    A repeated name keeps its last value.
    """
    query = F.regexp_extract(_col(url), r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            _url_text(F.substring_index(p, "=", 1)).alias("key"),
            _url_text(F.regexp_extract(p, "=(.*)$", 1)).alias("value"),
        ),
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]),
    )
    return F.map_from_entries(last)


def _url_text(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def overlay(defaults, supplied) -> Column:
    """Map of ``defaults`` with ``supplied`` laid over it; a supplied key wins even when its value is null."""
    supplied = _col(supplied)
    kept = F.map_filter(_col(defaults), lambda k, _: ~F.map_contains_key(supplied, k))
    return F.map_concat(kept, supplied)


def valid_override(c) -> Column:
    """True when a supplied override text is a finite number."""
    v = _col(c).try_cast("double")
    return F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))


def format_summary(total, churned, remained) -> Column:
    return F.format_string("%d of %d customers churned and %d stayed", _col(churned), _col(total), _col(remained))


def short_text(c, width: int = 5) -> Column:
    """First ``width`` characters of a value's text, as shown in a table cell."""
    return F.substring(_col(c).cast("string"), 1, width)


# How the public version scheme spells and orders what may follow the numbers of a release.
VERSION_STAGES = {"dev": -4, "alpha": -3, "a": -3, "beta": -2, "b": -2, "candidate": -1, "preview": -1, "pre": -1, "rc": -1, "c": -1, "post": 1, "rev": 1, "r": 1}


def version_key(c) -> Column:
    """A version text as a value in the order of versions: 1.10 after 1.9, 1.0 equal to 1, 1.0.dev2 < 1.0a1 < 1.0b2 <
    1.0b10 < 1.0rc1 < 1.0 < 1.0.post1, and a development or post release next to the one it belongs to.

    Upper case, a leading v and the signs between parts do not matter; an epoch (``1!``) comes first, a local part
    (``+...``) last, its numbers by value and after its words. Of numbers only the value counts, at any length.
    A text without a number comes before all versions.
    """
    text = F.lower(F.trim(_col(c)))
    whole = r"^v?(?:(\d+)!)?(\d+(?:\.\d+)*)((?:[-_.]?[a-z]+[-_.]?\d*|-\d+)*)(?:\+([a-z0-9]+(?:[-_.][a-z0-9]+)*))?.*$"
    part = lambda k: F.regexp_extract(text, whole, k)
    number = lambda p: F.coalesce(F.nullif(p, F.lit("")).try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    release = F.regexp_replace(part(2), r"(\.0+)+$", "")
    pieces = F.regexp_extract_all(part(3), F.lit(r"([a-z]+[-_.]?\d*|-\d+)"), F.lit(1))
    rank = F.create_map(*[F.lit(x) for pair in VERSION_STAGES.items() for x in pair])
    # A bare -N is a post release; other words come before the release, in the order of their text.
    stage = lambda p: F.coalesce(rank[F.regexp_extract(p, r"^([a-z]*)", 1)], F.when(p.startswith("-"), 1).otherwise(-5))
    later = F.transform(
        pieces, lambda p: F.struct(stage(p).alias("stage"), F.when(stage(p) == -5, F.regexp_extract(p, r"^([a-z]*)", 1)).otherwise("").alias("word"), number(F.regexp_extract(p, r"(\d+)$", 1)).alias("n"))
    )
    end = F.array(F.struct(F.lit(0).alias("stage"), F.lit("").alias("word"), F.lit(0).cast("decimal(38,0)").alias("n")))
    local = F.filter(F.split(part(4), "[-_.]"), lambda p: p != "")
    return F.struct(
        (part(2) != "").alias("any"),
        number(part(1)).alias("epoch"),
        F.transform(F.split(release, r"\."), number).alias("release"),
        F.concat(later, end).alias("stages"),
        F.transform(local, lambda p: F.struct(p.rlike(r"^\d+$").alias("numeric"), F.coalesce(p.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("n"), p.alias("text"))).alias("local"),
    )


def numeric_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# Zelen and Severo's approximation of the normal distribution function (error below 7.5e-8).
NORMAL_CDF_T = 0.2316419
NORMAL_CDF_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

# Acklam's rational approximation of the normal quantile (relative error below 1.15e-9).
QUANTILE_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
QUANTILE_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
QUANTILE_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982664783e00)
QUANTILE_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
QUANTILE_TAIL = 0.02425
QUANTILE_EDGE = 1e-12


def _horner(coefficients, x: Column) -> Column:
    """Polynomial with the highest power first."""
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_cdf(x) -> Column:
    x = _col(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(NORMAL_CDF_T) * F.abs(x))
    tail = F.exp(-x * x / F.lit(2.0)) / F.lit(math.sqrt(2 * math.pi)) * _horner(NORMAL_CDF_B[::-1], t) * t
    return F.when(x >= 0, F.lit(1.0) - tail).otherwise(tail)


def normal_quantile(df, p: str, name: str):
    """Add the normal quantile of column ``p``; in steps, so that no part of the formula is repeated in the plan."""
    clamped = F.greatest(F.lit(QUANTILE_EDGE), F.least(F.lit(1.0 - QUANTILE_EDGE), F.col(p)))
    q, r, s = F.col("_q"), F.col("_r"), F.col("_s")
    middle = _horner(QUANTILE_A, r) * q / (_horner(QUANTILE_B, r) * q * q + F.lit(1.0))
    low = _horner(QUANTILE_C, s) / (_horner(QUANTILE_D, s) * s + F.lit(1.0))
    return (
        df.withColumn("_p", clamped)
        .withColumns({"_q": F.col("_p") - F.lit(0.5), "_s": F.sqrt(F.lit(-2.0) * F.ln(F.least(F.col("_p"), F.lit(1.0) - F.col("_p"))))})
        .withColumn("_r", q * q)
        .withColumn(
            name, F.when(F.col("_p") < QUANTILE_TAIL, low).when(F.col("_p") > 1.0 - QUANTILE_TAIL, -low).otherwise(middle)
        )
        .drop("_p", "_q", "_r", "_s")
    )
