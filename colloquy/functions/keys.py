"""Keys that ignore how a value is spelled. All are plain expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space or punctuation in a url.
URL_NOISE = r"[\p{P}\p{Z}\p{Cc}\p{Cf}\s$+<=>^`|~]+"
FULLWIDTH_DIGITS, ASCII_DIGITS = "０１２３４５６７８９", "0123456789"


def url_identity(url: Column) -> Column:
    """Equal for urls that differ at most in letter case, white space, punctuation and the order of query parameters.

    The part before the first ``?`` and each parameter (split at ``&`` or ``;``) lose white space and punctuation; the
    parameters are sorted. Null stays null. A url of nothing but punctuation has the key ``''``.
    """
    low = F.lower(url)
    at = F.instr(low, "?")
    bare = lambda c: F.regexp_replace(c, URL_NOISE, "")
    query = F.when(at > 0, F.substr(low, at + F.lit(1))).otherwise(F.lit(""))
    params = F.array_sort(F.transform(F.split(query, "[&;]"), bare))
    return F.concat(bare(F.when(at > 0, F.substr(low, F.lit(1), at - F.lit(1))).otherwise(low)), F.array_join(params, ""))


URL_IDENTITY_SQL = r"""
 (regexp_replace(CASE WHEN strpos({c}, '?') > 0 THEN lower(left({c}, strpos({c}, '?') - 1)) ELSE lower({c}) END,
   '[\p{{P}}\p{{Z}}\p{{Cc}}\p{{Cf}}\s$+<=>^`|~]+', '', 'g')
  || CASE WHEN strpos({c}, '?') = 0 THEN '' ELSE array_to_string(list_sort(list_transform(
   regexp_split_to_array(lower(substr({c}, strpos({c}, '?') + 1)), '[&;]'),
   lambda x: regexp_replace(x, '[\p{{P}}\p{{Z}}\p{{Cc}}\p{{Cf}}\s$+<=>^`|~]+', '', 'g'))), '') END)
"""


def speaker_number(label: Column) -> Column:
    """The number a speaker label states, as BIGINT: the first run of digits, ASCII or full width; null if there is none
    or it doesn't fit."""
    digits = F.regexp_extract(F.translate(label, FULLWIDTH_DIGITS, ASCII_DIGITS), r"([0-9]+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


SPEAKER_NUMBER_SQL = f"try_cast(nullif(regexp_extract(translate({{c}}, '{FULLWIDTH_DIGITS}', '{ASCII_DIGITS}'), '([0-9]+)', 1), '') AS BIGINT)"


def usable_bounds(start: Column, end: Column) -> Column:
    """Both bounds set, finite, and the end after the start: never null, and a plain conjunction, so that its null checks
    reach the scan."""
    finite = lambda c: ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return start.isNotNull() & end.isNotNull() & finite(start) & finite(end) & (end > start)


def millis(seconds: Column) -> Column:
    """Seconds as whole milliseconds, null where they are out of range."""
    return F.round(seconds * 1000).try_cast("bigint")
