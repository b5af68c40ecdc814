"""Scalar functions as column expressions; none is a Python UDF, so filters and projections reach the scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File extensions of audio, and keywords that mark a tag as music.
AUDIO_EXTENSIONS = ["mp3", "m4a", "aac", "ogg", "opus", "wav", "flac", "m4b", "webm", "aif", "aiff"]
MUSIC_KEYWORDS = [
    "music", "songs", "song", "jazz", "rock", "classical", "pop", "hip-hop", "hip hop", "rap", "electronic", "edm", "reggae", "blues", "country", "metal", "folk", "r&b", "rnb", "soul", "punk", "indie", "alternative", "opera",
    "音楽", "楽曲", "ソング", "歌", "nhạc", "bài hát", "ca nhạc", "acoustic", "karaoke", "remix", "live session", "bolero", "vpop",
]
SCHEME_AND_HOST = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?]*)?"


def strip(value: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+\z", "")


def text_or(value: Column, *others: Column) -> Column:
    """The first of the values that is neither null nor empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (value, *others)])


def normalize_lang(lang: Column) -> Column:
    """Trimmed, lower case, ``-`` for ``_``; null is ''."""
    return F.coalesce(F.replace(F.lower(strip(lang)), F.lit("_"), F.lit("-")), F.lit(""))


def lang_matches(lang: Column, allowed: list[str]) -> Column:
    """``lang`` (normalized before) is one of the codes or a variant of one; empty codes are ignored."""
    codes = [c.strip().lower().replace("_", "-") for c in allowed]
    hit = F.lit(False)
    for c in filter(None, codes):
        hit = hit | (lang == c) | F.startswith(lang, F.lit(c + "-"))
    return F.coalesce(hit, F.lit(False))


def base_lang(lang: Column, bases: tuple[str, ...] = ("ja", "en")) -> Column:
    """The base a code begins with, hyphen or not; other codes as they are; null or '' is 'unknown'."""
    out = F.when(F.coalesce(lang, F.lit("")) == "", "unknown")
    for b in bases:
        out = out.when(F.startswith(lang, F.lit(b)), b)
    return out.otherwise(lang)


def normalize_url(url: Column) -> Column:
    """Trimmed, without tabs and line ends, fragment or an empty query; scheme and host in lower case, path and query as
    they are."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(strip(url), r"[\t\r\n]", ""), r"#.*\z", ""), r"\?\z", "")
    head = F.regexp_extract(bare, SCHEME_AND_HOST, 0)
    return F.concat(F.lower(head), F.substr(bare, F.length(head) + F.lit(1)))


def url_path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"[?#].*\z", ""), SCHEME_AND_HOST, "")


def is_audio_url(url: Column) -> Column:
    """The path ends with an extension of audio, in any case; query and fragment don't matter; null is false."""
    return F.coalesce(F.lower(url_path(url)).rlike(r"\.(" + "|".join(AUDIO_EXTENSIONS) + r")\z"), F.lit(False))


def url_suffix(url: Column) -> Column:
    """The last suffix of the path with its dot, else '.bin'."""
    return text_or(F.regexp_extract(url_path(url), r"[^/.](\.[^./]+)\z", 1), F.lit(".bin"))


def watch_url(url: Column) -> Column:
    """A bare video id as the address of its page."""
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("https://www.youtube.com/watch?v="), url))


def episode_key(url: Column) -> Column:
    return F.sha1(normalize_url(url))


def dialogue_key(key: Column, index: Column) -> Column:
    """Key and index with at least four digits; an index that is no number counts as 0."""
    return F.concat(key, F.lit("_"), F.format_string("%04d", F.coalesce(index.try_cast("bigint"), F.lit(0).cast("bigint"))))


def episode_of_dialogue(key: Column) -> Column:
    """What stands before the last ``_``."""
    return F.regexp_replace(key, "_[^_]*$", "")


def tag_terms(meta: Column) -> Column:
    """The terms, as they stand, of a JSON object's ``tags`` that are objects with a string that isn't empty."""
    tags = F.try_variant_get(F.try_parse_json(meta), "$.tags", "array<variant>")
    terms = F.transform(tags, lambda t: F.when(F.schema_of_variant(F.try_variant_get(t, "$.term", "variant")) == "STRING", F.try_variant_get(t, "$.term", "string")))
    return F.coalesce(F.filter(terms, lambda t: t.isNotNull() & (t != "")), F.array().cast("array<string>"))


def is_music(*term_lists: Column) -> Column:
    """Any term contains a keyword, in any case."""
    quoted = "|".join("\\Q" + k + "\\E" for k in MUSIC_KEYWORDS)
    return F.exists(F.concat(*term_lists), lambda t: F.lower(t).rlike(quoted))


def sample_terms(*term_lists: Column) -> Column:
    """The distinct terms of several lists, trimmed."""
    return F.array_distinct(F.filter(F.transform(F.concat(*term_lists), strip), lambda t: t != ""))


def too_long(part: Column, whole: Column, share: float = 1 / 3) -> Column:
    """``part`` takes at least ``share`` of ``whole``; false where whole is null or not positive."""
    whole = F.coalesce(whole, F.lit(0.0))
    return (whole > 0) & (F.coalesce(part, F.lit(0.0)) / F.when(whole > 0, whole) >= share)


def quality_status(duration: Column, sample_rate: Column, bit_rate: Column, most_sec: float = 10_800, least_rate: int = 16_000, least_bits: int = 32_000) -> Column:
    """What a probe says of a recording, first rule first; null rates pass."""
    return (
        F.when(F.coalesce(duration, F.lit(0.0)) <= 0, "error")
        .when(duration > most_sec, "skipped_duration")
        .when(sample_rate < least_rate, "skipped_low_quality")
        .when(bit_rate < least_bits, "skipped_low_quality")
        .otherwise("ok")
    )


def number_or_none(value: Column) -> Column:
    """Null for values that aren't finite."""
    value = value.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def mean_of(*values: Column) -> Column:
    """The mean of those that aren't null; null if none is left."""
    known = F.filter(F.array(*map(number_or_none, values)), lambda v: v.isNotNull())
    return F.aggregate(known, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(known), F.lit(0))


def metric_status(any_metric: Column, any_error: Column) -> Column:
    return F.when(any_metric & ~any_error, "ok").when(any_metric, "partial").otherwise("unavailable")


def sample_index(seconds: Column, rate: int = 16_000) -> Column:
    """The sample at a time, cut off, not rounded."""
    return (seconds * rate).try_cast("bigint")


def label_time(ms: Column) -> Column:
    """Whole milliseconds as seconds with three decimals, by integer arithmetic, so there is no tie to round."""
    return F.concat(F.floor(ms / 1000).cast("string"), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))


def safe_name(value: Column) -> Column:
    """Signs other than letters, digits, ``.``, ``_`` and ``-`` become ``_``; none of ``._`` at the ends; '' is 'item'."""
    return text_or(F.regexp_replace(F.regexp_replace(value, r"[^\p{L}\p{Nd}._\-]", "_"), "^[._]+|[._]+$", ""), F.lit("item"))


def parse_turn(raw: Column) -> Column:
    """A turn written as text, ``start end [speaker]``, parted by blanks or commas, as struct(speaker, start, end).

    The first two numbers are the bounds; the speaker is the last part that is no number, else a third number, else
    SPEAKER_00. Null where there are fewer than two numbers.
    """
    parts = F.filter(F.split(F.trim(raw), r"[\s,]+"), lambda p: p != "")
    numbers = F.filter(F.transform(parts, lambda p: p.try_cast("double")), lambda n: n.isNotNull())
    words = F.filter(parts, lambda p: p.try_cast("double").isNull())
    speaker = F.coalesce(F.try_element_at(words, F.lit(-1)), F.try_element_at(numbers, F.lit(3)).try_cast("bigint").cast("string"), F.lit("SPEAKER_00"))
    return F.when(F.size(numbers) >= 2, F.struct(speaker.alias("speaker"), F.get(numbers, 0).alias("start"), F.get(numbers, 1).alias("end")))


def gpu_index(device: Column) -> Column:
    """The number after the colon of a device's name; null if it has none."""
    return F.get(F.split(device, ":"), 1).try_cast("int")


def probe_info(probe: Column) -> Column:
    """struct(duration, sample_rate, bit_rate) of a probe's JSON: duration 0 where it is missing or no number, the stream's
    bit rate before the file's, null where there is none."""
    at = lambda p: F.get_json_object(probe, p)
    duration = F.coalesce(at("$.format.duration").try_cast("double"), F.lit(0.0))
    bits = F.coalesce(at("$.streams[0].bit_rate").try_cast("int"), at("$.format.bit_rate").try_cast("int"))
    return F.struct(duration.alias("duration"), at("$.streams[0].sample_rate").try_cast("int").alias("sample_rate"), bits.alias("bit_rate"))


def dialogue_meta(device: str, start: str, end: str, index: str, *rest: str) -> Column:
    """The metadata of a dialogue as JSON; null fields are left out."""
    span = (F.col(end) - F.col(start)).alias("dialogue_duration_sec")
    return F.to_json(F.struct(*rest, F.col(index).alias("dialogue_idx"), F.col(start).alias("dialogue_start"), F.col(end).alias("dialogue_end"), span, F.col(device).alias("device"), gpu_index(F.col(device)).alias("gpu_id")))


def metadata_language(*candidates: Column) -> Column:
    """The first that isn't null or empty, in lower case; 'vi' where all are."""
    return F.lower(F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit("vi")))


def counted_duration(dialogue_sec: Column, duration_sec: Column, is_dialogue: Column | None = None) -> Column:
    """The seconds a sample counts for: of a dialogue its own, of any other the recording's; without ``is_dialogue`` the
    first that is neither null nor 0. 0 where there is none."""
    if is_dialogue is not None:
        return F.coalesce(F.when(is_dialogue, dialogue_sec).otherwise(duration_sec), F.lit(0.0))
    return F.coalesce(F.nullif(dialogue_sec, F.lit(0.0)), F.nullif(duration_sec, F.lit(0.0)), F.lit(0.0))


def short_key(key: Column, signs: int = 8) -> Column:
    return F.substring(key, 1, signs)


def hours_text(ms: Column) -> Column:
    """Whole milliseconds as hours, minutes and seconds, h:mm:ss, cut off."""
    sec = F.floor(ms / 1000)
    return F.format_string("%d:%02d:%02d", F.floor(sec / 3600), F.floor(sec % 3600 / 60), sec % 60)


#: Names under which models give a turn's bounds and speaker, best first.
START_NAMES, END_NAMES, SPEAKER_NAMES = ("start", "begin", "start_time", "start_sec"), ("end", "stop", "end_time", "end_sec"), ("speaker", "label", "speaker_id", "spk")


def parse_raw_turn(raw: Column) -> Column:
    """A turn as a model gives it, in JSON, as struct(speaker, start, end): an object with names as above, a list of start,
    end and speaker, or text as for parse_turn(). Null where there are no two bounds, as in what is none of these."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    first = lambda names, t: F.coalesce(*[F.try_variant_get(v, f"$.{n}", t) for n in names])
    named = F.struct(F.coalesce(first(SPEAKER_NAMES, "string"), F.lit("SPEAKER_00")).alias("speaker"), first(START_NAMES, "double").alias("start"), first(END_NAMES, "double").alias("end"))
    at = lambda k, t: F.try_variant_get(v, f"$[{k}]", t)
    listed = F.struct(F.coalesce(at(2, "string"), F.lit("SPEAKER_00")).alias("speaker"), at(0, "double").alias("start"), at(1, "double").alias("end"))
    given = F.when(kind.startswith("OBJECT"), named).when(kind.startswith("ARRAY"), listed)
    # what begins with a number is read as one, whatever follows it
    text = parse_turn(F.coalesce(F.when(kind == "STRING", F.try_variant_get(v, "$", "string")), raw))
    turn = F.coalesce(given, text)
    return F.when(turn["start"].isNotNull() & turn["end"].isNotNull(), turn)
