"""Source allowlists in JSON lines or structured JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators.dedup import keep_first

TYPES = ("rss", "youtube")
_URLS = "array<string>"


def _finish(records: DataFrame, path: str) -> DataFrame:
    """Defaults, normalized urls, first of equal urls; a type other than TYPES raises where it is read."""
    kind = F.lower(F.coalesce("source_type", F.lit("rss")))
    known = F.when(kind.isin(*TYPES), kind).otherwise(F.raise_error(F.concat(F.lit(f"{path}: unsupported source_type "), kind)))
    out = records.select(
        E.text_or(F.col("source_id"), F.concat(F.lit("allowlist_"), F.col("line_no").cast("string"))).alias("source_id"),
        known.alias("source_type"),
        E.normalize_url(F.col("url")).alias("url"),
        F.lower(E.text_or(F.col("language"), F.lit("vi"))).alias("language"),
        F.coalesce("show_name", F.lit("")).alias("show_name"),
        F.coalesce("license_notes", F.lit("")).alias("license_notes"),
        F.coalesce(F.col("priority").try_cast("int"), F.lit(0)).alias("priority"),
        "line_no",
        "url_no",
    )
    return keep_first(out, ["url"], [F.col("line_no"), F.col("url_no")]).drop("url_no")


def parse_lines(lines: DataFrame, path: str = "") -> DataFrame:
    """``lines``: at (from 0), line. One record a line; blank lines and those that begin with # are skipped but counted."""
    lines = lines.where((F.trim("line") != "") & ~F.ltrim("line").startswith("#"))
    schema = "source_id string, source_type string, url string, language string, show_name string, license_notes string, priority string"
    parsed = lines.select((F.col("at") + 1).alias("line_no"), F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r"))
    return _finish(parsed.select("line_no", "r.*", F.lit(0).alias("url_no")), path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A file of parse_lines(). An allowlist is kept by hand, so its lines are numbered in one task."""
    return parse_lines(spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "line")), path)


def parse_structured(texts: DataFrame, path: str = "") -> DataFrame:
    """``texts``: value, at (the number of the text's first source, from 0). A JSON list of sources, an object with ``sources``, or one with a single source; each lists urls of several kinds,
    in the order url, urls, youtube playlists, channels, videos and urls, rss urls. Scalars stand for lists of one."""
    text = texts.select(F.col("at").alias("__from"), F.parse_json("value").alias("v"))
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    inner = F.try_variant_get("v", "$.sources", "variant")
    many = F.when(is_list, F.try_variant_get("v", "$", "array<variant>")).when(F.schema_of_variant(inner).startswith("ARRAY"), F.try_variant_get(inner, "$", "array<variant>")).when(inner.isNotNull(), F.array(inner))
    sources = text.select("__from", F.posexplode(many).alias("at", "s"))
    get = lambda p, t="string": F.try_variant_get("s", p, t)

    def urls(path: str, kind) -> object:
        value = F.coalesce(get(path, _URLS), F.array_compact(F.array(get(path))))
        return F.transform(F.filter(value, lambda u: u != ""), lambda u: F.struct(kind.alias("source_type"), u.alias("url")))

    own = F.lower(E.text_or(get("$.source_type"), F.lit("rss")))
    found = F.concat(urls("$.url", own), urls("$.urls", own), *[urls(f"$.youtube.{k}", F.lit("youtube")) for k in ("playlists", "channels", "videos", "urls")], urls("$.rss.urls", F.lit("rss")))
    rows = sources.select((F.col("__from") + F.col("at") + 1).alias("line_no"), *[get(f"$.{k}").alias(k) for k in ("source_id", "language", "show_name", "license_notes", "priority")], F.posexplode(found).alias("url_no", "u"))
    return _finish(rows.select("*", "u.*"), path)


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """A file of parse_structured()."""
    return parse_structured(spark.read.text(path, wholetext=True).select("value", F.lit(0).alias("at")), path)


def read_allowlist(spark: SparkSession, path: str) -> DataFrame:
    """By suffix, or, where that says nothing, by the first sign. A path that doesn't exist is an empty list."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "source_id string, source_type string, url string, language string, show_name string, license_notes string, priority int, line_no int")
    structured = path.endswith(".json") or (not path.endswith(".jsonl") and spark.read.text(path, wholetext=True).select(F.ltrim("value")).first()[0].startswith("["))
    return read_structured(spark, path) if structured else read_jsonl(spark, path)
