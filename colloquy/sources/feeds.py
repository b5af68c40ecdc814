"""Feed tables: schema inference, filtered scans, the prioritized union of sources, entries and cutoffs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators.dedup import keep_first
from colloquy.operators.sequence import take_until

#: Names of columns that hold a feed's url or language, best first.
URL_COLUMNS = ["feedurl", "feed_url", "url", "originalurl", "original_url"]
LANG_COLUMNS = ["language", "lang"]


#: What makes a table a likely one: a part of its name, and what that is worth.
NAME_HINTS = {"feed": 3, "podcast": 1}


def feed_columns(columns: list[str]) -> list[str] | None:
    """The url and the language column, the best of each by name in any case; None unless there are both."""
    by_name: dict[str, str] = {}
    for c in columns:
        by_name.setdefault(c.lower(), c)
    best = [[by_name[w] for w in wanted if w in by_name][:1] for wanted in (URL_COLUMNS, LANG_COLUMNS)]
    return [c for found in best for c in found] if all(best) else None


def likeliest_feeds(tables: dict[str, list[str]]) -> tuple[str, str, str]:
    """(table, url column, language column): of the tables with both columns the one whose name has the most hints; the
    first of equals. Raises ValueError if there is none."""
    fitting = {name: pair for name, columns in tables.items() if (pair := feed_columns(columns))}
    if not fitting:
        raise ValueError("no table has a url and a language column")
    worth = lambda name: sum(n for hint, n in NAME_HINTS.items() if hint in name.lower())
    chosen = max(fitting, key=worth)  # max() keeps the first of equals
    return (chosen, *fitting[chosen])


def read_feeds(tables: dict[str, DataFrame], languages: list[str]) -> DataFrame:
    """``url``, ``lang`` of the feed table among ``tables``: trimmed urls and normalized languages, of rows that have both
    and whose language is one of ``languages`` or a variant."""
    name, url, lang = likeliest_feeds({k: df.columns for k, df in tables.items()})
    rows = tables[name].select(F.col(url).cast("string").alias("raw"), E.normalize_lang(F.col(lang).cast("string")).alias("lang"))
    return rows.where((F.coalesce("raw", F.lit("")) != "") & (F.col("lang") != "") & E.lang_matches(F.col("lang"), languages)).select(E.strip(F.col("raw")).alias("url"), "lang")


def prioritized(videos: DataFrame, feeds: DataFrame, allowed: DataFrame) -> DataFrame:
    """One list of sources: videos by priority, then feeds in their order, then allowed feeds by priority; the first of
    equal urls wins. Inputs: url, lang, source_id, priority, pos; result adds ``block``."""
    blocks = [df.select("url", "lang", "source_id", "priority", "pos", F.lit(k).alias("block")) for k, df in enumerate((videos, feeds, allowed))]
    union = blocks[0].unionByName(blocks[1]).unionByName(blocks[2])
    return keep_first(union.where(F.coalesce("url", F.lit("")) != ""), ["url"], [F.col("block"), F.desc("priority"), F.col("pos")]).drop("pos")


def entry_audio(entries: DataFrame, enclosures: str = "enclosures", links: str = "links", media: str = "media_content") -> DataFrame:
    """Audio urls of feed entries, one row each with ``audio_pos``: enclosures' href, then href of links that are
    enclosures, then url or href of media; what is no audio is left out, repeats are kept."""
    some = lambda c: F.coalesce(F.col(c), F.array())
    found = F.concat(
        F.transform(some(enclosures), lambda x: x["href"]),
        F.transform(F.filter(some(links), lambda x: x["rel"] == "enclosure"), lambda x: x["href"]),
        F.transform(some(media), lambda x: E.text_or(x["url"], x["href"])),
    )
    rest = [c for c in entries.columns if c not in (enclosures, links, media)]
    return entries.select(*rest, F.posexplode(F.filter(found, lambda u: E.is_audio_url(u))).alias("audio_pos", "audio_url"))


def feed_items(items: DataFrame, feed: str, order: list[str], feed_terms: str, entry_terms: str, limit: int | None) -> DataFrame:
    """Entries of feeds that aren't music: a feed with a music tag has none; the limit counts all entries, also those that
    are skipped as music themselves, and 0 leaves none."""
    rows = items.where(~E.is_music(F.col(feed_terms)))
    if limit is not None:
        rows = rows.withColumn("__pos", F.row_number().over(W.partitionBy(feed).orderBy(*order))).where(F.col("__pos") <= limit).drop("__pos")
    return rows.where(~E.is_music(F.col(entry_terms)))


def video_entries(entries: DataFrame, source: str, cell: str, order: list[str], limit: int | None, target_sec: float | None) -> DataFrame:
    """Entries of a playlist until either stop, both tested after an entry is taken: ``limit`` entries, so 0 yields one,
    or ``target_sec`` of durations (null: 0), so the entry that crosses it stays. Bare ids become addresses; entries
    without any are left out. ``entries``: ``source``, url, duration, and a ``cell`` that rises with the order."""
    rows = entries.where(F.coalesce("url", F.lit("")) != "").withColumn("url", E.watch_url(F.col("url"))).withColumn("duration", F.col("duration").try_cast("double"))
    if target_sec is not None:
        rows = take_until(rows, [source], cell, order, "duration", target_sec)
    if limit is not None:
        rows = rows.withColumn("__pos", F.row_number().over(W.partitionBy(source).orderBy(cell, *order))).where(F.col("__pos") <= max(1, limit)).drop("__pos")
    return rows


def source_entries(sources: DataFrame, entries: DataFrame, limit: int | None, target_sec: float | None) -> DataFrame:
    """Items of sources by their type: source_id, kind, url, duration, pos. ``sources``: source_id, kind; ``entries``:
    source_id, url, duration, pos, from wherever they were fetched. Of 'youtube' video_entries(), of 'rss' entries that are
    audio, at most ``limit`` of a source; any other kind raises where it is read."""
    rows = entries.join(sources.select("source_id", F.lower("kind").alias("kind")), "source_id")
    cell = F.floor(F.col("pos") / 10_000)
    videos = video_entries(rows.where("kind = 'youtube'").withColumn("__cell", cell), "source_id", "__cell", ["pos"], limit, target_sec).drop("__cell")
    heard = rows.where("kind = 'rss'")
    if limit is not None:
        heard = heard.withColumn("__pos", F.row_number().over(W.partitionBy("source_id").orderBy("pos"))).where(F.col("__pos") <= limit).drop("__pos")
    heard = heard.where(E.is_audio_url(F.col("url")))
    other = rows.where(F.coalesce(~F.col("kind").isin("youtube", "rss"), F.lit(True)))
    wrong = other.withColumn("kind", F.raise_error(F.concat(F.lit("unsupported source_type "), F.coalesce("kind", F.lit("null")))).cast("string"))
    columns = ["source_id", "kind", "url", F.col("duration").cast("double").alias("duration"), "pos"]
    return videos.select(*columns).unionByName(heard.select(*columns)).unionByName(wrong.select(*columns))
