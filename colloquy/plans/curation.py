"""Sources, quality, curation and manifests over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.functions.keys import usable_bounds
from colloquy.operators import curate as C
from colloquy.operators.dedup import insert_missing, keep_first, pending, upsert
from colloquy.operators.prefix import running_before
from colloquy.operators.sequence import take_until
from colloquy.session import read_table
from colloquy.sources.feeds import feed_items, prioritized, read_feeds

LANGUAGES = ["vi", "ja", "en"]
DONE = ("ok", "skipped_duration", "skipped_low_quality", "skipped_no_dialogues")


def records(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(read_table(spark, d, "source_records"), ["record_id"], [F.col("added_at")])


def items(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(read_table(spark, d, "audio_items"), ["item_id"], [F.col("fetched_at")])


def lang_filter(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d).withColumn("code", E.normalize_lang(F.col("lang")))
    return r.where(E.lang_matches(F.col("code"), LANGUAGES)).select("record_id", "code")


def base_language(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", E.base_lang(E.normalize_lang(F.col("lang"))).alias("base_lang"))


def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).where("url is not null").select("record_id", E.normalize_url(F.col("url")).alias("url"), E.url_suffix(E.normalize_url(F.col("url"))).alias("suffix"))


def audio_urls(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).where(E.is_audio_url(F.col("audio_url"))).select("item_id", E.episode_key(F.col("audio_url")).alias("episode_key"))


def source_priority_union(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d).select(E.normalize_url(F.col("url")).alias("url"), F.lower(E.text_or(E.strip(F.col("lang")), F.lit("vi"))).alias("lang"), F.col("source_id"), F.coalesce("priority", F.lit(0)).alias("priority"), F.col("record_id").alias("pos"), F.lower(F.trim("source_type")).alias("kind"))
    allowed = {k: keep_first(r.where(F.col("kind") == k), ["url"], [F.col("pos")]) for k in ("youtube", "rss")}
    feeds = read_feeds({"feeds": items(spark, d).select(F.col("rss_url").alias("url"), "lang", "item_id")}, LANGUAGES)
    feeds = feeds.groupBy("url").agg(F.min("lang").alias("lang")).select("url", "lang", F.sha1("url").alias("source_id"), F.lit(0).alias("priority"), F.lit(0).cast("bigint").alias("pos"))
    return prioritized(allowed["youtube"], feeds, allowed["rss"])


def music_items(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).where(E.is_music(E.tag_terms(F.col("feed_meta")), E.tag_terms(F.col("entry_meta")))).select("item_id")


def feed_item_limit(spark: SparkSession, d: str) -> DataFrame:
    i = items(spark, d).where("rss_url is not null").select("item_id", "rss_url", E.tag_terms(F.col("feed_meta")).alias("f"), E.tag_terms(F.col("entry_meta")).alias("e"))
    return feed_items(i, "rss_url", ["item_id"], "f", "e", 5).select("item_id", "rss_url")


def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes")
    return e.select("episode_key", E.quality_status(F.col("duration_sec"), F.col("sample_rate"), F.col("bit_rate"), 1_800, 44_100, 96_000).alias("verdict"))


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes").join(quality_gate(spark, d), "episode_key")
    ok = F.col("verdict") == "ok"
    return e.agg(F.count_if(ok).alias("written"), F.count_if(F.col("verdict").startswith("skipped")).alias("skipped"), F.count_if(F.col("verdict") == "error").alias("errors"), F.sum(F.when(ok, F.round(F.col("duration_sec") * 1000).cast("bigint"))).alias("written_ms"))


def pending_anti_join(spark: SparkSession, d: str) -> DataFrame:
    i = items(spark, d).where("audio_url is not null").select(E.episode_key(F.col("audio_url")).alias("episode_key"), "item_id")
    return pending(keep_first(i, ["episode_key"], [F.col("item_id")]), read_table(spark, d, "episodes"), "episode_key", DONE)


def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes").select("episode_key", "status", "updated_at", F.lit(0).cast("bigint").alias("seq"))
    i = read_table(spark, d, "audio_items").where("audio_url is not null").select(F.sha1("audio_url").alias("episode_key"), F.lit("seen").alias("status"), F.col("fetched_at").alias("updated_at"), F.col("item_id").alias("seq"))
    return upsert(e, i, "episode_key", ["updated_at", "seq"])


def ledger_insert(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes").select("episode_key")
    return insert_missing(e, read_table(spark, d, "audio_items").where("audio_url is not null").select(F.sha1("audio_url").alias("episode_key")), "episode_key")


def keep_first_dedup(spark: SparkSession, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return keep_first(lines, ["l_partkey", "l_suppkey"], [F.col("l_orderkey"), F.col("l_linenumber")])


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Dialogue samples: tasks with their episode's recording and its first item."""
    t = read_table(spark, d, "separation_tasks").select("task_id", "episode_key", "dialogue_idx", "dlg_start", "dlg_end").distinct()
    e = read_table(spark, d, "episodes").select("episode_key", "audio_url", F.col("duration_sec").alias("episode_duration_sec"))
    known = e.select("audio_url").where("audio_url is not null").distinct()
    i = read_table(spark, d, "audio_items").join(known, "audio_url", "left_semi")
    i = i.groupBy("audio_url").agg(F.min_by(F.struct("rss_url", "lang", "feed_meta", "entry_meta"), "item_id").alias("i"))
    i = i.select("audio_url", "i.rss_url", "i.lang", F.concat(E.tag_terms(F.col("i.feed_meta")), E.tag_terms(F.col("i.entry_meta"))).alias("terms"))
    dur = F.when(usable_bounds(F.col("dlg_start"), F.col("dlg_end")), F.col("dlg_end") - F.col("dlg_start"))
    joined = t.join(e, "episode_key").join(i, "audio_url", "left").withColumn("duration_sec", dur).withColumnRenamed("task_id", "sample_id")
    return joined.withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))


def too_long_ratio(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).where(E.too_long(F.col("duration_sec"), F.col("episode_duration_sec"))).select("sample_id")


def curation_classes(spark: SparkSession, d: str) -> DataFrame:
    return C.classified(samples(spark, d)).select("sample_id", "reason")


def curation_report(spark: SparkSession, d: str) -> DataFrame:
    return C.reason_report(C.classified(samples(spark, d)))


def top_terms_by_reason(spark: SparkSession, d: str) -> DataFrame:
    return C.top_terms(C.classified(samples(spark, d)))


def manifest_export(spark: SparkSession, d: str) -> DataFrame:
    return C.manifest(keep_first(samples(spark, d), ["audio_url", "dialogue_idx"], [F.col("sample_id")]))


def language_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.language_counts(manifest_export(spark, d).withColumn("language", E.normalize_lang(F.col("language"))))


def language_histogram(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).groupBy(E.normalize_lang(F.col("lang")).alias("lang")).agg(F.count("*").alias("n"))


def episode_progress(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    ms = F.coalesce(F.round(F.col("duration_sec") * 1000).cast("bigint"), F.lit(0))
    return s.groupBy("episode_key").agg(F.count("*").alias("dialogues"), F.sum(ms).alias("collected_ms"))


def dialogue_keys(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "separation_tasks").select("task_id", "dlg_key", "episode_key", "dialogue_idx").distinct()
    return t.select("task_id", E.dialogue_key(F.col("episode_key"), F.col("dialogue_idx").cast("string")).alias("made_key"), E.episode_of_dialogue(F.col("dlg_key")).alias("of_episode"))


def target_cutoff(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes").select("episode_key", F.round(F.col("duration_sec") * 1000).cast("bigint").alias("ms"), F.substring("episode_key", 1, 2).alias("cell"))
    return take_until(e, [], "cell", ["episode_key"], "ms", 40 * 3_600_000).select("episode_key", "ms")


def entry_cutoff(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"), F.floor(F.col("event_id") / 1000).alias("cell"))
    return take_until(ev, ["user_id"], "cell", ["event_id"], "cents", 500_000).select("user_id", "event_id", "cents")


def stride_partition(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes").select("episode_key", F.substring("episode_key", 1, 2).alias("cell"))
    return running_before(e, [], "cell", [F.col("episode_key")], F.lit(1), "pos").select("episode_key", (F.col("pos") % 8).cast("bigint").alias("part"))


def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


_NORM = r"""(lower(regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?]*)?')) || substr({b}, length(regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?]*)?')) + 1))"""
_STRIP = r"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+\z', '', 'g')"
_BARE = r"regexp_replace(regexp_replace(regexp_replace(" + _STRIP + r", '[\t\r\n]', '', 'g'), '#.*\z', ''), '\?\z', '')"


def _norm(c: str) -> str:
    return _NORM.format(b=_BARE.format(c=c))


def _path(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({c}, '[\t\r\n]', '', 'g'), '[?#].*\z', ''), '^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?]*)?', '')"


_LANG = "coalesce(replace(lower(" + _STRIP + "), '_', '-'), '')"
_MATCH = "(" + " OR ".join(f"{{l}} = '{x}' OR starts_with({{l}}, '{x}-')" for x in LANGUAGES) + ")"
_BASE = "CASE WHEN coalesce({l}, '') = '' THEN 'unknown' WHEN starts_with({l}, 'ja') THEN 'ja' WHEN starts_with({l}, 'en') THEN 'en' ELSE {l} END"
_REC = "rec AS (SELECT * FROM source_records QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY added_at) = 1)"
_ITM = "itm AS (SELECT * FROM audio_items QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY fetched_at) = 1)"
_TERMS = """coalesce(list_filter(list_transform(CAST(CASE WHEN json_valid({c}) THEN CASE WHEN json_type({c}, '$.tags') = 'ARRAY' THEN json_extract({c}, '$.tags') END END AS JSON[]),
 lambda t: CASE WHEN json_type(t) = 'OBJECT' AND json_type(t, '$.term') = 'VARCHAR' THEN json_extract_string(t, '$.term') END), lambda t: t <> ''), CAST([] AS VARCHAR[]))"""
_MUSIC = "(" + " OR ".join("contains(lower(x), '" + k + "')" for k in E.MUSIC_KEYWORDS) + ")"
_IS_MUSIC = f"(len(list_filter({{c}}, lambda x: {_MUSIC})) > 0)"
_SMP = f"""
tsk AS (SELECT DISTINCT task_id, episode_key, dialogue_idx, dlg_start, dlg_end FROM separation_tasks),
fst AS (SELECT audio_url, rss_url, lang, {_TERMS.format(c="feed_meta")} || {_TERMS.format(c="entry_meta")} AS terms FROM audio_items WHERE audio_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY audio_url ORDER BY item_id) = 1),
smp AS MATERIALIZED (SELECT task_id AS sample_id, t.episode_key, e.audio_url, dialogue_idx, dlg_start, dlg_end, CASE WHEN dlg_end > dlg_start THEN dlg_end - dlg_start END AS duration_sec, e.duration_sec AS episode_duration_sec, rss_url, lang, coalesce(terms, []) AS terms
 FROM tsk t JOIN episodes e ON t.episode_key = e.episode_key LEFT JOIN fst ON fst.audio_url = e.audio_url)"""
_LONG = "(coalesce(episode_duration_sec, 0) > 0 AND coalesce(duration_sec, 0) / episode_duration_sec >= CAST(1 AS DOUBLE) / 3)"
_CLS = f"""{_SMP}, cls AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY coalesce(audio_url, ''), coalesce(dialogue_idx, -1) ORDER BY sample_id) > 1 THEN 'dup' WHEN {_IS_MUSIC.format(c="terms")} THEN 'music' WHEN {_LONG} THEN 'too_long' ELSE 'kept' END AS reason FROM smp)"""
_MS = "CAST(coalesce(round(duration_sec * 1000), 0) AS BIGINT)"
_MAN = f"""{_SMP}, man AS (SELECT lang AS language, rss_url, audio_url, dialogue_idx, dlg_start AS episode_start_sec, dlg_end AS episode_end_sec, duration_sec, episode_duration_sec FROM smp
 WHERE coalesce(audio_url, '') <> '' QUALIFY row_number() OVER (PARTITION BY audio_url, dialogue_idx ORDER BY sample_id) = 1)"""
_GATE = """gate AS (SELECT *, CASE WHEN coalesce(duration_sec, 0) <= 0 THEN 'error' WHEN duration_sec > 1800 THEN 'skipped_duration' WHEN sample_rate < 44100 THEN 'skipped_low_quality' WHEN bit_rate < 96000 THEN 'skipped_low_quality' ELSE 'ok' END AS verdict FROM episodes)"""

SQL = {
    "lang_filter": f"WITH {_REC}, c AS (SELECT record_id, {_LANG.format(c='lang')} AS code FROM rec) SELECT * FROM c WHERE {_MATCH.format(l='code')}",
    "base_language": f"WITH c AS (SELECT doc_id, {_LANG.format(c='lang')} AS l FROM documents) SELECT doc_id, {_BASE.format(l='l')} AS base_lang FROM c",
    "url_normalize": f"WITH {_REC}, n AS (SELECT record_id, {_norm('url')} AS url FROM rec WHERE url IS NOT NULL) SELECT record_id, url, coalesce(nullif(regexp_extract({_path('url')}, '[^/.](\\.[^./]+)\\z', 1), ''), '.bin') AS suffix FROM n",
    "audio_urls": f"WITH {_ITM} SELECT item_id, sha1({_norm('audio_url')}) AS episode_key FROM itm WHERE regexp_matches(lower({_path('audio_url')}), '\\.({'|'.join(E.AUDIO_EXTENSIONS)})\\z')",
    "source_priority_union": f"""WITH {_REC}, {_ITM}, r AS (SELECT {_norm("url")} AS url, lower(coalesce(nullif({_STRIP.format(c="lang")}, ''), 'vi')) AS lang, source_id, coalesce(priority, 0) AS priority, record_id AS pos, lower(trim(source_type)) AS kind FROM rec),
     a AS (SELECT * FROM r WHERE kind IN ('youtube', 'rss') QUALIFY row_number() OVER (PARTITION BY kind, url ORDER BY pos) = 1),
     l AS (SELECT {_STRIP.format(c="rss_url")} AS url, {_LANG.format(c="lang")} AS lang FROM itm WHERE coalesce(rss_url, '') <> ''),
     f AS (SELECT url, min(lang) AS lang FROM l WHERE lang <> '' AND {_MATCH.format(l="lang")} GROUP BY url),
     u AS (SELECT url, lang, source_id, priority, pos, 0 AS block FROM a WHERE kind = 'youtube' UNION ALL SELECT url, lang, sha1(url), 0, 0, 1 FROM f UNION ALL SELECT url, lang, source_id, priority, pos, 2 FROM a WHERE kind = 'rss')
     SELECT url, lang, source_id, priority, block FROM u WHERE coalesce(url, '') <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY block, priority DESC, pos) = 1""",
    "music_items": f"WITH {_ITM} SELECT item_id FROM itm WHERE {_IS_MUSIC.format(c=_TERMS.format(c='feed_meta') + ' || ' + _TERMS.format(c='entry_meta'))}",
    "feed_item_limit": f"""WITH {_ITM}, i AS (SELECT item_id, rss_url, {_TERMS.format(c="feed_meta")} AS f, {_TERMS.format(c="entry_meta")} AS e FROM itm WHERE rss_url IS NOT NULL),
     l AS (SELECT * FROM i WHERE NOT {_IS_MUSIC.format(c="f")} QUALIFY row_number() OVER (PARTITION BY rss_url ORDER BY item_id) <= 5) SELECT item_id, rss_url FROM l WHERE NOT {_IS_MUSIC.format(c="e")}""",
    "quality_gate": f"WITH {_GATE} SELECT episode_key, verdict FROM gate",
    "run_summary": f"WITH {_GATE} SELECT count(*) FILTER (verdict = 'ok') AS written, count(*) FILTER (starts_with(verdict, 'skipped')) AS skipped, count(*) FILTER (verdict = 'error') AS errors, CAST(sum(CASE WHEN verdict = 'ok' THEN {_MS} END) AS BIGINT) AS written_ms FROM gate",
    "pending_anti_join": f"WITH {_ITM}, i AS (SELECT sha1({_norm('audio_url')}) AS episode_key, min(item_id) AS item_id FROM itm WHERE audio_url IS NOT NULL GROUP BY 1) SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM episodes e WHERE e.episode_key = i.episode_key AND status IN {DONE})",
    "ledger_upsert": "WITH u AS (SELECT episode_key, status, updated_at, 0 AS seq FROM episodes UNION ALL SELECT sha1(audio_url), 'seen', fetched_at, item_id FROM audio_items WHERE audio_url IS NOT NULL) SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY episode_key ORDER BY updated_at DESC, seq DESC) = 1",
    "ledger_insert": "SELECT episode_key FROM episodes UNION SELECT sha1(audio_url) FROM audio_items WHERE audio_url IS NOT NULL",
    "keep_first_dedup": "SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) = 1",
    "too_long_ratio": f"WITH {_SMP} SELECT sample_id FROM smp WHERE {_LONG}",
    "curation_classes": f"WITH {_CLS} SELECT sample_id, reason FROM cls",
    "curation_report": f"WITH {_CLS} SELECT reason, count(*) AS samples, CAST(sum({_MS}) AS BIGINT) AS ms FROM cls GROUP BY reason UNION ALL SELECT 'total', count(*), CAST(sum({_MS}) AS BIGINT) FROM cls",
    "top_terms_by_reason": f"""WITH {_CLS}, x AS (SELECT DISTINCT sample_id, reason, {_STRIP.format(c="unnest(terms)")} AS term FROM cls), n AS (SELECT reason, term, count(*) AS samples FROM x WHERE term <> '' GROUP BY 1, 2)
     SELECT reason, term, samples, row_number() OVER (PARTITION BY reason ORDER BY samples DESC, term) AS rank FROM n QUALIFY rank <= 50""",
    "manifest_export": f"WITH {_MAN} SELECT * FROM man",
    "language_counts": f"WITH {_MAN}, n AS (SELECT {_LANG.format(c='language')} AS l, duration_sec FROM man) SELECT {_BASE.format(l='l')} AS base_lang, count(*) AS n, CAST(sum({_MS}) AS BIGINT) AS ms FROM n GROUP BY 1",
    "language_histogram": f"WITH {_REC} SELECT {_LANG.format(c='lang')} AS lang, count(*) AS n FROM rec GROUP BY 1",
    "episode_progress": f"WITH {_SMP} SELECT episode_key, count(*) AS dialogues, CAST(sum({_MS}) AS BIGINT) AS collected_ms FROM smp GROUP BY 1",
    "dialogue_keys": "SELECT DISTINCT task_id, episode_key || '_' || printf('%04d', coalesce(dialogue_idx, 0)) AS made_key, regexp_replace(dlg_key, '_[^_]*$', '') AS of_episode FROM separation_tasks",
    "target_cutoff": "WITH m AS (SELECT episode_key, CAST(round(duration_sec * 1000) AS BIGINT) AS ms FROM episodes), c AS (SELECT *, coalesce(sum(coalesce(ms, 0)) OVER (ORDER BY episode_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM m) SELECT episode_key, ms FROM c WHERE b < 144000000",
    "entry_cutoff": "WITH m AS (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events), c AS (SELECT *, coalesce(sum(coalesce(cents, 0)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM m) SELECT user_id, event_id, cents FROM c WHERE b < 500000",
    "stride_partition": "SELECT episode_key, (row_number() OVER (ORDER BY episode_key) - 1) % 8 AS part FROM episodes",
    "json_extract": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
}
QUERIES = {f.__name__: f for f in (lang_filter, base_language, url_normalize, audio_urls, source_priority_union, music_items, feed_item_limit, quality_gate, run_summary, pending_anti_join, ledger_upsert, ledger_insert, keep_first_dedup, too_long_ratio, curation_classes, curation_report, top_terms_by_reason, manifest_export, language_counts, language_histogram, episode_progress, dialogue_keys, target_cutoff, entry_cutoff, stride_partition, json_extract)}
