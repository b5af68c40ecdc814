"""Template residue and error-page text (problem 9).

*Content.* Character n-gram models of filler, of notices (error pages, scripts required) and of natural prose give each
position of a text a log likelihood ratio; windows in which its mean is high are residue. A text is excluded if they cover
half of it or more, so one that talks about errors in a sentence or two stays. A residue model is a mixture of its seeds'
and the prose's n-grams: what the seeds don't know costs a window little, whatever the size of the corpus.

*Fields.* Whatever has brackets, signs or capitals as a template field could have is a window of its own. Models of fields
and of other bracketed matter, over characters and over their kinds, tell whether it is a field; models of sentences with
a slot and of sentences that quote one tell, over the sentence around it, whether it is unfilled.

The models of residue and of fields come from residue_seeds.py, that of prose from all texts of the corpus, each distinct
one once, so that a page with many copies isn't taken for prose. Thresholds were set on the labelled texts DEV of
tests/llm/residue_texts.py. Executors count n-grams and judge texts; the driver has tables of fixed size only. Every text
is read and scored whole.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import residue_seeds as seeds
from colloquy.llm.repeats import Repeats, repeats
from colloquy.session import read_table

LANGUAGES = seeds.LANGUAGES
#: Orders of n-grams; bits of the tables of content and of fields and quotes; positions scored at a time.
ORDERS, BITS, FIELD_BITS, CHUNK = (2, 3, 4), 18, 16, 1 << 19
#: The seeds' part in a residue model; what an n-gram is likely at least in prose; the part of the seeds' prose in prose at
#: least, and for how many n-grams of the corpus it counts.
SEEDED, FLOOR, KNOWN_PROSE, KNOWN_GRAMS = 0.2, 2e-5, 0.1, 20_000
#: Characters in a window; least mean log ratio of one that is residue; least share of residue in a text that is excluded.
WINDOW, LEAST_RATIO, LEAST_COVER = 24, 0.15, 0.5
#: Likelihood of an n-gram at least, and the least mean log ratio of a field; the same of sentences, and the least sum of
#: one that quotes.
FIELD_FLOOR, LEAST_FIELD, QUOTE_FLOOR, LEAST_QUOTE = 1e-5, 0.0, 1e-4, 10.0

#: Commonest words of the two languages that letters don't tell apart.
SPANISH = re.compile(r"\b(?:el|la|los|las|de|del|y|en|que|un|una|es|se|por|con|su|para|al|lo|como|más|este|esta|todo|nos)\b|[ñ¿¡áéíóú]")
ENGLISH = re.compile(r"\b(?:the|of|and|to|in|is|it|that|was|for|on|with|as|at|by|this|you|we|be|are|or|not|from|have)\b")
VIETNAMESE = "ăâđêôơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉĩịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹàèìòùãõ"
MARKUP = re.compile(r"<[^<>\n]{1,200}>")
SENTENCE_END = re.compile(r"[.!?…]\s|[。！？\n|]")
#: Keys of texts a task remembers so as to pass on each of a text's copies once, and candidates it has judged.
REMEMBERED = 200_000
APART, SLOT = np.zeros(ORDERS[-1] - 1, dtype=np.uint32), "\x01"

#: What a template field could be. Letters of scripts without spaces are \w, too, so \b doesn't tell where ASCII ends.
FROM, TO = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
CANDIDATE = re.compile(
    r"(?=[^\w\s,;'!?\"”“。、-]|[A-Z_○-◯〇△×Ｘ]|(?<![A-Za-z0-9_])[dmyhx])(?:[#$%@!*|]?\{+[^{}\n]*\}+|\*\|[^|\n]+\|\*|\[+[^\[\]\n]+\]+|<+[^<>\n]+>+|\(\(+[^()\n]+\)\)+|%?\([^()\n]+\)(?:[sd]" + TO + r")?"
    r"|（[^（）\n]+）|［[^［］\n]+］|【[^【】\n]+】|＜[^＜＞\n]+＞|｛[^｛｝\n]+｝|〔[^〔〕\n]+〕|«[^«»\n]+»|&lt;[^&\n]+&gt;"
    r"|(?P<sign>[%@#*~|]{2,3}|[%@#])[^\W\d_](?:[\w .\-]*?\w)?(?P=sign)|" + FROM + r"(?P<two>_{2,3}|[:$*~|_])[^\W\d_](?:[\w.\-]*?[^\W_])?(?P=two)" + TO +
    "|" + FROM + r"[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+" + TO +
    "|" + FROM + r"(?:[Xx]{2,}(?:[/.:\-][Xx]{2,})*|[DMYdmy]{2,4}(?P<cut>[/.\-])[DMYdmy]{2,4}(?P=cut)[DMYdmy]{2,4}|[Hh]{2}:[Mm]{2}(?::[Ss]{2})?|TB[ACD]|TODO|FIXME|TK(?:TK)?)" + TO +
    r"|[_＿]{2,}(?:[/ ][_＿]{2,})*|[〇○◯●△×Ｘ]{2,}|…{3,}|\.{6,}|%[sd]" + TO + ")"
)


@lru_cache(maxsize=1)
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point below 2^16, two classes: what it is in a field, and 1 to 3 for a Japanese, Vietnamese or other
    letter, 0 for any other."""
    shape, script = np.full(1 << 16, ord("L"), dtype=np.uint32), np.zeros(1 << 16, dtype=np.int64)
    for c in range(1 << 16):
        x = chr(c)
        japanese = "぀" <= x <= "ヿ" or "一" <= x <= "鿿"
        shape[c] = ord("0") if x.isdigit() else ord("あ") if japanese else (ord("A") if x.isupper() else ord("a")) if x.isalpha() else c
        script[c] = 0 if not x.isalpha() else 1 if japanese else 2 if x.lower() in VIETNAMESE else 3
    return shape, script


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def language_of(text: str) -> str:
    """ja, vi, es or en, by the letters of the whole text and, between the last two, by its common words; en where
    nothing tells."""
    n = np.zeros(4, dtype=np.int64)
    codes = points(text)
    for at in range(0, len(codes), CHUNK):
        n += np.bincount(_kinds()[1][np.minimum(codes[at : at + CHUNK], 0xFFFF)], minlength=4)
    letters = max(1, int(n[1:].sum()))
    if n[1] > 0.1 * letters:
        return "ja"
    if n[2] > 0.03 * letters:
        return "vi"
    low = text.lower()
    return "es" if sum(1 for _ in SPANISH.finditer(low)) > sum(1 for _ in ENGLISH.finditer(low)) else "en"


def normal(text: str, lines: bool = False) -> str:
    """The text in lower case, entities resolved, without markup, runs of white space as one space (with ``lines``, as a
    line end where they hold one), digits as 0."""
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = MARKUP.sub(" ", text)
    if lines:
        text = re.sub(r"\s*\n\s*", "\n", text)
    return re.sub(r"\d", "0", re.sub(r"[^\S\n]+" if lines else r"\s+", " ", text)).lower().strip()


def grams(codes: np.ndarray, bits: int = BITS) -> Iterator[np.ndarray]:
    """For each order the table places of the n-grams that start at each position."""
    h = np.full(len(codes), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(ORDERS[-1]):
        h = h[: max(0, len(codes) - k)]
        h ^= codes[k:]
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        if k + 1 in ORDERS:
            yield (h >> np.uint64(64 - bits)).astype(np.int64)


def counted(codes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Counts of the n-grams, one row for each order."""
    table = np.zeros((len(ORDERS), 1 << bits), dtype=np.int64)
    for at in range(0, len(codes), CHUNK):
        for row, g in zip(table, grams(codes[at : at + CHUNK + ORDERS[-1] - 1], bits), strict=True):
            row += np.bincount(g[:CHUNK], minlength=1 << bits)
    return table


def shares(table: np.ndarray) -> np.ndarray:
    return table / np.maximum(1, table.sum(axis=-1, keepdims=True))


def views(span: str) -> tuple[np.ndarray, np.ndarray]:
    """A candidate's characters, and their kinds."""
    own = f"\x02{span}\x03"
    return points(own.lower()), _kinds()[0][np.minimum(points(own), 0xFFFF)]


@lru_cache(maxsize=1)
def _seed_models() -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Tables of fields, (view, order, place); of quotes, by language; of filler, notices and prose, by language."""

    def field_shares(of) -> np.ndarray:
        """Each language weighs the same, however many names it has here."""
        return sum(shares(np.stack([counted(v, FIELD_BITS) for v in views("\x03\x02".join(of(x)))])) for x in LANGUAGES) / len(LANGUAGES)

    def quote_shares(lines: str, x: str) -> np.ndarray:
        """Half plain prose, so that common words speak for neither side."""
        marked = re.sub(r"(?<![A-Za-z])F(?![A-Za-z])", SLOT, lines)
        own, plain = (shares(counted(points("\n".join(map(normal, t))), FIELD_BITS)) for t in (marked.split(";"), [seeds.PROSE[x]]))
        return (own + plain) / 2

    def content(lines: list[str]) -> np.ndarray:
        return shares(counted(points("\n".join(map(normal, lines)))))

    fields = np.log((field_shares(seeds.fields) + FIELD_FLOOR) / (field_shares(seeds.asides) + FIELD_FLOOR)).astype(np.float32)
    quotes = {x: np.log((quote_shares(seeds.QUOTES[x], x) + QUOTE_FLOOR) / (quote_shares(seeds.SLOTS[x], x) + QUOTE_FLOOR)).astype(np.float32) for x in LANGUAGES}
    latin = seeds.LATIN.strip().split("\n") * 4
    return fields, quotes, {x: (content(seeds.filler(x) + latin), content(seeds.notices(x)), content(seeds.prose(x))) for x in LANGUAGES}


@dataclass
class Models:
    """Tables of log likelihood ratios: of content by language, (order, place, kind of residue); of fields; of quotes by
    language."""

    residue: dict[str, np.ndarray]
    fields: np.ndarray
    quotes: dict[str, np.ndarray]
    known: dict[str, bool] = field(default_factory=dict)

    def coverage(self, text: str, language: str | None = None) -> float:
        """Share of a text's characters in windows that are residue; 0 for a text without any."""
        codes, table = points(normal(text)), self.residue[language or language_of(text)]
        covered, total = 0, len(codes)
        for at in range(0, total, CHUNK):
            part = codes[max(0, at - WINDOW) : at + CHUNK + WINDOW + ORDERS[-1]]
            scores = np.zeros((len(part) + 1, table.shape[2]), dtype=np.float64)
            for rows, g in zip(table, grams(part), strict=True):
                scores[1 : len(g) + 1] += rows.take(g, axis=0)
            np.cumsum(scores, axis=0, out=scores)
            w = min(WINDOW, len(part))
            hit = (scores[w:] - scores[:-w]).max(axis=1) >= LEAST_RATIO * w * len(ORDERS)
            if not hit.any():
                continue
            hits = np.concatenate([[0], np.cumsum(hit)])  # a position is covered if one of the w windows that hold it is a hit
            mask = hits[np.minimum(np.arange(1, len(part) + 1), len(hit))] > hits[np.maximum(np.arange(len(part)) - w + 1, 0)]
            first = min(at, WINDOW)
            covered += int(mask[first : first + min(CHUNK, total - at)].sum())
        return covered / total if total else 0.0

    def is_field(self, span: str) -> bool:
        if span not in self.known:
            mean = 0.0
            for codes, table in zip(views(span), self.fields, strict=True):
                for row, g in zip(table, grams(codes, FIELD_BITS), strict=True):
                    mean += float(row[g].sum()) / max(1, len(g))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[span] = mean >= LEAST_FIELD * len(ORDERS) * len(self.fields)
        return self.known[span]

    def unfilled(self, text: str, language: str | None = None) -> int:
        """How many template fields stand in the text unfilled; those in a sentence that quotes them don't count."""
        parts, last = [], 0
        for m in CANDIDATE.finditer(text):
            if self.is_field(m.group()):
                parts += [text[last : m.start()], SLOT]
                last = m.end()
        if not last:
            return 0
        around = normal("".join(parts) + text[last:], lines=True)
        codes, table = points(around), self.quotes[language or language_of(text)]
        sums = np.zeros(len(codes) + 1)
        for at in range(0, len(codes), CHUNK):
            for row, g in zip(table, grams(codes[at : at + CHUNK + ORDERS[-1] - 1], FIELD_BITS), strict=True):
                g = g[:CHUNK]
                sums[at + 1 : at + 1 + len(g)] += row[g]
        sums = np.cumsum(sums) / len(ORDERS)
        ends, n = [m.end() for m in SENTENCE_END.finditer(around)], 0
        for m in re.finditer(SLOT, around):
            k = bisect_right(ends, m.start())
            n += bool(sums[ends[k] if k < len(ends) else len(around)] - sums[ends[k - 1] if k else 0] < LEAST_QUOTE)
        return n

    def is_residue(self, text: str) -> bool:
        x = language_of(text)
        return self.unfilled(text, x) > 0 or self.coverage(text, x) >= LEAST_COVER


def models_of(prose: dict[str, np.ndarray]) -> Models:
    """Models from the seeds and, by language, the n-gram counts of the corpus; a language of which the corpus has nothing
    knows the seeds' prose only."""
    fields, quotes, content = _seed_models()
    residue = {}
    for x in LANGUAGES:
        *kinds, known = content[x]
        part = max(KNOWN_PROSE, KNOWN_GRAMS / (KNOWN_GRAMS + prose[x][0].sum()))
        natural = (1 - part) * shares(prose[x]) + part * known + FLOOR
        residue[x] = np.stack([np.log(1 - SEEDED + SEEDED * k / natural) for k in kinds], axis=2).astype(np.float32)
    return Models(residue, fields, quotes)


def _table() -> np.ndarray:
    return np.zeros((len(LANGUAGES), len(ORDERS), 1 << BITS), dtype=np.int64)


def tally(texts: Iterable[str], table: np.ndarray) -> None:
    """Adds the n-grams of the texts. None spans two of them, so that it doesn't matter which are counted together."""
    by: dict[str, list[np.ndarray]] = {}
    for t in texts:
        by.setdefault(language_of(t), [APART]).extend((points(normal(t)), APART))
    for x, codes in by.items():
        own = counted(np.concatenate(codes))
        for row, g in zip(own, grams(np.zeros(ORDERS[-1], dtype=np.uint32)), strict=True):
            row[g] = 0  # what is between texts only
        table[LANGUAGES.index(x)] += own


def fit(texts: list[str]) -> Models:
    """Models of texts in memory."""
    table = _table()
    tally({normal(t): t for t in texts}.values(), table)
    return models_of(dict(zip(LANGUAGES, table, strict=True)))


#: Places in a row of counts.
PLACES = 1 << 11
COUNTS = "part int, h bigint, h2 bigint, counts binary, text string"
COUNTS_ARROW = pa.schema([("part", pa.int32()), ("h", pa.int64()), ("h2", pa.int64()), ("counts", pa.binary()), ("text", pa.string())])


def _packed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Counts as rows of PLACES places; what is all 0 is left out."""
    kept = [(k, zlib.compress(v.tobytes(), 1)) for k, v in sums.items() if v.any()]
    columns = [pa.array([k for k, _ in kept], pa.int32()), *[pa.nulls(len(kept), pa.int64())] * 2, pa.array([v for _, v in kept], pa.binary()), pa.nulls(len(kept), pa.string())]
    return pa.RecordBatch.from_arrays(columns, schema=COUNTS_ARROW)


def _slices(table: np.ndarray) -> dict[int, np.ndarray]:
    return dict(enumerate(table.reshape(-1, PLACES)))


def plain_text(text: Column) -> Column:
    """In lower case, with single spaces, digits as 0: what copies of a text have in common."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"(?U)\s+", " "), r"(?U)\d", "0")


def prose_counts(texts: DataFrame) -> dict[str, np.ndarray]:
    """By language the n-gram counts of a table with a column ``text`` without nulls, each distinct plain_text() once. Texts that don't repeat are counted where they are read; of the others each task passes
    on one copy. Tasks are few, so the tables they send don't grow with the data."""
    spark = texts.sparkSession
    keyed = texts.select(plain_text(F.col("text")).alias("text")).select(F.xxhash64("text").alias("h"), F.xxhash64("text", F.lit(1)).alias("h2"), "text")
    shared = spark.sparkContext.broadcast(repeats(keyed.select("h", "h2")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Repeats = shared.value
        table, seen = _table(), set()
        for b in batches:
            again = found.may_repeat(b.column("h").to_numpy())
            tally((t for t, twice in zip(b.column("text").to_pylist(), again.tolist(), strict=True) if not twice), table)
            fresh = []
            for k in np.flatnonzero(again).tolist():
                key = (b.column("h")[k].as_py(), b.column("h2")[k].as_py())
                if key not in seen:
                    fresh.append(k)
                    seen.add(key)
            if len(seen) > REMEMBERED:
                seen.clear()
            if fresh:
                own = b.take(pa.array(fresh))
                n = own.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([-1] * n, pa.int32()), own.column("h"), own.column("h2"), pa.nulls(n, pa.binary()), own.column("text").cast(pa.string())], schema=COUNTS_ARROW)
        yield _packed(_slices(table))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by part, h, h2: sums of the counts, and of the texts among them, each once."""
        sums: dict[int, np.ndarray] = {}
        table, last = None, None
        for b in batches:
            once = []
            for part, h, h2, counts, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part < 0:
                    if (h, h2) != last:
                        once.append(text)
                    last = (h, h2)
                else:
                    own = np.frombuffer(zlib.decompress(counts), dtype=np.int64)
                    sums[part] = sums[part] + own if part in sums else own
            if once:
                table = _table() if table is None else table
                tally(once, table)
        if table is not None:
            for part, own in _slices(table).items():
                sums[part] = sums[part] + own if part in sums else own
        yield _packed(sums)

    counts = keyed.coalesce(4 * spark.sparkContext.defaultParallelism).mapInArrow(count, COUNTS)
    counts = counts.repartition("part", "h").sortWithinPartitions("part", "h", "h2").mapInArrow(add, COUNTS)
    rows = counts.repartition("part").mapInArrow(add, COUNTS).select("part", "counts").toArrow()
    table = _table()
    flat = table.reshape(-1, PLACES)
    for part, own in zip(rows["part"].to_pylist(), rows["counts"].to_pylist(), strict=True):
        flat[part] += np.frombuffer(zlib.decompress(own), dtype=np.int64)
    shared.destroy()
    return dict(zip(LANGUAGES, table, strict=True))


def residue(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fields`` (unfilled template fields), ``coverage`` (share of residue windows), ``is_residue``.

    One row for each row with an id. Null and empty texts, and those of white space, have 0 and 0 and are no residue.
    Texts are scored whole, whatever their length. Other columns are not read. On an empty table the models are those of
    the seeds.
    """
    rows = documents.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    models = models_of(prose_counts(rows.where(F.length(F.trim("text")) > 0).select("text")))
    shared = documents.sparkSession.sparkContext.broadcast(models)  # tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Models = shared.value
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            spoken = [language_of(t) for t in texts]
            fields, cover = [m.unfilled(t, x) for t, x in zip(texts, spoken, strict=True)], [m.coverage(t, x) for t, x in zip(texts, spoken, strict=True)]
            verdict = [f > 0 or c >= LEAST_COVER for f, c in zip(fields, cover, strict=True)]
            yield pa.record_batch([b.column("doc_id"), pa.array(fields, pa.int64()), pa.array(cover, pa.float64()), pa.array(verdict, pa.bool_())], ["doc_id", "fields", "coverage", "is_residue"])

    return rows.mapInArrow(run, "doc_id bigint, fields bigint, coverage double, is_residue boolean")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return residue(read_table(spark, d, "documents")).where("is_residue").select("doc_id")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return residue(read_table(spark, d, "documents"))


SQL: dict[str, str] = {}
QUERIES = {"p9_found": p9_found, "p9_scores": p9_scores}
