"""Quality rules by distribution divergence (operator 7).

One pass over the texts takes plain counts (words, symbols, repeated lines and
repeated 5-word windows) and two histograms of fixed width: character classes
and common words. The histograms of the documents that pass the base rules are
summed by language over the whole corpus and give the language references: one
row for each name in ``LANGUAGES``, and for every other language in at least
``MIN_ROWS`` such documents (the ``MAX_LANGUAGES`` most frequent, so their size
is bounded). A document is then compared with every reference by Jensen-Shannon
distance; it is dropped if even the nearest is farther than the limits. Short
texts, whose histograms say little, and documents of a named language without a
reference are left to the base rules (``MIN_CHARS``, ``MIN_WORDS``).

Edge cases: null and empty texts have no words and fail the base rules; without
any reference (empty corpus) nothing is dropped by distance; repeated rows are
judged alike; a null or blank language adds to no reference but is judged; a language
without a reference has distances of 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.scan import map_texts
from pageflow.session import scratch_path

MIN_BASE_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_CHARS, MIN_WORDS = 200, 40
#: Jensen-Shannon distances (0 to 1) over which a document is unlike the language.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.45

#: Documents from which a language not in ``LANGUAGES`` has a reference, and how many such languages at most.
MIN_ROWS, MAX_LANGUAGES = 100, 200

# Frequent function words of each language.
LANGUAGES = {
    "en": "the of and to in is on with by be for that this are was from or as at it an a not have has which but they",
    "fr": "de la le les des du en et un une que qui est dans pour par sur au aux pas plus avec ce il elle ne se sont",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er aus bei nach",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha",
}
_COMMON = {w.encode(): i for i, w in enumerate(dict.fromkeys(" ".join(LANGUAGES.values()).split()))}
N_COMMON = len(_COMMON) + 1  # the last bin: all other words
_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _OTHER, _WIDE = range(8)
N_CLASSES, _REST = 8, 8  # class 8: continuation bytes, not counted
SYMBOLS = b"#*$%&|<>"


def _byte_classes() -> np.ndarray:
    """Class of each byte of UTF-8; a character beyond ASCII counts once, at its first byte."""
    table = np.full(256, _OTHER, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = _SPACE
    table[97:123], table[65:91], table[48:58] = _LOWER, _UPPER, _DIGIT
    table[list(b".,;:!?'\"()-")] = _STOP
    table[list(SYMBOLS)] = _SYMBOL
    table[0x80:0xC0], table[0xC0:] = _REST, _WIDE
    return table


_CLASS = _byte_classes()


def repeated_window_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that are found twice or more (``ids``: dense word numbers)."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    codes, base = ids[:n].astype(np.int64), int(ids.max()) + 1
    for k in range(1, window):
        if int(codes.max()) + 1 > (1 << 62) // base:  # dense again, so that the next step can't overflow
            codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        codes = codes * base + ids[k:k + n]
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    again = (counts > 1)[inverse]
    marks = np.zeros(len(ids) + 1, np.int64)
    marks[:n] += again
    marks[window:] -= again[: len(ids) + 1 - window]
    return int((np.cumsum(marks) > 0).sum())


def measures(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class histogram, common-word histogram)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    classes = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]
    words = data.split()
    common = np.zeros(N_COMMON, np.int64)
    dup_lines = repeats = 0
    if words:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        get = _COMMON.get
        bins = np.fromiter((get(w.lower().strip(b".,;:!?'\"()-"), N_COMMON - 1) for w in number), np.int64, len(number))
        common = np.bincount(bins[ids], minlength=N_COMMON)
        repeats = repeated_window_words(ids)
        lines = [x for x in data.split(b"\n") if x.strip()]
        dup_lines = len(lines) - len(set(lines))
    return (len(words), int(classes.sum() - classes[_SPACE]), int(classes[_SYMBOL]), dup_lines, repeats, classes, common)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of ``p`` to ``q``; both hold counts, no row is all 0."""
    p = p / p.sum(axis=-1, keepdims=True)
    q = q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.maximum(0, (left + right) / 2))


_FEATURES = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, classes array<long>, common array<long>")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts and histograms of every whole text."""

    def run(batches):
        for b in batches:
            rows = [measures(t) for t in b.column("text").to_pylist()]
            longs = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            lists = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (5, 6)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), *longs, *lists], [
                "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "common"])

    return map_texts(docs, {"doc_id": F.col(f"`{id_col}`").cast("long"), "lang": F.col(f"`{lang_col}`").cast("string"),
                            "text": text_col}, _FEATURES, run)


def base_failed():
    return ((F.col("n_words") < MIN_BASE_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def references(found: DataFrame) -> DataFrame:
    """Per language: the summed histograms of all documents that pass the base rules (at most so many rows as languages
    in ``LANGUAGES`` and ``MAX_LANGUAGES`` more)."""
    sums = [F.sum(F.col("classes")[i]).alias(f"a{i}") for i in range(N_CLASSES)]
    sums += [F.sum(F.col("common")[i]).alias(f"b{i}") for i in range(N_COMMON)]
    known = F.col("lang").isin(*LANGUAGES)
    by_lang = found.where(~base_failed() & (F.trim("lang") != "")).groupBy("lang").agg(*sums, F.count("*").alias("n"))
    return (by_lang.where(known | (F.col("n") >= MIN_ROWS)).orderBy(known.desc(), F.col("n").desc(), "lang")
            .limit(len(LANGUAGES) + MAX_LANGUAGES))


def judge(found: DataFrame, languages: list) -> DataFrame:
    """Adds char_distance and word_distance (to the nearest reference), base_failed and kept."""
    refs = [(np.array(r[1:1 + N_CLASSES], float), np.array(r[1 + N_CLASSES:1 + N_CLASSES + N_COMMON], float)) for r in languages]
    refs = [(a, b) for a, b in refs if a.sum() and b.sum()]
    named = {*LANGUAGES, *(r["lang"] for r in languages)}

    def nearest(column, k: int) -> np.ndarray:
        counts = np.array(column.to_pylist(), float)
        counts[counts.sum(axis=1) == 0, -1] = 1  # nothing to count: these fail the base rules anyway
        return np.min([distance(counts, r[k]) for r in refs], axis=0) if refs else np.zeros(len(counts))

    def run(batches):
        for b in batches:
            if b.num_rows:
                judged = np.array([x in named or not (x or "").strip() for x in b.column("lang").to_pylist()])
                far = [np.where(judged, nearest(b.column(c), k), 0.0) for k, c in enumerate(("classes", "common"))]
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], *map(pa.array, far)],
                                                 [*b.schema.names[:-2], "char_distance", "word_distance"])

    schema = _FEATURES.rpartition(", classes")[0] + ", char_distance double, word_distance double"
    unlike = (((F.col("word_chars") >= MIN_CHARS) & (F.col("char_distance") > MAX_CHAR_DISTANCE))
              | ((F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)))
    judged = found.mapInArrow(run, schema).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & ~unlike)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every document. The counts are written once to the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark, "quality")
    features(docs, id_col, text_col, lang_col).write.parquet(path)
    found = spark.read.parquet(path)
    return judge(found, sorted(references(found).collect(), key=lambda r: r["lang"]))
