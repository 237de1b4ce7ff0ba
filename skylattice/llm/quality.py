"""Quality rules: fixed limits first, then boosted trees over document statistics.

Statistics are counted per document inside the task that reads it; no row is moved. The
trees are fitted on the driver on at most ``sample`` labelled documents and reach the tasks
as node arrays of a few kilobytes.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import boosting
from skylattice.llm.text import documents, hash_table, hashes, window_hashes, words_of

SAMPLE = 8192  # labelled documents the trees are fitted on, at most
KEEP = 0.5  # least score of a kept document
REPEAT_WINDOW = 8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the trees, and whether the score may only fall as the feature grows.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "capital_share": -1,
    "exclamation_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "letter_share": 0,
    "digit_share": 0,
    "stop_share": 0,
}
SYMBOLS = re.compile(r"[#*$%&|<>]")
LETTERS = re.compile(r"[^\W\d_]")
DIGITS = re.compile(r"\d")
CAPITALS = re.compile(r"[A-Z]")
STOP_LENGTH = 3  # short words stand for function words of any language


def statistics(text: str, table) -> tuple[list[int], list[float]]:
    """The base counts of ``BASE`` and the features of one text.

    Code points inside words are counted, so white space never is. An empty text has
    zeros everywhere.
    """
    words = words_of(text)
    n = len(words)
    if not n:
        return [0] * len(BASE), [0.0] * len(FEATURES)
    compact = b"".join(words).decode("utf-8", "surrogatepass")
    chars = len(compact)
    symbols = len(SYMBOLS.findall(text))
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").split()]
    dup_lines = len(lines) - len(set(lines))
    h = hashes(table, words)
    repeat = 0
    if n >= REPEAT_WINDOW:
        windows = window_hashes(h, REPEAT_WINDOW)
        _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[where] > 1)
        if len(starts):
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + REPEAT_WINDOW, -1)
            repeat = int((np.cumsum(edge)[:n] > 0).sum())
    counts = Counter(words)
    letters = len(LETTERS.findall(compact))
    features = [
        float(np.log1p(n)),
        chars / n,
        symbols / n,
        dup_lines / max(1, len(lines)),
        repeat / n,
        len(CAPITALS.findall(compact)) / max(1, letters),
        compact.count("!") / n,
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        letters / chars,
        len(DIGITS.findall(compact)) / chars,
        sum(c for w, c in counts.items() if len(w) <= STOP_LENGTH) / n,
    ]
    return [n, chars, symbols, dup_lines, repeat], features


def document_statistics(docs: DataFrame, model: boosting.Trees | None = None) -> DataFrame:
    """``doc_id``, the base counts, and the features or, with a model, the score."""
    out = "features array<double>" if model is None else "score double"

    def count(batches):
        table = hash_table()
        for batch in batches:
            found = [statistics(t or "", table) for t in batch.column("text").to_pylist()]
            base = np.array([b for b, _ in found], np.int64).reshape(-1, len(BASE))
            features = np.array([f for _, f in found]).reshape(-1, len(FEATURES))
            last = (
                pa.array(features.tolist(), pa.list_(pa.float64()))
                if model is None
                else pa.array(model.score(features))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(base[:, i]) for i in range(len(BASE))), last],
                ["doc_id", *BASE, "features" if model is None else "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(count, f"doc_id long, {', '.join(f'{c} long' for c in BASE)}, {out}")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Trees:
    """Trees for ``quality`` fitted on at most ``sample`` labelled documents.

    The sample takes the smallest hashes of ids, the same at every run. Labels without id
    or quality are left out; labels of an id that disagree count as their mean, rounded.
    Without labels every document scores one half.
    """
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.round(F.avg("quality")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # at most `sample` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    found = document_statistics(rows).join(F.broadcast(chosen), "doc_id").select("doc_id", "features", "quality")
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    x = np.array(found["features"].tolist()).reshape(-1, len(FEATURES))
    return boosting.fit(x, found["quality"].to_numpy(float), monotone=list(FEATURES.values()))


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed``, ``score``, ``kept``.

    Null texts count as empty and fail the base rules (fewer than 20 words). Repeated rows
    are judged alike, each on its own. Other columns of ``docs`` are ignored; an empty
    table gives no rows.
    """
    scored = document_statistics(docs, fit(docs, labels, sample))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= keep)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(documents(spark, sf_dir), labels).select(
        "doc_id", *BASE, "base_failed", "kept", "score"
    )
