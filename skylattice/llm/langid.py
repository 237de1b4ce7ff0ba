"""Language identification of documents that may mix languages.

Training counts character trigrams per language over all training documents; every task
counts its own documents in numpy and Spark adds the partial counts up. The model is a
table of a fixed number of bins per language, so its size does not depend on the data.

A document is a mixture: each word comes from one of the languages, with a probability per
language from the n-grams of the word, or from a noise source. Noise is flat at a level that
follows the word's likeliest language, as wide alphabets have less likely trigrams than small
ones. Expectation-maximisation
estimates the proportions. The languages present are those of the set with the best
penalised likelihood: starting from the best single one, a language is added while the
likelihood gains more than the penalty.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm.text import documents, slices

BINS = 1 << 16  # bins of hashed n-grams per language
SMOOTHING = 0.5
NOISE = 3.2  # how far noise is below a language's own mean log-likelihood of a trigram
STEPS = 25  # of expectation-maximisation
PENALTY = 3.0  # of a further language, times the logarithm of the number of words
PROBE = 0.02  # proportion at which a further language is tested first
CHUNK_CHARS = 400_000  # text handled in one go inside a task; a longer text goes alone
HELD_OUT = 2
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    """Which code points are letters, built once per Python process."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all trigrams, where words begin among them, and the text of each word.

    Text is lower-cased and reduced to words of letters with a space on each side, so each
    letter is the middle of one trigram.
    """
    lower = [t.lower() for t in texts]
    codes = np.frombuffer(f" {' '.join(lower)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letters()[codes], codes, np.uint32(32))
    borders = np.cumsum([len(t) + 1 for t in lower])
    middle = np.flatnonzero(codes != 32)
    before = codes[middle - 1].astype(np.uint64)
    h = before * np.uint64(0x9E3779B97F4A7C15) + codes[middle]
    h = h * np.uint64(0x9E3779B97F4A7C15) + codes[middle + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    begin = np.flatnonzero(before == 32)
    return (h >> np.uint64(48)).astype(np.int64), begin, np.searchsorted(borders, middle[begin], side="right")


def chunks(texts):
    """Consecutive texts as lists of about ``CHUNK_CHARS`` characters, with their positions."""
    some, at, size = [], [], 0
    for i, text in texts:
        if some and size + len(text) > CHUNK_CHARS:
            yield at, some
            some, at, size = [], [], 0
        some.append(text)
        at.append(i)
        size += len(text)
    if some:
        yield at, some


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == HELD_OUT


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and log-probabilities of shape (bins, languages).

    Learns from the rows whose text and lang are not null. At most languages x bins partial
    sums reach the driver, whatever the size of the data.
    """

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                bins = sums.setdefault(lang, np.zeros(BINS, np.int64))
                for _, some in chunks(enumerate(texts)):
                    bins += np.bincount(trigrams(some)[0], minlength=BINS)
        for lang, bins in sums.items():
            at = np.flatnonzero(bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(bins[at])],
                ["lang", "bin", "n"],
            )

    rows = docs.where("text is not null and lang is not null")
    rows = rows.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = rows.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.zeros((BINS, len(langs)))
    counts[found["bin"], found["lang"].map({x: i for i, x in enumerate(langs)})] = found["n"]
    used = max(1, int((counts.sum(1) > 0).sum()))
    total = counts.sum(0)
    return langs, np.log((counts + SMOOTHING) / (total + SMOOTHING * used))


def noise_levels(model: np.ndarray) -> np.ndarray:
    """Log-likelihood of a trigram of noise per language, at least that of a uniform bin.

    Trigrams in uniform bins are at most that likely under any language on average.
    """
    seen = np.exp(model) - np.exp(model.min(0))  # in proportion to the counts of training
    total = seen.sum(0)
    mean = np.where(total > 0, (seen * model).sum(0) / np.where(total > 0, total, 1), -np.inf)
    return np.maximum(mean - NOISE, -np.log(BINS))


def by_doc(values, starts):
    return np.add.reduceat(values, starts, axis=-1)


def mixture(like, doc, allowed):
    """Proportions and log-likelihood of each document over the sources it is allowed.

    like: (sources, words), scaled so that the best source of a word has 1; words of a
    document are adjacent and numbered by ``doc``. allowed: (sources, documents).
    """
    n = allowed.shape[1]
    starts, size = np.searchsorted(doc, np.arange(n)), np.bincount(doc, minlength=n)
    share = allowed / allowed.sum(0)
    for _ in range(STEPS):
        part = like * share[:, doc]
        part /= np.maximum(part.sum(0), 1e-30)
        share = by_doc(part, starts) / size
    return share, by_doc(np.log(np.maximum((like * share[:, doc]).sum(0), 1e-30)), starts)


def bounds(like, doc, share):
    """The most that a document's log-likelihood could gain from each further source.

    The likelihood is concave in the proportion of a new source, so its tangent at one
    small proportion bounds the gain at all of them.
    """
    starts = np.searchsorted(doc, np.arange(share.shape[1]))
    base = np.zeros(like.shape[1], np.float32)
    for part, weight in zip(like, share):
        base += part * weight[doc]
    base = 1 / np.maximum(base, np.float32(1e-30))
    out = np.empty(share.shape)
    for s, part in enumerate(like):
        mixed = part * base
        mixed *= np.float32(PROBE)
        mixed += np.float32(1 - PROBE)
        gain = by_doc(np.log(mixed).astype(np.float64), starts)
        np.divide(1, mixed, out=mixed)
        # sum of (ratio - 1) / mixed, with ratio = (mixed - 1 + PROBE) / PROBE
        slope = (np.bincount(doc, minlength=share.shape[1]) - by_doc(mixed.astype(np.float64), starts)) / PROBE
        out[s] = gain + np.where(slope > 0, slope * (1 - PROBE), -slope * PROBE)
    out[share > 0] = -np.inf
    return out


def infer(like: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Proportions of the chosen sources, one column per document.

    like: log-likelihoods (sources, words). A set of k sources costs
    ``PENALTY * k * log(words)``; sets grow by the source that gains most.
    """
    sources = len(like)
    scaled = like - like.max(0)
    starts = np.searchsorted(doc, np.arange(n))
    cost = PENALTY * np.log(np.bincount(doc, minlength=n) + 1)
    alone = by_doc(scaled.astype(np.float64), starts)
    np.exp(np.maximum(scaled, -60), out=scaled)
    share = np.eye(sources)[:, alone.argmax(0)]
    value = alone.max(0)
    open_, words, local = np.arange(n), scaled, doc
    while len(open_):
        old, old_share = value[open_], share[:, open_]
        best, best_share = np.full(len(open_), -np.inf), old_share.copy()
        hope = bounds(words, local, old_share) > cost[open_]
        for s in range(sources):
            some = np.flatnonzero(hope[s])
            if not len(some):
                continue
            sub = hope[s][local]
            trial = (old_share[:, some] > 0).astype(np.float32)
            trial[s] = 1
            got, fit = mixture(words[:, sub], np.searchsorted(some, local[sub]), trial)
            better = fit > best[some]
            best[some[better]], best_share[:, some[better]] = fit[better], got[:, better]
        gained = best - old > cost[open_]
        value[open_[gained]], share[:, open_[gained]] = best[gained], best_share[:, gained]
        pick = gained[local]
        words, local = words[:, pick], np.searchsorted(np.flatnonzero(gained), local[pick])
        open_ = open_[gained]
    return share


def _labeller(spark: SparkSession, langs: list[str], model: np.ndarray):
    """A function from texts to their main language, its share, and all shares."""
    # Spark sends the model, of fixed size, to each executor once
    shared = spark.sparkContext.broadcast(model.T.astype(np.float32).copy())
    level = noise_levels(model).astype(np.float32)

    def label(texts):
        names, score, sets = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        usable = ((i, t) for i, t in enumerate(texts) if langs and t and any(map(str.isalpha, t)))
        for at, some in chunks(usable):
            bins, begin, doc = trigrams(some)
            like = np.stack([np.add.reduceat(t[bins], begin) for t in shared.value])
            alone = by_doc(like.astype(np.float64), np.searchsorted(doc, np.arange(len(some))))
            noise = level[like.argmax(0)] * np.diff(np.append(begin, len(bins)))
            like = np.concatenate([like, noise[None].astype(np.float32)])
            for i, row, single in zip(at, infer(like, doc, len(some)).T, alone.T):
                # under noise alone no language has a share: the likeliest one then
                best = int((row[: len(langs)] if row[: len(langs)].any() else single).argmax())
                names[i], score[i] = langs[best], min(1.0, row[best])
                sets[i] = [(langs[k], float(row[k])) for k in np.flatnonzero(row[: len(langs)] > 0)]
        return names, score, sets

    return label


def identify(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` per document.

    ``lang_pred`` is the language of the largest proportion, ``score`` that proportion,
    ``languages`` all proportions of the chosen set. Where all is noise, ``lang_pred`` is the
    likeliest language and ``score`` 0. A null text, one without letters, or a
    model without languages gives ``und`` with score 0. Repeated rows are labelled alike.
    Other columns are ignored; an empty table gives no rows.
    """
    label = _labeller(docs.sparkSession, langs, model)

    def run(batches):
        for batch in slices(batches):
            names, score, sets = label(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array(score),
                    pa.array(sets, pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "lang_pred", "score", "languages"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, languages map<string,double>")


def keep_known(docs: DataFrame, langs: list[str], model: np.ndarray, least: float = 0.5) -> DataFrame:
    """The documents of which at least the share ``least`` is in languages of the model.

    Texts that mix known languages stay; noise, texts without letters and null texts go.
    All columns are kept.
    """
    label = _labeller(docs.sparkSession, langs, model)

    def run(batches):
        for batch in slices(batches):
            _, _, sets = label(batch.column("text").to_pylist())
            known = [sum(share for _, share in found) >= least for found in sets]
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out_identify(docs: DataFrame) -> DataFrame:
    """Learns from three quarters of the documents and labels all of them."""
    langs, model = train(docs.where(~held_out("doc_id")))
    return identify(docs, langs, model).withColumn("held_out", held_out("doc_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_identify(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "lang_pred", "score", "languages"
    )
