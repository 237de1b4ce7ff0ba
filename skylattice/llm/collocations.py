"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: every word with the words that follow it in its piece,
lead columns padded with the empty string past the end of the piece. A window's first words
are a phrase that begins there, so the count of a shorter phrase is the sum over the windows
that it leads. The text is exploded once, whatever the longest length.

A task counts its windows some millions at a time, sums shorter phrases from them, and sends
each different phrase once, to a bucket by its hash. Most windows are different and do not
get fewer; so they move as columns of codes, in order and compressed, with the words of the
codes: a few bytes each. A phrase that a third of the corpus repeats is one row per task, and
a bucket has no more of it than the tasks. All later steps work on phrases that are frequent
enough: a part of a candidate is at least as frequent as the candidate.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.llm.text import block_count, documents, mix, whole
from skylattice.session import settle

LONGEST = 3  # words of the longest candidate
LEAST = 10  # occurrences of a candidate
INSIDE = 50  # per cent of its occurrences inside one longer candidate that drop a phrase
TOP = 2000
SCALE = 1_000_000  # scores are whole numbers of this part of one
SHARES = 256  # parts of a language that are ranked before the language is
AT_ONCE, AT_ONCE_BYTES = 1 << 21, 1 << 27  # windows, and their bytes, that a task counts at a time
BUCKET_CHARS = 16_000_000  # text whose phrases meet in one bucket
BASE = 0x9E3779B97F4A7C15  # of a phrase's polynomial hash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENDS = ".,;:!?\n\x0b\f\r"  # end a piece; no word holds one, so a lone "." can stand for them


def windows(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, w1, w2, ...``: a row per word, with the words after it in its piece.

    A null language is ``und``. A null, empty or wordless text has no rows. Columns other than
    ``text`` and ``lang`` are ignored.
    """
    marked = F.replace(F.translate(whole(), UPPER + ENDS, LOWER + "." * len(ENDS)), F.lit("."), F.lit(" . "))
    tokens = F.split(marked, r"[\x20\x09]+")
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        tokens.alias("tokens"),
    )
    lead = [F.slice("tokens", k, F.size("tokens")).alias(f"t{k}") for k in range(1, longest + 1)]
    found = rows.select("lang", *lead).select("lang", F.inline(F.arrays_zip(*[f"t{k}" for k in range(1, longest + 1)])))

    def ends(k: int) -> Column:
        return F.col(f"t{k}").isNull() | F.col(f"t{k}").isin("", ".")

    shown, over = [F.col("t1").alias("w1")], F.lit(False)
    for k in range(2, longest + 1):
        over = over | ends(k)
        shown.append(F.when(over, "").otherwise(F.col(f"t{k}")).alias(f"w{k}"))
    return found.where(~ends(1)).select("lang", *shown)


def begins(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def added(columns: list[np.ndarray], f: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows in order, each with the sum of its counts; not for empty columns."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    at = begins(columns)
    return [c[at] for c in columns], np.add.reduceat(f[order], at)


def coded(column) -> tuple[np.ndarray, pa.Array, int]:
    """The codes of a column of strings, their strings, and the code of the empty string."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column if pa.types.is_dictionary(column.type) else column.dictionary_encode()
    strings = column.dictionary
    empty = pc.index(strings, "").as_py()
    if empty < 0:
        empty, strings = len(strings), pa.concat_arrays([strings, pa.array([""])])
    return column.indices.to_numpy(), strings, empty


def send_phrases(table: pa.Table, buckets: int) -> pa.RecordBatch:
    """``bucket, data``: the phrases of some windows with their counts, packed by hash.

    A phrase that is shorter than the longest is padded by empty strings.
    """
    columns, strings, empty = map(list, zip(*(coded(table.column(c)) for c in table.column_names)))
    columns, f = added(columns, np.ones(table.num_rows, np.int64))
    parts, counts = [], []
    for k in range(len(columns) - 1, 0, -1):  # windows are in order, so each phrase is one run
        at = begins(columns[: k + 1])
        f_at, at = np.add.reduceat(f, at)[columns[k][at] != empty[k]], at[columns[k][at] != empty[k]]
        parts.append([c[at] if j <= k else np.full(len(at), empty[j], c.dtype) for j, c in enumerate(columns)])
        counts.append(f_at)
    columns, f = [np.concatenate(c) for c in zip(*parts)], np.concatenate(counts)
    h = np.zeros(len(f), np.uint64)
    for c, some in zip(columns, strings):
        of = np.array([xxhash.xxh3_64_intdigest(x) for x in some.cast(pa.binary()).to_pylist()], np.uint64)
        h *= np.uint64(BASE)
        h += of[c]
    bucket = (mix(h) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = begins([bucket])
    options, pieces = pa.ipc.IpcWriteOptions(compression="zstd"), []
    for rows in np.split(order, at[1:]):
        arrays = [pa.array(f[rows])]
        for c, some in zip(columns, strings):
            used, local = np.unique(c[rows], return_inverse=True)
            arrays.append(pa.DictionaryArray.from_arrays(pa.array(local.astype(np.int32)), some.take(pa.array(used))))
        piece, sink = pa.RecordBatch.from_arrays(arrays, ["f", *table.column_names]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, piece.schema, options=options) as writer:
            writer.write_batch(piece)
        pieces.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(pieces, pa.binary())], ["bucket", "data"])


def meet_phrases(table: pa.Table, least: int) -> pa.Table:
    """``lang, phrase, words, f`` of a bucket: frequent phrases, and a row of 0 words per language
    with the count of all words, frequent or not, that meet here."""
    found = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in table.column("data").to_pylist()])
    found = found.unify_dictionaries()
    columns, strings, empty = map(list, zip(*(coded(found.column(c)) for c in found.column_names[1:])))
    columns, f = added(columns, found.column("f").to_numpy())
    words = sum((c != e).astype(np.int32) for c, e in zip(columns[1:], empty[1:]))
    out = []
    if (words == 1).any():
        (lang,), n = added([columns[0][words == 1]], f[words == 1])
        out.append((strings[0].take(pa.array(lang)), pa.array([""] * len(n)), 0, n))
    for k in range(1, len(columns)):
        at = np.flatnonzero((words == k) & (f >= least))
        lang, *parts = (some.take(pa.array(c[at])) for c, some in zip(columns[: k + 1], strings))
        out.append((lang, pc.binary_join_element_wise(*parts, " "), k, f[at]))
    return pa.concat_tables([
        pa.table({"lang": lang, "phrase": phrase, "words": pa.array(np.full(len(n), k, np.int32)), "f": n})
        for lang, phrase, k, n in out
    ])


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, phrase, words, f``: the phrases of 1 to ``longest`` words with ``f >= least``.

    A row with an empty phrase of 0 words has the count of all words of the language, whatever
    it is. Words are joined by one space.
    """
    buckets = block_count(docs, BUCKET_CHARS)

    def send(batches):
        held, rows, size = [], 0, 0
        for batch in batches:
            held, rows, size = [*held, batch], rows + batch.num_rows, size + batch.nbytes
            if rows >= AT_ONCE or size >= AT_ONCE_BYTES:
                yield send_phrases(pa.Table.from_batches(held), buckets)
                held, rows, size = [], 0, 0
        if rows:
            yield send_phrases(pa.Table.from_batches(held), buckets)

    sent = windows(docs, longest).mapInArrow(send, "bucket int, data binary")
    schema = "lang string, phrase string, words int, f long"
    met = sent.groupBy("bucket").applyInArrow(lambda t: meet_phrases(t, least), schema)
    # only the counts of all words come from several buckets
    return met.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def _score(a, left, right) -> Column:
    """floor(SCALE * a * a / (l * r)), in whole numbers of up to 38 digits."""
    wide = {"a": a, "l": left, "r": right}
    d = {k: f"cast({v} as decimal(14,0))" for k, v in wide.items()}
    return F.expr(f"({d['a']} * {d['a']} * cast({SCALE} as decimal(7,0))) div ({d['l']} * {d['r']})")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its worst cut, ``n`` the words of
    the language. Ties of the score go to the more frequent phrase, then by the phrase's bytes,
    so ranks are total and repeated rows of the input only count twice. A language without
    candidates has no rows, as has an empty table. Counts below 10^14 are exact.
    """
    counts = settle(frequent_phrases(docs, longest, least), "collocation-counts")
    parts = counts.where("words > 0").select("lang", "phrase", "f")
    found = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))

    # the cuts of a candidate, each with the counts of its two parts
    word = F.split("phrase", " ")
    cut = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(word, F.lit(1), k), " ").alias("first"),
            F.array_join(F.slice(word, k + 1, F.col("words")), " ").alias("rest"),
        ),
    )
    cuts = found.select("lang", "phrase", "words", "a", F.inline(cut))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    scored = cuts.select("lang", "phrase", "a", F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))

    # the most frequent longer candidate around each shorter one
    shorter = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda at: F.array_join(F.slice(word, at, size), " "),
            ),
        )
    )
    longer = found.where("words > 2").select("lang", F.col("a").alias("around"), F.explode(shorter).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(f"around is null or 100 * around < {inside} * a")

    # a language's best are among the best of its shares, so none is ranked in one task
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    rows = rows.withColumn("share", share)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    words = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return rows.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k as words, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from split, (values (1), (2), (3)) as sizes(k) where len(w) >= k),
counts as (select lang, words, phrase, count(*) as f from grams group by all),
total as (select lang, sum(f)::bigint as n from counts where words = 1 group by lang),
found as (select lang, words, phrase, f as a, string_split(phrase, ' ') as w from counts where words > 1 and f >= 10),
cuts as (
  select lang, phrase, words, a, w, k, array_to_string(w[1:k], ' ') as first_part, array_to_string(w[k + 1:words], ' ') as rest
  from found, (values (1), (2)) as places(k) where k < words),
scores as (
  select c.*, x.f as l, y.f as r, (1000000::hugeint * c.a * c.a // (x.f::hugeint * y.f))::bigint as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.first_part
              join counts y on y.lang = c.lang and y.phrase = c.rest),
worst as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
  select lang, phrase, max(a) as around from (
    select lang, array_to_string(w[1:2], ' ') as phrase, a from found where words = 3
    union all select lang, array_to_string(w[2:3], ' '), a from found where words = 3) group by all),
kept as (select c.* from worst c left join around o using (lang, phrase) where o.around is null or 100 * o.around < 50 * c.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000
"""
