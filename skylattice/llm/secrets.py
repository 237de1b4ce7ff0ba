"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query. The index lists, for every
trigram that some query asks for, the documents that contain it. Postings are intersected
within a string, united within a clause and intersected over clauses; the documents left are
candidates, and only these are searched with the rule. A rule without a mandatory trigram
searches all documents. Built of DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm.text import documents, whole
from skylattice.llm.trigrams import clauses, grams
from skylattice.session import settle

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: Rules in order: pattern, the group that is measured, its least length. Fixed formats.
RULES = {
    "assign": (ASSIGN, 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
    "github": ("gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    "slack": ("xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    "google": ("AIza[A-Za-z0-9_-]+", 0, 39),
    "stripe": ("[rs]k_live_[A-Za-z0-9]+", 0, 24),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 36),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
}
BASE = ("assign", "access", "hex")
CHUNK = 256  # spans that are gathered before they are set aside: appending copies what it appends to


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The written index ``trigram, doc_id`` for the given lower-case trigrams.

    Its files are sorted by trigram; the postings of a common one are spread over files.
    Lower-casing the text may only add postings: the patterns decide on the text itself.
    """
    low = F.lower(whole())
    present = F.filter(F.array(*[F.when(low.contains(t), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(present).alias("trigram"))
    return settle(rows.repartition("trigram", "doc_id").sortWithinPartitions("trigram", "doc_id"), "postings")


def candidates(index: DataFrame, queries: dict[str, list[set[str]]]) -> DataFrame:
    """``doc_id, rules``: the rules whose trigram query a document satisfies."""
    spark = index.sparkSession
    asked = [
        (rule, i, string, gram, len(grams(string)))
        for rule, found in queries.items()
        for i, clause in enumerate(found)
        for string in sorted(clause)
        for gram in sorted(grams(string))
    ]
    # as large as the rules, whatever the data
    asked = F.broadcast(spark.createDataFrame(asked, "rule string, clause int, string string, trigram string, need int"))
    strings = index.join(asked, "trigram").groupBy("doc_id", "rule", "clause", "string", "need")
    strings = strings.agg(F.size(F.collect_set("trigram")).alias("got")).where("got = need")
    rules = strings.groupBy("doc_id", "rule").agg(F.size(F.collect_set("clause")).alias("met"))
    sizes = F.create_map(*[F.lit(x) for rule, found in queries.items() for x in (rule, len(found))])
    rules = rules.where(F.col("met") == sizes[F.col("rule")])
    return rules.groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def rule_spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans ``(start, kind, end)`` of a rule's matches, leftmost and not overlapping.

    What lies between matches and the matches themselves add up to their positions, in code
    points. Matches whose measured group is too short are dropped after the search.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    lengths = F.arrays_zip(
        F.transform(between, lambda x: F.length(x)).alias("gap"),
        F.transform(found, lambda x: F.length(x)).alias("size"),
        F.transform(measured, lambda x: F.length(x)).alias("measure"),
    )
    spans = "array<struct<start:int,kind:int,end:int>>"
    none = F.array().cast(spans)
    start = F.struct(F.lit(0).alias("at"), none.alias("last"), F.array().cast(f"array<{spans}>").alias("full"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        long = end.isNotNull() & (x["measure"] >= least)
        crowded = long & (F.size(acc["last"]) >= CHUNK)
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(crowded, F.array(span)).when(long, F.concat(acc["last"], F.array(span))).otherwise(acc["last"]).alias("last"),
            F.when(crowded, F.concat(acc["full"], F.array(acc["last"]))).otherwise(acc["full"]).alias("full"),
        )

    return F.aggregate(lengths, start, step, lambda acc: F.concat(F.flatten(acc["full"]), acc["last"]))


def scan(docs: DataFrame, rules: dict = RULES) -> DataFrame:
    """``doc_id, spans`` per document, spans ``(start, kind, end)`` by start, then rule order.

    A null text counts as empty. Rows that repeat an id are searched for the candidates of
    all of them, each in its own text. Other columns are ignored; an empty table gives none.
    """
    queries = {rule: found for rule, (pattern, _, _) in rules.items() if (found := clauses(pattern))}
    trigrams = sorted({g for found in queries.values() for clause in found for s in clause for g in grams(s)})
    chosen = candidates(build_index(docs, trigrams), queries).withColumnRenamed("doc_id", "candidate")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    rows = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("candidate")), "left")
    text, none = F.col("text"), F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = []
    for kind, (rule, (pattern, group, least)) in enumerate(rules.items()):
        # a run is long enough only if it has that many characters in a row
        worth = text.rlike(pattern.removesuffix("+") + f"{{{least},}}") if rule == "hex" else text.rlike(pattern)
        if rule in queries:
            worth = F.coalesce(F.array_contains("rules", rule), F.lit(False)) & worth
        parts.append(F.when(worth, rule_spans(text, kind, pattern, group, least)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    names = F.array(*map(F.lit, RULES))

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{rule}") for kind, rule in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def _sql() -> str:
    parts = []
    for kind, (rule, (pattern, group, least)) in enumerate(RULES.items()):
        quoted = pattern.replace(r"\"", '"').replace("'", "''")
        parts.append(
            f"select doc_id, {kind} as kind, '{rule}' as name, {least} as least, string_split_regex(t, '{quoted}') as p, "
            f"regexp_extract_all(t, '{quoted}') as m, regexp_extract_all(t, '{quoted}', {group}) as g from d"
        )
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
r as ({" union all ".join(parts)}),
i as (select doc_id, kind, name, least, p, m, g, unnest(range(1, len(m) + 1)) as i from r where len(m) > 0),
s as (select doc_id, kind, name,
        coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as a,
        length(m[i]) as n
      from i where length(g[i]) >= least),
o as (select doc_id, kind, a, name || ':' || a::bigint || ':' || (a + n)::bigint as told from s),
z as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
        string_agg(told, ',' order by a, kind) filter (kind < 3) as base, string_agg(told, ',' order by a, kind) as spans
      from o group by 1)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join z using (doc_id)
"""


SQL = _sql()
