"""Licence scans: the Dice coefficient of word bigrams against licence templates.

Lines, blocks between blank lines, and whole texts are normalised and compared with the
templates whose size is within the bounds that the least coefficient implies. All of it is
one projection over the scan; templates are a fixed table in the plan.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm.license_texts import TEMPLATES
from skylattice.llm.text import documents, whole

LEAST = 0.8
COPYRIGHT = r"copyright (\(c\) |© )?[0-9][^\n]*"


def normal(text: str) -> list[str]:
    """The words of a template: what ``normal_words`` gives for a column."""
    text = re.sub(COPYRIGHT, " ", re.sub(r"[A-Z]", lambda m: m[0].lower(), text))
    return re.sub(r"[^a-z0-9]+", " ", text).split()


def normal_words(text: Column) -> Column:
    """Words in lower case, without copyright lines, marks and white space."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, " "), "[^a-z0-9]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """The different pairs of neighbouring words; a single word pairs with nothing."""
    pairs = F.zip_with(
        words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def template_bigrams(text: str) -> list[str]:
    words = normal(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def segments(text: Column) -> Column:
    """Lines, blocks between blank lines and the whole text, each once."""
    return F.array_distinct(
        F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n"), F.array(text))
    )


def license_matches(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id, matches`` per document: ``(dice, license)`` of every template that is met.

    A template counts where some segment has a coefficient of ``least`` or more. A null or
    empty text meets none. Repeated rows are scanned each on its own. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = [(name, pairs) for name, text in templates if (pairs := template_bigrams(text))]
    table = F.array(*[
        F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, pairs)).alias("pairs"), F.lit(len(pairs)).alias("n"))
        for name, pairs in rows
    ])
    fewest = min(len(pairs) for _, pairs in rows) * least / (2 - least)

    def met(pairs):
        size = F.size(pairs)

        def near(t):  # twice the smaller over the sum bounds the coefficient
            return 2 * F.least(size, t["n"]) >= least * (size + t["n"])

        def scored(t):
            common = F.size(F.array_intersect(pairs, t["pairs"]))
            return F.struct((2 * common / (size + t["n"])).alias("dice"), t["license"].alias("license"))

        return F.filter(F.transform(F.filter(table, near), scored), lambda m: m["dice"] >= least)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), segments(whole()).alias("parts"))
    words = F.filter(F.transform("parts", normal_words), lambda w: F.size(w) > fewest)
    found = found.select("doc_id", F.transform(words, bigrams).alias("parts"))
    return found.select("doc_id", F.flatten(F.transform("parts", met)).alias("matches"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_matches(documents(spark, sf_dir))
    # the best coefficient, then the first name
    best = F.get(F.array_sort(F.transform("matches", lambda m: F.struct((-m["dice"]).alias("less"), m["license"]))), F.lit(0))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        "doc_id",
        best["license"].alias("license"),
        (-best["less"]).alias("dice"),
        F.array_join(names, ",").alias("licenses"),
    )


def _sql() -> str:
    values = ", ".join(
        "('{}', [{}])".format(name, ", ".join(f"'{p}'" for p in template_bigrams(text))) for name, text in TEMPLATES
    )
    copyright_ = COPYRIGHT.replace("'", "''")
    return rf"""
with t(license, pairs) as (values {values}),
s as (select distinct doc_id, part from (
  select doc_id, unnest(list_concat(string_split(coalesce(text, ''), chr(10)),
    string_split_regex(coalesce(text, ''), '\n[ \t\r]*\n'), [coalesce(text, '')])) as part from documents)),
w as (select doc_id, list_filter(string_split(regexp_replace(regexp_replace(lower(part), '{copyright_}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') as ws from s),
b as (select doc_id, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as pairs from w where len(ws) > 1),
m as (select doc_id, license, 2 * len(list_intersect(b.pairs, t.pairs)) / (len(b.pairs) + len(t.pairs)) as dice
      from b join t on 2 * least(len(b.pairs), len(t.pairs)) >= {LEAST} * (len(b.pairs) + len(t.pairs))),
g as (select doc_id, first(license order by dice desc, license) as license, max(dice) as dice, string_agg(distinct license, ',' order by license) as licenses
      from m where dice >= {LEAST} group by 1)
select doc_id, license, dice, coalesce(licenses, '') as licenses from documents left join g using (doc_id)
"""


SQL = _sql()
