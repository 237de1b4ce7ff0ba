"""A training corpus in stages; each works on all rows its predecessor kept.

Every stage but the last returns the columns of the documents it was given, ``n_chars``
counted anew where texts change.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import langid, lines, mixing, packing, simhash
from skylattice.llm.text import WORD, documents
from skylattice.session import settle


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents; texts in no known language go, null ones too."""
    langs, model = langid.train(docs)
    return langid.keep_known(docs, langs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later lines of similarity 0.8 or more go, and documents left without a word."""
    found = lines.line_dedup(docs, rest=True).where(F.col("text").rlike(WORD))
    return _counted(found.select(*["text" if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, by SimHash over three words within two bits, one stays."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come in the target shares; a document may come twice or in part."""
    return _counted(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as packing.pack gives them."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]
ORACLE_SQL = None  # SQL cannot say the first stage; tests compare stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each result written before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
