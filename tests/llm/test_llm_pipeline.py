"""Stages of the pipeline against brute force, on planted rows."""

import random
import re

from llm_corpus import SCHEMA

import corpus_pipeline
from skylattice.llm import simhash

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def stayed(rows):
    """One row per component of fingerprints within two bits: the smallest id, nulls last."""
    bits = [simhash.fingerprint(r[1] or "") for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= 2:
                root[top(i)] = top(j)
    best = {}
    for i, r in enumerate(rows):
        best.setdefault(top(i), []).append((r[0] is None, r[0] or 0))
    return sorted(min(v) for v in best.values())


def test_near_dedup_keeps_one_of_each_component(spark, docs, rows):
    found = STAGES["near_dedup"](spark, docs, SF)
    assert found.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect())
    assert got == stayed(rows)


def test_near_dedup_of_long_copies(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(2000)]
        for k in range(4):  # an exact copy, one in capitals, one with a word changed
            copy = list(words)
            if k == 3:
                copy[rng.randrange(2000)] = "other"
            text = " ".join(copy)
            rows.append((4 * i + k, text.upper() if k == 2 else text, "en", "s", 1))
    found = STAGES["near_dedup"](spark, spark.createDataFrame(rows, SCHEMA).repartition(4), SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == stayed(rows)
    assert 40 <= len(found) < 60 and set(range(0, 160, 4)) <= {r.doc_id for r in found}


def test_unrelated_rows_of_one_id_stay(spark):
    texts = [" ".join(f"{c}{i}" for i in range(200)) for c in "abc"]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (9, texts[0]), (None, texts[2]), (None, texts[2])]
    rows = [(*r, "en", "s", 1) for r in rows]
    found = STAGES["near_dedup"](spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert sorted(r.text for r in found) == texts


def test_line_dedup_leaves_no_similar_line(spark, docs):
    found = STAGES["line_dedup"](spark, docs, SF).orderBy("doc_id").collect()
    sets = [set(line.split()) for r in found for line in r.text.split("\n") if re.search(r"\S", line)]
    for i, a in enumerate(sets):
        assert all(10 * len(a & b) < 8 * len(a | b) for b in sets[:i])
