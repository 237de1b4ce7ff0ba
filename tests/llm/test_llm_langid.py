"""Languages of wide alphabets, and documents in which noise wins."""

import random

import numpy as np

from skylattice.llm import langid

SCHEMA = "doc_id long, text string, lang string"


def test_wide_alphabet_and_noise(spark):
    rng = random.Random(1)
    plain = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null and lang is not null")
    rows = [(r.doc_id, r.text, r.lang) for r in plain.collect()]
    letters = [chr(0x4E00 + i) for i in range(2500)]
    known = ["".join(rng.choices(letters, k=rng.randrange(2, 4))) for _ in range(6000)]
    wide = [(10_000 + i, " ".join(rng.choices(known, k=600)), "zz") for i in range(200)]
    langs, model = langid.train(spark.createDataFrame(rows + wide[:150], SCHEMA))
    assert all(model[langid.trigrams([t])[0], langs.index("zz")].mean() < -9 for _, t, _ in wide)
    junk = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(3000)) for _ in range(20)]
    junk = [(20_000 + i, " ".join(t[j : j + 6] for j in range(0, 3000, 6)), None) for i, t in enumerate(junk)]
    table = spark.createDataFrame(wide + junk + rows[:200], SCHEMA)
    found = {r.doc_id: r for r in langid.identify(table, langs, model).collect()}
    kept = {r.doc_id for r in langid.keep_known(table, langs, model).collect()}
    assert all(found[i].lang_pred == "zz" and found[i].score > 0.9 and i in kept for i, _, _ in wide)
    assert not kept & {i for i, _, _ in junk}
    for i, text, _ in junk:
        r = found[i]
        if not r.languages:
            bins, _, _ = langid.trigrams([text])
            assert r.score == 0 and r.lang_pred == langs[int(model[bins].sum(0).argmax())]
    assert any(not found[i].languages for i, _, _ in junk)
    # words of both alphabets in one document
    mixed = [(1, wide[160][1][:900] + " " + max((r for r in rows if r[2] == "en"), key=lambda r: len(r[1]))[1][:900], None)]
    [r] = langid.identify(spark.createDataFrame(mixed, SCHEMA), langs, model).collect()
    assert {"en", "zz"} <= set(r.languages) and sum(r.languages.values()) > 0.9


def test_noise_level_is_below_every_language():
    model = np.log(np.full((langid.BINS, 1), 1 / langid.BINS))
    assert np.allclose(langid.noise_levels(model), -np.log(langid.BINS))
