"""Toxicity: thresholds of small languages, sampling and repeated rows."""

import random
from zlib import crc32

import numpy as np
import pytest

from pyspark.sql import functions as F

from panelkit.llm import langid, queries, toxicity

SCHEMA = "doc_id long, text string, lang string"
MARK = {"en": "vequ", "xx": "zorba"}


def corpus(spark, sizes, first=0, seed=3):
    """Documents and labels; a toxic text holds its language's mark. ``sizes`` has (lang, toxic, rows)."""
    rng = random.Random(seed)
    plain = {k: [f"{k}{a}{b}" for a in "bdgklmnprst" for b in "aeiouy"] for k in MARK}
    docs, labels = [], []
    for lang, toxic, n in sizes:
        for _ in range(n):
            words = [rng.choice(plain[lang]) for _ in range(30)]
            if toxic:
                words[rng.randrange(30)] = MARK[lang]
            docs.append((first + len(docs), " ".join(words), lang))
            labels.append((docs[-1][0], toxic))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"), docs


def test_small_language_is_learned_from_all_its_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", 100)
    docs, labels, _ = corpus(spark, [("en", 1, 1500), ("en", 0, 1500), ("xx", 1, 50), ("xx", 0, 150)])
    marks = toxicity._marks(labels)
    sample, names = toxicity._sample(docs, marks)
    known = {r.doc_id for r in marks.collect()}
    toxic_xx = sum(i in known for i in range(3000, 3050))
    assert names == ["en", "xx"] and len(sample) == 200
    assert sum(r.lang == "xx" and r.toxic for r in sample) == toxic_xx > 30  # all of them, not a thirtieth of 100
    model = toxicity.fit(docs, labels)
    assert model.shift[0] != model.shift[1]
    fresh = corpus(spark, [("xx", 1, 60), ("xx", 0, 60)], seed=9)[2]
    got = toxicity.scores(model, [t.encode() for _, t, _ in fresh], toxicity.Reader()) >= toxicity.CUT
    assert got[:60].sum() >= 50 and got[60:].sum() <= 3
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 50)  # longer texts are learned from as well
    assert len(toxicity._sample(docs, marks)[0]) == 200


def test_thresholds_count_all_rows():
    z = np.array([-2.0, -1.0, 0.0, 1.0, 2.0])
    # with the true share of toxic rows the cut lies higher than with as many toxic as clean rows
    assert toxicity.counted_cut(z, np.array([0, 0, 1, 1, 8]), np.array([5, 3, 1, 1, 0])) < 0
    assert toxicity.counted_cut(z, np.array([0, 0, 1, 1, 8]), np.array([500, 300, 100, 100, 0])) > 1
    assert toxicity.shares({"a": 3, "b": 1000, "c": 40}, 100) == {"a": 3, "c": 40, "b": 57}


def test_repeated_ids_leave_the_others_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", 20)
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 20)
    docs, labels, _ = corpus(spark, [("en", 1, 100), ("en", 0, 100)])
    rows = docs.orderBy(F.xxhash64("doc_id")).collect()
    hot = next(r for r in rows if r.doc_id < 100 and crc32(str(r.doc_id).encode()) % 4 != 2
               and crc32(str(r.doc_id).encode()) % 5)
    docs = docs.union(spark.createDataFrame([hot] * 400, SCHEMA))
    sample, _ = toxicity._sample(docs, toxicity._marks(labels))
    assert len({r.doc_id for r in sample}) == len(sample) == 40
    seen = []
    monkeypatch.setattr(langid, "train", seen.append)
    langid.fit(docs)
    assert len(seen[0]["en"]) == len(set(seen[0]["en"])) == 20


def test_long_texts_score_as_a_whole(monkeypatch):
    """A text of parts has the logit and votes of the whole text, wherever the parts are cut."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghÀé,文") for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    texts = [",".join(words).encode(), ("x" * 5000 + " " + " ".join(words)).encode(), ("É文" * 900).encode(),
             b"a b", b",,," * 900]
    rows = [(f"good{i} thing vequ bad word", 1) if i % 2 else (f"good{i} fine text bad", 0) for i in range(60)]
    model = toxicity.train([t.encode() for t, _ in rows], [y for _, y in rows], ["x", "y"] * 30)
    model.table[1:] = np.random.default_rng(0).normal(size=model.table[1:].shape)  # every word counts
    whole = toxicity.logits(model, texts, toxicity.Reader())
    for size in (60, 61, 257):
        monkeypatch.setattr(toxicity, "BLOCK", size)
        parts = toxicity.logits(model, texts, toxicity.Reader())
        assert np.allclose(parts[0], whole[0], atol=1e-5) and (parts[1] == whole[1]).all()


@pytest.mark.parametrize("size, caught, alarms", [("sf0.01", 7, 3), ("sf0.1", 106, 11)])
def test_held_out_rows(spark, size, caught, alarms):
    folder = f"/root/testdata/{size}"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    rows = queries.QUERIES["op8_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert {r.toxic for r in rows} == {0, 1}
    assert sum(r.toxic == 1 and r.predicted == 1 for r in rows) >= caught
    assert sum(r.toxic == 0 and r.predicted == 1 for r in rows) <= alarms


def test_few_rows_of_one_class_in_the_fit():
    model = toxicity.train([b"bad words", b"good words"], [1, 0], [None, None])
    assert np.isfinite(toxicity.scores(model, [b"", b"bad", b"good words"], toxicity.Reader())).all()
    assert toxicity._drawn(1.0, np.array([3.0]), np.array([1])) == 1.0


def test_dropped_rows_are_those_that_score_as_toxic(spark):
    docs, labels, _ = corpus(spark, [("en", 1, 150), ("en", 0, 150)])
    docs = docs.union(spark.createDataFrame([(None, None, None), (900, "", "en"), (900, "", "en")], SCHEMA))
    bad = {r.doc_id for r in toxicity.score_documents(docs, labels).where("predicted = 1").collect()}
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 120 <= len(bad) <= 160
    want = [tuple(r) for r in docs.collect() if r.doc_id not in bad]
    assert None not in bad and 900 not in bad  # no words, no reason
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))
