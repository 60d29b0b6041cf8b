"""The rows that each stage of the pipeline keeps, against loops over all rows."""

import hashlib
import re
import struct
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

import corpus_pipeline
from panelkit.llm import mixing, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The folder of a table with planted copies and near copies, and the rows before and after each stage."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.where(F.length("text") > 400).orderBy("doc_id").limit(12)
    copies = some.withColumn("text", F.concat(F.regexp_replace("text", " ", "  "), F.lit("")))
    near = some.withColumn("text", F.concat("text", F.lit(" indeed")))
    rows = docs
    for k, more in enumerate([copies, near, some.withColumn("text", F.lit("")), some.withColumn("text", F.lit(None).cast("string"))]):
        rows = rows.unionByName(more.withColumn("doc_id", (F.col("doc_id") + 100_000 * (k + 1)).cast("long")))
    rows.withColumn("doc_id", F.col("doc_id").cast("long")).coalesce(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    frames = [now]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/after_{name}")
        now = spark.read.parquet(f"{folder}/after_{name}")
        frames.append(now)
    return folder, frames


def rows_of(frame):
    return Counter(map(str, map(tuple, frame.collect())))


def test_toxicity_stage(spark, steps):
    folder, (docs, kept, *_) = steps
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bad = {r.doc_id for r in toxicity.score_documents(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == docs.columns
    assert rows_of(kept) == Counter(str(tuple(r)) for r in docs.collect() if r.doc_id not in bad)


def test_exact_dedup_stage(steps):
    _, (_, docs, kept, *_) = steps
    best = {}
    for r in docs.collect():
        text = re.sub("[ \t\n\v\f\r]+", " ", r.text or "")
        best[text] = min(best.get(text, (r.doc_id, r)), (r.doc_id, r), key=lambda x: x[0])
    assert len(best) < docs.count() - 12 and kept.columns == docs.columns
    assert rows_of(kept) == Counter(str(tuple(r)) for _, r in best.values())


def simhash_by_hand(text):
    words = re.findall(r"[^ \t\n\v\f\r]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_dedup_stage(steps):
    _, (_, _, docs, kept, *_) = steps
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    marks = [simhash_by_hand(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = [rows[i] for i in range(len(rows)) if find(i) == i]
    assert len(want) < len(rows) and kept.columns == docs.columns
    assert rows_of(kept) == Counter(str(tuple(r)) for r in want)


def test_mixing_stage(steps):
    _, (*_, docs, kept, _) = steps
    copies = {r.doc_id: r.copies for r in mixing.mix_documents(docs).collect()}
    want = Counter()
    for r in docs.collect():
        want[str(tuple(r))] += copies[r.doc_id]
    assert kept.columns == docs.columns and rows_of(kept) == +want and 0 < kept.count()


def test_encoding_stage_and_whole_run(spark, steps):
    folder, (*_, docs, out) = steps
    library = Tokenizer.from_file(str(Path(public_tokenizers.path("word_bpe_49k.json"))))
    library.no_truncation()
    library.no_padding()
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[str((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                  hashlib.sha256(decoded.encode()).hexdigest()))] += 1
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows_of(out.select(columns)) == want
    assert rows_of(corpus_pipeline.run(spark, folder).select(columns)) == want
