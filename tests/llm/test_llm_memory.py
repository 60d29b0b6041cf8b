"""What the operators leave behind: checkpointed files by the number of rows, nothing kept in idle Python workers."""

import gc

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from panelkit.llm import bpe, components, simhash
from panelkit.llm.common import map_columns


def _counting(monkeypatch, module):
    """Numbers of files of the checkpoints that a module makes."""
    files, real = [], module.materialize

    def counted(df):
        done = real(df)
        files.append(done.rdd.getNumPartitions())
        return done

    monkeypatch.setattr(module, "materialize", counted)
    return files


def _uneven(spark):
    """Shuffle partitions that are not joined, as with many empty ones on a large cluster."""
    held = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    return old


def test_rounds_write_files_for_their_edges(spark, monkeypatch):
    files = _counting(monkeypatch, components)
    old = _uneven(spark)
    try:
        edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        got = {r.node: r.root for r in components.connected_components(edges).collect()}
        assert got == dict.fromkeys(range(61), 0)
        assert files[0] == 23 and len(files) > 2 and set(files[1:]) == {1}
        files.clear()
        monkeypatch.setattr(components, "EDGES_PER_FILE", 20)
        got = {r.node: r.root for r in components.connected_components(edges, 5).collect()}
        assert got == dict.fromkeys(range(61), 0)
        assert files[0] == 5 and set(files[1:]) == {3}
        none = components.connected_components(edges.where("a < 0"))
        assert none.collect() == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_fingerprints_are_written_in_files_for_their_number(spark, monkeypatch):
    files = _counting(monkeypatch, simhash)
    old = _uneven(spark)
    try:
        docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("same words but "), F.col("id") % 20)
                                      .alias("text")).repartition(4)
        monkeypatch.setattr(simhash, "ROWS_PER_FILE", 10)
        rows = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
        assert len(rows) == 40 and all(rows[i] == rows[i + 20] <= i for i in range(20))
        assert files == [4, 4]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_idle_workers_keep_no_tokenizer(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("word_bpe_49k.json")
    assert sorted((r.doc_id, r.n_tokens) for r in bpe.encode_documents(docs, path).collect()) == [(1, 2), (2, 0)]

    def held(batches):
        for _ in batches:
            gc.collect()
            yield pa.RecordBatch.from_pydict({"n": [sum(type(x).__name__ == "Tokenizer" for x in gc.get_objects())]})

    assert {r.n for r in spark.range(8).repartition(8).mapInArrow(held, "n long").collect()} == {0}


def test_few_rows_of_a_batch_are_objects_at_a_time(spark):
    rows = spark.range(0, 2_600, 1, 1).selectExpr("id", "cast(id as string) as text")

    def make():
        def long_lists():
            return sum(type(x) is list and len(x) > 1_000 and type(x[7]) is str and x[7] == "7"
                       for x in gc.get_objects())

        return lambda text: (long_lists() if text == "7" else -1, int(text))

    got = sorted(tuple(r) for r in map_columns(rows, make, "n long, back long", ["id"], ["text"]).collect())
    assert [(i, back) for i, _, back in got] == [(i, i) for i in range(2_600)]
    assert got[7][1] == 0
