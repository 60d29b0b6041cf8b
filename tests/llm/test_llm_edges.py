"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from panelkit.llm import (bpe, chat, exact_dedup, langid, mixing, simhash, syncmers, toxicity, unigram, urlfilter)

LONG = "word " * 60_000
ROWS = [(1, "the cat  sat", "en", "src1"), (2, "the cat sat", "en", "src1"), (3, None, None, None), (4, "", "de", "x"),
        (5, LONG, "en", "src2"), (6, "\x1c\u0000 é 😀", "fr", "src3"), (2, "the cat sat", "en", "src1"),
        (None, "no id", "en", "src1"), (7, "12 34 !", "en", "src1")]
CLASH = ("row", "key", "fp", "keep_id", "k_id", "score", "tokens", "bucket", "m_id", "arg_0")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (2, 0, 1), (5, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def operators(spark, labels):
    vocabulary = unigram.zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return {
        "syncmers": syncmers.fingerprints, "mixing": mixing.mix_documents,
        "unigram": lambda d: unigram.count_tokens(d, vocabulary), "simhash": simhash.near_groups,
        "exact": exact_dedup.exact_groups, "langid": langid.identify,
        "toxicity": lambda d: toxicity.score_documents(d, labels),
        "bpe": lambda d: bpe.encode_documents(d, public_tokenizers.path("word_bpe_49k.json"))}


def test_a_row_for_every_row(docs, operators):
    for name, op in operators.items():
        out = op(docs)
        assert out.count() == len(ROWS), name
        assert len(set(out.columns)) == len(out.columns), name


def test_empty_tables_give_no_rows(docs, operators):
    for name, op in operators.items():
        assert op(docs.limit(0)).count() == 0, name


def test_pipeline_stages_keep_columns(docs, labels):
    for out in (exact_dedup.keep_first(docs), simhash.keep_one_per_group(docs), mixing.mixed(docs),
                toxicity.drop_toxic(docs, labels)):
        assert out.columns == docs.columns
        out.count()
    kept = [r.doc_id for r in exact_dedup.keep_first(docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 5, 6, None, 7], key=str)
    for keep in (exact_dedup.keep_first, simhash.keep_one_per_group, mixing.mixed):
        assert keep(docs.limit(0)).count() == 0


def test_chat_edges(spark):
    text = "~0 ~1 </s>[INST] <|im_start|>x\n<|im_end|> ~"
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (2, 0, None, None), (2, 0, None, None),
            (None, None, "assistant", "é😀"), (3, 0, "a\n~b", LONG), (4, 0, "system", "s"), (4, 1, "user", "u"),
            (4, 2, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit(1))
    out = {r.conv_id: r for r in chat.digest(chat.format_records(chat.records_of_turns(df), "record")).collect()}
    assert {k: r.n_turns for k, r in out.items()} == {1: 2, 2: 2, None: 1, 3: 1, 4: 3}
    assert out[1].loss_chars == len(text) and out[1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    said = f"user\n{text}\nassistant\n{text}\n"
    assert out[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert out[3].turns_sha256 == hashlib.sha256(f"a\n~b\n{LONG}\n".encode()).hexdigest()
    assert (out[1].layout, out[3].layout, out[4].layout) == ("prompt", "messages", "system prompt")
    assert chat.records_of_turns(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    records = ['{"messages":[{"role":"user","content":"q"},{"content":"a","role":"assistant"}]}',
               '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
               '{"prompt":"q","response":"a"}', '{"completion":"a","prompt":"q"}',
               '{"instruction":"q","input":null,"output":"a"}', '{"instruction":"q","output":"a"}',
               '{"other":1}', "no json", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "conv_id int, record string")
    out = sorted(chat.canonical(df, "record").collect(), key=lambda r: r.conv_id)
    assert all([(t.role, t.text) for t in r.turns] == [("user", "q"), ("assistant", "a")] for r in out[:6])
    assert all(r.turns is None and r.layout is None for r in out[6:])


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.ORG/en/1x?y"), (4, "x://casino.com"), (5, "x://a.com/de/1"),
            (6, "x://org"), (7, "x://b.net/#f"), (1, None), (8, "x://free.b.net/p://q")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("listed", F.lit("x"))
    out = {r.page_id: r for r in urlfilter.filter_urls(pages).collect()}
    assert (out[3].host, out[3].path, out[3].rule, out[3].verdict) == ("a.example.org", "/en/1x", "example.org/en/1", "block")
    assert (out[1].host, out[1].path, out[1].verdict) == ("", "", "allow")
    assert out[4].verdict == "block" and out[4].rule is None and out[5].rule == "com/de/"
    assert out[6].rule is None and out[7].verdict == "allow" and out[8].verdict == "block"
    assert urlfilter.filter_urls(pages).count() == len(rows) and urlfilter.filter_urls(pages.limit(0)).count() == 0
