"""Operators against brute force, public libraries and held-out rows."""

import random
import re
from collections import defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from panelkit.llm import (bpe, exact_dedup, langid, queries, simhash, syncmers, toxicity, unigram, urlfilter)
from panelkit.llm.components import connected_components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())


def simhash_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    found = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def test_simhash_groups_equal_brute_force(spark, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op5_simhash_near_dedup"](spark, SF).collect()}
    ids = sorted(texts)
    marks = np.array([simhash_by_hand(texts[i]) for i in ids], np.uint64)
    assert all(int(got[i].fingerprint, 16) == m for i, m in zip(ids, marks.tolist()))
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(marks[k + 1:] ^ marks[k]) <= 3):
            a, b = sorted((find(i), find(ids[k + 1 + j])))
            root[b] = a
    assert all(got[i].component_id == find(i) for i in ids)


def test_long_lists_keep_every_link():
    rng = np.random.default_rng(1)
    for n in (50, 6000):
        tails = np.unique(rng.integers(0, 1 << 14, n)).astype(np.uint64)
        links = simhash.spanning_links(tails, [0, 1, 2])
        small = np.unique(np.concatenate([np.concatenate(p) for p in zip(*links)])) if links else tails[:0]
        linked = [i for i, t in enumerate(tails.tolist())
                  if (np.bitwise_count(tails ^ np.uint64(t)) <= simhash.MAX_BITS).sum() > 1]
        assert set(small.tolist()) == {tails.tolist()[i] for i in linked}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (200, 201)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_digest_runs_that_span_batches(spark):
    df = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 25_000).cast("string").alias("text"))
    out = exact_dedup.exact_groups(df.repartition(7))
    assert out.count() == 60_000
    assert out.where("keep_id <> doc_id % 25000 or kept <> (doc_id < 25000)").count() == 0


def _long_parts(spark):
    """Two input partitions of several Arrow batches each, one text longer than a batch, spaces, null texts and ids."""
    part = spark.range(0, 60_000, 1, 2)
    text = F.when(F.col("id") % 5 < 2, "the same").when(F.col("id") % 1_000 == 2, None) \
        .otherwise(F.concat(F.lit("number"), F.repeat(F.lit(" "), (1 + F.col("id") % 3).cast("int")), F.col("id") % 20_000))
    return part.select(F.when(F.col("id") % 7_000 != 6, F.col("id")).alias("doc_id"), text.alias("text"),
                       F.col("id").alias("n"))


def _smallest_by_text(rows):
    """For each normalised text the row numbers, those with the smallest id first."""
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.n)):
        groups[re.sub("[\x20\x09-\x0d]+", " ", r.text or "")].append(r)
    return groups


def test_first_runs_longer_than_a_batch(spark):
    docs = _long_parts(spark)
    groups = _smallest_by_text(docs.collect())
    assert max(map(len, groups.values())) > 20_000 and len(groups) > 10_000
    want = sorted((str(r.doc_id), str(rows[0].doc_id), len(rows), r.doc_id == rows[0].doc_id)
                  for rows in groups.values() for r in rows)
    got = exact_dedup.exact_groups(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == want


def test_kept_rows_of_parts_longer_than_a_batch(spark):
    docs = _long_parts(spark)
    want = sorted(str(tuple(rows[0])) for rows in _smallest_by_text(docs.collect()).values())
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and sorted(str(tuple(r)) for r in kept.collect()) == want


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.Tokenizer(bpe.load(path))
    rng = random.Random(3)
    signs = "abcdeinorst'.<|>/wé Σσ́\x1c\x85​\u1c89Ǆ"
    samples = ["", " ", "aaaaaaa", "<|endoftext|>x<|startoftext|>", "İstanbul ΣΑΣ", "x" * 500]
    samples += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for s in samples:
        ids = np.frombuffer(own.encode(s), "<u4").tolist()
        assert ids == library.encode(s, add_special_tokens=False).ids, s
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), s
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples[:20])], "doc_id long, text string")
    back = {r.doc_id: r.text for r in bpe.decode_ids(bpe.encode_ids(rows, path), path).collect()}
    assert all(back[i] == library.decode(library.encode(s, add_special_tokens=False).ids, skip_special_tokens=False)
               for i, s in enumerate(samples[:20]))


def library_unigram(model):
    from tokenizers import Tokenizer, models, pre_tokenizers
    low = min(s for _, s in model.pieces)
    spare = [(f"<0x{b:02X}>", low) for b in range(256)] if model.byte_fallback else []
    out = Tokenizer(models.Unigram([("<unk>", low), *spare, *model.pieces], 0, model.byte_fallback))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")])
    return out


def test_unigram_counts_equal_the_library(texts):
    model = unigram.zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    own, library = unigram.Counter(model), library_unigram(model)
    some = [t for _, t in sorted(texts.items())[:60]]
    assert [own.text(t)[0] for t in some] == [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    rng = random.Random(4)
    for _ in range(60):  # few pieces with few scores give many ties
        pieces = {"".join(rng.choice("abcé中▁") for _ in range(rng.randint(1, 4))): -rng.randint(1, 6) / 2 for _ in range(9)}
        model = unigram.Unigram(tuple(pieces.items()), rng.random() < 0.5)
        own, library = unigram.Counter(model), library_unigram(model)
        for _ in range(20):
            s = "".join(rng.choice("abcé中 \n\xa0d") for _ in range(rng.randint(0, 14)))
            assert own.text(s)[0] == len(library.encode(s, add_special_tokens=False).ids), (s, pieces)


def test_syncmer_rules(spark, texts):
    codes = np.array([ord(c) for c in texts[0][:400]], np.uint64)
    inner = syncmers._run_hashes(codes, syncmers.S)
    width = syncmers.K - syncmers.S + 1
    by_hand = [i for i in range(len(codes) - syncmers.K + 1)
               if min(inner[i:i + width]) in (inner[i], inner[i + width - 1])]
    assert syncmers.closed_syncmers(codes)[0].tolist() == by_hand
    got = {r.doc_id: r for r in syncmers.fingerprints(
        spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for a, b in zip(ids, ids[1:] + ids[:1]):
        r, mark, after = got[a], syncmers.fingerprint(texts[a]), syncmers.fingerprint(texts[b])
        other = syncmers.fingerprint(syncmers.edited(texts[a], texts[b]))
        assert r.fingerprint == mark.tobytes().hex() and r.edited_fingerprint == other.tobytes().hex()
        assert r.near_next == syncmers.likeness(mark, after) and 0 <= r.near_edited <= 1
        assert syncmers.likeness(mark, mark) == 1.0
    long = [r for r in got.values() if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > 0.3 > np.mean([r.near_next for r in long])


def test_language_phrases_by_hand():
    model = langid.train({"a": ["abcabcabd"], "b": ["xyzxyzxyw"]})
    text = "abcabd xyz?"
    counts, _ = langid.phrases(model, [text, ""])
    for k, sample in enumerate(["\0abcabcabd", "\0xyzxyzxyw"]):
        rest, n = text.replace(" ", "\0").replace("?", "\0"), 0
        while rest:
            size = 1
            while size < len(rest) and rest[:size + 1] in sample:
                size += 1
            rest, n = rest[size:], n + 1
        assert counts[0, k] == n
    assert langid.predict(model, ["abc", "xyz", "12", ""])[0] == ["a", "b", "und", "und"]


def test_language_and_toxicity_on_held_out_rows(spark):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    out = queries.QUERIES["op7_language_id"](spark, SF).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95
    out = queries.QUERIES["op8_toxicity"](spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_classifier_learns_stems():
    rng = random.Random(5)
    plain = ["".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    rows = []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 3 == 0:
            words[rng.randrange(60)] = "vequ" + rng.choice(plain)
        rows.append((" ".join(words).encode(), int(i % 3 == 0)))
    model = toxicity.train([t for t, _ in rows[:240]], [y for _, y in rows[:240]], ["x"] * 240)
    got = toxicity.scores(model, [t for t, _ in rows[240:]], toxicity.Reader()) >= toxicity.CUT
    assert np.mean(got == np.array([y for _, y in rows[240:]])) > 0.9
    one = rows[0][0]
    assert abs(toxicity.scores(model, [one], toxicity.Reader())[0]
               - toxicity.scores(model, [b"x", one, b""], toxicity.Reader())[1]) < 1e-6


def test_cascade_is_exact(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    levels = urlfilter.build_cascade(keys)
    assert len(levels) > 1
    wrong = keys.where(urlfilter.listed_column(levels, F.col("key")) != F.col("listed"))
    assert wrong.count() == 0
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(
        F.lit("x://"), F.when(F.col("id") % 3 == 0, "free.").otherwise("h."), (F.col("id") % 90).cast("string")).alias("url"))
    out = urlfilter.filter_urls(pages, max_bits=64)  # several shards
    assert out.count() == 500 and out.where("(page_id % 3 = 0) <> (verdict = 'block')").count() == 0
