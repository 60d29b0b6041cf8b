"""Syncmer fingerprints: shared passages of long texts, repeated anchors."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.llm import syncmers


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def test_shared_passage_of_long_texts():
    rng, found = random.Random(2), 0
    for _ in range(20):
        passage = words(rng, 50)
        a, b = (" ".join([words(rng, rng.randrange(15_000)), passage, words(rng, 5_000)]) for _ in range(2))
        found += syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(b)) > 0
    assert found == 20


def test_all_places_count():
    rng = random.Random(4)
    one, other = words(rng, 2000), words(rng, 2000)
    mark = syncmers.fingerprint(f"{one} {other} {one}")
    assert len(mark) > 2 * len(np.unique(mark["hash"])) * 0.7
    # the second copy of a passage is found in order after the other one
    assert syncmers.likeness(mark, syncmers.fingerprint(f"{other} {one}")) > 0.75
    assert syncmers.likeness(mark, mark) == 1.0
    many = syncmers.fingerprint("ab cd " * 50_000)
    assert syncmers.likeness(many, many) == 1.0


def test_blocks_change_nothing(monkeypatch):
    texts = [words(random.Random(5), n) for n in (5, 60, 400, 3000)] + ["ab cd " * 2000]
    whole = [syncmers.fingerprint(t).tobytes() for t in texts]
    monkeypatch.setattr(syncmers, "BLOCK", 100)
    assert [syncmers.fingerprint(t).tobytes() for t in texts] == whole


def longest_order(a, b):
    """Longest common subsequence by the whole table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_common_order_against_the_whole_table():
    rng = random.Random(7)
    for n, letters in [(40, 3), (60, 20), (80, 500), (120, 2), (90, 1)] * 6:
        a, b = (np.array([rng.randrange(letters) for _ in range(rng.randrange(n))], np.uint32) for _ in range(2))
        assert syncmers.common_order(a, b) == longest_order(a.tolist(), b.tolist())
    a, b = (np.array([rng.randrange(m) for _ in range(400)], np.uint32) for m in (2, 2))  # by bits
    assert syncmers.common_order(a, b) == longest_order(a.tolist(), b.tolist())


def test_anchors_of_an_edited_text_are_those_of_the_text_itself():
    rng = random.Random(8)
    texts = [words(rng, n) for n in (0, 1, 2, 3, 4, 9, 50, 300)] + ["ab cd " * 9, "é文" * 30, "x" * 25]
    for a in texts:
        for b in texts:
            own, other = ((c := syncmers._codes(t), *syncmers._anchors(c)) for t in (a, b))
            half, changed = len(a) // 2, syncmers.edited(a, b)
            got = syncmers._edited_anchors(own, other, len(a) - half, min(half, len(b)))
            assert syncmers._written(changed, *got).tobytes() == syncmers.fingerprint(changed).tobytes(), (a, b)


def by_hand(spark, rows):
    """Compare ``fingerprints`` with a loop over the sorted rows that shares no code with it but the rule of syncmers."""
    def anchors(text):
        codes = np.array([ord(c) for c in text], np.uint64)
        if len(codes) < syncmers.K:
            return [text] if text else []
        inner = syncmers._run_hashes(codes, syncmers.S).tolist()
        width = syncmers.K - syncmers.S + 1
        found = [text[i:i + syncmers.K] for i in range(len(inner) - width + 1)
                 if min(inner[i:i + width]) in (inner[i], inner[i + width - 1])]
        return found or [text]

    def alike(a, b):
        a, b = anchors(a), anchors(b)
        return 2 * longest_order(a, b) / (len(a) + len(b)) if a and b else float(len(a) == len(b))

    frame = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {(r.doc_id, r.text): r.h for r in frame.select("*", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r]))
    want = []
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        a, b = a or "", b or ""
        changed = a[:len(a) - len(a) // 2] + b[:len(a) // 2]
        want.append((i, len(a), hashlib.sha256(changed.encode()).hexdigest(), alike(a, changed), alike(a, b)))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next)
           for r in syncmers.fingerprints(frame.repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rows_of_any_ids_against_brute_force(spark):
    rng = random.Random(9)
    ids = [-2 ** 63, 2 ** 63 - 1, 0, 5, 6, None, None, -1, 2 ** 62, *range(100, 140)]
    by_hand(spark, [(i, words(rng, rng.randrange(40))) for i in ids] + [(7, None), (8, "")])
    same = words(rng, 30)
    by_hand(spark, [(3, same)] * 60 + [(1, "one"), (9, words(rng, 20)), (None, same)])  # a repeated row
    by_hand(spark, [(4, "only")])


def test_uneven_ids_are_dealt_evenly(spark):
    def most(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return max(r["count"] for r in syncmers.neighbours(frame).groupBy("bucket").count().collect())

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert most([(i, f"text {i}") for i in [*range(2000), 2 ** 63 - 1]]) < 3 * 2001 / parts  # an outlier
    assert most([(5, "the same")] * 1500 + [(i, f"text {i}") for i in range(500)]) < 3 * 2000 / parts  # a hot row
    assert most([(None, f"text {i}") for i in range(2000)]) < 3 * 2000 / parts
