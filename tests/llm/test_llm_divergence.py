"""Source divergence against dense sums over all terms, and its edges."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from panelkit.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string"


def brute(rows):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 10]
        own = {s: counts[x, s] for x, s in groups if x == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()))
        for s in own:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(found, 1) if part == "pair" or k <= 10}
    return out


def audited(spark, rows):
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).withColumn("p", F.lit("x"))).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_random_corpora(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        words = [f"W{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)] + ["é", "日本", "Ünder"]
        rows = [(i, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", "é", "z", None]),
                 rnd.choice([" ", "-", "7 "]).join(rnd.choices(words, weights=range(1, 64), k=rnd.randrange(0, 40))))
                for i in range(200)]
        assert audited(spark, rows) == brute(rows)


def test_edges(spark):
    long = "again " * 400_000
    rows = [(i, "en", "a", "One two") for i in range(9)] + [(None, "en", "b", "one " + long), (1, "en", "b", None),
            (2, "en", "c", ""), (3, "xx", "a", "rare"), (3, "xx", "b", "1 2"), (4, "yy", None, "x")]
    rows += [(9, "en", "a", "two two")] * 3
    assert audited(spark, rows) == brute(rows)
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    assert audited(spark, [(1, None, None, None)]) == set()


def test_a_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    assert divergence.terms_of("Abc abcdefgh é1É x".encode()) == Counter({b"abc": 1, b"abcdefgh": 1, "é".encode(): 1,
                                                                        "É".encode(): 1, b"x": 1})


def test_trees_cut_anywhere_add_up():
    import pyarrow as pa
    rnd = random.Random(5)
    paths = sorted(sorted((s, rnd.randrange(5, 8), 3) for s in rnd.sample("abcdef", rnd.randrange(2, 6))) for _ in range(80))
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("zero", pa.int64())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 80), pa.array([[dict(zip(("source", "p", "zero"), x)) for x in p] for p in paths], kind),
         pa.array([1 + i % 3 for i in range(80)])], names=["lang", "path", "rows"])
    sums = [Counter(), Counter()]
    for k, size in enumerate((80, 7)):
        for at in range(0, 80, size):
            for out in divergence.grow_trees(iter([batch.slice(at, size)])):
                for r in out.to_pylist():
                    sums[k][r["a"], r["b"]] += r["v"]
    f = lambda p, q: (p - q) ** 2 // (p + q)
    whole = Counter()
    for i, path in enumerate(paths):
        for j, (b, pb, zb) in enumerate(path):
            for a, pa_, za in path[:j]:
                whole[a, b] += (1 + i % 3) * (f(pa_, pb) - f(pa_, zb) - f(za, pb) + f(za, zb))
    assert sums[0] == sums[1] == whole
