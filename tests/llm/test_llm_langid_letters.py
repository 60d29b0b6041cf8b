"""Every letter counts as itself, however many there are."""

import random

from panelkit.llm import langid


def text(rnd, first, n):
    return "".join(chr(first + rnd.randrange(600)) for _ in range(n))


def longest_phrases(sample, said):
    """Phrases of a greedy parse into the longest pieces of the sample."""
    at = n = 0
    while at < len(said):
        size = 1
        while at + size < len(said) and said[at:at + size + 1] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_disjoint_alphabets_of_600_letters():
    rnd = random.Random(1)
    first = {"a": 0x4E00, "b": 0x5E00}  # 600 ideographs each
    model = langid.train({k: [text(rnd, c, 300) for _ in range(40)] for k, c in first.items()})
    said = [(k, text(rnd, first[k], 40)) for _ in range(100) for k in "ab"]
    langs, _ = langid.predict(model, [t for _, t in said])
    assert sum(p == k for p, (k, _) in zip(langs, said)) >= 198


def test_phrases_of_rare_letters_against_brute_force():
    rnd = random.Random(2)
    letters = [chr(0x4E00 + i) for i in range(150)] + list("abcdefgh")
    samples = {k: ["".join(rnd.choices(letters, k=400))] for k in ("x", "y")}
    model = langid.train(samples)
    said = ["".join(rnd.choices(letters + [chr(0x9000)], k=rnd.randrange(1, 300))) for _ in range(30)]
    said += [samples["x"][0][50:90] + samples["y"][0][10:60]]
    counts, _ = langid.phrases(model, said)
    for row, t in zip(counts, said):
        assert list(row) == [longest_phrases(samples[k][0], t) for k in model.langs]


def test_cuts_change_nothing(monkeypatch):
    rnd = random.Random(3)
    letters = "abcd"
    samples = {k: ["".join(rnd.choices(letters, k=900)), "aaab"] for k in ("x", "y", "z")}
    model = langid.train(samples)
    said = ["".join(rnd.choices(letters + "q ", k=rnd.randrange(1, 700))) for _ in range(20)]
    said += ["a" * 500, samples["y"][0][:800], "a" * 301 + "b" + samples["x"][0][5:400]]
    for size, most in ((512, 256), (7, 256), (16, 4)):
        monkeypatch.setattr(langid, "SEGMENT", size)
        monkeypatch.setattr(langid, "MOST_SEGMENTS", most)
        counts, _ = langid.phrases(model, said)
        for row, t in zip(counts, said):
            t = " ".join(t.split()) if t.strip() == t else " ".join(f"|{t}|".split()).strip("|")
            want = [longest_phrases("".join("\0" + s for s in samples[k]), t.replace(" ", "\0")) for k in model.langs]
            assert list(row) == want


def test_any_number_of_languages_in_blocks(spark, monkeypatch):
    rnd = random.Random(4)
    rows = []
    for k in range(45):  # each language has its own letters
        rows += [(100 * k + i, "".join(chr(0x4E00 + 30 * k + rnd.randrange(30)) for _ in range(60)), f"l{k:02}")
                 for i in range(12)]
    rows += [(9_000_000, None, "l01"), (9_000_001, "12", "l01"), (None, rows[0][1], None)] + [rows[7]] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    want = {i: lang for i, t, lang in rows if lang and t and len(t) > 5}
    assert all(r.lang_pred == want.get(r.doc_id, "l00" if r.doc_id is None else "und") for r in got)
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 100)
    one = langid.identify(docs).collect()
    assert sorted(map(str, one)) == sorted(map(str, got))


def test_short_texts_fill_the_sample(spark):
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choices("abcdefgh", k=20)), "x") for i in range(4000)]
    rows += [(5000 + i, "".join(rnd.choices("abcdefgh", k=2000)), "y") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert abs(model.bits[0] - model.bits[1]) < 1e-9
