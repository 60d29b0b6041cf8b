"""License scan against a plain scan with Python's regexes, soundness of the prefilters, edges."""

import re

from pyspark.sql import functions as F

from panelkit.llm import license_rules, licenses
from panelkit.llm.common import table

try:
    from re import _parser as sre
except ImportError:
    import sre_parse as sre

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, rules=license_rules.RULES):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(text)
    wide = " " + "  ".join(words) + " " if words else "  "

    def places(pattern):
        return [(wide[:m.start()].count(" ") // 2, wide[:m.end()].count(" ") // 2 - 1) for m in re.finditer(pattern, wide)]

    base = [(s, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"),
                                             ("general public license", "gpl"))
            for s in range(len(words)) if words[s:s + len(phrase.split())] == phrase.split()]
    found = [(s, e, r) for r in rules for s, e in places(r.pattern)]
    kept = [(s, e, r) for s, e, r in found if not any(
        a <= s and e <= b and o.tier <= r.tier and (a, -b, o.tier, o.number) < (s, -e, r.tier, r.number) for a, b, o in found)]
    score = max([0.5 if base else 0.0] + [(1.0, 0.9, 0.7, 0.4)[r.tier - 1] for _, _, r in kept])
    starts = [s for s, _ in base]
    listed = lambda x: ",".join(sorted(set(x)))
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), listed(x for _, x in base),
            listed([x for _, x in base] + [r.label for _, _, r in kept]), score)


def scanned(df):
    return [tuple(r) for r in licenses.digest(licenses.scan(df)).collect()]


def examples(parsed, most=40):
    """Some strings that a regex matches, with every branch and both ends of every repeat."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            part = [chr(arg)]
        elif op == "IN":
            part = [chr(a) if str(o) == "LITERAL" else "x" for o, a in arg]
        elif op == "SUBPATTERN":
            part = examples(arg[-1])
        elif op == "BRANCH":
            part = [x for branch in arg[1] for x in examples(branch)]
        else:
            low, high, item = arg
            part = [x * low for x in examples(item)] + [x * min(high, max(low, 1)) for x in examples(item)]
        out = [a + b for a in out for b in dict.fromkeys(part)]
        if len(out) > most:
            out = out[:most // 2] + out[-most // 2:]
    return list(dict.fromkeys(out))


def test_hundreds_of_rules_and_sound_prefilters():
    assert len(license_rules.RULES) > 300
    gate = re.compile("|".join(license_rules.GATE))
    for r in license_rules.RULES:
        for x in examples(sre.parse(r.pattern)):
            assert re.fullmatch(r.pattern, x), (r, x)
            assert f" {r.word} " in x, (r, x)
            assert gate.search(x.replace("  ", " ")), (r, x)


def test_every_rule_against_brute_force(spark):
    texts = [examples(sre.parse(r.pattern))[-1] for r in license_rules.RULES]
    rows = [(i, f"Some words, and{t}then more.") for i, t in enumerate(texts)]
    rows += [(1000 + i, t.upper() + texts[i - 1] + texts[i - 7]) for i, t in enumerate(texts)]
    out = scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r[0]: r[1:] for r in out} == {i: brute(t) for i, t in rows}


def test_documents_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    assert {r[0]: r[1:] for r in scanned(docs)} == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_edges(spark):
    mit = "The MIT License. "
    rows = [(1, None), (2, ""), (3, "!?"), (4, "mit license mit license"), (5, mit * 3000), (6, "x" * 300_000 + " MIT\nLicense"),
            (7, "GNU Lesser General Public License, version 2.1"), (8, "é MIT-licensé mit licenseK"), (9, "mit"),
            (4, "mit license mit license"), (None, "Licensed under the Apache License, Version 2.0"), (10, "KK license")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit("x")).withColumn("label", F.lit("x"))
    got = scanned(df)
    assert sorted(map(str, got)) == sorted(str((i, *brute(t))) for i, t in rows)
    by = {r[0]: r for r in got}
    assert by[5][2:5] == (3000, 1, 8998) and by[5][6] == "mit"
    assert by[7][6] == "gpl,lgpl-2.1"  # the base label stays, the covered titles are suppressed
    assert by[None][5:] == ("apache", "apache,apache-2.0", 0.9)
    assert licenses.scan(df.limit(0)).count() == 0
