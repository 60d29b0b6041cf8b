"""License scan by ordered signature rules, with DataFrame functions only.

Texts are normalised to lower-case words. Two prefilters gate the rules: a text without any gate word is done, and a
rule is tried only if its own word occurs. A rule's matches become intervals of words. In the order of their starts,
a detection is suppressed if one of the same or a stronger tier covers it (of equal ones the first rule's stays).

Places and suppression are folds over arrays in blocks, so that their time grows in proportion to the matches; no
text is sent and no row leaves its task.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.llm.license_rules import GATE, RULES

#: What parts words; and the base phrases with their labels. Fixed values.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: The score of a text is that of its strongest detection: by tier, and for base phrases alone.
TIER_SCORES, BASE_SCORE = (1.0, 0.9, 0.7, 0.4), 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Items that a fold appends to one array.
BLOCK = 512
SPAN = "struct<start: int, before: int, tier: int, rule: int, label: string, end: int>"


def fold(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """All arrays of ``kind`` that ``step(state, item)`` gives beside the next state, as one array.

    ``items`` is read once a block, so it should be a plain column or field. Appending copies an array; in blocks
    that is a bounded cost an item.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(s: Column, item: Column) -> Column:
        state, out = step(s["state"], item)
        return F.struct(state.alias("state"), F.concat(s["out"], out).alias("out"), s["done"].alias("done"))

    def block(s: Column, k: Column) -> Column:
        return F.aggregate(F.slice(items, k * BLOCK + 1, BLOCK),
                           F.struct(s["state"].alias("state"), none.alias("out"), s["done"].alias("done")), one,
                           lambda t: F.struct(t["state"].alias("state"), F.array_append(t["done"], t["out"]).alias("done")))

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    return F.when(F.size(items) > 0, F.flatten(F.aggregate(
        blocks, F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("done")), block,
        lambda s: s["done"]))).otherwise(none)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time, also where ``use`` reads it in a loop."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_line(text: Column) -> Column:
    """The words with one blank between them."""
    return F.trim(F.regexp_replace(text, SEPARATORS, " "))


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def steps(text: Column, pattern: Column, found: Column) -> Column:
    """For each match the words before it (from the last one on) and its own; a word has two blanks of its own."""
    before = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    return F.zip_with(before, found, lambda b, m: F.struct(
        (blanks(b) / 2).cast("int").alias("gap"), (blanks(m) / 2).cast("int").alias("size")))


def spans(rules: Column, text: Column) -> Column:
    """An interval of words for each match of each of the ``rules`` (rule, tier, label, pattern)."""
    tried = F.filter(F.transform(rules, lambda r: F.struct(r.alias("r"), F.regexp_extract_all(text, r["pattern"], F.lit(0))
                                                           .alias("found"))), lambda x: F.size(x["found"]) > 0)
    paced = F.transform(tried, lambda x: F.struct(x["r"].alias("r"), steps(text, x["r"]["pattern"], x["found"]).alias("s")))

    def placed(x: Column) -> Column:
        def step(at: Column, s: Column) -> tuple[Column, Column]:
            start, end = at + s["gap"], at + s["gap"] + s["size"] - 1
            return end + 1, F.array(F.struct(
                start.alias("start"), (-end).alias("before"), x["r"]["tier"].alias("tier"), x["r"]["rule"].alias("rule"),
                x["r"]["label"].alias("label"), end.alias("end")))
        return fold(x["s"], F.lit(0), step, SPAN)

    return F.flatten(F.transform(paced, placed))


def unsuppressed(found: Column) -> Column:
    """Sorted spans without those that one of the same or a stronger tier, earlier in the order, covers."""
    def step(ends: Column, x: Column) -> tuple[Column, Column]:
        covered = x["end"] <= F.element_at(ends, x["tier"])
        wider = F.transform(ends, lambda e, i: F.when(i + 1 >= x["tier"], F.greatest(e, x["end"])).otherwise(e))
        return wider, F.when(covered, F.array().cast(f"array<{SPAN}>")).otherwise(F.array(x))
    return fold(found, F.array(*[F.lit(-1) for _ in TIER_SCORES]), step, SPAN)


def _table(rules: list[tuple[int, int, str, str, str]]) -> Column:
    """The rules as one constant."""
    names = ("rule", "tier", "label", "word", "pattern")
    return F.from_json(F.lit(json.dumps([dict(zip(names, r)) for r in rules])),
                       "array<struct<rule: int, tier: int, label: string, word: string, pattern: string>>")


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``n_words``, ``base`` and ``detections`` for every row of ``docs``.

    ``base`` has the places of the base phrases, ``detections`` the intervals (first and last word, from 0) of the
    rules that are not suppressed, each with label, tier and number of the rule. Both are sorted and empty where
    nothing is found. Null text counts as empty. Texts are read whole; repeated rows and null ids each give a row, an
    empty table none.
    """
    line = docs.select(*[F.col(f"`{k}`") for k in keep], words_line(text_or_empty(text)).alias("__line"))
    gate = F.col("__line").rlike("(?i)" + "|".join(GATE))
    wide = F.concat(F.lit(" "), F.replace(F.translate("__line", UPPER, LOWER), F.lit(" "), F.lit("  ")), F.lit(" "))
    n_words = F.when(F.col("__line") == "", 0).otherwise(blanks(F.col("__line")) + 1).cast("long")
    gated = line.select(*keep, n_words.alias("n_words"), F.when(gate, wide).alias("__text"))
    t = F.col("__text")
    words = F.filter(F.split(F.lit(" ".join(sorted({r.word for r in RULES}))), " "),
                     lambda w: F.contains(t, F.concat(F.lit(" "), w, F.lit(" "))))
    rules = _table([(r.number, r.tier, r.label, r.word, r.pattern) for r in RULES])
    phrases = _table([(i, 1, label, "", f" {phrase.replace(' ', '  ')} ") for i, (phrase, label) in enumerate(BASE)])
    tried = once(words, lambda present: F.filter(rules, lambda r: F.array_contains(present, r["word"])))
    found = gated.withColumn("__spans", F.when(t.isNotNull(), F.array_sort(spans(tried, t)))) \
        .withColumn("base", F.when(t.isNotNull(), F.array_sort(spans(phrases, t))))
    none = F.array().cast(f"array<{SPAN}>")
    told = lambda c: F.transform(F.coalesce(c, none), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["tier"].alias("tier"), s["rule"].alias("rule"),
        s["label"].alias("label")))
    kept = F.when(F.size("__spans") > 0, unsuppressed(F.col("__spans")))
    return found.select(*keep, "n_words", told(F.col("base")).alias("base"), told(kept).alias("detections"))


def _listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def digest(found: DataFrame) -> DataFrame:
    """One row of counts and labels for each row of ``scan``."""
    base, rules = F.col("base"), F.col("detections")
    of_base, of_rules = base["label"], rules["label"]
    score = F.greatest(
        F.when(F.size(base) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)),
        F.when(F.size(rules) > 0, F.element_at(F.array(*[F.lit(s) for s in TIER_SCORES]), F.array_min(rules["tier"])))
        .otherwise(F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base["start"]).cast("long").alias("first_word"), F.array_max(base["start"]).cast("long").alias("last_word"),
        _listed(of_base).alias("base_labels"), _listed(F.concat(of_base, of_rules)).alias("labels"), score.alias("score"))
