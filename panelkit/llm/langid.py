"""Language identification by cross-parsing.

For each language a suffix automaton is built from a bounded sample of labelled
text. A text is parsed from left to right into the longest phrases that occur
in the sample. A phrase of a sample of n letters stands for log2(n) bits, so the phrases
are weighted by that; the language that needs the fewest bits wins. Samples are
filled to the same number of letters where a language has so many.

The automata are tables: a row per state, a column per common letter, each
cell with the next state and whether a phrase ended. Arcs of all other letters
of the samples are a sorted list, so that every letter counts as itself. A batch of texts is cut into
segments and all segments take one step at a time, in all languages at once. A segment is parsed again if
the one before it ended in another state than it began with, so that cuts change nothing.
Languages come in blocks of a bounded number; each block parses all texts and keeps the best two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.session import materialize

#: The fit reads passages of at most SAMPLE_LETTERS characters until a language has LETTERS_PER_LANGUAGE codes (letters
#: and gaps between words), at most SAMPLE_ROWS of them.
SAMPLE_ROWS = 4_096
SAMPLE_LETTERS = 400
LETTERS_PER_LANGUAGE = 24_000
#: Languages whose automata are held at once, about 9 MB each. More are parsed block by block.
BLOCK_LANGUAGES = 32

#: Letters with a column of their own in the tables; arcs of rarer ones are searched for. Column 0 is any run of other
#: signs, and a letter that is in no sample is in no phrase.
COLUMNS = 62
#: Letters that a segment holds in a text of at most MOST_SEGMENTS segments (a longer text has longer ones), and code
#: points of a batch.
SEGMENT = 512
MOST_SEGMENTS = 256
BATCH = 1 << 22


def letter_codes(letters: list[str]) -> np.ndarray:
    """A code for each code point: 0 if not a letter, its place in ``letters`` (lower case), or one over the last."""
    rank = {c: i + 1 for i, c in enumerate(letters)}
    other = len(letters) + 1
    out = np.zeros(0x110000, np.int32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            out[cp] = rank.get(c.lower(), other)
    return out


def codes_of(text: str, table: np.ndarray) -> np.ndarray:
    """The codes of a text, each run of zeros reduced to one."""
    codes = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes[np.concatenate([[True], (codes[1:] > 0) | (codes[:-1] > 0)])] if len(codes) else codes


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Arcs of the suffix automaton of a sequence: next state by code for each state, the first being the start."""
    length, link, nexts = [0], [-1], [{}]
    last = 0
    for c in codes:
        now = len(length)
        length.append(length[last] + 1)
        link.append(0)
        nexts.append({})
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = now
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                nexts.append(dict(nexts[q]))
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return nexts


@dataclass
class Model:
    """``table``: cells of all languages, (state row times columns) * 2 + whether a phrase ended.

    ``rare_keys`` (row, rare letter) are sorted, with a cell each; ``rare_first`` has the cells with which a rare letter
    begins a phrase, by language. ``bits`` is the weight of a phrase, by language.
    """

    langs: list[str]
    letters: np.ndarray
    table: np.ndarray
    starts: np.ndarray
    width: int
    rare_keys: np.ndarray
    rare_cells: np.ndarray
    rare_first: np.ndarray
    bits: np.ndarray


def train(samples: dict[str, list[str]]) -> Model:
    """Automata from sample texts by language."""
    counts: dict[str, int] = {}
    for texts in samples.values():
        for t in texts:
            for c in t.lower():
                if c.isalpha() and len(c) == 1:
                    counts[c] = counts.get(c, 0) + 1
    letters = sorted(sorted(counts), key=lambda c: -counts[c])
    table = letter_codes(letters)
    common = min(len(letters), COLUMNS)
    n_rare = len(letters) - common
    pad = common + 2
    width = pad + 1
    blocks, starts, base = [], [], 0
    bits = np.zeros(len(samples))
    keys: list[int] = []
    cells_of: list[int] = []
    rare_first = np.zeros((len(samples), n_rare), np.int64)
    for k, lang in enumerate(sorted(samples)):
        joined: list[int] = []
        for t in samples[lang]:
            joined.extend([0, *codes_of(t, table).tolist()])
        joined = joined[:LETTERS_PER_LANGUAGE]
        bits[k] = np.log2(len(joined) + 1)
        arcs = suffix_automaton(joined)
        auto = np.full((len(arcs), width), -1, np.int64)
        rare_first[k] = 2 * (len(arcs) + base) * width + 1
        for state, step in enumerate(arcs):
            for c, to in step.items():
                if c <= common:
                    auto[state, c] = to
                else:
                    keys.append((state + base) * n_rare + c - common - 1)
                    cells_of.append(2 * (to + base) * width)
                    if state == 0:
                        rare_first[k, c - common - 1] = cells_of[-1] + 1
        # after a letter that is in no phrase, the next one begins a phrase: a state of its own
        lost = len(auto)
        fresh = np.where(auto[0] >= 0, auto[0], lost)
        cells = np.where(auto >= 0, 2 * (auto + base) * width, 2 * (fresh + base) * width + 1)
        cells = np.concatenate([cells, (2 * (fresh + base) * width + 1)[None]])
        cells[:, pad] = 2 * (np.arange(len(cells)) + base) * width  # padding moves nothing
        blocks.append(cells)
        starts.append((lost + base) * width)
        base += len(cells)
    whole = np.concatenate(blocks) if blocks else np.zeros((0, width), np.int64)
    kind = np.int32 if whole.size * 2 < 2 ** 31 else np.int64
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return Model(sorted(samples), table, whole.astype(kind).ravel(), np.array(starts, np.int64), width,
                 np.array(keys, np.int64)[order], np.array(cells_of, np.int64)[order], rare_first, bits)


def phrases(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each text in each language, and the number of its letters."""
    return parse(model, texts)[:2]


def parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``phrases``, and how many letters are in no sample of the language.

    Segments are parsed side by side from the start and then again from the state in which the one before ended, until
    that state is the one they were parsed from: the result is that of the uncut text.
    """
    coded = [codes_of(t, model.letters) for t in texts]
    n_letters = np.array([np.count_nonzero(c) for c in coded], np.int64)
    parts, owner = [], []
    for i, c in enumerate(coded):
        if n_letters[i]:
            size = max(SEGMENT, -(-len(c) // MOST_SEGMENTS))
            for at in range(0, len(c), size):
                parts.append(c[at:at + size])
                owner.append(i)
    counts = np.zeros((len(texts), len(model.langs)), np.int64)
    unknown = np.zeros_like(counts)
    if not parts or not model.langs:
        return counts, n_letters, unknown
    own = np.array(owner)
    follows = np.concatenate([[False], own[1:] == own[:-1]])
    begin = np.repeat(model.starts[:, None], len(parts), axis=1).astype(model.table.dtype)
    end, ended, lost = np.empty_like(begin), np.zeros(begin.shape, np.int32), np.zeros(begin.shape, np.int32)
    todo = np.arange(len(parts))
    while len(todo):
        end[:, todo], ended[:, todo], lost[:, todo] = _walk(model, [parts[k] for k in todo], begin[:, todo])
        before = np.where(follows, np.roll(end, 1, axis=1), begin)
        todo = np.flatnonzero((before != begin).any(axis=0))
        begin = before
    for k in range(len(model.langs)):
        counts[:, k] = np.bincount(own, weights=ended[k], minlength=len(texts))
        unknown[:, k] = np.bincount(own, weights=lost[k], minlength=len(texts))
    return counts, n_letters, unknown


def _walk(model: Model, parts: list[np.ndarray], begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The states (a row per language) in which segments end, the phrases begun and the letters in no sample."""
    sizes = np.array([len(p) for p in parts])
    order = np.argsort(-sizes, kind="stable")
    grid = np.full((int(sizes.max()), len(parts)), model.width - 1, np.int32)
    for lane, k in enumerate(order):
        grid[:len(parts[k]), lane] = parts[k]
    other, n_rare = model.width - 2, model.rare_first.shape[1]
    rare = np.where(sizes[order] > np.arange(len(grid))[:, None], grid - other, -1)  # the place among the rare letters
    grid = np.minimum(grid, model.width - 1) if not n_rare else np.where(rare >= 0, other, grid)
    rare[rare >= n_rare] = -1  # in no sample
    some = (rare >= 0).any(axis=1)
    alive = np.searchsorted(-sizes[order], -np.arange(len(grid)), "left")  # lanes longer than the step
    state = begin[:, order]
    ended, lost = np.zeros(state.shape, np.int32), np.zeros(state.shape, np.int32)
    for step in range(len(grid)):
        n = alive[step]
        cell = model.table[state[:, :n] + grid[step, :n]]
        if some[step]:
            lanes = np.flatnonzero(rare[step, :n] >= 0)
            key = state[:, lanes].astype(np.int64) // model.width * n_rare + rare[step, lanes]
            at = np.minimum(np.searchsorted(model.rare_keys, key), len(model.rare_keys) - 1)
            cell[:, lanes] = np.where(model.rare_keys[at] == key, model.rare_cells[at], model.rare_first[:, rare[step, lanes]])
        ended[:, :n] += cell & 1
        state[:, :n] = cell >> 1
        lost[:, :n] += (state[:, :n] == model.starts[:, None]) & (grid[step, :n] > 0)
    back = np.argsort(order)
    return state[:, back], ended[:, back], lost[:, back]


#: What a block of languages says of a text: bits, letters in no sample and name of the best two, or null names.
BEST = "b1 double, u1 long, l1 string, b2 double, u2 long, l2 string"


def best_two(model: Model, texts: list[str]) -> pd.DataFrame:
    """The columns of BEST for each text; null names if it has no letter or there is no such language."""
    out: list[tuple] = []
    first, size = 0, 0
    for i, t in enumerate([*texts, None]):
        if t is None or (size and size + len(t) > BATCH):
            counts, letters, unknown = parse(model, texts[first:i])
            bits = counts * model.bits
            for k in range(i - first):
                order = np.lexsort((unknown[k], bits[k]))[:2].tolist() if letters[k] else []
                row = [x for j in order for x in (float(bits[k][j]), int(unknown[k][j]), model.langs[j])]
                out.append(tuple(row + [None] * (6 - len(row))))
            first, size = i, 0
        size += len(t or "")
    return pd.DataFrame(out, columns=[c.split()[0] for c in BEST.split(", ")]).astype({"u1": "Int64", "u2": "Int64"})


def predict(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The language of each text and, as a score, how many fewer bits it takes than the second best."""
    best = best_two(model, texts)
    langs = [x if isinstance(x, str) else "und" for x in best["l1"]]
    b1, b2 = best["b1"].to_numpy(float), best["b2"].to_numpy(float)
    return langs, np.where(best["l1"].isna(), 0.0, np.where(b2 > 0, 1 - b1 / np.where(b2 > 0, b2, 1.0), 1.0))


def held_out() -> Column:
    """Rows no fit may learn from: the CRC-32 of the doc_id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _room(docs: DataFrame) -> list[tuple[str, float]]:
    """Each language that may be learned, with the share of its rows (by hash) that fills its sample about twice."""
    ids = (_learnable(docs).groupBy("doc_id", "lang").agg(F.max("chars").alias("chars"))  # copies of an id count once
           .groupBy("lang").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n")).collect())
    return sorted((r.lang, min(1.0, max((2 * LETTERS_PER_LANGUAGE + 20 * SAMPLE_LETTERS) / max(1, r.chars), 50 / r.n)))
                  for r in ids)


def _learnable(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, chars, h, passage`` of rows with a language that are not held out; passages from anywhere in the text."""
    text, h = text_or_empty(), F.xxhash64("doc_id")
    room = F.greatest(F.length(text) - SAMPLE_LETTERS, F.lit(0)) + 1
    return (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
            .select("doc_id", F.col("lang").cast("string").alias("lang"),
                    F.least(F.length(text), F.lit(SAMPLE_LETTERS)).cast("long").alias("chars"), h.alias("h"),
                    F.substring(text, (F.pmod(h, room) + 1).cast("int"), F.lit(SAMPLE_LETTERS)).alias("passage")))


def _samples(docs: DataFrame, rooms: list[tuple[str, float]]) -> dict[str, list[str]]:
    """Passages by language, in hash order, until a sample is full. About twice as many are read."""
    if not rooms:
        return {}
    near = F.broadcast(docs.sparkSession.createDataFrame(rooms, "lang string, share double"))  # a block of languages
    rows = (_learnable(docs).join(near, "lang").where(F.pmod(F.col("h"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
            .groupBy("doc_id", "lang", "h").agg(F.min("passage").alias("text")).collect())
    samples: dict[str, list[str]] = {}
    letters: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: (r.h % (1 << 30), r.h, r.doc_id, r.text)):
        n = sum(c.isalpha() for c in r.text)
        if n and letters.get(r.lang, 0) < LETTERS_PER_LANGUAGE and len(samples.get(r.lang, [])) < SAMPLE_ROWS:
            samples.setdefault(r.lang, []).append(r.text)
            letters[r.lang] = letters.get(r.lang, 0) + n
    return samples


def fit(docs: DataFrame) -> Model:
    """Train on a bounded, hash-ordered sample of rows with a language that are not held out, all languages at once."""
    return train(_samples(docs, _room(docs)))


def _said(model: Model) -> Column:
    @F.pandas_udf(BEST)
    def said(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield best_two(model, texts.tolist())

    return said(text_or_empty())


def _answer(best: Column) -> list[Column]:
    """Language and score of the best two by bits, letters in no sample and name, null if there is none."""
    first, second = F.get(best, 0), F.get(best, 1)
    score = F.when(second["b"] > 0, 1 - first["b"] / second["b"]).otherwise(1.0)
    return [F.coalesce(first["l"], F.lit("und")).alias("lang_pred"),
            F.when(first["l"].isNull(), 0.0).otherwise(score).alias("score")]


def _two(r: Column) -> Column:
    parts = [F.struct(r[f"b{i}"].alias("b"), r[f"u{i}"].alias("u"), r[f"l{i}"].alias("l")) for i in (1, 2)]
    return F.filter(F.array(*parts), lambda p: p["l"].isNotNull())


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``, from its whole text only.

    A null text, one without a letter, or any text if nothing could be learned, is ``und`` with score 0.
    Among languages with equally few bits the one whose sample lacks the fewest of the text's letters wins, then the
    first by name, with score 0. A language without a letter to learn from is never an answer. Repeated rows each give a
    row, a null doc_id is not held out, an empty table gives no rows. There may be any number of languages: up to
    BLOCK_LANGUAGES are asked in one pass without a shuffle; beyond that each block is a pass, and its answers
    for distinct texts of an id, not the texts, are merged.
    """
    rooms = _room(docs)
    if len(rooms) <= BLOCK_LANGUAGES:
        rows = docs.select("doc_id", held_out().alias("held_out"), _said(train(_samples(docs, rooms))).alias("r"))
        return rows.select("doc_id", "held_out", *_answer(_two(F.col("r"))))
    key = ["doc_id", "text_hash", "chars"]
    parts = None
    for at in range(0, len(rooms), BLOCK_LANGUAGES):
        model = train(_samples(docs, rooms[at:at + BLOCK_LANGUAGES]))
        part = (docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), F.length(text_or_empty()).alias("chars"),
                            _said(model).alias("r"))
                .groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("r")))
        part = materialize(part.select(*key, "n", _two(F.col("r")).alias("best")))  # one block's automata are held at a time
        parts = part if parts is None else parts.unionByName(part)
    best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, 2)
    rows = parts.groupBy(*key).agg(F.max("n").alias("n"), best.alias("best"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("doc_id", held_out().alias("held_out"), *_answer(F.col("best")))
