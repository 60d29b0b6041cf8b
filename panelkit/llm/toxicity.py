"""Toxicity scores by a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings: of the whole word and of its prefixes,
so that inflected forms share what their stem has learned. Filters of several
widths run over the words, max pooling keeps each filter's strongest answer
anywhere in the text, and a logistic layer gives the score. Embeddings begin with the word's
leaning towards toxic texts of the fit, and what fewer than LEAST_TEXTS of these texts hold is no input.

Words are hashed by numpy over the bytes of many texts at once. At scoring time
each filter's share of each hash bucket is a table row, so a text costs table
look-ups and sums; texts of any length are read in blocks, and memory is
bounded by the block. The language used for the threshold is guessed from the
words of the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import broadcast_if_small, text_or_empty
from panelkit.session import materialize

#: Scores from here on count as toxic.
CUT = 0.3
#: The weights are learned from at most this many labelled rows of each class, dealt over the languages.
SAMPLE_PER_CLASS = 1500
#: A clean text longer than SAMPLE_CHARS is learned from a passage of that length, a toxic one too once the whole
#: long toxic texts have LONG_CHARS together. Thresholds are taken from whole texts.
SAMPLE_CHARS = 20_000
LONG_CHARS = 10_000_000
#: Width of a bin of logits in the counts that the thresholds are taken from.
BIN = 1 / 64

BUCKETS = 1 << 15
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 4
PREFIXES = (3, 4, 5, 6)
#: The fit takes about this many passes over a row in all, in 4 to 40 rounds.
PASSES = 9_000
BATCH = 32
RATE = 0.15
SEED = 7
#: A threshold from n rows of the rarer class that the weights have not seen counts n times, what it is drawn towards
#: PRIOR times: the threshold of all languages for a language, and for that one the logit of CUT, which the weights fit.
PRIOR = 20
#: With fewer labelled rows than this a language is not told apart.
LEAST_ROWS = 5

#: A bucket of fewer texts of the fit is no input; an embedding begins with its leaning towards toxic texts times this.
LEAST_TEXTS = 3
LEAN = 0.1

#: Bytes of text read at a time.
BLOCK = 1 << 19
N_HASH = 1 + len(PREFIXES)
#: Taps: the (width, place) pairs; each is a column group of the look-up table.
TAPS = [(w, j) for w in WIDTHS for j in range(w)]
#: No-word rows after each text, as many as the widest filter reaches beyond its place.
PAD = max(WIDTHS) - 1

#: Bytes of words, A-Z lower-cased; 0 for all that parts words.
LETTER = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 0 for b in range(256)], np.uint8)
#: An odd multiplier and its inverse modulo 2**64, for polynomial hashes of byte ranges.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]).cumprod(dtype=np.uint64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return 1 + ((h >> np.uint64(32)) % np.uint64(BUCKETS - 1)).astype(np.int64)


class Reader:
    """Hashes the words of texts."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n + 1 > len(self.up):
            self.up, self.down = _powers(BASE, n + 1), _powers(INVERSE, n + 1)
        return self.up[:n], self.down

    @staticmethod
    def lower(data: np.ndarray) -> np.ndarray:
        low = LETTER[data]
        # an upper-case Latin-1 letter is 0xC3 and 0x80 to 0x9E, its lower case 0x20 more
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        low[after] |= np.where(low[after] < 0x9F, 0x20, 0).astype(np.uint8)
        return low

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's start and its buckets: the whole word, then its prefixes (0, which has no weight, if too short)."""
        up, down = self.powers(len(data))
        low = self.lower(data)
        inside = np.concatenate([[False], low > 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low * up, dtype=np.uint64)])
        out = np.zeros((len(start), N_HASH), np.int64)
        for col, k in enumerate((0, *PREFIXES)):
            at = np.flatnonzero(end - start > k) if k else np.arange(len(start))
            a = start[at]
            out[at, col] = _bucket((sums[a + k if k else end[at]] - sums[a]) * down[a] + np.uint64(k))
        return start, out

    def parts(self, text: bytes) -> Iterator[np.ndarray]:
        """Buckets of the words of a long text, some at a time. It is cut between words only."""
        data, at = np.frombuffer(text, np.uint8), 0
        while at < len(data):
            gaps = np.flatnonzero(LETTER[data[at:at + BLOCK]] == 0)
            if len(gaps) or at + BLOCK >= len(data):
                end = at + (int(gaps[-1]) + 1 if len(gaps) and at + BLOCK < len(data) else BLOCK)
                yield self.words(data[at:end])[1]
            else:  # a word longer than a block
                end = at + BLOCK
                while end < len(data) and LETTER[data[end]]:
                    gaps = np.flatnonzero(LETTER[data[end:end + BLOCK]] == 0)
                    end += int(gaps[0]) if len(gaps) else min(BLOCK, len(data) - end)
                yield self.long_word(data[at:end])
            at = end

    def long_word(self, data: np.ndarray) -> np.ndarray:
        """What ``words`` gives for a single word, in memory of a block."""
        out = self.words(data[:BLOCK // 2])[1]  # the prefixes
        total, power = 0, 1
        for at in range(0, len(data), BLOCK):
            before = min(at, 1)  # a letter's case is told by the byte before
            low = self.lower(data[at - before:at + BLOCK])[before:]
            total += power * int(np.sum(low * self.powers(len(low))[0], dtype=np.uint64))
            power = power * pow(BASE, len(low), 1 << 64) % (1 << 64)
        out[0, 0] = _bucket(np.array([total % (1 << 64)], np.uint64))[0]
        return out

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all words, each text followed by PAD rows of no word, and the row where each text starts."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.cumsum(lengths) - lengths
        start, found = self.words(np.frombuffer(b"\0".join(texts) + b"\0", np.uint8))
        of = np.searchsorted(begins, start, "right") - 1
        counts = np.bincount(of, minlength=len(texts))
        rows = np.zeros((len(found) + PAD * len(texts), N_HASH), np.int64)
        rows[np.arange(len(found)) + PAD * of] = found
        return rows, np.cumsum(counts + PAD) - counts - PAD


@dataclass
class Model:
    """``table``: per bucket the share of each tap's filters, then of each language's word weights."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    langs: list[str]
    shift: np.ndarray


def _blocks(texts: list[bytes], reader: Reader) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Texts in groups of about BLOCK bytes: index of the first, rows of words, where each text starts, places to use.

    A longer text comes in parts, each beginning with the last PAD words of the part before. The last PAD places
    of a part are left to the next one, so that all parts together have the places of the whole text.
    """
    group, size, first = [], 0, 0
    for i, text in enumerate(texts):
        if len(text) > 2 * BLOCK:
            if group:
                yield first, *(rows := reader.read(group)), len(rows[0])
            carry = np.zeros((0, N_HASH), np.int64)
            for found in reader.parts(text):
                carry = np.concatenate([carry, found])
                if len(carry) > PAD:
                    yield i, carry, np.zeros(1, np.int64), len(carry) - PAD
                    carry = carry[-PAD:]
            rows = np.concatenate([carry, np.zeros((PAD, N_HASH), np.int64)])
            yield i, rows, np.zeros(1, np.int64), len(rows)
            group, size, first = [], 0, i + 1
            continue
        group.append(text)
        size += len(text)
        if size > BLOCK:
            yield first, *(rows := reader.read(group)), len(rows[0])
            group, size, first = [], 0, i + 1
    if group:
        yield first, *(rows := reader.read(group)), len(rows[0])


def logits(model: Model, texts: list[bytes], reader: Reader) -> tuple[np.ndarray, np.ndarray]:
    """Each text's uncalibrated logit and guessed language."""
    n_tap, n_lang = len(TAPS) * FILTERS, len(model.langs)
    pooled = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
    votes = np.zeros((len(texts), n_lang), np.float64)
    for first, buckets, starts, n in _blocks(texts, reader):
        share = model.table[buckets[:, 0]]
        for k in range(1, N_HASH):
            share += model.table[buckets[:, k]]
        filters = np.empty((len(share), len(WIDTHS) * FILTERS), np.float32)
        for at, w in enumerate(WIDTHS):
            own = filters[:, at * FILTERS:(at + 1) * FILTERS]
            own[:] = model.bias[w]
            for k, (width, j) in enumerate(TAPS):
                if width == w:
                    own[:len(share) - j] += share[j:, k * FILTERS:(k + 1) * FILTERS]
        if n == len(share):  # from the rows of no word a filter must not reach into the next text
            for back in range(1, PAD + 1):
                filters[np.append(starts[1:], n) - back] = np.concatenate([model.bias[w] for w in WIDTHS])
        rows = slice(first, first + len(starts))
        pooled[rows] = np.maximum(pooled[rows], np.maximum.reduceat(filters[:n], starts, axis=0))
        votes[rows] += np.add.reduceat(share[:n, n_tap:], starts, axis=0, dtype=np.float64)
    z = np.maximum(pooled, 0).astype(np.float64) @ model.out + model.out_bias
    return z, votes.argmax(axis=1) if n_lang else np.zeros(len(texts), np.int64)


def scores(model: Model, texts: list[bytes], reader: Reader) -> np.ndarray:
    """Calibrated scores of UTF-8 texts."""
    if not texts:
        return np.zeros(0)
    z, lang = logits(model, texts, reader)
    return 1 / (1 + np.exp(-np.clip(z + model.shift[lang], -30, 30)))


def _language_weights(hashes: list[np.ndarray], langs: np.ndarray, n_lang: int) -> np.ndarray:
    """Per bucket of whole words and language: smoothed log share of the language's words."""
    counts = np.zeros((BUCKETS, n_lang))
    for h, k in zip(hashes, langs):
        np.add.at(counts[:, k], h[:, 0], 1)
    counts[0] = 0
    logs = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * BUCKETS))
    logs -= logs.mean(axis=1, keepdims=True)
    logs[0] = 0
    return logs


def train(texts: list[bytes], labels: list[int], langs: list[str | None]) -> Model:
    """Fit filters, embeddings and thresholds. Every fifth row is held back for the thresholds, which are drawn
    towards CUT the more the fewer these rows are.

    Without rows of both classes the model gives every text the share of toxic rows (0 without rows).
    """
    names = sorted({x for x in langs if x is not None})
    y = np.array(labels, np.float64)
    reader = Reader()
    docs = [reader.read([t])[0] for t in texts]
    known = [i for i, x in enumerate(langs) if x is not None]
    weights = _language_weights([docs[i] for i in known], np.array([names.index(langs[i]) for i in known]),
                                len(names)) if names else np.zeros((BUCKETS, 0))
    rng = np.random.default_rng(SEED)
    n_out = len(WIDTHS) * FILTERS
    emb = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    emb[0] = 0
    taps = rng.normal(0, 0.5, (DIM, len(TAPS) * FILTERS)).astype(np.float32)
    bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
    out, out_bias = rng.normal(0, 0.3, n_out), 0.0
    model = Model(np.zeros((BUCKETS, len(TAPS) * FILTERS + len(names)), np.float32), bias, out, out_bias, names,
                  np.zeros(max(1, len(names))))
    if len(set(labels)) < 2:
        model.out = np.zeros(n_out)
        model.out_bias = -30.0 if not labels or not labels[0] else 30.0
        return model
    held = np.arange(len(docs)) % 5 == 0
    fit = np.flatnonzero(~held) if len(set(y[~held])) == 2 else np.arange(len(docs))
    heard, lean = _leaning([docs[i] for i in fit], y[fit])
    emb[~heard] = 0
    emb[:, 0] += lean
    taps[0] = np.abs(taps[0])
    g_emb, g_taps = np.full(BUCKETS, 1e-2), np.full(taps.shape, 1e-2)
    g_out, g_ob, g_bias = np.full(n_out, 1e-2), 1e-2, {w: np.full(FILTERS, 1e-2) for w in WIDTHS}
    first_tap = {w: TAPS.index((w, 0)) for w in WIDTHS}
    for _ in range(min(40, max(4, PASSES // len(fit)))):
        order = rng.permutation(fit)
        for at in range(0, len(order), BATCH):
            d_emb: dict[str, list] = {"row": [], "grad": []}
            d_taps, d_out, d_ob = np.zeros_like(taps), np.zeros(n_out), 0.0
            d_bias = {w: np.zeros(FILTERS) for w in WIDTHS}
            part = order[at:at + BATCH]
            for i in part:
                h = docs[i]
                x = emb[h].sum(axis=1)
                resp = x @ taps
                best, arg = [], []
                for w in WIDTHS:
                    total = np.broadcast_to(bias[w], (len(x), FILTERS)).copy()
                    for j in range(w):
                        k = first_tap[w] + j
                        total[:len(x) - j] += resp[j:, k * FILTERS:(k + 1) * FILTERS]
                    a = total.argmax(axis=0)
                    arg.append(a)
                    best.append(total[a, np.arange(FILTERS)])
                pooled = np.maximum(np.concatenate(best), 0).astype(np.float64)
                err = 1 / (1 + np.exp(-np.clip(pooled @ out + out_bias, -30, 30))) - y[i]
                d_out += err * pooled
                d_ob += err
                back = err * out * (pooled > 0)
                for n, w in enumerate(WIDTHS):
                    g = back[n * FILTERS:(n + 1) * FILTERS]
                    d_bias[w] += g
                    for f in np.flatnonzero(g):
                        for j in range(w):
                            p = arg[n][f] + j
                            if p < len(x):
                                col = (first_tap[w] + j) * FILTERS + f
                                d_taps[:, col] += g[f] * x[p]
                                for b in h[p]:
                                    if heard[b]:
                                        d_emb["row"].append(b)
                                        d_emb["grad"].append((g[f], col))
            m = len(part)
            old = taps.copy()
            g_taps += (d_taps / m) ** 2
            taps -= (RATE * d_taps / m / np.sqrt(g_taps)).astype(np.float32)
            g_out += (d_out / m) ** 2
            out -= RATE * d_out / m / np.sqrt(g_out)
            g_ob += (d_ob / m) ** 2
            out_bias -= RATE * d_ob / m / np.sqrt(g_ob)
            for w in WIDTHS:
                g_bias[w] += (d_bias[w] / m) ** 2
                bias[w] -= (RATE * d_bias[w] / m / np.sqrt(g_bias[w])).astype(np.float32)
            if d_emb["row"]:
                rows, inverse = np.unique(np.array(d_emb["row"]), return_inverse=True)
                size, col = np.array([g for g, _ in d_emb["grad"]]), np.array([c for _, c in d_emb["grad"]])
                grad = np.zeros((len(rows), DIM))
                np.add.at(grad, inverse, size[:, None] * old[:, col].T / m)
                g_emb[rows] += (grad ** 2).mean(axis=1)
                emb[rows] -= (RATE * grad / np.sqrt(g_emb[rows])[:, None]).astype(np.float32)
    model.table[:, :len(TAPS) * FILTERS] = emb @ taps
    model.table[0] = 0
    model.table[:, len(TAPS) * FILTERS:] = weights
    model.out, model.out_bias, model.bias = out, out_bias, bias
    check = np.flatnonzero(held) if len(fit) < len(docs) else fit[:0]
    z, lang = logits(model, [texts[i] for i in check], reader) if len(check) else (np.zeros(0), np.zeros(0, int))
    at_cut = np.log(CUT / (1 - CUT))
    every = _drawn(at_cut, z, y[check])
    for k in range(len(model.shift)):
        own = lang == k
        model.shift[k] = at_cut - (_drawn(every, z[own], y[check][own]) if names else every)
    return model


def _drawn(towards: float, z: np.ndarray, y: np.ndarray) -> float:
    """The threshold of some rows, drawn towards another one the more the fewer they are."""
    n = min((y == 1).sum(), (y == 0).sum())
    return (n * threshold(z, y) + PRIOR * towards) / (n + PRIOR) if n else towards


def _leaning(docs: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that LEAST_TEXTS texts hold, and how much more of the toxic ones hold them (log odds over their deviation).

    A word that one or two texts hold tells these texts apart from the others, not toxic from clean ones; it is no input.
    """
    n = np.zeros((2, BUCKETS))
    for h, toxic in zip(docs, y):
        n[int(toxic), np.unique(h)] += 1
    known = n.sum(axis=0) >= LEAST_TEXTS
    known[0] = False
    of = np.array([[(y == 0).sum()], [(y == 1).sum()]], np.float64)
    odds = np.log((n + 0.5) / (of - n + 0.5))
    z = (odds[1] - odds[0]) / np.sqrt((1 / (n + 0.5)).sum(axis=0))
    return known, np.where(known, np.clip(z, 0, 6) * LEAN, 0).astype(np.float32)


def threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The cut between two values that gives the best F1; among equals, the middle of the widest gap."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    hits = y.sum() - np.concatenate([[0], np.cumsum(y)])
    picked = len(y) - np.arange(len(y) + 1)
    f1 = 2 * hits / np.maximum(picked + y.sum(), 1)
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    gap = np.diff(edges)
    best = max(range(len(f1)), key=lambda k: (gap[k] > 0, round(f1[k], 9), gap[k]))
    return float((edges[best] + edges[best + 1]) / 2)


def held_out() -> Column:
    """Rows whose labels no fit may see: the CRC-32 of the doc_id as text leaves 2 in modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _marks(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the rows a fit may see. With several labels one that says toxic counts; null ones do not."""
    return (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
            .groupBy("doc_id").agg((F.max(F.col("toxic").cast("int")) == 1).cast("int").alias("toxic")))


def shares(counts: dict[str, int], total: int) -> dict[str, int]:
    """``total`` rows dealt evenly over groups; what a small group leaves goes to the larger ones."""
    out, left = {}, total
    for k, (name, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[name] = min(n, max(1, left // (len(counts) - k)))
        left = max(0, left - out[name])
    return out


def _sample(docs: DataFrame, marks: DataFrame) -> tuple[list, list[str]]:
    """Rows (doc_id, text, toxic, lang) to learn from, and the languages that are told apart.

    Of each class SAMPLE_PER_CLASS rows, dealt over the languages, of texts of any length. Copies of a row count once.
    """
    order = F.xxhash64("doc_id", "text_hash")
    texts = docs.select("doc_id", text_or_empty().alias("text"), F.col("lang").cast("string").alias("lang"))
    known = materialize(
        texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.length("text").alias("chars"), "lang")
        .groupBy("doc_id", "text_hash", "chars").agg(F.min("lang").alias("lang")).join(marks, "doc_id")
        .withColumn("stratum", F.concat(F.col("toxic").cast("string"), F.coalesce("lang", F.lit("")))))
    counts = known.groupBy("stratum", "toxic", "lang").count().collect()
    of_lang: dict[str, int] = {}
    for r in counts:
        if r.lang is not None:
            of_lang[r.lang] = of_lang.get(r.lang, 0) + r["count"]
    strata: list[dict[str, int]] = [{}, {}]
    for r in counts:
        strata[r.toxic][r.stratum] = strata[r.toxic].get(r.stratum, 0) + r["count"]
    quota = shares(strata[0], SAMPLE_PER_CLASS) | shares(strata[1], SAMPLE_PER_CLASS)
    if not quota:
        return [], []
    # rows with small hashes, somewhat more than are needed; their number does not grow with the table
    limits = [(name, min(1.0, (2 * quota[name] + 50) / n)) for part in strata for name, n in part.items()]
    limits = docs.sparkSession.createDataFrame(limits, "stratum string, share double")
    near = (known.withColumn("h", order).join(F.broadcast(limits), "stratum")
            .where(F.pmod(F.col("h"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
            .select("doc_id", "text_hash", "chars", "toxic", "lang", "stratum", "h").collect())
    picked, long = [], 0
    for r in sorted(near, key=lambda r: (r.h % (1 << 30), r.h, r.doc_id, r.text_hash)):
        if quota[r.stratum] > 0:
            quota[r.stratum] -= 1
            whole = r.chars <= SAMPLE_CHARS
            if not whole and r.toxic and long + r.chars <= LONG_CHARS:
                whole, long = True, long + r.chars
            room = max(1, r.chars - SAMPLE_CHARS + 1)
            picked.append((r.doc_id, r.text_hash, r.chars, r.toxic, r.lang, 1 if whole else 1 + r.h % room,
                           r.chars if whole else SAMPLE_CHARS))
    kind = {f.name: f.dataType.simpleString() for f in known.schema}
    chosen = docs.sparkSession.createDataFrame(
        picked, f"doc_id {kind['doc_id']}, text_hash long, chars int, toxic int, own string, at int, take int")
    rows = (texts.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.length("text").alias("chars"))
            .join(F.broadcast(chosen), ["doc_id", "text_hash", "chars"])
            .select("doc_id", F.expr("substring(text, at, take)").alias("text"), "toxic", F.col("own").alias("lang"))
            .distinct().collect())
    return (sorted(rows, key=lambda r: (crc32(str(r.doc_id).encode()), r.doc_id, r.text)),
            sorted(name for name, n in of_lang.items() if n >= LEAST_ROWS))


def _learn(docs: DataFrame, marks: DataFrame) -> tuple[Model, list]:
    """The model with thresholds from its sample, and the doc_ids its weights have seen."""
    sample, names = _sample(docs, marks)
    own = set(names)
    model = train([r.text.encode() for r in sample], [r.toxic for r in sample],
                  [r.lang if r.lang in own else None for r in sample])
    held = np.arange(len(sample)) % 5 == 0
    rest = {r.toxic for r, h in zip(sample, held) if not h}
    return model, [r.doc_id for r, h in zip(sample, held) if len(rest) < 2 or not h]


def _raw_column(model: Model) -> Column:
    """Uncalibrated logit and place of the guessed language of the text."""
    @F.pandas_udf("z double, k int")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for texts in batches:
            z, k = logits(model, texts.tolist(), reader) if len(texts) else (np.zeros(0), np.zeros(0))
            yield pd.DataFrame({"z": z.astype("float64"), "k": k.astype("int32")})

    return raw(text_or_empty().cast("binary"))


def _raw(docs: DataFrame, model: Model) -> DataFrame:
    return docs.select("doc_id", _raw_column(model).alias("r")).select("doc_id", "r.z", "r.k")


def counted_cut(at: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """``threshold`` for counts of rows at ascending values."""
    hits = toxic.sum() - np.concatenate([[0], np.cumsum(toxic)])
    picked = hits + clean.sum() - np.concatenate([[0], np.cumsum(clean)])
    f1 = np.round(2 * hits / np.maximum(picked + toxic.sum(), 1e-9), 9)
    edges = np.concatenate([[at[0] - 1], at, [at[-1] + 1]])
    best = np.lexsort((-np.arange(len(f1)), np.diff(edges), f1))[-1]
    return float((edges[best] + edges[best + 1]) / 2)


def calibrate(model: Model, raw: DataFrame, marks: DataFrame, seen: list) -> Model:
    """Set the thresholds from all labelled rows of ``raw`` (doc_id, z, k), by counts of logits in bins.

    Rows that the weights have learned from score better than they should. They count through the unseen rows
    of their class and language, which are weighted up to the number of all. Copies of a row count once. The fewer unseen
    rows there are, the more a threshold is drawn towards the general one (PRIOR).
    """
    if not model.out.any():  # one class only
        return model
    kind = marks.schema["doc_id"].dataType.simpleString()
    known = marks.join(F.broadcast(marks.sparkSession.createDataFrame([(x,) for x in set(seen)], f"doc_id {kind}")
                                   .withColumn("seen", F.lit(True))), "doc_id", "left")
    rows = (raw.distinct().join(known, "doc_id")
            .groupBy("k", "toxic", F.coalesce("seen", F.lit(False)).alias("seen"),
                     F.floor(F.col("z") / F.lit(BIN)).alias("bin")).count().collect())
    bins = sorted({r.bin for r in rows})
    at = {b: i for i, b in enumerate(bins)}
    values = (np.array(bins) + 0.5) * BIN
    n_lang = max(1, len(model.langs))
    counts = np.zeros((2, n_lang, 2, len(bins)))  # seen, language, class, bin
    for r in rows:
        counts[int(r.seen), r.k, r.toxic, at[r.bin]] += r["count"]
    unseen, every = counts[0], counts.sum(axis=0)
    n = unseen.sum(axis=2)
    fair = unseen * (every.sum(axis=2) / np.maximum(n, 1))[:, :, None]
    at_cut = np.log(CUT / (1 - CUT))
    total = unseen.sum(axis=0) * (every.sum(axis=(0, 2)) / np.maximum(n.sum(axis=0), 1))[:, None]
    cut = at_cut
    if (least := n.sum(axis=0).min()):
        cut = (least * counted_cut(values, total[1], total[0]) + PRIOR * at_cut) / (least + PRIOR)
    model.shift[:] = at_cut - cut
    for k in range(n_lang):
        if (least := n[k].min()):
            own = fair[k].sum(axis=0) > 0
            own_cut = counted_cut(values[own], fair[k][1][own], fair[k][0][own])
            model.shift[k] = at_cut - (least * own_cut + PRIOR * cut) / (least + PRIOR)
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Weights from a bounded sample, thresholds from all labelled rows that are not held out."""
    marks = materialize(_marks(labels))
    model, seen = _learn(docs, marks)
    small = broadcast_if_small(marks)
    if small is marks:  # many labels: all texts are scored where they lie and only the scores are sent
        return calibrate(model, _raw(docs, model), marks, seen)
    return calibrate(model, _raw(docs.join(small.select("doc_id"), "doc_id", "left_semi"), model), marks, seen)


def score_column(model: Model, name: str = "text") -> Column:
    """The calibrated score of a text column, as a double from 0 to 1."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader()
        for texts in batches:
            yield pd.Series(scores(model, texts.tolist(), reader), dtype="float64")

    return score(text_or_empty(name).cast("binary"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null or empty text gets the score of no words. Repeated rows each give a row; a null doc_id is not
    held out; an empty table gives no rows. Labels, lang, source and doc_id are no inputs of a score.
    """
    marks = materialize(_marks(labels))
    model, seen = _learn(docs, marks)
    raw = materialize(_raw(docs, model))
    model = calibrate(model, raw, marks, seen)
    shift = F.element_at(F.array(*[F.lit(float(x)) for x in model.shift]), F.col("k") + 1)
    z = F.greatest(F.least(F.col("z") + shift, F.lit(30.0)), F.lit(-30.0))
    rows = raw.select("doc_id", held_out().alias("held_out"), (1 / (1 + F.exp(-z))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose whole text scores CUT or more; all columns unchanged."""
    return docs.where(score_column(fit(docs, labels)) < CUT)
