"""Source divergence audit over a frequent-pattern tree of term rows.

A term's row holds its nonzero counts by source, in the order of the sources. All rows of a language form a prefix
tree: rows with the same beginning share nodes, and a node counts how many rows run through it. What two sources
differ by is, if no term occurred in either, the same for every term. Corrections to that are of two kinds: by one
source's count alone, taken once for each distinct count, and by both counts, taken once for each node and each of
its ancestors and multiplied by the node's rows.

Spark sorts equal and similar rows together, each task builds the tree of its rows in numpy, depth by depth, and
sends one sum for each pair of sources. A node cut by the edge of a task gives two smaller multiplicities, whose
sums are the same. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import broadcast_if_small
from panelkit.session import materialize

#: Fixed values of the audit: a kept term's least documents, the unit of p, the smoothing, ranks of part ``term``.
LEAST_DOCS, UNIT, SMOOTH, TOP_TERMS = 10, 1_000_000_000, 2, 10
#: Bytes that a task holds of its counts before it sends them, and the length at which a text is cut (between terms).
HELD = 64 << 20
PIECE = 1 << 20
#: Node and ancestor pairs that a task handles at once.
PAIRS = 1 << 22

#: Letters in lower case, all bytes of other letters as they are, the rest a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ONE_DOC = 1 << 48


def terms_of(text: bytes) -> Counter:
    """How often each term occurs; the text is read in pieces that end between terms."""
    out: Counter = Counter()
    plain, at = text.translate(_LETTERS), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        out.update(plain[at:end].split())
        at = end
    return out


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to partial counts (lang, source, term, n, docs)."""
    groups: dict[tuple[str, str], dict[bytes, int]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in groups.items():
            terms, packed = list(own), np.fromiter(own.values(), np.int64, len(own))
            for at in range(0, len(terms), 10_000):
                part, now = terms[at:at + 10_000], packed[at:at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()),
                     pa.array(now % _ONE_DOC), pa.array(now // _ONE_DOC)], names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    held = docs = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            own = groups.setdefault((lang, source), {})
            docs += 1
            for term, n in terms_of(text.as_py()).items():
                old = own.get(term)
                if old is None:
                    held += len(term) + 150
                    old = 0
                own[term] = old + n + _ONE_DOC
            if held > HELD or docs == 30_000:  # document counts take 15 bits
                yield from sent()
                held = docs = 0
    yield from sent()


def share(count: Column, total: Column, terms: Column) -> Column:
    """p: the smoothed share of a count, in units of a billionth, from 1; null without terms."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(22,0)")
    whole = F.call_function("div", top, F.nullif(total + 2 * terms, F.lit(0)).cast("decimal(22,0)"))
    return whole.cast("long") + 1


def apart(p: Column, q: Column) -> Column:
    """f: the squared difference over the sum, rounded down."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def tree_corrections(langs: np.ndarray, lengths: np.ndarray, source: np.ndarray, p: np.ndarray, zero: np.ndarray,
                     rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the corrections by both counts over a tree, as (lang, first source, second source, sum).

    The paths are sorted rows of equal ``langs``: row i has ``lengths[i]`` items and stands for ``rows[i]`` terms.
    ``source``, ``p`` and ``zero`` (the p of no occurrence) are matrices with a column for each depth.
    """
    depth = source.shape[1]
    inside = np.arange(depth)[None, :] < lengths[:, None]
    same = np.zeros(source.shape, bool)
    same[1:] = (source[1:] == source[:-1]) & (p[1:] == p[:-1]) & inside[1:] & inside[:-1] & (langs[1:] == langs[:-1])[:, None]
    shared = np.cumprod(same, axis=1).sum(axis=1)  # items that a row has in common with the one before
    n_source = int(source.max(initial=0)) + 1
    keys, sums = [], []
    for k in range(1, depth):
        begins = np.flatnonzero(shared <= k)
        many = np.add.reduceat(rows, begins)
        node = lengths[begins] > k
        at, many = begins[node], many[node]
        for j in range(k):
            pa_, pb, za, zb = p[at, j], p[at, k], zero[at, j], zero[at, k]
            both = _apart(pa_, pb) - _apart(pa_, zb) - _apart(za, pb) + _apart(za, zb)
            keys.append((langs[at] * n_source + source[at, j]) * n_source + source[at, k])
            sums.append(many * both)
        if sum(map(len, keys)) > PAIRS:
            keys, sums = _added(keys, sums)
    keys, sums = _added(keys, sums)
    key, total = keys[0], sums[0]
    return key // n_source ** 2, key // n_source % n_source, key % n_source, total


def _added(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    key, place = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, place, np.concatenate([np.zeros(0, np.int64), *sums]))
    return [key], [total]


def grow_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted paths (lang, path, rows) to sums (lang, a, b, v)."""
    for batch in batches:
        paths, lang = batch.column(1), batch.column(0).dictionary_encode()
        offsets = paths.offsets.to_numpy().astype(np.int64)
        items = paths.values
        name = items.field("source").dictionary_encode()
        code = name.indices.to_numpy().astype(np.int64)
        p, zero = items.field("p").to_numpy(), items.field("zero").to_numpy()
        lang_code, rows = lang.indices.to_numpy().astype(np.int64), batch.column(2).to_numpy()
        length, at = np.diff(offsets), 0
        while at < len(length):
            widest = np.maximum.accumulate(length[at:])
            fits = np.flatnonzero(widest.astype(np.int64) ** 2 * np.arange(1, len(widest) + 1) <= PAIRS)
            end = at + (int(fits[-1]) + 1 if len(fits) else 1)
            own = length[at:end]
            place = np.minimum(offsets[at:end, None] + np.arange(int(own.max()))[None, :], offsets[end] - 1)
            one, a, b, v = tree_corrections(lang_code[at:end], own, code[place], p[place], zero[place], rows[at:end])
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(one)), name.dictionary.take(pa.array(a)), name.dictionary.take(pa.array(b)),
                 pa.array(v)], names=["lang", "a", "b", "v"])
            at = end


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group of ``docs``.

    Part ``pair`` has a row for each other source of the language, part ``term`` at most TOP_TERMS terms that are
    commoner in the group than in its language. Null text, lang and source count as empty. Every row is a document
    of its own, repeated ones too. A group without terms still has its pairs; a language in which no term reaches
    LEAST_DOCS documents has pairs of value 0. An empty table gives no rows. Other columns are not read.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*text)
    groups = rows.select("lang", "source").distinct()
    counts = (rows.withColumn("text", F.col("text").cast("binary"))
              .mapInArrow(count_terms, "lang string, source string, term binary, n long, docs long")
              .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = materialize(
        counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                           F.collect_list(F.struct("source", "n")).alias("items"))
        .where(F.col("docs") >= LEAST_DOCS).select("lang", F.col("term").cast("string").alias("term"), "total", "items"))
    cells = kept.select("lang", "term", "total", F.inline("items"))
    of_lang = kept.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count(F.lit(1)).alias("terms"))
    sizes = materialize(
        groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("group_n", "lang_n", "terms")]))
    sizes = sizes.withColumn("zero", share(F.lit(0).cast("long"), F.col("group_n"), F.col("terms")))
    small = broadcast_if_small(sizes)
    valued = cells.join(small, ["lang", "source"]).select(
        "lang", "source", "term", "total", "lang_n", "terms", "zero",
        share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"))

    # part ``pair``: what all terms have in common, corrections by one count, corrections by two
    one, two = small.select("lang", F.col("source").alias("a"), F.col("zero").alias("za"), "terms"), \
        sizes.select("lang", F.col("source").alias("b"), F.col("zero").alias("zb"))
    common = two.join(one, "lang").where("a < b") \
        .select("lang", "a", "b", F.coalesce(F.col("terms") * apart(F.col("za"), F.col("zb")), F.lit(0)).alias("v"))
    distinct = valued.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("rows"))
    single = distinct.join(one, "lang").where(F.col("a") != F.col("source")).select(
        "lang", F.least("a", "source").alias("a"), F.greatest("a", "source").alias("b"),
        (F.col("rows") * (apart(F.col("p"), F.col("za")) - apart(F.col("zero"), F.col("za")))).alias("v"))
    paths = (valued.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "zero"))).alias("path"))
             .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("rows")).where(F.size("path") > 1))
    double = (paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
              .mapInArrow(grow_trees, "lang string, a string, b string, v long"))
    sums = common.unionByName(single).unionByName(double).groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = sums.select("lang", F.inline(both), "value")

    # part ``term``
    q = share(F.col("total"), F.col("lang_n"), F.col("terms"))
    terms = valued.withColumn("q", q).where("p > q") \
        .select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = [(pairs, "pair", F.lit(True)), (terms, "term", F.col("rank") <= TOP_TERMS)]
    out = [df.withColumn("rank", F.row_number().over(by_value)).where(keep)
           .select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for df, name, keep in parts]
    return out[0].unionByName(out[1])
