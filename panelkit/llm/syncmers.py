"""Document fingerprints of closed syncmers.

A run of ``K`` code points is a closed syncmer if the smallest hash among its
inner runs of ``S`` stands at its first or last place. The choice depends on
nothing outside the run, so an unchanged passage has the same anchors wherever it
stands. The fingerprint keeps every closed syncmer of the whole text in the order of the text, as its distance from
the one before and its hash, so it grows with the text (about an anchor of 5 bytes every 4 characters). A text without
a syncmer is its own anchor.

Two fingerprints are compared by position: the longest sequence of anchors in the same order in both texts counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from panelkit.llm.common import text_or_empty

K, S = 12, 5
SEED = 42
#: Code points hashed at a time.
BLOCK = 1 << 20
#: Bytes of text that a range of neighbours should hold, and the most ranges. A larger table has larger ranges; a range
#: is sorted with spilling and read row by row, so its size is no bound on memory.
RANGE_BYTES = 64 << 20
MOST_RANGES = 1 << 16

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: An anchor as it is written. Closed syncmers are less than K apart. Two unlike anchors have equal hashes once in 2**32.
_ANCHOR = np.dtype([("gap", "u1"), ("hash", ">u4")])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def _run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    n = len(codes) - size + 1
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = h * _A + codes[i:i + n]
    return _mix(h)


def closed_syncmers(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all closed syncmers of an array of code points."""
    if len(codes) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    inner = _run_hashes(codes.astype(np.uint64), S)
    width = K - S + 1
    n = len(inner) - width + 1
    least, span = inner, 1
    while span < width:  # minimum over windows of growing width
        step = min(span, width - span)
        least = np.minimum(least[:len(least) - step], least[step:])
        span += step
    at = np.flatnonzero((inner[:n] == least) | (inner[width - 1:] == least))
    h = np.zeros(len(at), np.uint64)  # of the inner runs that cover the whole run
    for i in [*range(0, K - S, S), K - S]:
        h = h * _A + inner[at + i]
    return at, (_mix(h) >> np.uint64(32)).astype(np.uint32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _anchors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``closed_syncmers`` of a text of any length, block by block."""
    if len(codes) < BLOCK + K:
        return closed_syncmers(codes)
    parts = []
    for at in range(0, len(codes) - K + 1, BLOCK):
        places, hashes = closed_syncmers(codes[at:at + BLOCK + K - 1])
        parts.append((places + at, hashes))
    return np.concatenate([p for p, _ in parts]), np.concatenate([h for _, h in parts])


def _written(text: str, places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if text and not len(places):
        places, hashes = np.zeros(1, np.int64), [xxh32_intdigest(text.encode("utf-8", "surrogatepass"), SEED)]
    out = np.empty(len(places), _ANCHOR)
    out["gap"], out["hash"] = np.diff(places, prepend=0), hashes
    return out


def fingerprint(text: str) -> np.ndarray:
    """The anchors of a text in their order (an array of gap and hash)."""
    return _written(text, *_anchors(_codes(text)))


def _edited_anchors(own: tuple, following: tuple, cut: int, take: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the first ``cut`` code points of one text followed by the first ``take`` of another.

    Both are given as (code points, places, hashes). Anchors depend on nothing outside themselves, so only the
    runs over the seam are new.
    """
    codes, places, hashes = own
    other, later, others = following
    first = max(0, cut - K + 1)
    seam, found = closed_syncmers(np.concatenate([codes[first:cut], other[:min(take, K - 1)]]))
    before = np.searchsorted(places, cut - K, "right")
    inside = np.searchsorted(later, take - K, "right")
    # a short start holds runs that are in the other text alone; they are counted there
    new = seam + first < cut
    return (np.concatenate([places[:before], seam[new] + first, later[:inside] + cut]),
            np.concatenate([hashes[:before], found[new], others[:inside]]))


def common_order(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two sequences of hashes. Exact, in memory in proportion to them.

    A common start and end are cut off. What is left is matched pair by pair (Hunt-Szymanski) or, if hashes repeat so
    often that the pairs outnumber the words of the table, by bits.
    """
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    start = int(unlike[0]) if len(unlike) else n
    a, b, n = a[start:], b[start:], n - start
    unlike = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    end = int(unlike[0]) if len(unlike) else n
    a, b = a[:len(a) - end], b[:len(b) - end]
    both = np.intersect1d(a, b)
    if not len(both):
        return start + end
    a, b = a[np.isin(a, both)], b[np.isin(b, both)]
    if len(b) > len(a):
        a, b = b, a
    a, b = np.searchsorted(both, a), np.searchsorted(both, b)
    pairs = int(np.dot(np.bincount(a, minlength=len(both)), np.bincount(b, minlength=len(both))))
    if pairs <= len(a) * (8 + len(b) // 64):
        order = np.argsort(b, kind="stable")
        edges = np.searchsorted(b[order], np.arange(len(both) + 1)).tolist()
        tails: list[int] = []
        where = order.tolist()
        for x in a.tolist():
            for k in range(edges[x + 1] - 1, edges[x] - 1, -1):
                p = where[k]
                at = bisect_left(tails, p)
                tails[at:at + 1] = [p]
        return start + end + len(tails)
    # a row of the table as one number: a zero bit is a place of b where the length grows
    masks: dict[int, int] = {}
    for code in np.unique(b):
        masks[int(code)] = int.from_bytes(np.packbits(b == code, bitorder="little").tobytes(), "little")
    full = (1 << len(b)) - 1
    row = full
    for x in a.tolist():
        hit = row & masks[x]
        row = ((row + hit) | (row - hit)) & full
    return start + end + len(b) - row.bit_count()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1: twice the number of common anchors in the same order over the number of all anchors (Dice)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return 2 * common_order(a["hash"].astype(np.uint32), b["hash"].astype(np.uint32)) / (len(a) + len(b))


def edited(text: str, following: str) -> str:
    """The last half of a text (rounded down) replaced by as many code points from the start of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


#: The order of rows: null ids first, then by id, of equal ids by a hash of the text; equal rows by where they lie.
_ORDER = ["known", "doc_id", "text_hash", "salt"]


def neighbours(docs: DataFrame) -> DataFrame:
    """``bucket, tail, doc_id, text``, dealt to a partition for each bucket and sorted so that a row precedes its next.

    Buckets are ranges of the order with about equally many rows, whatever the ids are; equal rows are split as well. Their
    bounds are at most MOST_RANGES short keys on the driver. The first row of each bucket is added to the bucket
    before it as its tail (that of the first bucket to the last). Whole texts are sent once but for the tails.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")) \
        .withColumn("known", F.col("doc_id").isNotNull().cast("int")) \
        .withColumn("text_hash", F.xxhash64("text")).withColumn("salt", F.monotonically_increasing_id())
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, min(MOST_RANGES, total // RANGE_BYTES))
    keys = rows.select(*_ORDER).repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in _ORDER])
    bounds = sorted((tuple(r.low[c] if r.low[c] is not None else 0 for c in _ORDER) for r in keys.groupBy(
        F.spark_partition_id().alias("part")).agg(F.min(F.struct(*_ORDER)).alias("low")).collect()))
    columns = [np.array(c, np.int64) for c in zip(*bounds)] or [np.zeros(1, np.int64)] * len(_ORDER)

    @F.pandas_udf("bucket int, first boolean")
    def placed(known: pd.Series, doc_id: pd.Series, text_hash: pd.Series, salt: pd.Series) -> pd.DataFrame:
        own = [c.to_numpy(np.int64) for c in (known, doc_id, text_hash, salt)]
        low, high = np.zeros(len(own[0]), np.int64), np.full(len(own[0]), len(columns[0]), np.int64)
        while (high - low > 1).any():  # the last bound that is not over the row's key
            mid = (low + high) // 2
            over, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for bound, value in zip(columns, own):
                over |= same & (bound[mid] > value)
                same &= bound[mid] == value
            low, high = np.where(over, low, mid), np.where(over, mid, high)
        first = np.logical_and.reduce([bound[low] == value for bound, value in zip(columns, own)])
        return pd.DataFrame({"bucket": low.astype(np.int32), "first": first})

    key = [F.coalesce(F.col(c), F.lit(0).cast("long")) for c in _ORDER]
    rows = rows.select("doc_id", "text", "known", "text_hash", placed(*key).alias("at"))
    last = len(columns[0]) - 1
    copies = F.when(F.col("at.first"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    to = F.when(~F.col("tail"), F.col("at.bucket")).when(F.col("at.bucket") > 0, F.col("at.bucket") - 1).otherwise(last)
    return (rows.withColumn("tail", F.explode(copies)).withColumn("bucket", to)
            .repartitionById(last + 1, "bucket").sortWithinPartitions("bucket", "tail", "known", "doc_id", "text_hash")
            .select("bucket", "tail", "doc_id", "text"))


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one that follows it in its bucket; only two texts are held beside the batch."""
    last = None
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        out, size = [], 0
        for bucket, tail, doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
            codes = _codes(text)
            parts = (codes, *_anchors(codes))
            mark = _written(text, *parts[1:])
            if last is not None and last[0] == bucket:
                _, own_id, own_text, own_parts, own = last
                changed = edited(own_text, text)
                half = len(own_text) // 2
                other = _written(changed, *_edited_anchors(own_parts, parts, len(own_text) - half, min(half, len(text))))
                out.append((own_id, len(own_text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            own.tobytes().hex(), other.tobytes().hex(), likeness(own, other), likeness(own, mark)))
                size += 10 * (len(own) + len(other))
            last = None if tail else (bucket, doc_id, text, parts, mark)
            if size > 1 << 25:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row of ``docs``.

    The next row is the one with the next larger doc_id (rows that repeat an id follow each other by a hash of their
    text, null ids come first), after the last one the first. Null text is empty; an empty text has the empty
    fingerprint, like only to itself. A single row is its own next one; an empty table gives no rows. Other
    columns are ignored. ``docs`` should give its rows in the same order when read again, as files do.
    """
    return neighbours(docs).mapInArrow(_compare, SCHEMA)
