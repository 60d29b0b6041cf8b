"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has 8 bytes. Two fingerprints that differ in at most ``MAX_BITS``
(3) bits differ in at most 3 bytes, so they share at least ``MIN_SHARED`` (5)
bytes by position: the guaranteed minimum of the count filter. A posting list
of one positional byte alone would hold a 256th of all rows, and tallying its
pairs would be quadratic. So a posting is keyed by ``MIN_SHARED`` positional
bytes at a time (all 56 choices): a pair reaches the minimum exactly if it meets
in one of these lists. For every pair that meets, the shared positional bytes
are tallied, pairs under the minimum dropped, and the bit distance verified.

A list holds distinct fingerprints that agree in 40 bits, so at most 2**24 of
them, whatever the input. Copies are reduced to one fingerprint beforehand.
In a list the links are reduced to a spanning forest, never all its pairs: by
comparing with the not yet reached ones, or, in long lists, by looking up the
2,324 neighbours within 3 bits in a bitmap of the 24 open bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from panelkit.llm.common import files_for, map_columns, one_row, text_or_empty, whole_row
from panelkit.llm.components import connected_components
from panelkit.session import materialize

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
MIN_SHARED = 8 - MAX_BITS

#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16
#: In lists up to this long each pair is compared; in longer ones a spanning forest is grown.
SHORT_LIST = 8
#: Distinct fingerprints that a checkpointed file should hold; each makes a posting for each choice.
ROWS_PER_FILE = 5_000
#: From this length on, neighbours are looked up in a bitmap.
LONG_LIST = 4096

CHOICES = list(combinations(range(8), MIN_SHARED))
#: For each choice of byte positions, the 64-bit mask that keeps them.
MASKS = [sum(0xFF << (8 * p) for p in choice) for choice in CHOICES]


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a UTF-8 text, as a signed integer (0 without words)."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    n = max(1, len(words) - size + 1)
    first, last = starts[:n].tolist(), (ends[min(size, len(words)) - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        shingles = map(joined.__getitem__, map(slice, first[at:at + BLOCK], last[at:at + BLOCK]))
        block = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(SEED))), np.uint8)
        counts += np.add.reduce(np.unpackbits(block.reshape(-1, 8), axis=1), axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, keep: list[str], size: int = SHINGLE_WORDS) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint of each row's whole text."""
    rows = docs.select(*keep, text_or_empty().cast("binary").alias("text_bytes"))
    return map_columns(rows, lambda: lambda text: (fingerprint(text, size),), "fp long", keep, ["text_bytes"])


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def postings(fps: DataFrame) -> DataFrame:
    """``choice, shared, fp``: one posting for each choice of positional bytes."""
    masked = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in MASKS])
    return fps.select("fp", F.posexplode(masked).alias("choice", "shared"))


def _neighbour_masks(max_bits: int) -> np.ndarray:
    one = 1 << np.arange(24, dtype=np.int64)
    return np.array([sum(c) for k in range(1, max_bits + 1) for c in combinations(one.tolist(), k)], np.int64)


def spanning_links(fps: np.ndarray, open_bytes: list[int], max_bits: int = MAX_BITS) -> list[tuple[np.ndarray, ...]]:
    """A spanning forest, as (from, to) arrays, of the links among distinct fingerprints of one list."""
    out = []
    if len(fps) < LONG_LIST:
        rest = fps
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                x = queue.pop()
                near = np.bitwise_count(rest ^ x) <= max_bits
                found = rest[near]
                if len(found):
                    rest = rest[~near]
                    out.append((np.full(len(found), x), found))
                    queue.extend(found)
        return out
    tail = np.zeros(len(fps), np.int64)
    for k, p in enumerate(open_bytes):
        tail |= ((fps >> np.uint64(8 * p)) & np.uint64(0xFF)).astype(np.int64) << (8 * k)
    back = np.full(1 << 24, -1, np.int32)
    back[tail] = np.arange(len(fps), dtype=np.int32)
    masks = _neighbour_masks(max_bits)
    for start in range(len(fps)):
        if back[tail[start]] < 0:
            continue
        back[tail[start]] = -1
        queue = [start]
        while queue:
            x = queue.pop()
            near = tail[x] ^ masks
            found = back[near]
            found = found[found >= 0]
            if len(found):
                back[tail[found]] = -1
                out.append((np.full(len(found), fps[x]), fps[found]))
                queue.extend(found.tolist())
    return out


def _first_choice() -> np.ndarray:
    """For a set of shared byte positions (as 8 bits): the first choice inside it, or -1 under the minimum."""
    return np.array([next((k for k, c in enumerate(CHOICES) if all(s >> p & 1 for p in c)), -1)
                     for s in range(256)], np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the postings of sorted lists. A list that goes on in the next batch is held back."""
    first = _first_choice()
    held: list[tuple[np.ndarray, ...]] = []

    def flush(lists: tuple[np.ndarray, ...]):
        choice, shared, fp = lists
        if len(fp) < 2:
            return
        new = np.flatnonzero((choice[1:] != choice[:-1]) | (shared[1:] != shared[:-1])) + 1
        starts = np.concatenate([[0], new])
        lengths = np.diff(np.concatenate([starts, [len(fp)]]))
        a, b = [], []
        short = np.repeat(np.where(lengths <= SHORT_LIST, lengths, 0), lengths)
        where = np.arange(len(fp)) - np.repeat(starts, lengths)
        for d in range(1, SHORT_LIST):
            at = np.flatnonzero(where + d < short)
            if not len(at):
                break
            x, y = fp[at], fp[at + d]
            diff = x ^ y
            same = np.zeros(len(at), np.int64)  # the tally of shared positional bytes, as a set
            for p in range(8):
                same |= ((diff >> np.uint64(8 * p)) & np.uint64(0xFF) == 0).astype(np.int64) << p
            ok = (np.bitwise_count(same) >= MIN_SHARED) & (first[same] == choice[at]) \
                & (np.bitwise_count(diff) <= MAX_BITS)
            a.append(x[ok])
            b.append(y[ok])
        for k in np.flatnonzero(lengths > SHORT_LIST):
            s, n = starts[k], lengths[k]
            open_bytes = [p for p in range(8) if p not in CHOICES[int(choice[s])]]
            for x, y in spanning_links(fp[s:s + n], open_bytes):
                a.append(x)
                b.append(y)
        if a and sum(map(len, a)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.uint64).view(np.int64))
                                              for v in (a, b)], names=["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        choice, shared, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        fp = fp.astype(np.int64).view(np.uint64)
        last = np.flatnonzero((choice != choice[-1]) | (shared != shared[-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut == 0 and held and held[0][0][0] == choice[-1] and held[0][1][0] == shared[-1]:
            held.append((choice, shared, fp))
            continue
        parts = [*held, (choice[:cut], shared[:cut], fp[:cut])]
        yield from flush(tuple(np.concatenate([p[i] for p in parts]) for i in range(3)))
        held = [(choice[cut:], shared[cut:], fp[cut:])]
    if held:
        yield from flush(tuple(np.concatenate([p[i] for p in held]) for i in range(3)))


def links(fps: DataFrame) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints (column fp) within MAX_BITS bits."""
    lists = (postings(fps).repartition("choice", "shared")
             .sortWithinPartitions("choice", "shared").select("choice", "shared", "fp"))
    return lists.mapInArrow(_links, "a long, b long")


def linked_groups(rows: DataFrame) -> DataFrame:
    """``fp, root, component_id`` for each distinct fp of ``rows`` (doc_id, fp).

    ``root`` names the group; ``component_id`` is the smallest doc_id in it.
    ``rows`` should be materialised: it is counted first.
    """
    files = files_for(rows.count(), ROWS_PER_FILE)
    firsts = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")).coalesce(files))
    roots = connected_components(links(firsts.select("fp")), files)
    linked = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    best = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return linked.join(best, "root").select("fp", "root", "component_id")


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Words are runs of other than ASCII white space, A-Z lower-cased; shingles
    have 3 words, repeats count. A null or empty text has fingerprint zero and
    is linked like any other. Equal fingerprints are one group; repeated rows
    each give a row. A null doc_id is never the smallest unless all are null.
    An empty table gives no rows. Other columns are ignored.
    """
    rows = materialize(fingerprints(docs, ["doc_id"]))
    return (rows.join(linked_groups(rows), "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per group of near duplicates: the one with the smallest doc_id, columns unchanged.

    Rows without an id come last in their group; ties are broken by the hash of the text, then by the whole row.
    """
    text_hash = F.xxhash64(text_or_empty())
    rows = materialize(fingerprints(docs.select("doc_id", "text", text_hash.alias("k_hash")), ["doc_id", "k_hash"]))
    groups = linked_groups(rows)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k_hash")
    best = rows.join(groups, "fp").groupBy("root").agg(F.min(order).alias("best"))
    winners = best.select(F.col("best.doc_id").alias("w_id"), F.col("best.k_hash").alias("w_hash"))
    tagged = docs.select(whole_row(docs), F.col("doc_id").alias("k_id"), text_hash.alias("k_hash"))
    kept = tagged.join(winners, F.col("k_id").eqNullSafe(F.col("w_id")) & (F.col("k_hash") == F.col("w_hash")),
                       "left_semi")
    return one_row(kept, ["k_id", "k_hash"])
