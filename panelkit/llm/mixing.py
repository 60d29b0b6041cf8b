"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). A node's budget of tokens is shared
among its children by weight, none getting more than its subtree can supply
(the tokens of its leaves times ``max_epochs``); what a child can't take goes to
its siblings, and only what a whole family can't take is, by the same rule one
level up, taken over by the family's own siblings.

A leaf reads its documents in seeded epochs: each epoch orders them by a hash
of seed, epoch and id. The leaf takes whole epochs while its budget lasts, and
from the last one the prefix of documents that begin before the budget ends.

No leaf is sorted as a whole. Tokens are summed per leaf and hash bucket, the
bucket that holds the end of the prefix is found from these sums, and only the
rows of that bucket are ordered. The result of a plan is a row per leaf with the
hash and id where its prefix ends; applying it needs no shuffle of documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import broadcast_if_small, text_or_empty
from panelkit.session import materialize

LEVELS = ("m_domain", "m_lang", "m_source")
#: Bits of the order hash, and of its leading part that names a bucket.
HASH_BITS = 60
BUCKET_BITS = 14


@dataclass(frozen=True)
class Mix:
    """Target weights by node name for each level (``default`` for the others), size, and repeats."""

    domain: dict[str, int] = field(default_factory=dict)
    lang: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)
    default: int = 1
    #: Budget as a percentage of all tokens, and the most often that a document may be read.
    percent: int = 90
    max_epochs: int = 2
    seed: int = 42


#: The mix of the registered query and of the pipeline.
PRODUCTION = Mix(domain={"web": 5, "reference": 3, "forum": 2}, lang={"en": 4, "de": 2, "fr": 2, "es": 2})


def n_tokens() -> Column:
    """Words parted by ASCII white space."""
    text = F.regexp_replace(text_or_empty(), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, r"[\x20\x09-\x0D]+"))).cast("long")


def domain() -> Column:
    """The domain of a source: its number modulo 3, sources without a number belong to the first."""
    number = F.regexp_extract(F.coalesce(F.col("source").cast("string"), F.lit("")), "([0-9]{1,9})$", 1)
    kind = F.coalesce(F.when(number != "", number).cast("long"), F.lit(0)) % 3
    return F.element_at(F.array(*map(F.lit, ("web", "reference", "forum"))), (kind + 1).cast("int"))


def leaf_columns() -> list[Column]:
    """Domain, language and source of a row; null counts as the empty name."""
    return [domain().alias(LEVELS[0]), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias(LEVELS[1]),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias(LEVELS[2])]


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The place of a document in an epoch: 60 bits of an MD5."""
    key = F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _weight(level: str, names: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in names.items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Split each parent's ``budget`` among its children by ``weight``, none above its ``capacity``.

    In the order of capacity per weight the first children are filled; from the first that is not, the
    rest of the budget is shared by weight. ``budget`` of the result is the child's, in whole tokens.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy((F.col("capacity") / F.col("weight")).asc(), F.col(child).asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = (children.withColumn("left", left).withColumn("open_weight", weights)
            .withColumn("level", F.col("left") / F.col("open_weight"))
            .withColumn("full", F.col("capacity") <= F.col("level") * F.col("weight")))
    first_open = F.min(F.when(~F.col("full"), F.struct(F.col("capacity") / F.col("weight"), F.col(child),
                                                       F.col("level")))).over(family)
    fair = F.floor(first_open["level"] * F.col("weight")).cast("long")
    got = F.when(F.col("full") | first_open.isNull(), F.col("capacity")).otherwise(F.least("capacity", fair))
    return rows.withColumn("budget", F.greatest(got, F.lit(0))).drop("left", "open_weight", "level", "full")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``m_domain, m_lang, m_source, leaf_tokens, budget`` from the tokens per leaf (same columns but budget)."""
    leaves = leaves.withColumn("capacity", F.col("leaf_tokens") * mix.max_epochs)
    total = leaves.agg(F.floor(F.sum("leaf_tokens") * mix.percent / 100).cast("long").alias("budget"))
    weights = (mix.domain, mix.lang, mix.source)
    out = None
    for depth, level in enumerate(LEVELS):
        nodes = (leaves.groupBy(*LEVELS[:depth + 1]).agg(F.sum("capacity").alias("capacity"))
                 .withColumn("weight", _weight(level, weights[depth], mix.default)))
        # the total is one row by construction
        nodes = nodes.join(F.broadcast(total)) if out is None else nodes.join(
            out.select(*LEVELS[:depth], "budget"), list(LEVELS[:depth]))
        out = _share(nodes, list(LEVELS[:depth]), level)
    return leaves.drop("capacity").join(out.select(*LEVELS, "budget"), list(LEVELS))


def plan_mix(rows: DataFrame, mix: Mix) -> DataFrame:
    """A row per leaf: ``m_domain, m_lang, m_source, leaf_tokens, budget, epochs, end_hash, end_id``.

    ``rows`` has doc_id, tokens and the leaf columns. A document is read ``epochs`` times, and once more if
    its hash in the epoch with that number, then its id, come no later than the end (none, if null).
    """
    rows = materialize(rows)
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("leaf_tokens"))
    plan = materialize(budgets(leaves, mix)
                       .withColumn("epochs", F.when(F.col("leaf_tokens") > 0, F.floor(
                           F.col("budget") / F.col("leaf_tokens"))).otherwise(0).cast("long"))
                       .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("leaf_tokens")))
    keys = list(LEVELS)
    placed = (rows.join(broadcast_if_small(plan.where("rest > 0").select(*keys, "epochs", "rest")), keys)
              .withColumn("hash", order_hash(mix.seed, F.col("epochs"), F.col("doc_id")))
              .withColumn("bucket", F.shiftright("hash", HASH_BITS - BUCKET_BITS)))
    # a leaf has at most 2 ** BUCKET_BITS sums, so this window is bounded
    sums = placed.groupBy(*keys, "rest", "bucket").agg(F.sum("tokens").alias("tokens"))
    run = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (sums.withColumn("before", F.coalesce(F.sum("tokens").over(run), F.lit(0)))
           .where("before < rest and before + tokens >= rest").select(*keys, "bucket", "before"))
    row = Window.partitionBy(*keys, "bucket").orderBy("hash", F.col("doc_id").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    # one cut bucket a leaf, and the plan has been counted
    last = (placed.join(broadcast_if_small(materialize(cut)), [*keys, "bucket"])
            .withColumn("begins", F.col("before") + F.coalesce(F.sum("tokens").over(row), F.lit(0)))
            .where("begins < rest")
            .groupBy(*keys).agg(F.max(F.struct("hash", "doc_id")).alias("end")))
    return plan.join(last, keys, "left").select(*keys, "leaf_tokens", "budget", "epochs",
                                                F.col("end.hash").alias("end_hash"),
                                                F.col("end.doc_id").alias("end_id"))


def _copies(seed: int, doc_id: str) -> Column:
    here = F.struct(order_hash(seed, F.col("epochs"), F.col(doc_id)).alias("hash"), F.col(doc_id).alias("id"))
    end = F.struct(F.col("end_hash").alias("hash"), F.col("end_id").alias("id"))
    return (F.col("epochs") + F.when(F.col("end_hash").isNotNull() & (here <= end), 1).otherwise(0)).cast("long")


def mix_documents(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """``doc_id, domain, lang, source, tokens, budget, copies`` for every row of ``docs``.

    ``copies`` tells how often the mix reads the document (0: left out); ``budget`` is that of its leaf.
    Null language, source or text count as empty; documents without words take no budget but follow the
    same order. Rows that repeat an id follow the same decision. An empty table gives no rows.
    """
    rows = materialize(docs.select("doc_id", n_tokens().alias("tokens"), *leaf_columns()))
    plan = broadcast_if_small(materialize(plan_mix(rows, mix)))
    return rows.join(plan, list(LEVELS)).select(
        "doc_id", F.col("m_domain").alias("domain"), F.col("m_lang").alias("lang"),
        F.col("m_source").alias("source"), "tokens", "budget", _copies(mix.seed, "doc_id").alias("copies"))


def mixed(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """``docs`` as the mix reads them: each row as often as ``copies`` says, all columns unchanged."""
    plan = broadcast_if_small(materialize(plan_mix(
        docs.select("doc_id", n_tokens().alias("tokens"), *leaf_columns()), mix)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    tagged = docs.select(row, F.col("doc_id").alias("m_id"), *leaf_columns())
    return (tagged.join(plan, list(LEVELS))
            .select("row", F.explode(F.array_repeat(F.lit(0), _copies(mix.seed, "m_id").cast("int"))))
            .select("row.*"))
