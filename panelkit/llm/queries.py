"""Queries of this package: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (bpe, chat, divergence, exact_dedup, langid, license_rules, licenses, mixing, simhash, syncmers,
                          toxicity, unigram, urlfilter, whitening)
from panelkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op6_exact_dedup", r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


#: The budget tree in SQL: one block a level, each sharing its parent's budget by weight up to capacity.
_MIX_LEVEL = """
{name}_n AS (SELECT {keys}, sum(capacity)::BIGINT AS capacity, {weight} AS weight FROM leaf GROUP BY ALL),
{name}_b AS (
    SELECT n.*, p.budget AS parent,
           p.budget - coalesce(sum(n.capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS avail,
           sum(n.weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM {name}_n n JOIN {up} p {on}
    WINDOW w AS ({part} ORDER BY n.capacity / n.weight, n.{last})),
{name}_f AS (
    SELECT *, avail::DOUBLE / open_weight AS lvl, capacity <= avail::DOUBLE / open_weight * weight AS filled
    FROM {name}_b),
{name} AS (
    SELECT {keys}, greatest(CASE WHEN filled OR o IS NULL THEN capacity
                                 ELSE least(capacity, floor(o.lvl * weight)::BIGINT) END, 0) AS budget
    FROM (SELECT *, min(CASE WHEN NOT filled THEN {{'k': capacity / weight, 'c': {last}, 'lvl': lvl}} END)
                    OVER ({part2}) AS o FROM {name}_f))"""


def _weights_sql(column: str, names: dict[str, int], default: int) -> str:
    cases = "".join(f" WHEN '{k}' THEN {v}" for k, v in names.items())
    return f"CASE {column}{cases} ELSE {default} END"


def _mix_sql(m: mixing.Mix) -> str:
    level = [
        _MIX_LEVEL.format(name="a", keys="dom", weight=_weights_sql("dom", m.domain, m.default), up="total",
                          on="ON true", part="", part2="", last="dom"),
        _MIX_LEVEL.format(name="b", keys="dom, lang", weight=_weights_sql("lang", m.lang, m.default), up="a",
                          on="USING (dom)", part="PARTITION BY n.dom", part2="PARTITION BY dom", last="lang"),
        _MIX_LEVEL.format(name="c", keys="dom, lang, source", weight=str(m.default), up="b",
                          on="USING (dom, lang)", part="PARTITION BY n.dom, n.lang",
                          part2="PARTITION BY dom, lang", last="source")]
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           ['web', 'reference', 'forum'][1 + coalesce(try_cast(nullif(
               regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT), 0) % 3] AS dom,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens
    FROM documents),
leaf AS (SELECT dom, lang, source, sum(tokens)::BIGINT AS leaf_tokens,
                sum(tokens)::BIGINT * {m.max_epochs} AS capacity FROM d GROUP BY ALL),
total AS (SELECT floor(sum(leaf_tokens) * {m.percent} / 100)::BIGINT AS budget FROM leaf),
{",".join(level)},
plan AS (SELECT *, CASE WHEN leaf_tokens > 0 THEN budget // leaf_tokens ELSE 0 END AS epochs
         FROM leaf JOIN c USING (dom, lang, source)),
placed AS (
    SELECT d.*, budget, epochs, budget - epochs * leaf_tokens AS rest,
           ('0x' || substr(md5('{m.seed}/' || epochs || '/' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM d JOIN plan USING (dom, lang, source)),
run AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY dom, lang, source ORDER BY h, doc_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
    FROM placed)
SELECT doc_id, dom AS domain, lang, source, tokens, budget::BIGINT AS budget,
       (epochs + CASE WHEN begins < rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM run"""


@query("op2_mix_sources", _mix_sql(mixing.PRODUCTION))
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_CONTROLS_SQL = "replace({x}, '~', '~0')"
for _head, _tail in chat.CONTROLS:
    _CONTROLS_SQL = f"replace({_CONTROLS_SQL}, '{_head}{_tail}', '{_head}~1{_tail}')"


@query("op3_chat_format", f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
    SELECT *, replace({_CONTROLS_SQL.format(x='role')}, chr(10), '~2') AS r,
           {_CONTROLS_SQL.format(x='text')} AS x FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       sum(length(r) + length(x) + {len(chat.BEGIN) + len(chat.END) + 2})::BIGINT AS formatted_chars,
       CASE list(role ORDER BY turn NULLS FIRST, role, text)
            WHEN ['user', 'assistant'] THEN 'prompt' WHEN ['system', 'user', 'assistant'] THEN 'system prompt'
            ELSE 'messages' END AS layout
FROM t GROUP BY conv_id""")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_records(chat.records_of_turns(rows), "record", "typed"))


_LISTED_SQL = ", ".join(f"'{w}'" for w in urlfilter.LISTED_WORDS)
_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urlfilter.RULES)


@query("op9_url_filter", rf"""
WITH p AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
rules(h, r, v) AS (VALUES {_RULES_SQL}),
m AS (
    SELECT p.*, (SELECT max_by({{'rule': h || r, 'verdict': v}}, length(h || r)) FROM rules
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r)) AS hit,
           list_has_any(regexp_split_to_array(host, '[.-]'), [{_LISTED_SQL}]) AS listed
    FROM p)
SELECT page_id, host, path, hit.rule AS rule,
       coalesce(hit.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM m""")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = unigram.zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram.count_tokens(table(spark, sf_dir, "documents"), model)


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_syncmer_fingerprints")
def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_RULE_ROWS_SQL = ", ".join(f"({r.number}, {r.tier}, '{r.label}', ' {r.word} ', '{r.pattern}')" for r in license_rules.RULES)
_BASE_ROWS_SQL = ", ".join(f"({i}, 1, '{label}', ' license ', ' {phrase.replace(' ', '  ')} ')"
                           for i, (phrase, label) in enumerate(licenses.BASE))
#: Places of the matches of a table of rules; a word of ``doubled`` has two blanks of its own.
_PLACES_SQL = """
{name}_m AS (SELECT r, tier, number, label, regexp_extract_all(doubled, pattern) AS found,
                    regexp_split_to_array(doubled, pattern) AS pieces
             FROM d JOIN {name}_rules ON contains(doubled, word) AND regexp_matches(doubled, pattern)),
{name}_w AS (SELECT r, tier, number, label,
                    list_transform(found, lambda s: (length(s) - length(replace(s, ' ', ''))) // 2) AS own,
                    list_transform(pieces, lambda s: (length(s) - length(replace(s, ' ', ''))) // 2) AS gap
             FROM {name}_m),
{name}_i AS (SELECT *, unnest(range(1, len(own) + 1)) AS i FROM {name}_w),
{name} AS (SELECT r, tier, number, label, own[i] AS size,
                  (list_sum(gap[1:i]) + coalesce(list_sum(own[1:i - 1]), 0))::BIGINT AS first FROM {name}_i)"""


@query("op12_license_scan", rf"""
WITH n AS (
    SELECT row_number() OVER () AS r, doc_id,
           trim(regexp_replace(coalesce(text, ''), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g')) AS line
    FROM documents),
d AS (SELECT *, ' ' || replace(translate(line, '{licenses.UPPER}', '{licenses.LOWER}'), ' ', '  ') || ' ' AS doubled FROM n),
base_rules(number, tier, label, word, pattern) AS (VALUES {_BASE_ROWS_SQL}),
rule_rules(number, tier, label, word, pattern) AS (VALUES {_RULE_ROWS_SQL}),
{_PLACES_SQL.format(name="base")},
{_PLACES_SQL.format(name="rule")},
kept AS (
    SELECT * FROM rule a WHERE NOT EXISTS (
        SELECT 1 FROM rule b WHERE b.r = a.r AND b.first <= a.first AND b.first + b.size >= a.first + a.size
        AND b.tier <= a.tier AND (b.first < a.first OR b.size > a.size OR b.tier < a.tier OR b.number < a.number))),
b AS (SELECT r, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word,
             list_sort(list_distinct(list(label))) AS labels FROM base GROUP BY r),
k AS (SELECT r, list(label) AS labels, min(tier) AS tier FROM kept GROUP BY r)
SELECT doc_id, CASE WHEN line = '' THEN 0 ELSE length(line) - length(replace(line, ' ', '')) + 1 END::BIGINT AS n_words,
       coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, k.labels))), ','), '') AS labels,
       greatest(CASE WHEN n_base > 0 THEN {licenses.BASE_SCORE} ELSE 0 END,
                coalesce({list(licenses.TIER_SCORES)}[k.tier], 0))::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN k USING (r)""")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


@query("op13_source_divergence", rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL
      HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS terms, sum(total) AS lang_n FROM k GROUP BY ALL),
g AS (SELECT lang, source, coalesce(terms, 0)::HUGEINT AS terms, coalesce(lang_n, 0)::HUGEINT AS lang_n,
             coalesce(group_n, 0)::HUGEINT AS group_n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS group_n FROM c GROUP BY ALL) USING (lang, source)),
x AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
             1 + {divergence.UNIT}::HUGEINT * (coalesce(n, 0) + 2) // (group_n + 2 * terms) AS p,
             1 + {divergence.UNIT}::HUGEINT * (total + 2) // (lang_n + 2 * terms) AS q
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM x WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))
