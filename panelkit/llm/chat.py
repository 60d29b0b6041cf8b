"""Chat formatting by schema fingerprints, with DataFrame functions only.

A raw conversation is a JSON record of some layout. The nested field paths of a
record (its schema without the scalar types) are hashed; the fingerprint picks
one of the declared mappings, which turns the record into canonical turns
(role, text). The template marks turns with control strings. These, and the
escape sign itself, are escaped inside roles and texts, so that a text can hold
any control string and reading back gives it unchanged. The loss mask is a list
with a run per turn: how many characters of the turn come before its masked
ones, and how many are masked (all of an assistant's text, else none).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

#: Control strings of common templates: what parts the sign before the mark from the rest.
CONTROLS = (("<", "|"), ("<", "/s>"), ("<", "s>"), ("[", "INST]"), ("[", "/INST]"), ("<", "<SYS>>"), ("<", "</SYS>>"))
TURNS = "array<struct<role string, text string>>"
#: Spark's variant holds no string over 20,000,000 characters and no record over 128 MB: a conversation whose turns
#: take more than this (UTF-8 bytes, and TURN_BYTES for each turn) is not sent through it.
RECORD_BYTES = 16_000_000
TURN_BYTES = 64


@dataclass(frozen=True)
class Mapping:
    """``shape`` is the layout's schema without scalar types; ``turns`` maps a variant column to canonical turns."""

    name: str
    shape: str
    turns: object

    @property
    def fingerprint(self) -> Column:
        return F.xxhash64(F.lit(self.shape))


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _list(path: str, role: str, text: str, names: dict[str, str] | None = None):
    """A list of messages; role names are translated where the mapping declares it."""
    def turns(v: Column) -> Column:
        items = _get(v, path, f"array<struct<`{role}`: string, `{text}`: string>>")

        def one(m: Column) -> Column:
            said = F.coalesce(m[role], F.lit(""))
            for old, new in (names or {}).items():
                said = F.when(m[role] == old, F.lit(new)).otherwise(said)
            return F.struct(said.alias("role"), F.coalesce(m[text], F.lit("")).alias("text"))

        return F.transform(items, one)
    return turns


#: Declared layouts. Keys of an object are in alphabetic order.
MAPPINGS = (
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content: _, role: _>>>", _list("$.messages", "role", "content")),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from: _, value: _>>>",
            _list("$.conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    Mapping("prompt", "OBJECT<prompt: _, response: _>", lambda v: F.array(
        _turn("user", _get(v, "$.prompt")), _turn("assistant", _get(v, "$.response")))),
    Mapping("completion", "OBJECT<completion: _, prompt: _>", lambda v: F.array(
        _turn("user", _get(v, "$.prompt")), _turn("assistant", _get(v, "$.completion")))),
    Mapping("system prompt", "OBJECT<prompt: _, response: _, system: _>", lambda v: F.array(
        _turn("system", _get(v, "$.system")), _turn("user", _get(v, "$.prompt")),
        _turn("assistant", _get(v, "$.response")))),
    Mapping("instruction", "OBJECT<input: _, instruction: _, output: _>", lambda v: F.array(
        _turn("user", F.concat_ws("\n", F.nullif(_get(v, "$.instruction"), F.lit("")),
                                  F.nullif(_get(v, "$.input"), F.lit("")))),
        _turn("assistant", _get(v, "$.output")))),
    Mapping("bare instruction", "OBJECT<instruction: _, output: _>", lambda v: F.array(
        _turn("user", _get(v, "$.instruction")), _turn("assistant", _get(v, "$.output")))),
)


def shape(v: Column) -> Column:
    """The nested field paths of a variant: its schema with every scalar type as ``_``."""
    return F.regexp_replace(F.schema_of_variant(v), r"\b(?!OBJECT\b|ARRAY\b)[A-Z]+(\([0-9, ]*\))?(?=[,>]|$)", "_")


def canonical(df: DataFrame, record: str, typed: str | None = None) -> DataFrame:
    """Add ``layout`` (the mapping's name) and ``turns`` for a column of JSON text.

    Records that are null, no JSON, or of no declared layout get null in both; nothing is dropped. A null
    role or text becomes empty. Other columns pass unchanged, but for the two added names. ``typed`` names a
    column with the shape and turns of a record that was built from rows (see ``records_of_turns``); they count
    where the record has no variant.
    """
    v, mark = F.col("__variant"), F.col("__mark")
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in MAPPINGS:
        layout = F.when(mark == m.fingerprint, F.lit(m.name)).otherwise(layout)
        turns = F.when(mark == m.fingerprint, m.turns(v).cast(TURNS)).otherwise(turns)
    found = F.xxhash64(shape(v))
    if typed:
        turns = F.when(v.isNull(), F.col(typed)["turns"].cast(TURNS)).otherwise(turns)
        found = F.when(v.isNull(), F.xxhash64(F.col(typed)["shape"])).otherwise(found)
    return (df.withColumn("__variant", F.try_parse_json(record)).withColumn("__mark", found)
            .withColumn("layout", layout).withColumn("turns", turns).drop("__variant", "__mark"))


def escape(text: Column) -> Column:
    """``~`` becomes ``~0``; a control string gets ``~1`` after its first sign."""
    out = F.replace(text, F.lit("~"), F.lit("~0"))
    for head, tail in CONTROLS:
        out = F.replace(out, F.lit(head + tail), F.lit(f"{head}~1{tail}"))
    return out


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~2"), F.lit("\n")),
                     F.lit("~0"), F.lit("~"))


def _header(role: Column) -> Column:
    """A role takes one line: its line breaks are escaped too."""
    return F.concat(F.replace(escape(role), F.lit("\n"), F.lit("~2")), F.lit("\n"))


def formatted(turns: Column) -> Column:
    """The turns in the template, one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(BEGIN), _header(t["role"]), escape(t["text"]), F.lit(END + "\n"))), "")


def loss_mask(turns: Column) -> Column:
    """Per turn ``skip`` and ``take``: characters from the turn's begin mark on, then masked ones."""
    return F.transform(turns, lambda t: F.struct(
        (F.length(_header(t["role"])) + len(BEGIN)).alias("skip"),
        F.when(t["role"] == LEARNED, F.length(escape(t["text"]))).otherwise(0).alias("take")))


def read_turns(text: Column) -> Column:
    """The canonical turns of a formatted string."""
    parts = _parts(text)
    body = F.transform(parts, lambda p: F.substring(p, 1, F.length(p) - len(END) - 1))
    return F.transform(body, lambda b: F.struct(
        unescape(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substring(b, F.instr(b, "\n") + 1, F.length(b))).alias("text")))


def _parts(text: Column) -> Column:
    """What follows each begin mark."""
    parts = F.split(text, r"<\|im_start\|>")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def read_loss(text: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.zip_with(_parts(text), mask, lambda p, m: unescape(
        F.substring(p, m["skip"] + 1 - len(BEGIN), m["take"]))), "")


def format_records(df: DataFrame, record: str, typed: str | None = None) -> DataFrame:
    """``canonical`` with ``formatted`` and ``loss_mask`` added; null where no layout fits."""
    return canonical(df, record, typed).withColumn("formatted", formatted(F.col("turns"))) \
        .withColumn("loss_mask", loss_mask(F.col("turns")))


def records_of_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, record, typed`` from rows by turn (conv_id, turn, role, text).

    A user's and an assistant's turn become a prompt record, with a system's turn before them a system prompt
    record, all others a list of messages. Turns are in the order of turn, then role and text; null turns
    come first; a null role or text counts as empty, and a null conv_id as an id of its own. Repeated rows
    are turns of their own, and rows with equal conv_id are one conversation. One conversation is one record, so its turns meet in one row. A conversation over
    RECORD_BYTES has no JSON record; ``typed`` has the shape and turns of every one.
    """
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    turns = (rows.select("conv_id", F.col("turn"), F.col("role").cast("string"), F.col("text").cast("string"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("m"))
             .select("conv_id", "m", F.when(F.size("m") <= 3, F.transform("m", lambda t: t["role"])).alias("roles")))
    m = F.col("m")
    # whole lists are compared: a role may hold any sign, line breaks included
    pair, triple = (F.coalesce(F.col("roles") == F.array(*map(F.lit, names)), F.lit(False))
                    for names in (("user", "assistant"), ("system", "user", "assistant")))
    size = F.aggregate(m, F.lit(0).cast("long"), lambda n, t: n + TURN_BYTES + F.octet_length(t["role"])
                       + F.octet_length(t["text"]))
    kind = F.when(pair, "prompt").when(triple, "system prompt").otherwise("messages")
    shapes = F.create_map(*[F.lit(x) for s in MAPPINGS for x in (s.name, s.shape)])
    typed = F.struct(shapes[kind].alias("shape"), F.transform(m, lambda t: F.struct(t["role"], t["text"])).alias("turns"))
    record = (F.when(size > RECORD_BYTES, F.lit(None).cast("string")).when(pair, F.to_json(F.struct(
        m[0]["text"].alias("prompt"), F.get(m, 1)["text"].alias("response"))))
        .when(triple, F.to_json(F.struct(
            F.get(m, 1)["text"].alias("prompt"), F.get(m, 2)["text"].alias("response"), m[0]["text"].alias("system"))))
        .otherwise(F.to_json(F.struct(F.transform(m, lambda t: F.struct(
            t["text"].alias("content"), t["role"].alias("role"))).alias("messages")))))
    return turns.select("conv_id", record.alias("record"), typed.alias("typed"))


def digest(df: DataFrame) -> DataFrame:
    """What the formatted output of ``df`` (conv_id, formatted, loss_mask) says when it is read back."""
    read = df.select("conv_id", "layout", "formatted", read_turns(F.col("formatted")).alias("back"),
                     read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return read.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout")
