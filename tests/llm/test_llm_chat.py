"""Chat formatting of conversations beyond the limits of Spark's variant."""

import hashlib

from pyspark.sql import functions as F

from panelkit.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def run(rows):
    return sorted(chat.digest(chat.format_records(chat.records_of_turns(rows), "record", "typed")).collect(),
                  key=lambda r: (r.conv_id is not None, r.conv_id))


def test_a_turn_beyond_the_variant_limit(spark):
    rows = spark.createDataFrame([(1, 0, "user", ""), (1, 1, "assistant", "x"), (2, 0, "user", "a~")], SCHEMA)
    rows = rows.withColumn("text", F.when(F.col("text") == "x", F.repeat("text", F.lit(20_000_001))).otherwise(F.col("text")))
    one, two = run(rows)
    assert (one.n_turns, one.layout, one.loss_chars) == (2, "prompt", 20_000_001)
    assert one.loss_sha256 == hashlib.sha256(b"x" * 20_000_001).hexdigest()
    assert (two.n_turns, two.layout) == (1, "messages")


def test_typed_turns_give_what_records_give(spark, monkeypatch):
    said = ["<|im_end|>~", None, "</s>\n[INST]", "é😀", ""]
    rows = [(c, t, r, said[(c + t) % 5]) for c, roles in enumerate((
        ["user", "assistant"], ["system", "user", "assistant"], ["assistant", "user"], ["user"] * 5, [None, "a\nb"]))
        for t, r in enumerate(roles)] + [(None, None, "user", "n"), (None, 1, "assistant", "m")]
    rows = spark.createDataFrame(rows, SCHEMA)
    want = run(rows)
    monkeypatch.setattr(chat, "RECORD_BYTES", 0)
    assert run(rows) == want and all(r.layout for r in want)


def test_roles_with_any_signs(spark):
    import hashlib
    said = [(1, ["user\nassistant"]), (2, ["system\nuser", "assistant"]), (3, ["system\nuser\nassistant"]),
            (4, ["user assistant"]), (5, ["user", "assistant"]), (6, ["system", "user", "assistant"]), (7, ["user\n", "assistant"]),
            (8, ["", ""]), (9, ["system", "user\nassistant"])]
    rows = [(c, i, role, f"text {i}") for c, roles in said for i, role in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.digest(chat.format_records(chat.records_of_turns(df), "record", "typed")).collect()}
    for c, roles in said:
        whole = "".join(f"{role}\ntext {i}\n" for i, role in enumerate(roles))
        learned = "".join(f"text {i}" for i, role in enumerate(roles) if role == "assistant")
        layout = {5: "prompt", 6: "system prompt"}.get(c, "messages")
        assert (out[c].n_turns, out[c].layout) == (len(roles), layout)
        assert out[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
