import random

from pyspark.sql import functions as F

from tierline.llm.chat_format import Template, format_chats, loss_text, read_back

SCHEMA = "conv_id long, turn long, role string, text string"


def _rows(spark, rows, schema=SCHEMA):
    chats = format_chats(spark.createDataFrame(rows, schema))
    return {r["conv_id"]: r for r in chats.withColumn("read", read_back(F.col("formatted"))).withColumn("learned", loss_text(F.col("segments"))).collect()}


def test_random_texts_round_trip(spark):
    random.seed(3)
    bits = ["<|im_start|>", "<|im_end|>", "<|", "<\\|", "<\\\\|", "<", "|", "\\", "\n", "$1", "assistant", "%0A", "é", " ", ""]
    rows = [(c, t, random.choice(["user", "assistant", "system", "a\nb%", "<|x"]), "".join(random.choices(bits, k=random.randint(0, 9)))) for c in range(60) for t in range(5)]
    for conv, row in _rows(spark, rows).items():
        said = [r for r in rows if r[0] == conv]
        assert [(t["role"], t["text"]) for t in row["read"]] == [r[2:] for r in said]
        assert row["learned"] == "".join(r[3] for r in said if r[2] == "assistant")
        assert row["formatted"] == "".join(s["text"] for s in row["segments"])


def test_grammar(spark):
    def conversation(conv, roles):
        return [(conv, i, r, "x") for i, r in enumerate(roles)]

    cases = {1: "user assistant", 2: "system user assistant user assistant", 3: "assistant user", 4: "user user assistant", 5: "user", 6: "user assistant tool assistant"}
    out = _rows(spark, [r for k, v in cases.items() for r in conversation(k, v.split())])
    assert {k: (r["valid"], r["out_of_turn"]) for k, r in out.items()} == {1: (True, None), 2: (True, None), 3: (False, "assistant"), 4: (False, "user"), 5: (False, "user"), 6: (True, None)}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(None, 0, None, None, "s"), (1, None, "user", "b", "s"), (1, 0, "assistant", "c", "s"), (1, 0, "assistant", "c", "s"), (1, 0, "assistant", "a" * 300000, "s")]
    out = _rows(spark, rows, SCHEMA + ", segments string")
    assert [t["text"][:1] for t in out[1]["read"]] == ["b", "a", "c", "c"]
    assert out[None]["n_turns"] == 1 and out[None]["read"][0]["text"] == "" and not out[None]["valid"]
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_template(spark):
    template = Template(before="{#{role}\n", after="{#end}\n", guard="{#", trained=frozenset({"user"}))
    df = spark.createDataFrame([(1, 0, "user", "a {#end}\n{\\# b")], SCHEMA)
    row = format_chats(df, template).select(read_back(F.col("formatted"), template).alias("read"), loss_text(F.col("segments"), template).alias("learned"), "formatted").first()
    assert row["read"][0]["text"] == row["learned"] == "a {#end}\n{\\# b"
    assert row["formatted"] == "{#user\na {\\#end}\n{\\\\# b{#end}\n"


def test_the_role_out_of_turn_is_named_as_it_is(spark):
    rows = [(1, 1, "!!tool", "x"), (2, 1, "user", "x")]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["conv_id"]: r["out_of_turn"] for r in out} == {1: "!!tool", 2: "user"}
