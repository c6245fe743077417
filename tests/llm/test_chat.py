"""Chat formatting: everything can be read back from the output."""

import hashlib

from pyspark.sql import functions as F

from eventlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def read_back(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    chats = chat.format_chats(df)
    out = chats.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"), "segments").collect()
    return {r["conv_id"]: r for r in out}


NASTY = ["", "\\", "\\\\", "<s>", "</s>", "<\\s>", "[INST] a [/INST]", "<<SYS>>x<</SYS>>", "<msg><sep>", "<", "s>", "<|im_start|>user", "a\n\nb", "é😀", "\\<s\\>", "<<s>", "<s></s><s>", "$1 \\E \\Q"]


def test_every_text_comes_back(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(NASTY)] + [(i, 1, "assistant", t) for i, t in enumerate(NASTY)]
    got = read_back(spark, rows)
    for i, t in enumerate(NASTY):
        assert [(x["role"], x["text"]) for x in got[i]["turns"]] == [("user", t), ("assistant", t)]
        assert got[i]["loss"] == t
        assert "".join(s["text"] for s in got[i]["segments"]) == got[i]["formatted"]
        assert got[i]["formatted"].count("<s>") == 2 and got[i]["formatted"].count("</s>") == 2
        assert not any(c in got[i]["formatted"] for c in chat.Template().foreign)


def test_adjacent_turns_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", ""), (1, 4, "assistant", "d"), (1, 5, "user", "e")]
    r = read_back(spark, rows)[1]
    assert r["formatted"] == "<s>user<msg>a<sep>b</s><s>assistant<msg>c<sep><sep>d</s><s>user<msg>e</s>"
    assert [(x["role"], x["text"]) for x in r["turns"]] == [x[2:] for x in rows]
    assert r["loss"] == "cd"


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, "x"), (1, 0, "user", None), (1, 0, "user", None), (None, 0, "assistant", "n"), (2, 5, "<s>\n", "r")]
    got = read_back(spark, rows)
    assert [(x["role"], x["text"]) for x in got[1]["turns"]] == [("user", "first"), ("", "x"), ("user", ""), ("user", "")]
    assert got[None]["loss"] == "n"
    assert [(x["role"], x["text"]) for x in got[2]["turns"]] == [("<s>\n", "r")]


def test_empty_table(spark):
    assert chat.digest(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_long_conversation_digest_by_brute_force(spark):
    turns = [(7, k, ["user", "user", "assistant"][k % 3], f"t{k} </s>") for k in range(3000)]
    r = chat.digest(chat.format_chats(spark.createDataFrame(turns, SCHEMA).repartition(5))).first()
    text = "".join(f"{role}\n{t}\n" for _, _, role, t in turns)
    loss = "".join(t for _, _, role, t in turns if role == "assistant")
    assert r["n_turns"] == 3000 and r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
