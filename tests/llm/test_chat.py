import hashlib

from pyspark.sql import functions as F

from riskloom.llm import chat

KIND = "conv_id long, turn long, role string, text string, formatted string, at int"


def frame(spark):
    marks = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", marks), (2, 1, "assistant", marks),
        (3, 0, "assistant", "\\</s> \\\\[INST]"), (3, 1, "user", "back\\"), (3, 2, "assistant", " </s> </s>"), (3, 3, "assistant", ""),
        (4, None, None, None), (4, 0, "sys [/INST] tem </s>", "x\n\ny"), (4, 0, "assistant", "b"), (4, 0, "assistant", "a"),
        (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 1, "assistant", "no id"), (6, 0, "assistant", "<s></s>[/INST]" * 3000),
        (7, 0, "assistant", "x \\"), (7, 1, "user", "</s"), (7, 2, "assistant", "[INST"), (7, 3, "assistant", "$1 \\1 [/INST] "),
    ]
    return spark.createDataFrame([(*r, "clash", 9) for r in rows], KIND), rows


def test_round_trip_and_mask(spark):
    df, rows = frame(spark)
    made = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in made.select(
        "conv_id", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted([(-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv])
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r, x) for _, r, x in mine]
        assert got[conv]["loss"] == "".join(x for _, r, x in mine if r == "assistant")
        for start, length in got[conv]["loss_spans"]:
            assert got[conv]["formatted"][start + length:].startswith(chat.CLOSE)


def test_plain_texts_are_not_escaped(spark):
    df, _ = frame(spark)
    got = chat.format_conversations(df.where("conv_id = 1")).first()
    assert got["formatted"] == "[INST] user [/INST] hi </s>[INST] assistant [/INST] hello </s>"
    assert chat.format_conversations(df.where("false")).count() == 0


def test_query_has_no_python(spark):
    plan = chat.format_conversations(frame(spark)[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_digest_of_the_marks(spark):
    df, _ = frame(spark)
    said = F.concat_ws("", F.transform(chat.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    got = chat.format_conversations(df.where("conv_id = 2")).select(F.sha2(said.cast("binary"), 256)).first()[0]
    text = "</s>[INST] ok [/INST]"
    assert got == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
