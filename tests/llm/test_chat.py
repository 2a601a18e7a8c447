import random

from pyspark.sql import functions as F

from orderlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>", "<|+|>", "&lt;", "&amp;#124;", "|>", "<|assistant|>", "", None, "a\nb", "🙂 é", "$1 \\ .*"]


def rows():
    rng = random.Random(6)
    found = [(c, t, rng.choice(["user", "assistant", "assistant", "a|b<[&", None]), rng.choice(NASTY)) for c in range(40) for t in range(rng.randint(1, 9))]
    found += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (50, 1, "user", "same"), (50, 1, "user", "same"), (50, 1, "assistant", "tie")]
    return found + [(60, t, "user" if t % 2 else "assistant", f"turn {t} " * 20) for t in range(2000)]


def order(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", (row[3] or "").encode())


def test_everything_reads_back(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).withColumn("blocks", F.lit(1)).withColumn("turns", F.lit("x"))
    made = chat.render(df)
    back = made.select(
        "conv_id", "formatted", chat.parsed(F.col("formatted")).alias("blocks"),
        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"), "loss_spans",
    ).collect()
    expected = {}
    for row in data:
        expected.setdefault(row[0], []).append(row)
    assert {r.conv_id for r in back} == set(expected)
    for r in back:
        turns = [(x[2] or "", x[3] or "") for x in sorted(expected[r.conv_id], key=order)]
        assert [(b.role, t) for b in r.blocks for t in b.texts] == turns
        assert all(x.role != y.role for x, y in zip(r.blocks, r.blocks[1:]))
        assert r.learned == "".join(t for role, t in turns if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in turns)
        assert r.formatted.count("<|end|>") == len(r.blocks) and "</s>" not in r.formatted and "[INST]" not in r.formatted


def test_empty(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).collect() == []


def test_spark_expressions_only(spark):
    plan = chat.render(spark.createDataFrame(rows()[:5], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
