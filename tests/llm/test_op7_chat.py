import hashlib
import random

from llm_rows import *  # noqa: F403
from pyspark.sql import functions as F

from gateflow.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def back(df):
    return {r.conv_id: r for r in chat.read(chat.format_turns(df)).collect()}


def test_template(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "more"), (1, 2, "assistant", "yes <|im_end|> \\")]
    r = chat.format_turns(spark.createDataFrame(rows, TURNS)).first()
    assert r.formatted == ("<|im_start|>user\nhi\n<|im_sep|>\nmore\n<|im_end|>\n"
                           "<|im_start|>assistant\nyes \\<|im_end|> \\\n<|im_end|>\n")
    raw = r.formatted.encode()
    assert [raw[m.start:m.end].decode() for m in r.mask] == ["yes \\<|im_end|> \\"]


def test_round_trip(spark):
    r = random.Random(4)
    bits = ["<|im_start|>", "<|im_end|>", "<|im_sep|>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "\n", "a", " ", "$1", "é👍", "<", "|>", "user\n"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "a b/ü\n<s>", "", None]),
             None if r.random() < 0.1 else "".join(r.choices(bits, k=r.randrange(12))))
            for c in range(60) for t in range(r.randrange(1, 14))]
    shuffled = rows[:]
    r.shuffle(shuffled)
    got = back(spark.createDataFrame(shuffled, TURNS).selectExpr("*", "1 as conv", "2 as chunk", "3 as r"))
    for c in range(60):
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == c]
        assert [tuple(t) for t in got[c].turns] == want
        assert got[c].loss_text == "".join(t for role, t in want if role == "assistant")


def test_long_conversation_in_chunks(spark):
    n = 5 * chat.CHUNK + 7
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    got = back(df.repartition(7))[1]
    assert [t.text for t in got.turns] == [f"t{i}" for i in range(n)]
    assert got.loss_text == "".join(f"t{i}" for i in range(n) if i % 3)
    assert got.formatted.count(chat.START) == 2 * -(-n // 3) - (n % 3 == 1)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "z"),
            (2, 0, "assistant", "x" * 500_000)]
    df = spark.createDataFrame(rows, TURNS)
    got = back(df)
    assert [tuple(t) for t in got[None].turns] == [("", "")]
    assert [tuple(t) for t in got[1].turns] == [("user", "b"), ("assistant", "z"), ("user", "a"), ("user", "a")]
    assert got[2].loss_text == "x" * 500_000
    assert chat.digests(chat.read(chat.format_turns(df.limit(0)))).count() == 0
    d = {r.conv_id: r for r in chat.digests(chat.read(chat.format_turns(df))).collect()}[1]
    assert d.turns_sha256 == hashlib.sha256(b"user\nb\nassistant\nz\nuser\na\nuser\na\n").hexdigest()


def test_running_sums(spark):
    rows = [(i, [r % 7 for r in range(n)]) for i, n in enumerate((0, 1, 2, chat.CHUNK, chat.CHUNK + 1, 3 * chat.CHUNK + 5))]
    df = spark.createDataFrame(rows, "i int, a array<long>").select("i", "a", chat.running_sums(F.col("a")).alias("s"))
    for r in df.collect():
        total, want = 0, []
        for x in r.a:
            total += x
            want.append(total)
        assert r.s == want


def test_mask_is_what_the_reader_uses(spark):
    """The loss text comes out of the formatted string at the mask's places."""
    rows = [(1, 0, "user", "ä"), (1, 1, "assistant", "éa</s>"), (1, 2, "user", "b"), (1, 3, "assistant", "👍")]
    out = chat.format_turns(spark.createDataFrame(rows, TURNS))
    assert chat.read(out).first().loss_text == "éa</s>👍"
    moved = out.withColumn("mask", F.transform("mask", lambda m: F.struct(m["start"].alias("start"), m["start"].alias("end"))))
    assert chat.read(moved).first().loss_text == ""
