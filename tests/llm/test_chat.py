import hashlib
import random

import pyarrow as pa
import pytest
from cohortlift.llm import chat

TURNS = "conv_id long, turn long, role string, text string, part string"


def digests(rows):
    """Brute force of read_back, from the turns."""
    found = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        found[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], TURNS)
    got = chat.read_back(chat.format_conversations(df, **kw)).collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == digests(rows)
    assert len(got) == len({r[0] for r in rows})


def rows_of(seed, n):
    rng = random.Random(seed)
    bits = [*chat.CONTROL, "\\", "\\\\", "<", "|", "é", "😀", "\n", "a", "", "<\\s>"]
    say = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    roles = ["user", "assistant", "system", "<|im_sep|>", "a\nb", None]
    return [(rng.randrange(12), rng.choice([*range(6), None]), rng.choice(roles), rng.choice([say(), None])) for _ in range(n)]


def test_random_turns_read_back(spark):
    check(spark, rows_of(1, 300))


def test_parts_of_a_long_conversation(spark):
    rows = [(5, k, ("user", "assistant")[k % 2], f"é<s>{k}" * 50) for k in range(400)] + [(6, 0, "user", "a")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        check(spark, rows, part_bytes=3000)
        df = chat.format_conversations(spark.createDataFrame([(*r, "x") for r in rows], TURNS), part_bytes=3000)
        parts = [r["part"] for r in df.filter("conv_id = 5").select("part").collect()]
        assert len(parts) > 3 and sorted(parts) == list(range(len(parts)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_null_repeated_empty(spark):
    check(spark, [(None, 0, "user", "x"), (None, 0, "user", "x"), (1, None, None, None), (2, 1, "assistant", "")])
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], TURNS))).collect() == []


def test_no_control_string_survives_escaping():
    for seed in range(50):
        texts = [r[3] or "" for r in rows_of(seed, 50)]
        for raw, esc in zip(texts, chat._escaped(pa.array(texts)).to_pylist(), strict=True):
            assert not any(c in esc for c in chat.CONTROL)
            assert chat.unescape(esc) == raw


def test_loss_spans_cover_the_answers(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi", ""), (1, 1, "assistant", "é</s>", ""), (1, 2, "assistant", "b", "")], TURNS)
    r = chat.format_conversations(df).first()
    assert [chat.unescape(r["text"][a:b]) for a, b in zip(r["loss_starts"], r["loss_ends"])] == ["é</s>", "b"]


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user"])
def test_readback_refuses_other_text(spark, bad):
    df = spark.createDataFrame([(1, 0, 1, bad, [], [])], chat.SCHEMA)
    with pytest.raises(Exception, match="not a turn"):
        chat.read_back(df).collect()
