"""Examples of long conversations: every one holds all turns before it."""

import pytest
from pyspark.sql import functions as F

from fringeframe.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def conversation(conv, n, chars, trained=lambda t: t % 2):
    return [(conv, t, "assistant" if trained(t) else "user", f"{conv} {t} \\ <|é\U0001f600 ".ljust(chars, "xyz\n"[t % 4])) for t in range(n)]


def transcripts(said):
    """conv_id -> turns as written, in order."""
    out = {}
    for conv, _, role, text in sorted(said, key=lambda v: (v[0] is not None, v[0] or 0, v[1])):
        out.setdefault(conv, []).append(chat.segment(role, text)[0])
    return out


def whole(rows):
    """(conv_id, seq) -> text, and how far the rows say it goes."""
    out = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["seq"], r["begin"])):
        text, end = out.get((r["conv_id"], r["seq"]), ("", 0))
        assert r["begin"] == len(text)
        out[r["conv_id"], r["seq"]] = text + r["text"], r["end"]
    return out


def test_long_conversations_are_written_whole(spark):
    """Contexts of conversation 1 come to 3 million characters, of the null one to 2 million in 10 examples."""
    said = conversation(1, 140, 600) + conversation(2, 6, 50) + conversation(None, 10, 40_000, lambda t: True)
    rows = chat.expand(chat.format_turns(spark.createDataFrame(said, SCHEMA))).where("loss_begin IS NOT NULL").collect()
    got, want = whole(rows), transcripts(said)
    assert len(got) == 70 + 3 + 10 and max(len(r["text"]) for r in rows) <= chat.WRITTEN
    for (conv, seq), (text, end) in got.items():
        assert text == "".join(want[conv][: seq + 1]) and end == len(text)
    assert sum(len(t) for (conv, _), (t, _) in got.items() if conv == 1) > 3_000_000


@pytest.mark.parametrize("size, held, marks", [(1 << 13, 1 << 20, 1 << 10), (7, 100, 2), (1, 1, 1), (64, 1 << 20, 3)])
def test_rows_of_any_size_are_read_alike(spark, monkeypatch, size, held, marks):
    said = conversation(1, 9, 60) + conversation(2, 5, 30, lambda t: t == 1) + conversation(3, 3, 20, lambda t: False) + conversation(None, 4, 25)
    df = spark.createDataFrame(said, SCHEMA)
    want = sorted(chat.read_back(chat.format_turns(df)).collect(), key=str)
    for name, value in (("WRITTEN", size), ("HELD", held), ("MARKS", marks)):
        monkeypatch.setattr(chat, name, value)
    assert sorted(chat.chat_report(df).collect(), key=str) == want
    assert sum(r["n_examples"] for r in want) == 4 + 1 + 0 + 2


@pytest.mark.parametrize("broken", [
    lambda d: d.where("NOT (seq = 39 AND begin = 8192)"),  # a row in the middle of a context
    lambda d: d.where("NOT (seq = 39 AND begin = 16384)"),  # the last row, with the reply
    lambda d: d.where("seq != 37"),  # an example
    lambda d: d.withColumn("text", F.when(F.expr("seq = 39 AND begin = 8192"), F.expr("overlay(text placing 'Q' from 100 for 1)")).otherwise(F.col("text"))),
    lambda d: d.withColumn("text", F.when(F.expr("seq = 39 AND begin = 0"), F.expr("substr(text, 2)")).otherwise(F.col("text"))),
])
def test_what_is_missing_from_a_long_context_is_found(spark, monkeypatch, broken):
    df = spark.createDataFrame(conversation(1, 40, 600), SCHEMA)
    made = chat.expand
    monkeypatch.setattr(chat, "expand", lambda d: broken(made(d)))
    with pytest.raises(Exception, match="example"):
        chat.chat_report(df).collect()


def test_a_piece_is_shared_by_many_examples(spark, monkeypatch):
    """Texts reach the tasks that write examples once for MARKS examples, and a turn longer than a row is cut."""
    monkeypatch.setattr(chat, "MARKS", 16)
    said = conversation(1, 100, 300, lambda t: True) + conversation(2, 2, 30_000)
    df = spark.createDataFrame(said, SCHEMA)
    got, want = whole(chat.expand(chat.format_turns(df)).where("loss_begin IS NOT NULL").collect()), transcripts(said)
    assert len(got) == 101 and all(text == "".join(want[conv][: seq + 1]) for (conv, seq), (text, _) in got.items())
    assert sorted(chat.chat_report(df).collect()) == sorted(chat.read_back(chat.format_turns(df)).collect())
