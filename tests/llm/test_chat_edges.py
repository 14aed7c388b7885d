"""Op 1: empty tables, repeated turns, missing and tied turn numbers, extra columns and long texts."""

from medtable.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, prompt string, chosen int, turns string"


def formatted(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return {r.conv_id: r for r in chat.format_pairs(chat.pairs_of(frame)).collect()}


def test_empty_table(spark):
    assert formatted(spark, []) == {}


def test_order_of_missing_and_tied_turns(spark):
    got = formatted(spark, [(1, 2, "user", "b"), (1, 2, "assistant", "c"), (1, None, "system", "s"), (1, 2, "user", "b"), (1, 3, "assistant", "end")])
    assert [(t.role, t.text) for t in got[1].chosen] == [("system", "s"), ("assistant", "c"), ("user", "b"), ("user", "b"), ("assistant", "end")]
    assert got[1].prefix_turns == 4 and got[1].chosen_completion == "<|assistant|>\nend<|end|>\n" and got[1].rejected_completion == ""


def test_long_texts_and_spans(spark):
    long = "é\U0001f600 word " * 50_000
    got = formatted(spark, [(1, 1, "user", long), (1, 2, "assistant", long), (2, 1, "user", long), (2, 2, "assistant", "no")])
    r = got[1]
    assert r.prefix_turns == 1 and r.prompt == f"<|user|>\n{long}<|end|>\n" and r.rejected_completion == "<|assistant|>\nno<|end|>\n"
    for text, spans in ((r.chosen_completion, r.chosen_spans), (r.rejected_completion, r.rejected_spans)):
        assert [text[s.start:s.start + s.length] for s in spans] == [text[len("<|assistant|>\n"):]]


def test_equal_conversations(spark):
    got = formatted(spark, [(k, t, role, "same") for k in (5, 6) for t, role in ((1, "user"), (2, "assistant"))])
    assert got[5].chosen_completion == got[5].rejected_completion == "" and got[5].chosen_spans == []
