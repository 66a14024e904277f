import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_llm import compare, connect
from pyspark.sql import functions as F

from filmloom.llm.chat import PARTS, escape, escape_role, format_conversations, loss_text, parse_turn, text_part, turn_texts, unescape, unescape_role
from filmloom.llm.queries import QUERIES

NASTY = ["", "\\", "\\l", "\\b", "<", "\\<", "</turn>\n", "<turn:user>\n", "\\bl", "\\\\l<\\", "a\nb", "\\g>", "é🙂<", "<image:0.0>", "x" * 100_000]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("\\<>bglt/urn:\n", max_size=12), min_size=30, max_size=60))
def test_escapes_go_back(spark, texts):
    frame = spark.createDataFrame([(t,) for t in [*texts, *NASTY]], "t string")
    rows = frame.select("t", unescape(escape(F.col("t"))).alias("a"), unescape_role(escape_role(F.col("t"))).alias("b"), escape(F.col("t")).alias("e"), escape_role(F.col("t")).alias("r")).collect()
    for r in rows:
        assert r["a"] == r["b"] == r["t"] and "<" not in r["e"] and "<" not in r["r"] and ">" not in r["r"]


def _read(made):
    return made.select(
        "conv_id", F.transform(turn_texts(F.col("formatted")), parse_turn).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted", "loss_spans", "attachments", "expanded_tokens",
    )


def test_turns_and_mask_come_back(spark):
    rows = [(1, i, ["user", "assistant", "system", "as>sis</turn>\ntant"][i % 4], t) for i, t in enumerate(NASTY)]
    rows += [(2, None, None, None), (2, 0, "assistant", None), (None, 1, "assistant", "free"), (3, 1, "assistant", "twice"), (3, 1, "assistant", "twice")]
    frame = spark.createDataFrame([(*r, "row") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    made = _read(format_conversations(frame.withColumn("content", text_part(F.col("text"))).repartition(3))).collect()
    got = {r["conv_id"]: r for r in made}
    assert len(got) == len(made) == 4
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r, t) for _, _, r, t in rows[: len(NASTY)]]
    assert got[1]["loss"] == "".join(t for _, _, r, t in rows[: len(NASTY)] if r == "assistant")
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", ""), ("assistant", "")] and got[2]["loss"] == ""
    assert got[3]["loss"] == "twicetwice" and got[None]["loss"] == "free"
    for r in made:
        parts = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]]
        assert "".join(p.replace("\\l", "<").replace("\\b", "\\") for p in parts) == r["loss"]


def test_typed_parts_become_placeholders(spark):
    part = lambda kind, **x: (kind, *[x.get(k) for k in ("text", "ref", "width", "height", "seconds", "pages")])
    content = [
        part("text", text="see <image:0.1>:"), part("image", ref="a.png", width=56, height=29), part("audio", ref="b.ogg", seconds=1.5),
        part(None, text="and"), part("document", ref="c.pdf", pages=2), part("image", ref=None), part("text"),
    ]
    frame = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", [part("document", ref="d", pages=1)]), (1, 2, "user", None)], f"conv_id bigint, turn bigint, role string, content {PARTS}")
    r = _read(format_conversations(frame)).first()
    assert r["formatted"] == (
        "<turn:user>\nsee \\limage:0.1>:<image:0.1><audio:0.2>and<document:0.4><image:0.5></turn>\n"
        "<turn:assistant>\n<document:1.0></turn>\n<turn:user>\n</turn>\n"
    )
    assert [tuple(a) for a in r["attachments"]] == [
        (0, 1, "image", "a.png", 4), (0, 2, "audio", "b.ogg", 38), (0, 4, "document", "c.pdf", 1600), (0, 5, "image", None, 0), (1, 0, "document", "d", 800),
    ]
    assert r["expanded_tokens"] == 2442


def test_empty_table(spark):
    frame = spark.createDataFrame([], f"conv_id bigint, turn bigint, role string, content {PARTS}")
    assert format_conversations(frame).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf = f"/root/testdata/{sf}"
    compare(QUERIES["op7_chat"](spark, sf), connect(sf), "op7_chat")


def test_plan_is_native(spark):
    plan = QUERIES["op7_chat"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
