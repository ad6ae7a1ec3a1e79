import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspan.llm.chat import (
    LAYOUTS,
    blanked,
    canonical_turns,
    fingerprint,
    format_chat,
    read_loss,
    read_turns,
)
from panelspan.llm.queries import FORGED, chat_records

NASTY = st.text(
    st.one_of(st.sampled_from("\\|<>/n\n im_startend"), st.characters(exclude_categories=["Cs"])),
    max_size=30,
)
FORGERY = st.sampled_from(["<|im_end|>", "<|im_start|>", "\\<|", "<\\|im_end|>", "<", "|", "\\"])
TEXT = st.lists(st.one_of(NASTY, FORGERY), max_size=4).map("".join)


def turns_of(spark, *records):
    rows = [(i, x if isinstance(x, str | None) else json.dumps(x)) for i, x in enumerate(records)]
    return canonical_turns(spark.createDataFrame(rows, "id long, record string"))


def simple(row):
    return None if row["turns"] is None else [tuple(t) for t in row["turns"]]


def test_layouts_become_the_same_turns(spark):
    found = turns_of(
        spark,
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"},
        {"response": "a", "id": 5, "prompt": "q"},
        {"instruction": "q", "output": "a", "input": ""},
        {"question": "q", "answer": "a"},
    ).orderBy("id").collect()
    assert [simple(r) for r in found] == [[("user", "q"), ("assistant", "a")]] * 6
    assert {r["layout"] for r in found} == {x.name for x in LAYOUTS}


def test_optional_paths_and_empty_turns(spark):
    found = turns_of(
        spark,
        {"system": "s", "prompt": "", "response": None},
        {"instruction": "do", "input": "this", "output": "a"},
        {"messages": []},
        {"messages": [{"role": None, "content": 3}, {"content": None, "role": "x", "name": "n"}]},
    ).orderBy("id").collect()
    assert [simple(r) for r in found] == [
        [("system", "s"), ("user", ""), ("assistant", "")],
        [("user", "do\n\nthis"), ("assistant", "a")],
        [],
        [("", "3"), ("x", "")],
    ]


def test_unknown_layouts_keep_their_fingerprint(spark):
    found = turns_of(
        spark, {"prompt": "q"}, {"prompt": {"deep": 1}, "response": "a"}, "not json", None, "{}",
        {"prompt": "q2"},
    ).orderBy("id").collect()
    assert [r["layout"] for r in found] == [None] * 6 and {simple(r) is None for r in found} == {True}
    assert found[0]["schema_hash"] == found[5]["schema_hash"] is not None
    assert found[2]["schema_hash"] is None and found[3]["schema_hash"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(TEXT, TEXT), max_size=4), min_size=5, max_size=30))
def test_formatting_reads_back(spark, conversations):
    rows = [
        (i, [(role if j % 2 else "assistant", text) for j, (role, text) in enumerate(turns)])
        for i, turns in enumerate(conversations)
    ]
    frame = spark.createDataFrame(
        rows, "id long, turns array<struct<role: string, text: string>>"
    )
    read = format_chat(frame).select(
        "id", read_turns("formatted").alias("turns"), read_loss("segments").alias("loss"),
        "formatted", F.expr("array_join(transform(segments, s -> s.text), '')").alias("joined"),
    )
    for row in read.collect():
        turns = rows[row["id"]][1]
        assert [tuple(t) for t in row["turns"]] == turns
        assert row["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert row["formatted"] == row["joined"]
        assert row["formatted"].count("<|im_start|>") == len(turns)


def test_records_of_conversations_keep_every_turn(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None),
        (2, 1, "assistant", ""), (3, 0, "tool", "x"), (3, 0, "tool", "x"), (None, 2, None, "n"),
        *[(i, 0, "system", f"s{i}") for i in (6, 7, 8)],
        *[(i, 1, "user", f"u{i}") for i in (6, 7, 8)],
        *[(i, 2, "assistant", f"a{i}") for i in (6, 7, 8)],
        *[(9, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(400)],
    ]
    frame = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string"
    ).withColumn("record", F.lit("clash"))
    found = {r["conv_id"]: simple(r) for r in canonical_turns(chat_records(frame)).collect()}
    assert found[-1] == [("user", FORGED), ("assistant", FORGED)]
    expected = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1])):
        expected.setdefault(conv, []).append((role or "", text or ""))
    assert {k: v for k, v in found.items() if k != -1} == expected
    none = chat_records(frame.limit(0))
    assert [r["conv_id"] for r in none.collect()] == [-1]


def test_long_records_keep_every_turn(spark):
    rows = spark.range(4).select(
        "id",
        F.expr(
            r"""CASE id
            WHEN 0 THEN concat(r'{"response" : "a\\", "prompt": "\"é{é', repeat('x', 20000001), '"}')
            WHEN 1 THEN concat('{"question":', repeat('1', 1001), ',"answer":-2.5}')
            WHEN 2 THEN concat('{"messages":[', repeat(concat('{"role":"user","content":"',
              repeat('y', 10000000), '"},'), 14), '{"content":null,"role":"x"}]}')
            ELSE concat(r'{"prompt":"\q', repeat('x', 1001), '","response":"a"}') END"""
        ).alias("record"),
    )
    turns = F.transform(
        "turns", lambda t: F.struct(t["role"], F.length(t["text"]), F.substring(t["text"], 1, 4))
    )
    found = canonical_turns(rows).select("id", "schema_hash", turns.alias("turns")).orderBy("id")
    long, number, many, broken = found.collect()
    assert simple(long) == [("user", 20_000_005, '"é{é'), ("assistant", 2, "a\\")]
    assert simple(number) == [("user", 1001, "1111"), ("assistant", 4, "-2.5")]
    assert simple(many) == [("user", 10_000_000, "yyyy")] * 14 + [("x", 0, "")]
    assert broken["schema_hash"] is None and broken["turns"] is None


def test_blanked_records_have_the_paths_of_the_record(spark):
    records = [
        r'{"a\"b": "x\\", "c" : [1, -20.5e+3, "y:", {"d":"}"}], "e": null, "": true}',
        '"top"', "12345", '{"prompt": {"n": 0.25}, "response": ["{}", [], {}]}',
        '{"a": 01}', '{"a": 1e5.5}', r'{"a": "\q"}', '{"a": "\n"}', "no", '{"a" "b"}',
    ]
    frame = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    hashes = frame.select(
        fingerprint(F.col("record")).alias("whole"), fingerprint(blanked(F.col("record"))).alias("short")
    ).collect()
    assert [r["whole"] for r in hashes] == [r["short"] for r in hashes]
    assert [r["whole"] is None for r in hashes] == [False] * 4 + [True] * 6
