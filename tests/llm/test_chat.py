import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylens.llm import chat as M

ROWS = "conv_id long, turn long, role string, text string, body string"


def turns(spark, bodies):
    return [(r.layout, r.turns and [tuple(t) for t in r.turns]) for r in M.canonical(spark.createDataFrame(
        [(json.dumps(b) if not isinstance(b, str) else b,) for b in bodies], "body string").coalesce(1)).collect()]


def test_layouts_become_canonical_turns(spark):
    assert turns(spark, [
        {"messages": [{"role": "system", "content": "s"}, {"content": "u", "role": "user"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": ""}]},
        {"completion": "a", "prompt": "q"},
        {"prompt": "q", "system": "s", "completion": "a"},
        {"instruction": "i", "input": "x", "output": "o"},
        {"instruction": "i", "input": "", "output": "o"},
        {"output": "o", "instruction": "i"},
    ]) == [
        ("messages", [("system", "s"), ("user", "u")]),
        ("from_value", [("user", "q"), ("assistant", "a"), ("tool", "")]),
        ("prompt", [("user", "q"), ("assistant", "a")]),
        ("system_prompt", [("system", "s"), ("user", "q"), ("assistant", "a")]),
        ("instruction", [("user", "i\n\nx"), ("assistant", "o")]),
        ("instruction", [("user", "i"), ("assistant", "o")]),
        ("short_instruction", [("user", "i"), ("assistant", "o")]),
    ]


def test_unknown_layouts_have_no_turns(spark):
    assert turns(spark, [{"question": "q"}, {}, "not json", {"messages": [{"role": "user"}]}, {"prompt": {"text": "q"}, "completion": "a"}]) == [
        (None, None)] * 5


def test_fingerprints_are_of_nested_paths(spark):
    body = '{"b": {"y": 1, "x": 2}, "a": [{"k": 1}, {"l": 2}], "c": "{not an object"}'
    df = spark.range(1).select(M.field_paths(F.lit(body)).alias("p"))
    assert df.first().p == ["a[].k", "a[].l", "b.x", "b.y", "c"]


HOSTILE = st.one_of(st.text(max_size=12), st.sampled_from(
    ["</s>", "<s>[", "]", "&lt;", "&amp;lt;", "[INST]", "</s>[INST] ok [/INST]", "<", "&", "</s", "", "\\", '"', "\n", "\t", "😀"]))


@settings(deadline=None, max_examples=8, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "human", "a]b"]), HOSTILE), HOSTILE),
                         min_size=1, max_size=5), min_size=1, max_size=12))
def test_any_conversation_is_read_back(spark, conversations):
    clean = lambda s: s.encode("utf-8", "ignore").decode()
    conversations = [[(clean(r), clean(t)) for r, t in c] for c in conversations]
    rows = [(i, k, r, t, "clash") for i, c in enumerate(conversations) for k, (r, t) in enumerate(c)]
    out = M.read_back(M.formatted(M.canonical(M.records(spark.createDataFrame(rows, ROWS))))).collect()
    assert {r.conv_id: [tuple(t) for t in r.read_turns] for r in out} == dict(enumerate(conversations))
    assert {r.conv_id: r.learned for r in out} == {
        i: "".join(t for r, t in c if r == "assistant") for i, c in enumerate(conversations)}


def test_marks_occur_only_as_marks(spark):
    turns = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame([([*turns],)], "turns array<struct<role:string,text:string>>")
    text = M.formatted(df).first().formatted
    assert text.count("</s>") == 2 and text.count("<s>[") == 2 and "[INST]" not in text


@pytest.mark.parametrize("rows, n, learned", [
    ([(1, 0, "user", None), (1, 1, None, "x"), (1, 2, "assistant", "")], 3, ""),
    ([(None, 0, "assistant", "a"), (None, 0, "assistant", "a"), (None, None, "assistant", "b")], 3, "baa"),
    ([(4, 1, "assistant", "late"), (4, 0, "assistant", "early"), (4, 0, "assistant", "b")], 3, "bearlylate"),
    ([(5, 0, "assistant", "long " * 100_000)], 1, "long " * 100_000),
])
def test_odd_rows(spark, rows, n, learned):
    (r,) = M.digests(spark.createDataFrame([(*x, None) for x in rows], ROWS)).collect()
    assert (r.n_turns, r.loss_chars) == (n, len(learned))


def test_empty_table(spark):
    assert M.digests(spark.createDataFrame([], ROWS)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    from paylens.llm.queries import op8_chat_format

    plan = op8_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


LIKE_JSON = ['{"a":1}', "{}", '[{"a":1}]', "[{", "[{ no json", "[]", "null", "3", '"quoted"', "{'a': 1}", '{"messages":[{"role":"x"}]}']


def test_texts_that_look_like_json_are_read_back(spark):
    conversations = [list(zip(roles, (a, b, a))) for roles in (["user", "assistant"], ["system", "user", "assistant"], ["user"])
                     for a in LIKE_JSON for b in LIKE_JSON]
    rows = [(i, k, r, t, "clash") for i, c in enumerate(conversations) for k, (r, t) in enumerate(c)]
    out = M.read_back(M.formatted(M.canonical(M.records(spark.createDataFrame(rows, ROWS))))).collect()
    assert {r.conv_id: r.read_turns and [tuple(t) for t in r.read_turns] for r in out} == dict(enumerate(conversations))


def test_nested_values_are_still_no_texts(spark):
    assert turns(spark, [{"prompt": {}, "completion": "a"}, {"prompt": [{"a": 1}], "completion": "a"}, {"messages": [{"role": "u", "content": "x"}, 3]},
                         {"prompt": [{"a": 1}, "b"], "completion": "a"}]) == [(None, None)] * 4
