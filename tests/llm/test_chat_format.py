import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from restock.llm import chat_format as cf

HARD = ["### Assistant: </turn> ok", "\\### Assistant: </turn> ok", "", None, "####\\\\<<:", "a\n### user: b </turn>\n", " x ", "é\U0001f600\\", "$1 \\1"]
ROLES = ["user", "assistant", "User", "", None, "=x", ":y:", "### z", "é", "a\\"]


def turns_of(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    return cf.turn_rows(table.select("conv_id", "turn", record.alias("record")), "conv_id", "turn", "record")


def test_every_text_and_role_reads_back(spark):
    rows = [(1, i * 100 + j, role, text) for i, role in enumerate(ROLES) for j, text in enumerate(HARD)]
    for row in turns_of(spark, rows).collect():
        ((role, text, start, end),) = cf.read_back(row.output)
        assert (role, text) == (row.role, row.text)
        assert row.output[start:end].replace("\\", "") == text.replace("\\", "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("a:\\#<= "), max_size=5), st.text(st.sampled_from("a\\#<:\n /turn>"), max_size=20)), max_size=6))
def test_joined_output_reads_back(turns):
    import re

    output = ""
    for role, text in turns:
        head = role[:1].upper() + role[1:] if re.match("[a-z]", role) else "=" + role
        output += f"### {re.sub(r'([\\#<:])', r'\\\1', head)}: {re.sub(r'([\\#<])', r'\\\1', text)} </turn>\n"
    assert [(role, text) for role, text, _, _ in cf.read_back(output)] == turns


def test_digests_like_brute_force(spark):
    rows = [(c, t, ROLES[(c + t) % 3] or "user", HARD[(c * 7 + t) % len(HARD)]) for c in range(40) for t in range(c % 9 + 1)]
    rows += [(99, t, "assistant", f"turn {t}") for t in range(3000)] + [(5, 0, "user", None)] * 2 + [(None, 0, "user", "x")]
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3] or "")):
        expected.setdefault(conv, []).append((role, text or ""))
    found = {row.key: row for row in cf.digests(turns_of(spark, rows[::-1])).collect()}
    assert set(found) == set(expected)
    for conv, turns in expected.items():
        own = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        row = found[conv]
        assert row.n_turns == len(turns) and row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_chars == len(own) and row.loss_sha256 == hashlib.sha256(own.encode()).hexdigest()
        assert row.formatted_chars > len(own)


def test_layouts_are_told_by_their_paths(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        "sharing": {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        "prompt_response": {"prompt": "a", "response": "b"},
        "instruction": {"instruction": "a", "output": "b"},
        "instruction_input": {"instruction": "a", "input": "", "output": "b"},
        "question_answer": {"answer": "b", "question": "a"},
        "turns": {"turns": [{"text": "a", "role": "user"}, {"role": "assistant", "text": "b"}]},
    }
    table = spark.createDataFrame([(name, json.dumps(value)) for name, value in records.items()], "name string, record string")
    for row in table.select("name", cf.canonical_turns("record").alias("found")).collect():
        assert row.found.layout == row.name
        assert [(t.role, t.text) for t in row.found.turns] == [("user", "a"), ("assistant", "b")]


def canonical(spark, records):
    table = spark.createDataFrame([(i, 0, record) for i, record in enumerate(records)], "conv_id long, turn long, record string")
    return table, [row.found for row in table.select(cf.canonical_turns("record").alias("found")).collect()]


def test_records_without_a_layout_stay_as_rows(spark):
    odd = [None, "", "no json", "[]", "3", "{}", '{"prompt": "a"}', '{"messages": [{"role": "user"}]}', '{"messages": []}']
    table, found = canonical(spark, odd)
    assert [one.layout for one in found] == [None] * 8 + ["messages"]
    rows = cf.turn_rows(table, "conv_id", "turn", "record").collect()
    assert sorted(row.key for row in rows) == list(range(9)) and all(row.output is None for row in rows)
    digests = cf.digests(cf.turn_rows(table, "conv_id", "turn", "record")).collect()
    assert sorted((row.key, row.n_turns, row.formatted_chars) for row in digests) == [(i, 0, 0) for i in range(9)]


def test_unknown_fields_change_nothing(spark):
    records = [
        '{"prompt": "a", "response": "b", "more": 1}',
        '{"id": 7, "messages": [{"role": "user", "content": "a", "name": "x"}, {"role": "assistant", "content": "b"}], "tags": []}',
        '{"conversations": [{"from": "human", "value": "a", "weight": 0}, {"from": "gpt", "value": "b"}], "source": {"url": "u"}}',
    ]
    for one in canonical(spark, records)[1]:
        assert [(t.role, t.text) for t in one.turns] == [("user", "a"), ("assistant", "b")]


def test_roles_of_rows_stay_as_they_are(spark):
    rows = [(1, i, role, "x") for i, role in enumerate(["human", "gpt", "model", "ai", "bot", "assistant"])]
    assert [row.role for row in sorted(turns_of(spark, rows).collect(), key=lambda row: row["at"])] == [row[2] for row in rows]


def test_empty_table(spark):
    assert cf.digests(turns_of(spark, [])).collect() == []


def test_clashing_columns(spark):
    table = spark.createDataFrame([(1, 0, "user", "a", "b", "c")], "conv_id long, turn long, role string, text string, key string, output string")
    record = F.to_json(F.struct("role", "text"))
    turns = cf.turn_rows(table.withColumn("record", record), "conv_id", "turn", "record")
    assert cf.digests(turns).collect()[0].n_turns == 1
