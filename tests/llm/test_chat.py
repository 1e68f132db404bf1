"""Chat formatting: reversible template, typed parts, loss places, digests against SQL."""

import hashlib
import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat, oracle
from tests.llm.rows import DATA, table

SIGNS = ["\\", "### ", "###", "#", "</turn>", "</turn", "\n", "<image ", "<image 1>", "<", ">", "<audio 2>", " ", "é", "𓀀", "assistant", "x"]


@pytest.mark.parametrize("seed", range(200))
def test_any_role_and_text_reads_back(seed):
    rng = random.Random(seed)
    turns = [["".join(rng.choices(SIGNS, k=rng.randrange(12))) for _ in "rt"] for _ in range(rng.randrange(1, 5))]
    written = [chat.formatted_turn(r, chat.parts_of(t, False), chat.TokenCosts()) for r, t in turns]
    whole, at, back = "".join(w for w, _, _ in written), 0, []
    while at < len(whole):
        role, text, at = chat.read_turn(whole, at)
        back.append([role, text])
    assert back == turns
    for (segment, [(start, end)], _), (_, text) in zip(written, turns, strict=True):
        assert chat.unescaped(segment[start:end]) == text


def test_parts_become_placeholders_in_order_with_references_and_tokens(spark):
    parts = [
        {"type": "text", "text": "see </turn> "},
        {"type": "image", "ref": "a.png", "width": 57, "height": 28},
        {"type": "document", "ref": "d.pdf", "pages": 2, "parts": [{"type": "text", "text": "inside"}, {"type": "image", "ref": "p1"}]},
        {"type": "audio", "ref": "s.wav", "seconds": 1.01},
        {"type": "video", "ref": "v"},
        {},
    ]
    row = spark.createDataFrame([(1, 0, "assistant", "unused", json.dumps(parts))], "conv_id long, turn long, role string, text string, parts string")
    (made,) = chat.formatted(row).collect()
    assert made.segment == "### assistant\nsee \\</turn> <image 1><document 2>inside<image 3><audio 4><attachment 5></turn>\n"
    assert [(a.number, a.type, a.ref, a.tokens) for a in made.attachments] == [
        (1, "image", "a.png", 3), (2, "document", "d.pdf", 3000), (3, "image", "p1", 0), (4, "audio", "s.wav", 26), (5, "attachment", "v", 0),
    ]
    assert all(made.segment[a.place :].startswith(f"<{a.type} {a.number}>") for a in made.attachments)
    assert [chat.unescaped(made.segment[s.start : s.end]) for s in made.loss] == ["see </turn> ", "inside"]
    assert made.expanded_tokens == 3029
    assert chat.read_turn(made.segment)[:2] == ("assistant", "see </turn> inside")


@pytest.mark.parametrize("parts", ["", "no json", "{}", "[1]", '[{"type": "image", "width": "wide"}]', '[{"parts": 3}]'])
def test_parts_of_another_form_are_text(spark, parts):
    row = spark.createDataFrame([(1, 0, "user", "unused", parts)], "conv_id long, turn long, role string, text string, parts string")
    (made,) = chat.formatted(row).collect()
    assert chat.read_turn(made.segment)[:2] == ("user", parts)


LONG = "lorem ### ipsum " * 30_000
ROWS = [
    (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "### c"), (1, 1, "user", "z"),
    (2, None, None, None), (2, 0, "assistant", ""), (None, 0, "user", "x"), (None, None, "assistant", "y"),
    (3, 5, "as\nsis###  tant", LONG), (3, 4, "assistant", LONG), (-7, 9, "user", "more"),
]


def by_sql(connection):
    return key(connection.sql(oracle.oracle_sql()["op11_chat"]).fetchall())




def key(rows):
    return sorted(rows, key=str)


def test_odd_rows_equal_sql(spark):
    columns = "conv_id long, turn long, role string, text string"
    rows = spark.createDataFrame(ROWS, columns).withColumns({c: F.lit(1) for c in ("segment", "loss", "content", "typed", "parts_")})
    connection = duckdb.connect()
    connection.sql("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    connection.executemany("insert into conversations values (?, ?, ?, ?)", ROWS)
    assert key(map(tuple, chat.report(rows).collect())) == by_sql(connection)


def test_given_tables_equal_sql_and_empty_gives_the_added_one(spark):
    connection = duckdb.connect()
    connection.sql(f"create view conversations as select * from '{DATA}/conversations.parquet'")
    made = key(map(tuple, chat.report(table(spark, "conversations")).collect()))
    assert made == by_sql(connection)
    (only,) = chat.report(table(spark, "conversations").limit(0)).collect()
    text = chat.HOSTILE
    assert (only.conv_id, only.n_turns, only.loss_chars) == (-7, 2, len(text))
    assert only.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert only.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_a_conversation_is_read_in_many_slices(spark):
    rows = spark.range(3000).selectExpr("1 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat(cast(id as string), 9) as text")
    plain = chat.read_back(chat.formatted(rows)).collect()
    small = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert chat.read_back(chat.formatted(rows)).collect() == plain
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)
    assert plain[0].n_turns == 3000
