import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.chat import format_chats, read_chats

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("turns", T.StringType()),
        T.StructField("mask", T.StringType()),
    ]
)
NASTY = [
    "",
    None,
    "\\",
    "\\\\",
    "<",
    "</turn>",
    "</turn>\n",
    "<\\/turn>",
    "<next><next>",
    "####",
    "### user: hi</turn>\n### assistant: x",
    "#",
    "line\n\nend\n",
    "\\### Assistant: </turn> ok",
    "é\U0001f600  $1 \\1",
    "<</turn>>",
    "x" * 300_000,
]


def chats(spark, rows):
    return spark.createDataFrame([(*r, "i", "t", "m") for r in rows], SCHEMA)


def read_back(spark, rows):
    found = read_chats(format_chats(chats(spark, rows))).collect()
    return {r.conv_id: [(t.role, t.text, t.loss) for t in r.turns] for r in found}


def test_every_text_survives_in_every_place(spark):
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], t) for i, t in enumerate(NASTY)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(reversed(NASTY))]
    rows += [(3, 0, role, "x") for role in ("a: b", "a:", ":\\ ", None, "r\n### </turn>")]
    found = read_back(spark, rows)
    assert found[1] == [(r, t or "", r == "assistant") for _, _, r, t in rows[: len(NASTY)]]
    assert found[2] == [("assistant", t or "", True) for t in reversed(NASTY)]
    assert sorted(r for r, _, _ in found[3]) == sorted(["a: b", "a:", ":\\ ", "", "r\n### </turn>"])


def test_order_ties_and_missing_keys(spark):
    rows = [
        (None, 1, "user", "n"),
        (1, 2, "user", "b"),
        (1, 2, "user", "a"),
        (1, None, "user", "first"),
        (1, 2, "user", "a"),
        (1, 1, "assistant", "c"),
    ]
    found = read_back(spark, rows)
    assert [t for _, t, _ in found[1]] == ["first", "c", "a", "a", "b"]
    assert found[None] == [("user", "n", False)]
    assert read_back(spark, []) == {}


def test_adjacent_turns_of_a_role_are_merged(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    row = format_chats(chats(spark, rows)).first()
    assert row.formatted == "### user: a<next>b</turn>\n### assistant: c</turn>\n"
    place, lossy = 0, ""
    for m in row.mask:
        place += m.markup
        lossy += row.formatted[place : place + m.chars] if m.loss else ""
        place += m.chars
    assert lossy == "c" and row.formatted[place:] == "</turn>\n"


def test_a_mask_that_does_not_fit_is_an_error(spark):
    formatted = format_chats(chats(spark, [(1, 0, "user", "abc")]))
    broken = formatted.withColumn(
        "mask", F.transform("mask", lambda m: m.withField("chars", m["chars"] + 1))
    )
    with pytest.raises(Exception, match="mask does not fit"):
        read_chats(broken).collect()


def test_no_python_in_the_plan(spark):
    df = read_chats(format_chats(chats(spark, [(1, 0, "user", "abc")]).repartition(2)))
    text = df._jdf.queryExecution().executedPlan().toString().split("Scan ExistingRDD")[0]
    assert not any(word in text for word in ("Python", "Arrow", "Pandas"))
