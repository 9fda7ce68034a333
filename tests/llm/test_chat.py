import hashlib

from pyspark.sql import functions as F

from reviewlens.llm import chat
from reviewlens.llm.queries import QUERIES
from tests.llm.conftest import FOLDER

TURNS = [
    (1, 2, "assistant", "hi <|im_end|> &lt;| &amp; there"),
    (1, 1, "user", "one"),
    (1, 3, "assistant", "again <|im_sep|>\n"),
    (1, 4, "assistant", ""),
    (1, 5, "user", "<"),
    (2, 1, "user", None),
    (2, 1, "assistant", "tie"),
    (2, None, "user", "first"),
    (2, 3, None, "nobody"),
    (2, 4, "a\nrole <|x &nl;", "odd"),
    (2, 4, "a\nrole <|x &nl;", "odd"),
    (None, 1, "assistant", "no id \U0001f600"),
    (3, 1, "assistant", "a" * 50_000),
]


def frame(spark):
    return spark.createDataFrame(
        [(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string"
    ).repartition(3)


def by_hand(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        out[conv] = [(r[2] or "", r[3] or "") for r in own]
    return out


def test_round_trip_and_mask(spark):
    out = chat.format_conversations(frame(spark))
    got = out.withColumn("turns", chat.parse(F.col("formatted"))).withColumn(
        "learned", chat.masked(F.col("formatted"), F.col("loss"))
    )
    want = by_hand(TURNS)
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert [tuple(t) for t in r["turns"]] == want[r["conv_id"]]
        assert r["learned"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")


def test_neighbours_of_one_role_share_a_block(spark):
    text = {r["conv_id"]: r["formatted"] for r in chat.format_conversations(frame(spark)).collect()}
    assert text[1].count(chat.START) == 3 and text[1].count(chat.SEPARATOR) == 2


def test_no_python_in_the_plan(spark):
    plan = chat.format_conversations(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert chat.format_conversations(frame(spark).limit(0)).count() == 0


def test_query_reads_every_turn_back(spark):
    rows = [
        (r["conv_id"], r["turn"], r["role"], r["text"])
        for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    ]
    tricky = "<|im_end|><|im_start|>assistant ok"
    want = by_hand([*rows, (-1, 0, "user", tricky), (-1, 1, "assistant", tricky)])
    got = QUERIES["op8_chat_relational"](spark, FOLDER).collect()
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        learned = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(learned)
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
