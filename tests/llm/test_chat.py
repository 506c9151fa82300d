import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tabstack.llm import chat
from tabstack.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[/OUT]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "\\", "\\\\", "[", "]", "<", ">", "/", "s>", "INST]", "\n", " ", "a", "é", "😀", "$1", "<\\s>", "[\\\\INST]"]


def run(spark, rows, template=chat.INSTRUCT):
    return chat.format_chats(spark.createDataFrame(rows, SCHEMA), template)


def plain(rows, template=chat.INSTRUCT):
    """The formatted texts and loss texts by string operations alone."""
    pattern = re.compile("|".join(f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})" for c in template.controls()))

    def esc(s):
        return pattern.sub(lambda m: "".join(x or "" for x in m.groups()[: next(k for k, g in enumerate(m.groups()) if g is not None) + 1]) + "\\" +
                           "".join(x or "" for x in m.groups()[next(k for k, g in enumerate(m.groups()) if g is not None) + 1:]), s)
    out = {}
    for c, t, r, x in sorted(rows):
        m = template.turns.get(r)
        one = m.open + esc(x) + m.close if m else template.other.open + esc(r) + template.name_end + esc(x) + template.other.close
        a, b, n = out.get(c, ("", "", 0))
        out[c] = (a + one, b + (x if m and m.loss else ""), n + 1)
    return {c: (template.begin + a + template.end, b, n) for c, (a, b, n) in out.items()}


def test_round_trip_of_nasty_texts(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "[ROLE]", "a[TEXT]", ""]), "".join(rng.choices(NASTY, k=rng.randint(0, 14))))
            for c in range(150) for t in range(rng.randint(1, 6))]
    want = plain(rows)
    out = run(spark, rows).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("masked", chat.loss_text(F.col("segments"))).collect()
    assert len(out) == 150
    for r in out:
        assert (r.formatted, r.masked, len(r.turns)) == want[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in sorted(rows) if x[0] == r.conv_id]
        assert "".join(s.text for s in r.segments) == r.formatted
        for s in r.segments[1:-1][1::3]:
            assert not any(c in s.text for c in chat.INSTRUCT.controls())


def test_machine_checks_the_order(spark):
    orders = {1: "su a u a", 2: "u a u", 3: "a u", 4: "u u", 5: "s", 6: "s u a a u", 7: "t", 8: "u s"}
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    rows = [(c, k, names[x], "x") for c, o in orders.items() for k, x in enumerate(o.replace(" ", ""))]
    got = {r.conv_id: (r.valid, r.n_accepted) for r in run(spark, rows).collect()}
    assert got == {1: (True, 5), 2: (True, 3), 3: (False, 0), 4: (False, 1), 5: (False, 1), 6: (False, 3), 7: (False, 0), 8: (False, 1)}


def test_edge_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (2, None, "user", "first"), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"),
            (None, 0, "user", "p"), (None, 0, "user", "p"), (3, 0, "user", ""), (4, 0, "assistant", "long \\ [INST] " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit("clash")).withColumn("segments", F.lit(1)).withColumn("t", F.lit(2))
    out = chat.format_chats(df)
    back = {}
    for r in out.withColumn("b", chat.read_back(F.col("formatted"))).collect():
        back.setdefault(r.conv_id, []).append([(t.role, t.text) for t in r.b])
    assert back[1] == [[("", "x"), ("assistant", "")]] and back[3] == [[("user", "")]]
    assert back[2] == [[("user", "first"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]]
    assert back[None] == [[("user", "p")], [("user", "p")]] and back[4] == [[("assistant", "long \\ [INST] " * 200_000)]]
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0
    d = {r.conv_id: r for r in chat.digests(out).collect() if r.conv_id}
    assert d[2].loss_sha256 == hashlib.sha256(b"abb").hexdigest() and d[2].loss_chars == 3 and d[3].loss_sha256 == hashlib.sha256(b"").hexdigest()


def test_another_template_and_refused_ones(spark):
    t = chat.Template("{b}", "{e}", {"q": chat.Turn("{q}", "{/q}"), "r": chat.Turn("{r}", "{/r}", loss=True)}, chat.Turn("{o}", "{/o}"), "{:}",
                      {("start", "q"): "q", ("q", "r"): "r"}, final=("r",))
    rows = [(1, 0, "q", "{q}{b}"), (1, 1, "r", "{\\r} {/x}")]
    r = run(spark, rows, t).withColumn("masked", chat.loss_text(F.col("segments"), t)).first()
    assert r.valid and r.formatted == "{b}{q}{\\q}{\\b}{/q}{r}{\\\\r} {/x}{/r}{e}" and r.masked == "{\\r} {/x}"
    with pytest.raises(ValueError):
        chat.Template("<<s>>", "</s>", {"q": chat.Turn("[q]", "[/q]")}, chat.Turn("[o]", "[/o]"), "[:]")
    with pytest.raises(ValueError):
        chat.Template("<s>", "</s>", {"q": chat.Turn("[q]", "[/q]"), "r": chat.Turn("[q]", "[/r]")}, chat.Turn("[o]", "[/o]"), "[:]")


def test_plan_is_native_and_query_reads_all(spark):
    df = QUERIES["op13_chat_formatting"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = {r.conv_id: r for r in df.collect()}
    assert len(got) == rows.select("conv_id").distinct().count() + 1
    own = got[-1]
    text = "</s>[INST] ok [/INST]"
    assert own.n_turns == 2 and own.loss_chars == len(text) and own.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert own.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert own.formatted_chars == 7 + 2 * (len(text) + 3) + 13 + 11
