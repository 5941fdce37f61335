import hashlib
import time

from pyspark.sql import functions as F

from checks.compare import differences
from skyflow.llm import chat
from skyflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escape(text):
    return text.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")


def brute(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        found.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        text, last = "", None
        for role, said in turns:
            if role == last:
                text = text.removesuffix("</turn>\n") + "<next>" + escape(said) + "</turn>\n"
            else:
                text += f"<turn {escape(role)}>{escape(said)}</turn>\n"
            last = role
        loss = "".join(said for role, said in turns if role == "assistant")
        out[conv] = (text, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text))
    return out


ROWS = [
    (1, 2, "assistant", "a\\b <turn user> </turn>\n"),
    (1, 1, "user", "é🙂"),
    (1, 3, "assistant", None),
    (1, 4, "assistant", "<next>"),
    (1, 5, None, ""),
    (2, None, "system>", "x"),
    (2, 1, "assistant", ""),
    (2, 1, "assistant", ""),
    (2, 1, "ass", "y"),
    (3, 1, "user", "\\l\\g\\b"),
    (4, 1, "assistant", "long " * 50000),
    (None, 1, "user", "no id"),
    *[(5, i, ["user", "assistant"][i // 3 % 2], f"t{i}<") for i in range(3000)],
]


def test_small(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_BLOCKS", 7)
    rows = spark.createDataFrame([(*r, "x") for r in ROWS], "conv_id long, turn long, role string, text string, turns string")
    wanted = brute(ROWS)
    texts = {r.conv_id: r for r in chat.format_conversations(rows).collect()}
    assert {i: r.formatted for i, r in texts.items()} == {i: w[0] for i, w in wanted.items()}
    for conv, row in texts.items():
        said = [t or "" for c, _, r, t in sorted((r for r in ROWS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0)) if r == "assistant"]
        assert [row.formatted[s.start : s.end] for s in row.loss_spans] == [escape(t) for t in said]
    found = {r.conv_id: tuple(r)[1:] for r in chat.report(rows).collect()}
    assert found == {i: w[1:] for i, w in wanted.items()}
    assert chat.report(rows.limit(0)).count() == 0


def test_query(spark):
    df = QUERIES["op6_chat"](spark, SF)
    assert differences(df, ORACLE["op6_chat"], SF) is None
    row = df.filter(F.col("conv_id") == -7).first()
    said = "\\### Assistant: </turn> ok"
    assert row.loss_sha256 == sha(said) and row.turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")


def test_tied_roles_are_sorted_as_they_are(spark):
    rows = [(1, 1, role, "x") for role in ("<a", "Z", "z", "\\", "]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df).select(chat.read_turns(F.col("formatted")).alias("t")).first().t
    assert [t.role for t in formatted] == ["<a", "Z", "\\", "]", "z"]


def test_many_adjacent_turns_of_one_role(spark):
    """More texts in a block than are summed together, and time that grows with their number."""
    rows = spark.range(3 * chat.CHUNK_TEXTS + 5).selectExpr("1L AS conv_id", "id AS turn", "'assistant' AS role", "concat('<é', id) AS text")
    said = "".join(f"<é{i}" for i in range(3 * chat.CHUNK_TEXTS + 5))
    found = chat.report(rows).first()
    assert (found.loss_chars, found.loss_sha256) == (len(said), sha(said))
    seconds = []
    for n in (20_000, 20_000, 100_000):
        many = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "'assistant' AS role", "'short text' AS text")
        began = time.time()
        assert chat.report(many).first().loss_chars == 10 * n
        seconds.append(time.time() - began)
    assert seconds[2] < 20 * max(seconds[1], 1)
