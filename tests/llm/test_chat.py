import hashlib

from pyspark.sql import functions as F
from tallybrook.llm import chat

LOG = "conversation long, seq long, message long, kind string, role string, text string"
ROWS = "conv_id long, turn long, role string, text string"


def test_fold(llm_spark):
    log = llm_spark.createDataFrame(
        [
            (1, 0, 1, "open", "user", None),
            (1, 2, 1, "delta", None, "lo"),
            (1, 1, 1, "delta", None, "hel"),
            (1, 3, 2, "open", "assistant", None),
            (1, 4, 2, "delta", None, "bad draft"),
            (1, 6, 2, "regenerate", None, None),
            (1, 7, 2, "delta", None, "good "),
            (1, 9, 2, "delta", None, "answer"),
            (1, 10, 3, "open", "user", None),
            (1, 11, 3, "delta", None, "oops"),
            (1, 12, 3, "delete", None, None),
            (1, 13, 1, "edit", None, "hello"),
            (1, 14, 1, "delta", None, " there"),
            (2, 0, 1, "delta", None, "no open"),
            (None, 0, 1, "open", None, None),
        ],
        LOG,
    ).repartition(4)
    found = {(r.conversation, r.position): (r.role, r.text) for r in chat.fold(log).collect()}
    assert found == {(1, 0): ("user", "hello there"), (1, 3): ("assistant", "good answer"), (2, 0): ("", "no open"), (None, 0): ("", "")}


def brute(rows):
    grouped = {}
    for conv, turn, role, text in rows:
        grouped.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in grouped.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        yield conv, (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_digests_of_odd_texts(llm_spark, none):
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    rows += [(1, 0, None, "a\\h####\\\\t </tu"), (1, 0, "odd\\n\n:x\\", None), (1, 3, "assistant", "\\"), (1, 3, "assistant", "\\")]
    rows += [(2, 5, "assistant", "</turn>\n### User:\n</turn"), (2, 5, "assistant", ""), (2, 6, "Assistant", "é" * 9), (2, -1, "@x", "###\\###")]
    rows += [(None, 0, "user", "x"), (3, None, "user", "y"), (4, 0, "assistant", "z" * 50_000)]
    formatted = chat.render(chat.fold(chat.log_of(llm_spark.createDataFrame(rows, ROWS).repartition(3)))).cache()
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
    rows[-3] = (None, 0, "user", "x")
    assert found == dict(brute([(c, -9 if t is None else t, r, x) for c, t, r, x in rows]))
    # Control strings of the template come from the template only.
    one = formatted.where("conversation = -7").first().formatted
    assert one.count("</turn>") == 2 and one.count("###") == 2
    assert chat.digests(chat.render(chat.fold(chat.log_of(llm_spark.createDataFrame([], ROWS))))).collect() == []


def test_no_python_in_the_plan(llm_spark):
    rows = llm_spark.createDataFrame([(1, 0, "user", "x")], ROWS)
    plan = chat.digests(chat.render(chat.fold(chat.log_of(rows))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_escapes_are_undone(llm_spark):
    texts = ["\\", "\\\\", "\\h", "\\\\h", "###", "#\\##", "</turn>\\t", "\\\\\\###", ""]
    rows = llm_spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows.where(chat.unescape(chat.escape(F.col("t"))) != F.col("t")).count() == 0
