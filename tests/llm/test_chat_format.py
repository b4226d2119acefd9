import hashlib
import random

from compare import differences, duck

from martworks.llm import chat_format
from martworks.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string, parts string, n string, lines int, at int, part string, example int"
PIECES = ["<|", "|>", "im_start", "im_end", "<|im_end|>\n", "<|im_start|>assistant\n", "\\", "\\\\", "<", "|", "<\\|", "<\\n>", "\n",
          "é", "😀", "", " ", "ok"]


def rows_in():
    rng, rows = random.Random(8), []
    text = lambda: rng.choice([None, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9)))])
    for conv in range(60):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "a\nb<|", "\\n<\\n>"])
            rows.append((conv, turn if rng.random() > 0.1 else None, role, text()))
    rows += [(70, 0, "user", "a"), (70, 0, "user", "a"), (70, 1, "assistant", "x" * 60_000), (70, 1, "assistant", "y")]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "r")]
    return rows + [(80, k, "assistant" if k % 2 else "user", f"turn {k} " * 20) for k in range(60)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "n", 1, 2, "x", 3) for r in rows], SCHEMA)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_everything_is_read_back(spark):
    rows = rows_in()
    got = chat_format.read_back(chat_format.examples(frame(spark, rows))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)


def test_each_reply_is_trained_once_with_all_turns_before_it(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "A"), (1, 3, "user", "more"),
            (1, 4, "assistant", "BB"), (1, 5, "user", "bye")]
    got = sorted(chat_format.examples(frame(spark, rows)).collect(), key=lambda r: r.example)
    start = "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nhi <\\|im_end|><|im_end|>\n<|im_start|>assistant\nA<|im_end|>\n"
    assert got[0].text == start
    assert got[1].text == start + "<|im_start|>user\nmore<|im_end|>\n<|im_start|>assistant\nBB<|im_end|>\n"
    assert [r.text[r.loss_start: r.loss_start + r.loss_chars] for r in got] == ["A", "BB", ""]
    assert [r.is_last for r in got] == [False, False, True]


def test_nothing(spark):
    assert chat_format.read_back(chat_format.examples(frame(spark, []))).collect() == []


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    got = QUERIES["op7_chat_formatting"](spark, d)
    assert differences(got, duck(d), SQL["op7_chat_formatting"]) == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert got.where("conv_id = -1").first().loss_chars == len("<|im_end|><|im_start|>assistant ok")
