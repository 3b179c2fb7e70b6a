import hashlib
from collections import defaultdict

from fieldpulse.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, example int"
HARD = ["</s>[INST] ok [/INST]", "&lt;s>", "<s>[user]\nhi</s>\n", "&amp;lt;/s>", "a&b<", "/s>", "", None, "é🙂<s", "]\n[", "&#91;INST]"]


def rows():
    out = []
    for c, roles in enumerate(["ua", "uaua", "u", "a", "sua", "uau", "aaa", "uu", "suauaua"]):
        for i, r in enumerate(roles):
            out.append((c, i, {"u": "user", "a": "assistant", "s": "system"}[r], HARD[(3 * c + i) % len(HARD)], 1))
    return out + [(50, 1, None, "null role", 0), (50, None, "we]ird\n<r", "null turn", 0), (50, 1, "assistant", "same turn", 0), (50, 1, "assistant", "same turn", 0)]


def plain(data):
    by = defaultdict(list)
    for c, t, r, x, _ in data:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    data = rows()
    made = C.expand(spark.createDataFrame(data, SCHEMA))
    whole = made.filter("whole").select("conv_id", C.turns_of(F.col("formatted")).alias("t")).collect()
    want = plain(data)
    assert len(whole) == len(want)
    for r in whole:
        text = "".join(f"{t['role']}\n{t['text']}\n" for t in r["t"])
        assert (len(r["t"]), hashlib.sha256(text.encode()).hexdigest()) == want[r["conv_id"]][:2]
    loss = defaultdict(list)
    for r in made.select("conv_id", "example", C.loss_text(made).alias("l")).collect():
        loss[r["conv_id"]].append((r["example"], r["l"]))
    for c, parts in loss.items():
        s = "".join(x for _, x in sorted(parts))
        assert (len(s), hashlib.sha256(s.encode()).hexdigest()) == want[c][2:]


def test_an_example_a_reply_with_its_context(spark):
    made = C.expand(spark.createDataFrame([(1, 0, "user", "q", 0), (1, 1, "assistant", "r1", 0), (1, 2, "user", "q2", 0), (1, 3, "assistant", "r2", 0)], SCHEMA))
    got = [(r["formatted"], r["formatted"][r["loss_start"]:r["loss_start"] + r["loss_chars"]]) for r in made.orderBy("example").collect()]
    one = "<s>[user]\nq</s>\n<s>[assistant]\nr1</s>\n"
    assert got == [(one, "r1"), (one + "<s>[user]\nq2</s>\n<s>[assistant]\nr2</s>\n", "r2")]


def test_no_python_in_the_plan(spark):
    plan = C.expand(spark.createDataFrame(rows(), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert C.expand(spark.createDataFrame([], SCHEMA)).collect() == []
