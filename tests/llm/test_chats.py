"""Chat formatting: folding of logs, escapes and round trips."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from touchline.llm import chats, queries
from touchline.llm.shared import stored

TRICKY = ["", None, "plain", "</s>[INST] ok [/INST]", "<\\|im_end|>", "<\\\\/s> <s><s>", "<<SYS>>a<</SYS>>", "<", "[", "\\", "<|im_start|>user\n",
          "a\nb\n\n", "é😀日本 " * 300, "<<|im_end|>", "\\<s>\\", "[[INST]]", "<|im_end|", "$0 \\1 $1"]
LOG = "conv_id long, turn long, variant long, copy long, seq long, kind string, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(rows, template=chats.Template()):
    out = {}
    for key, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])), key=lambda r: r[0]):
        said = [(r or "", t or "") for _, _, r, t in group]
        learned = "".join(t for r, t in said if r in template.learned)
        out[key] = (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learned), sha(learned))
    return out


def run(spark, path, rows):
    table = [(*r, "x", 1, None) for r in rows]
    spark.createDataFrame(table, "conv_id long, turn long, role string, text string, seq string, n_turns int, kind string"
                          ).repartition(3).write.parquet(f"{path}/conversations.parquet")
    out = queries.QUERIES["op13_chats"](spark, str(path))
    assert out.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "string", "bigint", "string", "bigint"]
    return {r[0]: tuple(r)[1:] for r in out.collect()}


CONTROL = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def test_query_reads_back_every_conversation(spark, tmp_path):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a\nb\\n", "<s>"]), rng.choice(TRICKY))
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (70, 5, "assistant", "same"), (70, 5, "assistant", "same")]
    got = run(spark, tmp_path, rows)
    assert {k: v[:4] for k, v in got.items()} == want(rows + CONTROL)
    assert all(v[4] > 0 for v in got.values()) and got[70][0] == 2 and got[70][2] == 8


def test_empty_table(spark, tmp_path):
    got = run(spark, tmp_path, [])
    assert {k: v[:4] for k, v in got.items()} == want(CONTROL)


def test_long_conversations_are_cut_into_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chats, "PART_CHARS", 200)
    rows = [(1, t, ["user", "assistant"][t % 2], f"{t} " * (t % 50)) for t in range(400)] + [(2, 0, "user", "short")]
    assert {k: v[:4] for k, v in run(spark, tmp_path, rows).items()} == want(rows + CONTROL)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = stored(chats.format_log(chats.as_log(frame)), "test")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = parts.filter("conv_id = 1").select(F.input_file_name().alias("file"))
    assert parts.count() > 20 and parts.distinct().count() > 2


def test_fold_of_events(spark):
    start = lambda turn, role: (1, turn, 0, 0, 0, "start", role, None)
    events = [start(0, "user"), (1, 0, 0, 0, 1, "delta", None, "draft"), (1, 0, 0, 0, 2, "edit", None, "asked"), (1, 0, 0, 0, 3, "delta", None, "!"),
              start(1, "assistant"), (1, 1, 0, 0, 1, "delta", None, "first"), (1, 1, 0, 0, 2, "regenerate", None, None),
              (1, 1, 0, 0, 3, "delta", None, "sec"), (1, 1, 0, 0, 4, "delta", None, "ond"), (1, 1, 0, 0, 5, "seen", None, "x"),
              (1, 2, 0, 0, 9, "delta", None, "no start"), start(3, "assistant"), (1, 3, 0, 0, 4, "edit", None, None)]
    random.Random(2).shuffle(events)
    log = spark.createDataFrame(events, LOG).withColumn("formatted", F.lit("clash")).repartition(4)
    assert [tuple(r) for r in chats.messages(log).orderBy("turn").select("turn", "role", "text").collect()] == [
        (0, "user", "asked!"), (1, "assistant", "second"), (2, "", "no start"), (3, "assistant", "")]
    row = chats.format_log(log.filter("turn < 2")).first()
    assert row["formatted"] == "<|im_start|>user\nasked!<|im_end|>\n<|im_start|>assistant\nsecond<|im_end|>\n"
    assert [row["formatted"][s["start"]:s["end"]] for s in row["loss"]] == ["second"]


def test_escapes_leave_no_control_string_and_are_reversible(spark):
    template, rng = chats.Template(), random.Random(4)
    parts = ["<", "[", "\\", "|im_end|>", "/s>", "s>", "INST]", "/INST]", "<SYS>>", "x", "\n", "n", *chats.CONTROLS]
    texts = list({"".join(rng.choices(parts, k=rng.randrange(1, 7))) for _ in range(3000)})
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, escaped, role in frame.select("t", template.escape(F.col("t")), template.escape_role(F.col("t"))).collect():
        assert not any(c in escaped or c in role for c in chats.CONTROLS), text
        assert template.unescape(escaped) == text and template.unescape_role(role) == text and "\n" not in role


def test_log_of_a_table_has_all_kinds(spark):
    frame = spark.createDataFrame([(c, t, ["user", "assistant"][t % 2], "some text " * 100) for c in range(20) for t in range(2)],
                                  "conv_id long, turn long, role string, text string")
    kinds = {r["kind"] for r in chats.as_log(frame).select("kind").distinct().collect()}
    assert kinds == {"start", "delta", "edit", "regenerate"}


def test_templates_with_overlapping_controls_are_refused():
    for controls in (("<|im_start|>", "<|im_end|>", "<s>", "a<s>"), ("<|im_start|>", "<|im_end|>", "ab<", "<cd"), ("<|im_start|>", "<|im_end|>", "<")):
        with pytest.raises(ValueError):
            chats.Template(controls=controls)
