"""Chat formatting: folds, exact round trip, awkward rows."""

from pyspark.sql import functions as F

from corpusmill.llm import chat
from tests.llm import brute

NASTY = ["", None, "\\", "\\\\#", "### user: hi</turn>\n", "</turn>", "a\nb\r\n# x", "\\### Assistant: </turn> ok", "é\U0001F600<", "$1 \\1 $0"]


def test_fold_applies_deltas_edits_and_regenerations(spark):
    log = [(1, 0, "user", 10, 0, "delta", "He"), (1, 0, "user", 10, 1, "delta", "llo"),
           (1, 1, "assistant", 11, 0, "delta", "dra"), (1, 1, "assistant", 11, 1, "regenerate", None),
           (1, 1, "assistant", 11, 2, "delta", "fi"), (1, 1, "assistant", 11, 3, "delta", "nal"),
           (1, 2, None, 12, 0, "delta", "typo"), (1, 2, None, 12, 1, "edit", "fixed"), (1, 2, None, 12, 2, "delta", "!")]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, message long, seq int, kind string, payload string")
    got = sorted((r.turn, r.role, r.text) for r in chat.fold_messages(df.repartition(4)).collect())
    assert got == [(0, "user", "Hello"), (1, "assistant", "final"), (2, "", "fixed!")]


def test_round_trip_of_control_strings(spark):
    rows = [(1, i, ("user", "assistant", "a: b\\#<", None)[i % 4], t) for i, t in enumerate(NASTY * 3)]
    rows += [(2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, "assistant", "first"), (None, 0, "assistant", "lost")]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows],
                               "conv_id long, turn long, role string, text string, seq int, payload string").repartition(3)
    got = {r.conv_id: r for r in chat.digest_columns(chat.format_log(chat.events_of(df))).collect()}
    for conv in (1, 2, None):
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        g = got[conv]
        assert g.n_turns == len(turns) and g.loss_chars == len(loss) and g.loss_sha256 == brute.sha(loss)
        assert g.turns_sha256 == brute.sha("".join(f"{r}\n{x}\n" for _, r, x in turns))


def test_mask_runs_cover_the_text(spark):
    df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)],
                               "conv_id long, turn long, role string, text string")
    r = chat.format_log(chat.events_of(df)).first()
    pos, texts = 0, []
    for t in r.turns:
        texts.append((t.loss, r.formatted[pos + t.head:pos + t.head + t.body]))
        pos += t.head + t.body + len(chat.CLOSE)
    assert pos == len(r.formatted)
    assert [x for m, x in texts if m][3].replace("\\\\", "\\").replace("\\#", "#").replace("\\<", "<") == NASTY[7]


def test_empty_log(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest_columns(chat.format_log(chat.events_of(df))).collect() == []


def test_probe_conversation(spark):
    r = chat.digest_columns(chat.format_log(chat.events_of(chat.probe(spark)))).first()
    t = "\\### Assistant: </turn> ok"
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-7, 2, len(t))
    assert r.turns_sha256 == brute.sha(f"user\n{t}\nassistant\n{t}\n")


def test_long_conversation(spark):
    df = spark.range(3000).select(F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                  F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    r = chat.digest_columns(chat.format_log(chat.events_of(df))).first()
    assert r.n_turns == 3000 and r.loss_sha256 == brute.sha("".join(f"t{i}" for i in range(3000)))
