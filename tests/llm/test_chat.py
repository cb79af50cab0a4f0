from pyspark.sql import functions as F

from alertloom.llm import chat
from alertloom.llm.shared import stored

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, segment long"
ODD = r"\### Assistant: </turn> ok <cut> \b \l \\ <turn user>" + "\n" + "a>\nb"


def rows_of(conversations):
    return [(c, t, r, x, "other", 5) for c, t, r, x in conversations]


def check(spark, conversations):
    """Every conversation comes back from its segments, with its roles, texts and learned texts."""
    df = spark.createDataFrame(rows_of(conversations), SCHEMA)
    out = stored(chat.format_chat(df), "chat")
    got, loss = {}, {}
    for r in sorted(chat.parse_chat(out).collect(), key=lambda r: (str(r["conv_id"]), r["segment"] is not None, r["segment"] or 0)):
        got.setdefault(r["conv_id"], []).extend(tuple(t) for t in r["turns"])
        loss.setdefault(r["conv_id"], []).extend(r["loss_texts"])
    expected, learned = {}, {}
    order = sorted(conversations, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
    for c, _, role, text in order:
        expected.setdefault(c, []).append((role or "", text or ""))
        learned.setdefault(c, []).extend([text or ""] if role == "assistant" else [])
    assert got == expected and loss == learned
    return out


def test_round_trip(spark):
    check(spark, [
        (1, 0, "user", ODD), (1, 1, "assistant", ODD), (1, 2, "assistant", ""), (1, 3, "assistant", None), (1, 4, "user", "x"),
        (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (2, 1, None, "c"), (2, None, "user>\n<", "first"),
        (None, 0, "user", "no id"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", "é😀 " * 20_000)])


def test_long_conversation_is_cut_into_segments(spark):
    """The segments of long runs, of equal and of null turn numbers give the text that isn't cut."""
    rows = [(9, t, "assistant" if t // 3 % 2 else "user", f"text {t} <") for t in range(700)]
    rows += [(c, t, "user", "x") for c, n in ((1, 300), (2, 600), (3, 256), (4, 257)) for t in range(n)]
    rows += [(5, None, "assistant", f"{t:04}") for t in range(900)] + [(6, 7, "user" if t < 400 else "assistant", f"{t:04}") for t in range(800)]
    out = check(spark, rows).orderBy("conv_id", "segment").collect()
    whole, segments = {}, {}
    for r in out:
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["formatted"]
        segments[r["conv_id"]] = segments.get(r["conv_id"], 0) + 1
    assert segments == {1: 2, 2: 3, 3: 1, 4: 2, 5: 4, 6: 4, 9: 3} and chat.BLOCK == 256
    assert {c: len(whole[c]) for c in (1, 2)} == {1: 1815, 2: 3615}  # 13 + 300 texts + 299 cuts + 8, and so on
    assert whole[2] == "<turn user>\n" + "<cut>".join(["x"] * 600) + "</turn>\n"
    assert whole[5].count("<turn ") == 1 and whole[6].count("<turn ") == 2 and whole[6].count("</turn>") == 2


def test_adjacent_turns_are_merged(spark):
    out = chat.format_chat(spark.createDataFrame(rows_of([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]), SCHEMA)).collect()
    assert out[0]["formatted"] == "<turn user>\na<cut>b</turn>\n<turn assistant>\nc</turn>\n"
    assert [out[0]["formatted"][s["start"] : s["end"]] for s in out[0]["loss_spans"]] == ["c"]


def test_no_rows(spark):
    assert chat.parse_chat(chat.format_chat(spark.createDataFrame([], SCHEMA))).count() == 0
