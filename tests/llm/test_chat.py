import hashlib

from hypothesis import given
from hypothesis import strategies as st

from mentionkit.llm import chat

COLUMNS = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "be \\ nice"), (1, 1, "user", "a<|im_end|>b"), (1, 2, "assistant", "c é𝒳\n"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (1, 5, "assistant", "[INST] \\<|im_sep|> <<SYS>> \\\\</s>"), (2, 0, "user", "only a question"), (3, None, None, None),
    (4, 1, "assistant", "twice"), (4, 1, "assistant", "twice"), (None, 0, "assistant", "no id"), (5, 0, "a<|im_sep|>\nb", "x" * 100_000),
]


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        replies = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), said, len(replies), hashlib.sha256(replies.encode()).hexdigest())
    return out


def test_report_against_plain_version(spark):
    rows = chat.chat_report(spark.createDataFrame([(*r, 1) for r in ROWS], COLUMNS + ", piece int")).collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}
    assert got == plain(ROWS + [tuple(r) for r in chat.CONTROL_CHECK])


def test_examples_hold_their_context_and_one_reply(spark):
    pieces = chat.formatted(spark.createDataFrame(ROWS, COLUMNS)).cache()
    rows = chat.example_texts(pieces).where("conv_id = 1").orderBy("target_seq").collect()
    assert [r["target_seq"] for r in rows] == [3, 5, 6]
    turns = [(r or "", x or "") for c, _, r, x in ROWS if c == 1]
    for r, upto in zip(rows, (3, 5, 6)):
        found = chat._PIECE.pattern
        assert chat.unescaped(r["text"][r["loss_start"] : r["loss_end"]]) == turns[upto - 1][1]
        parts = r["text"].split(chat.END)[:-1]
        assert [tuple(map(chat.unescaped, p.removeprefix(chat.START).split(chat.SEP))) for p in parts] == turns[:upto], found


@given(st.lists(st.sampled_from(list("\\<|>imstardenp_[]/INSTY") + ["<|im_end|>", "</s>", "[/INST]", "é"]), max_size=60))
def test_escapes_can_be_undone(parts):
    text = "".join(parts)
    out = text.replace("\\", "\\\\")
    for c in chat.CONTROL:
        out = out.replace(c, c[0] + "\\" + c[1:])
    assert chat.unescaped(out) == text
    assert not any(c in out for c in chat.CONTROL)


def test_empty_table_holds_the_control_check(spark):
    assert [r["conv_id"] for r in chat.chat_report(spark.createDataFrame([], COLUMNS)).collect()] == [-7]


def test_long_conversation_is_read_in_batches(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(5000)]
    got = chat.chat_report(spark.createDataFrame(rows, COLUMNS).repartition(7)).where("conv_id = 1").first()
    assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == plain(rows)[1]


def test_ids_stay_whole_beside_null(spark):
    rows = [(2**60 + 1, 0, "user", "a"), (None, 0, "user", "b"), (2**60 + 3, 0, "assistant", "c")]
    got = {r["conv_id"]: r["n_examples"] for r in chat.chat_report(spark.createDataFrame(rows, COLUMNS).coalesce(1)).collect()}
    assert got == {2**60 + 1: 0, None: 0, 2**60 + 3: 1, -7: 1}


def test_report_reads_the_loss_from_example_rows(spark):
    pieces = chat.formatted(spark.createDataFrame(ROWS, COLUMNS))
    found = chat.examples(pieces)
    assert found.count() == sum(r[2] == "assistant" for r in ROWS)
    none = {r["conv_id"]: (r["n_examples"], r["loss_chars"]) for r in chat.summaries(pieces, found.where("false")).collect()}
    assert set(none.values()) == {(0, 0)}
