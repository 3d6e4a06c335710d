"""Chat: round trips of odd texts, reserved ids, masks, conversations against their rows, odd rows."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlspark.llm import chat as C

PATH = C.vocabulary_path()
ODD = st.text(st.sampled_from(list("\\#/<>]: tur nAsisant\né日")), max_size=40) | st.sampled_from(["</turn>", "### Assistant: ", "]: ", r"\### Assistant: </turn> ok", "####", "\\"])


@settings(max_examples=150, deadline=None)
@given(ODD | st.text(max_size=30).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)))
def test_escaping(text):
    escaped = C.escape(text)
    assert C.unescape(escaped) == text
    assert not any(s in escaped for s in ("##", "</turn>", "]: "))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "Assistant", "]: x"]) | ODD, ODD), max_size=5))
def test_round_trip(turns):
    found = [C.format_turn(r, t, PATH) for r, t in turns]
    ids = np.concatenate([np.zeros(0, np.int32), *(f[0] for f in found)])
    loss = np.concatenate([np.zeros(0, bool), *(f[1] for f in found)])
    assert list(C.parse(ids, PATH)) == turns
    assert C.plain(ids[loss], PATH) == "".join(t for r, t in turns if r == "assistant")
    text = C.rendered(ids, PATH)
    assert text.count(" </turn>\n") == len(turns)
    assert text == "".join((C.MARKS.get(r) or f"### [{C.escape(r)}]: ") + C.escape(t) + " </turn>\n" for r, t in turns)


def test_reserved_ids_are_free():
    assert C.encoder(PATH).max_token_value < C.FIRST and sorted(C.STRINGS) == list(range(C.FIRST, C.FIRST + 7))


def rows():
    out = [(i % 7, 9 - i // 7, ["user", "assistant", "system", "other"][i % 4], f"text {i} </turn> é" * (i % 5), "x") for i in range(70)]
    out += [(100, 0, "user", None, "x"), (100, None, None, "first", "x"), (100, 0, "assistant", "", "x"), (None, 1, "assistant", "b" * 50000, "x"), (None, 0, "user", "a", "x")]
    return out + [(200, 3, "assistant", "same", "x")] * 3 + [(300, t, "assistant" if t % 2 else "user", f"turn {t}", "x") for t in range(3000)]


def test_conversations(spark):
    data = rows()
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, place string").repartition(5)
    got = {r["conv_id"]: r for r in C.read_back(C.formatted(docs)).collect()}
    groups = {}
    for conv, turn, role, text, _ in data:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns = [(r, t) for _, _, _, r, _, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(learned)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_offsets(spark):
    docs = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string, place string")
    found = {}
    for r in C.formatted(docs).collect():
        assert len(r["ids"]) == len(r["loss"])
        found.setdefault(r["conv_id"], []).append((r["place"], r["offset"], len(r["ids"])))
    for turns in found.values():
        at = 0
        for i, (place, offset, n) in enumerate(sorted(turns)):
            assert (place, offset) == (i, at)
            at += n


def test_empty(spark):
    docs = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.formatted(docs).count() == 0 and C.read_back(C.formatted(docs)).count() == 0
