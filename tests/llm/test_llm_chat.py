import hashlib

import pytest
from llm_frames import empty

from tablewright.llm import chat

TURN = "conv_id long, turn long, role string, text string, kind string, seq string"
EVENT = "conv_id long, seq long, message_id string, part int, kind string, role string, text string, extra string"
ODD = ["", None, "</s>[INST] ok [/INST]", "<s>user\n", "\\l \\\\ <", "a\nb\n", "é😀<|x|>", "x" * 50_000]


def test_content_never_makes_control_strings():
    for role in ("user", "assistant", "", "a\nb<s>\\"):
        messages = [(role, text or "") for text in ODD]
        formatted, spans = chat.render(messages)
        assert formatted.count(chat.OPEN) == formatted.count(chat.CLOSE) == len(messages)
        assert chat.parse(formatted) == messages
        learned = [chat.unescape(formatted[s["start"] : s["end"]]) for s in spans]
        assert learned == ([text for _, text in messages] if role == "assistant" else [])


def test_folding_events(spark):
    rows = [
        (1, 1, "m1", 0, "message", "user", "Hi", ""), (1, 2, "m2", 0, "delta", "assistant", "Hel", ""), (1, 3, "m2", 0, "delta", None, "lo", ""),
        (1, 4, "m1", 0, "edit", None, "Hi there", ""), (1, 5, "m2", 0, "regenerate", None, "dropped", ""), (1, 6, "m2", 0, None, None, "Good ", ""),
        (1, 7, "m2", 1, "delta", None, "day", ""), (1, 7, "m2", 0, "delta", None, "old ", ""), (2, None, "a", 0, "message", None, None, ""),
        (None, 1, "z", 0, "message", "system", "s", ""),
    ]
    got = {r.conv_id: chat.parse(r.formatted) for r in chat.format_events(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == {1: [("user", "Hi there"), ("assistant", "Good old day")], 2: [("", "")], None: [("system", "s")]}


def test_unknown_events_are_refused(spark):
    rows = [(1, 1, "m", 0, "delete", "user", "x", "")]
    with pytest.raises(Exception, match="unknown kind"):
        chat.format_events(spark.createDataFrame(rows, EVENT)).collect()


def test_turns_come_back(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", text, "k", "s") for c in (1, 2, None) for t, text in enumerate(ODD)]
    rows += [(1, 3, "user", "again", "k", "s")] * 2 + [(3, None, None, "first", "k", "s"), (3, 0, "assistant", "second", "k", "s")]
    done = chat.digests(chat.format_events(chat.turns_as_events(spark.createDataFrame(rows, TURN).repartition(5))))
    got = {r.conv_id: r for r in done.collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in mine)
        loss = "".join(text for _, _, role, text in mine if role == "assistant")
        r = got[conv]
        if conv != 1:  # turns of one number stand by role and a hash of the text
            assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(mine), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_a_text_said_again_is_a_turn_of_its_own(spark):
    said = {
        1: [(0, "user", "ok"), (1, "assistant", "Sure."), (2, "user", "ok"), (3, "assistant", "Sure.")],
        2: [(None, "user", "ok"), (0, "user", "ok"), (1, "assistant", None), (2, "user", "ok"), (3, "assistant", ""), (4, None, None), (5, None, "")],
        3: [(0, "assistant", "Sure."), (0, "assistant", "Sure."), (1, "assistant", "Sure.")],
    }
    rows = [(conv, *turn, "k", "s") for conv, turns in said.items() for turn in turns]
    events = chat.format_events(chat.turns_as_events(spark.createDataFrame(rows, TURN).repartition(5)))
    got = {r.conv_id: r for r in events.join(chat.digests(events).drop("formatted"), "conv_id").collect()}
    for conv, turns in said.items():
        r, mine = got[conv], [(role or "", text or "") for _, role, text in turns]
        assert chat.parse(r.formatted) == mine
        loss = "".join(text for role, text in mine if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(mine), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in mine).encode()).hexdigest()
        assert r.formatted_chars == len(r.formatted)


def test_empty_table(spark):
    assert chat.digests(chat.format_events(chat.turns_as_events(empty(spark, TURN)))).count() == 0
