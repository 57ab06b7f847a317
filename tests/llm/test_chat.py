"""Chat formatting: exact round trips, the machine's order, edges."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricewright.llm import chat

SHAPE = "conv_id long, turn long, role string, text string"
NASTY = ["\\", "\\\\", "#", "##", "###", "####", "</turn>", "</tur</turn>", "n>", "\\h", "\\b", "\\bh", "\\t", ": ", ":", "\n", "</turn>\n### user: ",
         "\\### Assistant: </turn> ok", "é😀", ""]


def back(spark, rows):
    out = chat.format_chat(spark.createDataFrame(rows, SHAPE))
    text = chat.formatted()
    return {r["conv_id"]: r for r in out.select("conv_id", "valid", "first_bad_turn", text.alias("text"), chat.trained().alias("trained"),
                                                chat.read_back(text).alias("turns")).collect()}


def test_round_trip_of_control_strings(spark):
    """Every pair of awkward pieces, as roles and as texts."""
    rows, want = [], {}
    for k, a in enumerate(NASTY):
        for j, b in enumerate(NASTY):
            c = k * len(NASTY) + j
            want[c] = [("user", a + b), (b + a, a), ("assistant", b + a)]
            rows += [(c, n, role, text) for n, (role, text) in enumerate(want[c])]
    got = back(spark, rows)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert got[c]["trained"] == "".join(t for r, t in turns if r == "assistant")


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]),
                                   st.text(alphabet="\\#</turn>:\n bhtcé", max_size=30)), min_size=1, max_size=8), min_size=1, max_size=20))
def test_any_conversation_comes_back(spark, convs):
    got = back(spark, [(c, n, role, text) for c, turns in enumerate(convs) for n, (role, text) in enumerate(turns)])
    for c, turns in enumerate(convs):
        assert [tuple(t) for t in got[c]["turns"]] == turns
        ok, state = [], "start"
        for role, _ in turns:  # the machine, step by step
            move = chat.CHAT.moves.get(state, {}).get(role)
            ok.append(move is not None)
            move = move or chat.CHAT.otherwise.get(role)
            state = move.state if move else state
        assert got[c]["first_bad_turn"] == (ok.index(False) + 1 if False in ok else None)
        assert got[c]["valid"] == (all(ok) and state == "answered")


def test_orders(spark):
    convs = {1: "sua", 2: "uaua", 3: "ua", 4: "u", 5: "au", 6: "uu", 7: "s", 8: "usa", 9: "uaa", 10: "su"}
    names = {"s": "system", "u": "user", "a": "assistant"}
    got = back(spark, [(c, n, names[x], "t") for c, s in convs.items() for n, x in enumerate(s)])
    assert {c for c in convs if got[c]["valid"]} == {1, 2, 3}
    assert {c: got[c]["first_bad_turn"] for c in (4, 5, 6, 8, 9)} == {4: None, 5: 1, 6: 2, 8: 2, 9: 3}


def test_more_turns_than_a_block(spark):
    n = 2 * chat.BLOCK + 3
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", str(k)) for k in range(n)]
    r = back(spark, rows[::-1])[1]
    assert [t["text"] for t in r["turns"]] == [str(k) for k in range(n)]
    assert r["trained"] == "".join(str(k) for k in range(1, n, 2)) and not r["valid"] and r["first_bad_turn"] is None


def test_edges(spark):
    rows = [(1, 0, None, None), (1, 1, "user", "a"), (1, 1, "user", "a"), (None, None, "assistant", "x"), (None, 3, "user", None), (2, 0, "assistant", "")]
    got = back(spark, rows)
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "a"), ("user", "a")]
    assert [tuple(t) for t in got[None]["turns"]] == [("assistant", "x"), ("user", "")] and got[None]["trained"] == "x"
    assert got[2]["trained"] == ""
    more = spark.createDataFrame([(*r, "mine", 1) for r in rows], SHAPE + ", segments string, valid int")
    plain = spark.createDataFrame(rows, SHAPE)
    assert sorted(map(repr, chat.chat_digest(more).collect())) == sorted(map(repr, chat.chat_digest(plain).collect()))
    assert [r["conv_id"] for r in chat.chat_digest(spark.createDataFrame([], SHAPE)).collect()] == [chat.PROBE_ID]


def test_probe(spark):
    r = chat.chat_digest(spark.createDataFrame([], SHAPE)).first()
    said = f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n"
    assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert r["loss_sha256"] == hashlib.sha256(chat.PROBE.encode()).hexdigest() and r["loss_chars"] == len(chat.PROBE) and r["valid"]


@pytest.mark.parametrize("cores", [1, 7])
def test_same_for_any_partitions(spark, cores):
    rows = spark.createDataFrame([(c, n, "user", f"{c} {n}") for c in range(20) for n in range(5)], SHAPE)
    assert sorted(map(repr, chat.chat_digest(rows.repartition(cores)).collect())) == sorted(map(repr, chat.chat_digest(rows).collect()))
