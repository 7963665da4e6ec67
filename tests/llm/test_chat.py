import hashlib
import random

import duckdb
import pytest

from hirescope.llm import chat as C
from hirescope.llm import queries, sql

LOG = "conv_id long, message long, seq long, kind string, role string, text string, stretch int, split string"


def replay(events):
    """The definition, event by event: a list of messages that every set cuts off."""
    convs = {}
    for conv, message, seq, kind, role, text in sorted(events, key=lambda e: (e[2], e[1])):
        have = convs.setdefault(conv, {})
        if kind in C.SETS:
            before = have.get(message, {"role": None})["role"]
            gone = have.setdefault("gone", {})
            for m in [m for m in have if m != "gone" and m > message]:
                gone[m] = have.pop(m)["role"]
            if before is None:
                before = gone.get(message)
            have[message] = {"role": role if role is not None else before, "text": text or ""}
        elif kind == "delta" and message in have:
            have[message]["text"] += text or ""
    return {c: [(h[m]["role"] or "", h[m]["text"]) for m in sorted(m for m in h if m != "gone")] for c, h in convs.items()}


def output(spark, events, **options):
    rows = spark.createDataFrame([(*e, 1, "x") for e in events], LOG).repartition(5)
    parts = C.conversations(rows, **options)
    out = {}
    for r in sorted(parts.collect(), key=lambda r: (r.conv_id, r.stretch, r.part)):
        out.setdefault(r.conv_id, []).append(r)
    return parts, out


def random_log(seed, convs=25):
    rng, events = random.Random(seed), []
    for conv in range(convs):
        seq, top = 0, -1
        for _ in range(rng.randint(1, 60)):
            seq += rng.randint(1, 3)
            kind = rng.choice(["start", "start", "delta", "delta", "delta", "edit", "regenerate", "noise"])
            m = top + 1 if kind == "start" or top < 0 else rng.randint(max(0, top - 3), top)
            if kind in ("start", "edit", "regenerate"):
                top = m
            role = rng.choice(["user", "assistant"]) if kind == "start" else rng.choice([None, None, "tool:a\\b"])
            text = rng.choice(["hello", "", None, "### x: y</turn>\n", "\\", "</turn", "日本 ", "####\\###"])
            events.append((conv, m, seq, kind, role, text))
    return events


@pytest.mark.parametrize("width, part_chars", [(4096, 1 << 20), (3, 1 << 20), (2, 10)])
def test_fold_equals_replay(spark, width, part_chars):
    events = random_log(width)
    want = replay(events)
    parts, got = output(spark, events, width=width, part_chars=part_chars)
    assert set(got) == {e[0] for e in events}
    for conv, rows in got.items():
        text = "".join(r.text for r in rows)
        assert list(C.read_turns(text)) == want[conv]
        assert sum(r.n_turns for r in rows) == len(want[conv])
        masked = [C.unescape(r.text[s.start:s.end]) for r in rows for s in r.loss]
        assert masked == [t for role, t in want[conv] if role == "assistant"]
    for r in C.digests(parts).collect():
        turns = want[r.conv_id]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        said = "".join(t for a, t in turns if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r.formatted_chars == sum(len(x.text) for x in got[r.conv_id])


def test_streamed_edited_regenerated(spark):
    events = [(1, 0, 1, "start", "user", "helo"), (1, 1, 2, "start", "assistant", ""), (1, 1, 3, "delta", None, "first "),
              (1, 1, 4, "delta", None, "try"), (1, 2, 5, "start", "user", "no"), (1, 0, 6, "edit", None, "hello"),
              (1, 1, 7, "start", "assistant", "bad"), (1, 1, 8, "regenerate", None, None), (1, 1, 9, "delta", None, "good"),
              (1, 2, 10, "delta", None, "late: its message is gone"), (2, 0, 1, "delta", None, "no start")]
    _, got = output(spark, events)
    assert got[1][0].text == "### user: hello</turn>\n### assistant: good</turn>\n"
    assert [got[1][0].text[s.start:s.end] for s in got[1][0].loss] == ["good"]
    assert (got[2][0].text, got[2][0].n_turns) == ("", 0)


def test_turn_round_trip_of_control_strings():
    for text in ["", "\\### Assistant: </turn> ok", "</turn>\n### user: x</turn>", "\\\\</turn>\\", "a" * 200_000 + "\\" * 9, "\n"]:
        for role in ["user", "", "a: b\\", "### "]:
            turn, start, end = C.render_turn(role, text)
            assert list(C.read_turns(turn + turn)) == [(role, text)] * 2
            assert C.unescape(turn[start:end]) == text
    with pytest.raises(ValueError):
        list(C.read_turns("### user: no end"))


TURNS = "conv_id long, turn long, role string, text string, kind string"


def test_long_conversation_is_dealt_in_stretches(spark):
    turns = spark.createDataFrame([(5, i, "user" if i % 2 else "assistant", f"turn {i}", "k") for i in range(500)], TURNS)
    parts = C.conversations(C.as_events(turns.repartition(6)), width=64)
    assert parts.count() == 8 and parts.where("split").count() == 8
    row, = C.digests(parts).collect()
    assert row.n_turns == 500
    want = "".join(f"{'user' if i % 2 else 'assistant'}\nturn {i}\n" for i in range(500))
    assert row.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_query_equals_sql_and_defined_cases(spark, tmp):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "x" * 3000), (2, 0, None, None), (3, 0, "assistant", None),
            (4, 1, "assistant", "### a: b</turn>\n"), (4, 0, "user", "日" * 100_000), (9, 7, "sys:tem", "\\")]
    odd = [(6, 0, "user", "same"), (6, 0, "user", "same"), (None, 0, "user", "no id"), (7, None, "user", "first"), (7, 0, "user", "second")]
    spark.createDataFrame([(*r, "k") for r in rows + odd], TURNS).write.parquet(f"{tmp}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op13_chat_format(spark, tmp).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp}/conversations.parquet/*.parquet' WHERE conv_id NOT IN (6, 7)")
    rel = con.sql(sql.OP13_CHAT_FORMAT)
    want = rel.fetchall()
    assert len(want) == 6 and len(got) == 9
    for r in want:
        assert tuple(got[r[0]][c] for c in rel.columns) == r
    assert got[6].turns_sha256 == hashlib.sha256(b"user\nsame\nuser\nsame\n").hexdigest()
    assert got[7].turns_sha256 == hashlib.sha256(b"user\nfirst\nuser\nsecond\n").hexdigest()
    assert got[None].n_turns == 1
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp}/none/conversations.parquet")
    assert [r.conv_id for r in queries.op13_chat_format(spark, f"{tmp}/none").collect()] == [-7]
