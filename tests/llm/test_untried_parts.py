"""Brute force for what no query runs: deltas, edits and regenerations of chats, and offsets of tokens."""

import base64
import random

import public_tokenizers

from tidemark.llm import bpe, chat


def folded(events):
    """Messages (turn, n, role, text) of one conversation, event by event."""
    first = lambda x, low: (x is not None, low if x is None else x)
    turns, had = {}, {}
    for _, turn, kind, role, text in sorted(events, key=lambda e: (first(e[0], 0), e[2] not in ("edit", "regenerate"), e[1], e[2], first(e[3], ""), e[4] or "")):
        had[turn] = had.get(turn) if role is None else role
        if kind in ("edit", "regenerate"):
            had = {t: x for t, x in had.items() if t <= turn}
            turns = {t: m for t, m in turns.items() if t < turn}
        if kind == "delta" and turn in turns:
            m = turns[turn][-1]
            m[:] = [m[0] if m[0] is not None else role, m[1] + (text or ""), m[2]]
        else:
            turns.setdefault(turn, []).append([role, text or "", None if kind == "message" else had[turn]])
    flat = [(t, a if a is not None else c or "", b) for t in sorted(turns) for a, b, c in turns[t]]
    return [(t, n, role, text) for n, (t, role, text) in enumerate(flat, 1)]


def test_fold(spark):
    """Random logs of all kinds, with null roles and texts, null and equal seqs, and repeated events."""
    drawn = random.Random(3)
    kinds = ["message", "delta", "delta", "edit", "regenerate"]

    def event(c, s):
        k = drawn.choice(kinds)
        return (drawn.choice([s, s, s // 2, None]), drawn.randrange(4), k, drawn.choice(["user", "assistant", None]), drawn.choice([None, f"{c}.{s} "]) if k != "regenerate" else None)

    logs = {c: [event(c, s) for s in range(drawn.randrange(1, 16))] for c in range(150)}
    logs = {c: log + [e for e in log if drawn.random() < 0.1] for c, log in logs.items()}
    rows = [(c, *e) for c, log in logs.items() for e in log]
    drawn.shuffle(rows)
    out = chat.fold(spark.createDataFrame(rows, "conv long, seq long, turn long, kind string, role string, text string")).collect()
    got = {c: sorted((r["turn"], r["n"], r["role"], r["text"]) for r in out if r["conv"] == c) for c in logs}
    assert got == {c: folded(log) for c, log in logs.items()}


def test_a_role_is_kept_through_edits_and_regenerations(spark):
    log = [(1, 1, 0, "message", "user", "hi"), (1, 2, 0, "edit", None, "hello"), (1, 3, 1, "delta", "assistant", "no"), (1, 4, 1, "regenerate", None, None), (1, 5, 1, "delta", None, "yes"), (1, 6, 0, None, None, "")]
    log += [(2, 1, 0, "message", "user", "a"), (2, 2, 0, "edit", None, "A"), (2, 2, 0, "edit", None, "B")]
    out = chat.fold(spark.createDataFrame(log, "conv long, seq long, turn long, kind string, role string, text string")).collect()
    assert sorted((r["conv"], r["n"], r["role"], r["text"]) for r in out) == [(1, 1, "user", "hello"), (1, 2, "", ""), (1, 3, "assistant", "yes"), (2, 1, "user", "B")]


def test_offsets(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    spell = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(path, "rb"))}
    texts = ["plain words", "漢字🙂 𝔘𝔫𝔦 é ß́", "\U0001f9d1‍\U0001f680 a\U000e0041�", "", None, "🙂" * 9]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    split = 0
    for r in bpe.encode(frame, path, public_tokenizers.PATTERN, starts="starts", ends="ends").collect():
        text = texts[r["doc_id"]] or ""
        char = [k for k, c in enumerate(text) for _ in c.encode()]  # of each byte
        at, want = 0, []
        for i in r["ids"]:
            want.append((char[at], char[at + len(spell[i]) - 1] + 1))
            at += len(spell[i])
        assert at == len(char) and list(zip(r["starts"], r["ends"])) == want
        split += sum(a[1] > b[0] for a, b in zip(want, want[1:]))
    assert split > 0  # characters whose bytes are in several tokens
