"""Chat formatting and conversation repair against brute force on small tables."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from gridmart.llm import chat_format, conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def _sorted(rows):
    """By conversation, turn (nulls first), role and text."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))


@pytest.fixture()
def talk():
    rng = random.Random(8)
    words = ["a", "bc.", "</s>", "[INST]", "\\", "<|end|>", "<|text|>", "é", "日本", "\n", "<", "[", "<<SYS>>", "ok!"]
    rows = []
    for conv in range(60):
        turns = rng.randrange(1, 9)
        start = rng.randrange(3)
        if start == 0:
            rows.append((conv, -1, "system", " ".join(rng.choices(words, k=rng.randrange(1, 30)))))
        for turn in range(turns):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            text = " ".join(rng.choices(words, k=rng.randrange(0, 60))) + rng.choice([".", "?", "", " ! "])
            rows.append((conv, turn, role, text))
    rows += [(100, None, "user", None), (100, None, None, "x."), (100, 3, "tool<|text|>", "y <|turn|>"),
             (None, 0, "user", "no id."), (None, 1, "assistant", "none."), (101, 0, "assistant", ""),
             (102, 5, "user", "same."), (102, 5, "user", "same."), (102, 9, "assistant", "fine."),
             (103, 0, "system", "s " * 900), (103, 1, "user", "long " * 3000), (103, 2, "assistant", "z."),
             (104, 0, "system", "rules."), *[(104, k, ["assistant", "user"][k % 2], f"turn {k} " * 20) for k in range(1, 90)]]
    return rows


def test_format_round_trip(spark, talk):
    frame = spark.createDataFrame(talk, SCHEMA).repartition(3)
    windows = chat_format.windows(frame, budget=200, history=50)
    got = {r.conv_id: r for r in chat_format.read_back(windows).collect()}
    whole = windows.collect()
    for conv, rows in itertools.groupby(_sorted(talk), key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in rows]
        said = "".join(t for r, t in turns if r == "assistant")
        r = got.pop(conv)
        assert (r.n_turns, r.loss_chars) == (len(turns), len(said)), conv
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        mine = [w for w in whole if w.conv_id == conv]
        assert r.formatted_chars == sum(len(w.formatted) for w in mine) and r.n_windows == len(mine)
        for w in mine:  # the system turn first, then history, then new turns, all in place
            shown = chat_format.read_turns(w.formatted)
            new = shown[w.n_repeated:]
            assert new == turns[w.first_turn:w.first_turn + w.n_turns]
            repeats = shown[:w.n_repeated]
            if repeats and turns[0][0] == "system" and repeats[0] == turns[0]:
                repeats = repeats[1:]
            assert repeats == turns[w.first_turn - len(repeats):w.first_turn]
            assert w.over_budget == (w.n_tokens > 200) and (not w.over_budget or w.n_turns == 1)
    assert not got
    kept = [w for w in whole if w.conv_id == 104]
    assert len(kept) > 5 and all(chat_format.read_turns(w.formatted)[0] == ("system", "rules.") for w in kept)
    assert all(w.n_repeated >= 2 for w in kept[1:])


def test_format_budget_is_used(spark, talk):
    """Greedy: a window's next turn would not have fitted."""
    frame = spark.createDataFrame([r for r in talk if r[0] == 104], SCHEMA)
    tokens = [r.tokens for r in chat_format.counted(frame).orderBy("turn").collect()]
    rows = sorted(chat_format.windows(frame, budget=300, history=80).collect(), key=lambda w: w.window)
    for w in rows[:-1]:
        assert w.n_tokens <= 300 < w.n_tokens + tokens[w.first_turn + w.n_turns]
        history = tokens[w.first_turn - w.n_repeated + 1:w.first_turn] if w.window else []
        assert sum(history) <= 80 and w.n_tokens == sum(history) + (tokens[0] if w.window else 0) + sum(
            tokens[w.first_turn:w.first_turn + w.n_turns])


def test_planted_conversation(spark):
    got = chat_format.read_back(chat_format.windows(chat_format.planted(spark))).collect()[0]
    said = "</s>[INST] ok [/INST]"
    text = chat_format.windows(chat_format.planted(spark)).collect()[0].formatted
    assert "</s>" not in text and "[INST]" not in text and "[/INST]" not in text
    assert (got.conv_id, got.n_turns, got.loss_chars) == (-1, 2, len(said))
    assert got.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_escape_is_reversible(spark):
    rng = random.Random(3)
    parts = ["\\", "<", "|", "[", "/", "INST]", "s>", "<SYS>>", "</SYS>>", "turn|>", "\n", "x", "\r", "]"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 12))) for _ in range(500)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escape("t").alias("e")).collect()
    for r in got:
        assert chat_format.unescape(r.e) == r.t
        assert not re.search(r"<\||</?s>|<</?SYS>>|\[/?INST\]", r.e)


def _brute(rows):
    """The contract, by strings and a full search over (cost, audit) of row suffixes."""
    rows = [(r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows]
    black = re.compile("[^\x20\x09-\x0D]")
    faults, seen = [], set()
    for _, role, text in rows:
        shown = black.findall(text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                      else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))

    @functools.cache
    def best(i, last, inserted=0):
        """(cost, audit) for rows i.. after a row of initial ``last``; two inserts in a row at most."""
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        found = [(0, "")] if i == len(rows) and last in ("", "a") else []
        steps = []
        if inserted < 2:
            steps.append(("I", 3, i, after[-1], inserted + 1))
        if i < len(rows):
            steps.append(("D", 4, i + 1, last, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                steps.append(("R", 3 + more, i + 1, after[-1], 0))
                if rows[i][1][:1] and rows[i][1][:1] in after:
                    steps.append(("K", more, i + 1, rows[i][1][0], 0))
        for letter, price, *to in steps:
            cost, audit = best(*to)
            found.append((cost + price, letter + audit))
        return min(found, default=(10**9, "~"))

    cost, audit = best(0, "")
    out, left, last = [], iter(rows), ""
    for letter in audit:
        _, role, text = (None, "", "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if last == "u" else "user"
        last = role[0]
        out.append(f"{role}:{text}")
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def _columns(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


def test_repair(spark, talk):
    rng = random.Random(5)
    rows = [r for r in talk if r[0] is None or r[0] < 103]
    for conv in range(200, 320):
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]) if turn else 0,
                         rng.choice(["system", "user", "assistant", "assistant", "tool", "", "u"]),
                         rng.choice(["yes.", "no", "", " \t", "well?", "fine.", "end. "])))
    ids = spark.createDataFrame([(i,) for i in {r[0] for r in rows} | {900}], "conv_id long")
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.conv_id: _columns(r) for r in conversation_repair.digests(frame, ids).collect()}
    order = {}
    for r in conversation_repair.ordered(conversation_repair._clean(frame), "turn", "role", "print").collect():
        order.setdefault(r.conv_id, []).append((r.conv_id, r.turn, r.role, r.text))
    for conv, group in order.items():
        assert got.pop(conv) == _brute(group), group
    assert got == {900: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    fixed = {}
    for r in conversation_repair.repaired(frame).collect():
        fixed.setdefault(r.conv_id, []).append((r.position, r.role, r.text))
    for rows in fixed.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[1][0] for x in sorted(rows)))


def test_cheapest_by_enumeration():
    """Every edit sequence of up to three rows, against the integer minimum."""
    for n in range(4):
        for codes in itertools.product(range(12), repeat=n):
            if n == 3 and sum(c * 7 for c in codes) % 5:
                continue
            best = None
            for edits in itertools.product("DKR", repeat=n):
                for inserts in itertools.product(range(3), repeat=n + 1):
                    audit, cost, out, ok = "", 0, "", True
                    for k in range(n + 1):
                        audit += "I" * inserts[k]
                        cost += 3 * inserts[k]
                        for _ in range(inserts[k]):
                            out += "a" if out[-1:] == "u" else "u"
                        if k == n:
                            break
                        fault, role = divmod(codes[k], 4)
                        audit += edits[k]
                        if edits[k] == "D":
                            cost += 4
                            continue
                        ok &= fault != 1
                        cost += 3 * (fault == 2) + 3 * (edits[k] == "R")
                        out += "suax"[role] if edits[k] == "K" else "a" if out[-1:] == "u" else "u"
                    if ok and re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
            assert conversation_repair.cheapest(bytes(codes)) == best, codes


def test_long_conversation_in_blocks():
    rng = random.Random(2)
    codes = bytes(rng.choice([1, 2, 1, 2, 6, 9, 3, 0]) for _ in range(700))
    blocks = conversation_repair.cheapest(codes)
    old, conversation_repair.BLOCK = conversation_repair.BLOCK, 10_000
    try:
        assert conversation_repair.cheapest(codes) == blocks
    finally:
        conversation_repair.BLOCK = old


def test_damage(spark, talk):
    got = sorted(map(str, (tuple(r) for r in conversation_repair.damaged(spark.createDataFrame(talk, SCHEMA)).collect())))
    want = []
    for conv, turn, role, text in talk:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want += [] if k == 0 else [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    assert got == sorted(map(str, want))


def test_empty_and_clashing_columns(spark, talk):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_format.windows(empty).count() == 0 and chat_format.read_back(chat_format.windows(empty)).count() == 0
    assert conversation_repair.digests(empty).count() == 0 and conversation_repair.repaired(empty).count() == 0
    frame = spark.createDataFrame(talk, SCHEMA)
    extra = frame
    for name in ("tokens", "window", "print", "code", "kind", "audit", "position", "fault", "copy", "formatted"):
        extra = extra.selectExpr("*", f"'clash' AS `{name}`")
    assert conversation_repair.digests(extra).exceptAll(conversation_repair.digests(frame)).count() == 0
    a, b = (chat_format.read_back(chat_format.windows(x)) for x in (extra, frame))
    assert a.exceptAll(b).count() == 0
    assert conversation_repair.damaged(extra).exceptAll(conversation_repair.damaged(frame)).count() == 0
