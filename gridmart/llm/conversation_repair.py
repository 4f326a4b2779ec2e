"""Operator 13, conversation structure repair: the cheapest edits that restore turn order.

A conversation's rows, by turn, are edited to role initials ``(s?(ua)+)?``: Keep (0), Rerole
to user or assistant (3), Delete (4, the only edit for a blank or duplicate row), Insert an
empty user or assistant row (3); a truncated row that stays costs 3 more. Among the cheapest
edit sequences the one whose letters (D, I, K, R) are ASCII-least is taken.

*Scalar big-integer weights.* An edit sequence is one integer: the high digits are its cost,
the low digits, a fixed number of octal places from the left, are its letters (D 1, I 2, K 3,
R 4), with zeros behind the last one. An edit adds its cost and its letter at the next place,
so integer order is cost first, then ASCII order, and an ordinary minimum over the DAG of
(row, pattern state) decides everything. No shorter sequence at a node is the head of an
equally cheap longer one (the rest would be inserts, which cost), so minima may be taken node
by node, and a long conversation may be solved in blocks of rows: the cheapest edits of a
block from each state to each state, then the same minimum over whole blocks.

Rows are shuffled by conversation twice: first a few bytes a row (flags and a fingerprint of
role and text), which give the edits; then the texts, behind the row that carries their
conversation's edits, so they stream through without being gathered.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own;
null turns come first, and rows of one turn are ordered by role, then by a fingerprint of
role and text. Roles are told by their first character; another than s, u or a can only be
reroled or deleted. A very long conversation costs the square of a block, not its own. A
conversation without rows (named by ``conv_ids``) has zeros and an empty audit. An empty
table gives no row. Further columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.conversations import flushed, ordered, stream

D, I, K, R = 1, 2, 3, 4
LETTERS = str.maketrans("1234", "DIKR")
#: Pattern states: nothing yet, after s, after u, after a; the state after each next role.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
TURN = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}  # after a user or assistant row
BLOCK = 128

#: A row's code: role (0 s, 1 u, 2 a, 3 other) + 4 * fault (0 none, 1 must go, 2 truncated).
ROLE = "sua"


class _Path:
    """Cheapest edit sequence to a node: ``value`` is cost and letters as one integer."""

    __slots__ = ("length", "value")

    def __init__(self, value: int, length: int):
        self.value, self.length = value, length


def _least(paths: dict[int, _Path], state: int, path: _Path) -> None:
    if state not in paths or path.value < paths[state].value:
        paths[state] = path


def _edit(path: _Path, cost: int, letter: int, places: int) -> _Path:
    weight = (cost << 3 * places) + (letter << 3 * (places - path.length - 1))
    return _Path(path.value + weight, path.length + 1)


def _inserted(paths: dict[int, _Path], places: int) -> dict[int, _Path]:
    """With up to two inserts; a third would come back to a state that it had."""
    out, last = dict(paths), paths
    for _ in range(2):
        new: dict[int, _Path] = {}
        for state, path in last.items():
            _least(new, TURN[state], _edit(path, 3, I, places))
        for state, path in new.items():
            _least(out, state, path)
        last = new
    return out


def _row(paths: dict[int, _Path], code: int, places: int) -> dict[int, _Path]:
    fault, role = divmod(code, 4)
    more = 3 if fault == 2 else 0
    out: dict[int, _Path] = {}
    for state, path in paths.items():
        _least(out, state, _edit(path, 4, D, places))
        if fault == 1:
            continue
        _least(out, TURN[state], _edit(path, 3 + more, R, places))
        to = NEXT[ROLE[role]].get(state) if role < 3 else None
        if to is not None:
            _least(out, to, _edit(path, more, K, places))
    return out


@lru_cache(100_000)
def _block(codes: bytes, state: int) -> tuple[tuple[int, int, int, int], ...]:
    """(end state, cost, letters in 3 * len + 2 places, length) of the cheapest edits."""
    places = 3 * len(codes) + 2
    paths = {state: _Path(0, 0)}
    for code in codes:
        paths = _row(_inserted(paths, places), code, places)
    low = (1 << 3 * places) - 1
    return tuple((s, p.value >> 3 * places, p.value & low, p.length) for s, p in paths.items())


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation's row codes."""
    places = 3 * (len(codes) + BLOCK) + 4
    paths = {START: _Path(0, 0)}
    for at in range(0, len(codes), BLOCK):
        block = codes[at:at + BLOCK]
        width = 3 * len(block) + 2
        new: dict[int, _Path] = {}
        for state, path in paths.items():
            for to, cost, letters, length in _block(block, state):
                weight = (cost << 3 * places) + (letters << 3 * (places - path.length - width))
                _least(new, to, _Path(path.value + weight, path.length + length))
        paths = new
    ends = _inserted(paths, places)
    best = min((ends[s] for s in (START, AFTER_A) if s in ends), key=lambda p: p.value)
    letters = format(best.value & ((1 << 3 * places) - 1), "o").zfill(places)[:best.length]
    return best.value >> 3 * places, letters.translate(LETTERS)


def edited(audit: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows; ``rows`` are read one per letter D, K or R."""
    state = START
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == AFTER_U else "user"
        state = NEXT[role[0]][state]
        yield role, text


STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
STAT_NAMES = [c.split()[0] for c in STATS.split(", ")]
PLAN = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in STAT_NAMES[:-1]], ("audit", pa.string())])
RESULT = pa.schema([*PLAN, ("repaired_sha256", pa.string())])
REPAIRED = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _clean(rows: DataFrame) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    return out.withColumn("print", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))


def plans(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """Fault counts, cost and audit per conversation of ``rows`` (conv_id, turn, role, text),
    and of every conversation in ``conv_ids``."""
    first = F.substring("role", 1, 1)
    code = (F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
            + F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), 4)
            .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 8).otherwise(0))
    coded = _clean(rows).select("conv_id", "turn", "role", "print", code.cast("int").alias("code"))
    if conv_ids is not None:
        coded = coded.unionByName(conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(),
                                  allowMissingColumns=True)

    def plan(conv_id, turns, codes, seen_before) -> dict:
        final = bytearray()
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        for c, again in zip(codes, seen_before, strict=True):
            fault, role = divmod(c, 4)
            name = "blank" if fault == 1 else "duplicate" if again else "truncated" if fault == 2 else None
            if name:
                counts[name] += 1
            final.append(role + 4 * {"blank": 1, "duplicate": 1, "truncated": 2, None: 0}[name])
        roles = [c & 3 for c in codes]
        illegal = sum(p not in ((0, 1), (1, 2), (2, 1)) for p in zip(roles, roles[1:], strict=False))
        cost, audit = cheapest(bytes(final))
        low, high, distinct = turns
        return {"conv_id": conv_id, "gaps": high - low + 1 - distinct if distinct else 0, **counts,
                "illegal": illegal, "cost": cost, "audit": audit}

    def conversations(rows) -> Iterator[dict]:
        now, begun = None, False
        codes, again, seen, turns, last = bytearray(), bytearray(), set(), (0, 0, 0), None
        for conv_id, turn, mark, code in rows:
            if not begun or conv_id != now:
                if begun:
                    yield plan(now, turns, codes, again)
                now, begun = conv_id, True
                codes, again, seen, turns, last = bytearray(), bytearray(), set(), (0, 0, 0), None
            if code is None:  # names the conversation only
                continue
            key = bytes.fromhex(mark)
            codes.append(code)
            again.append(key in seen)
            seen.add(key)
            if turn is not None and turn != last:
                turns = (turns[0] if turns[2] else turn, turn, turns[2] + 1)
                last = turn
        if begun:
            yield plan(now, turns, codes, again)

    def run(batches):
        rows = stream(batches, "conv_id", "turn", "print", "code", text="print")
        yield from flushed(conversations(rows), PLAN, lambda r: 100 + len(r["audit"]))

    return ordered(coded, "turn", "role", "print").mapInArrow(run, f"conv_id long, {STATS}")


def _with_plans(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's plan (``kind`` 0), then its rows."""
    both = planned.withColumn("kind", F.lit(0)).unionByName(_clean(rows).withColumn("kind", F.lit(1)),
                                                            allowMissingColumns=True)
    return ordered(both, "kind", "turn", "role", "print")


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """(plan, repaired rows) of each conversation; the rows must be read before the next one."""
    ahead: list[tuple] = []

    def texts() -> Iterator[tuple[str, str]]:
        for row in rows:
            if row[0] == 0:
                ahead.append(row)
                return
            yield row[1], row[2]

    row = next(rows, None)
    while row is not None:
        plan = dict(zip(["conv_id", *STAT_NAMES], row[3:], strict=True))
        left = texts()
        yield plan, edited(plan["audit"], left)
        for _ in left:  # up to the next plan
            pass
        row = ahead.pop() if ahead else None


_READ = ("kind", "role", "text", "conv_id", *STAT_NAMES)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, position, role, text: the repaired conversations themselves."""

    def out(batches) -> Iterator[dict]:
        for plan, kept in _conversations(stream(batches, *_READ)):
            for k, (role, text) in enumerate(kept):
                yield {"conv_id": plan["conv_id"], "position": k, "role": role, "text": text}

    def run(batches):
        yield from flushed(out(batches), REPAIRED, lambda r: 50 + len(r["text"]))

    return _with_plans(rows, plans(rows)).mapInArrow(run, "conv_id long, position long, role string, text string")


def digests(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """The plan of each conversation and the digest of its repaired ``role:text`` lines."""

    def out(batches) -> Iterator[dict]:
        for plan, kept in _conversations(stream(batches, *_READ)):
            h = hashlib.sha256()
            for k, (role, text) in enumerate(kept):
                h.update(f"{chr(10) if k else ''}{role}:{text}".encode())
            yield plan | {"repaired_sha256": h.hexdigest()}

    def run(batches):
        yield from flushed(out(batches), RESULT, lambda r: 200 + len(r["audit"]))

    return _with_plans(rows, plans(rows, conv_ids)).mapInArrow(run, f"conv_id long, {STATS}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; nulls: one space) with faults by the remainder of
    crc32(``conv_id:turn``) by 20: 0 drops the row, 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 sets its role to user."""
    space = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                             F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
            .filter(F.col("fault") != 0)
            .select("conv_id", "turn",
                    F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("fault") == 1, "")
                    .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
                    .alias("text"),
                    F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                    .alias("copy"))
            .drop("copy"))
