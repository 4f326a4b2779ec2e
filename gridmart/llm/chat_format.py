"""Operator 11, chat formatting: conversations cut into training windows of a token budget.

*Template.* A turn is ``<|turn|>role<|text|>text<|end|>``. In roles and texts a backslash is
doubled, and a backslash is put after the first character of anything that could be read as a
control string (``<|``, ``<s>``, ``</s>``, ``<<SYS>>``, ``<</SYS>>``, ``[INST]``, ``[/INST]``);
dropping one backslash of each escape gives the text back. A mark counts as one token, the
rest as the byte-level BPE tokenizer encodes it.

*Budgeted windows.* Prefix sums over the turns' tokens choose spans of whole turns: a window
holds the conversation's system turn (a first turn of role ``system``), then as many of the
turns just before its span as fit into ``history`` tokens, then the longest span of new turns
that the budget leaves room for. The next window starts where the span ends. The system turn
and the history of later windows are repeats, so they are left out of the loss mask; under
the mask lies the text of every assistant turn, once.

Defined cases: a null text or role is empty; a null conv_id is a conversation of its own;
null turns come first, and rows of one turn are ordered by role and text; repeated rows are
turns of their own. A turn larger than the room gets a window of its own without history
(``over_budget`` where the budget is passed); turns are never cut or dropped. A system turn
of more than half the budget stands in the first window only. An empty table gives no window.
Further columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.conversations import flushed, ordered, stream
from gridmart.llm.textops import small_batches

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Characters that start a control string, by what follows them (Java and Python syntax).
CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
BUDGET, HISTORY = 1024, 256

WINDOW = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int64()), ("first_turn", pa.int64()), ("n_turns", pa.int64()),
    ("n_repeated", pa.int64()), ("n_tokens", pa.int64()), ("over_budget", pa.bool_()),
    ("formatted", pa.string()), ("loss_start", pa.list_(pa.int64())), ("loss_end", pa.list_(pa.int64()))])
WINDOW_DDL = ("conv_id long, window long, first_turn long, n_turns long, n_repeated long, n_tokens long, "
              "over_budget boolean, formatted string, loss_start array<long>, loss_end array<long>")
DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
DIGEST_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_windows long")


def escape(column):
    """Column expression of ``unescape``'s inverse."""
    doubled = F.replace(F.coalesce(column, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


_TOKENIZERS: dict[int, object] = {}


def _tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    key = hash(vocabulary)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer.from_str(vocabulary)
        _TOKENIZERS[key].encode_special_tokens = True
    return _TOKENIZERS[key]


def counted(rows: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """conv_id, turn, escaped role and text, and the tokens of the formatted turn."""
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path("byte_bpe_50k.json")
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = rows.sparkSession.sparkContext.broadcast(f.read())  # a file of a few MB

    def run(batches):
        for b in small_batches(batches, limit=1 << 18):  # the tokenizer's results are large objects
            tok = _tokenizer(vocabulary.value)
            sizes = [np.array([len(e.ids) for e in tok.encode_batch_fast(b[c].to_pylist(), add_special_tokens=False)],
                              np.int64) for c in ("role", "text")]
            yield pa.RecordBatch.from_pydict({c: b[c] for c in ("conv_id", "turn", "role", "text")}
                                             | {"tokens": sizes[0] + sizes[1] + 3})

    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        escape(F.col("role").cast("string")).alias("role"),
                        escape(F.col("text").cast("string")).alias("text"))
            .mapInArrow(run, "conv_id long, turn long, role string, text string, tokens long"))


class _Conversation:
    """Windows of one conversation as its turns come in; holds a window's turns and history."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.turns: list[tuple[str, str]] = []  # from turn ``base`` on
        self.sums = [0]  # prefix sums of their tokens
        self.base = self.next = self.window = 0
        self.system: tuple[str, str] | None = None
        self.system_tokens = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        if not self.base and not self.turns and role == "system" and 2 * tokens <= self.budget:
            self.system, self.system_tokens = (role, text), tokens
        self.turns.append((role, text))
        self.sums.append(self.sums[-1] + tokens)
        if self.sums[-1] - self.sums[self.next - self.base] > self.budget:
            yield from self.windows(last=False)

    def windows(self, last: bool = True) -> Iterator[dict]:
        """Windows that later turns cannot change (all of them when ``last``)."""
        while self.next - self.base < len(self.turns):
            i, n = self.next - self.base, len(self.turns)
            keep = self.system if self.next else None
            left = self.budget - (self.system_tokens if keep else 0)
            first = self.sums[i + 1] - self.sums[i]
            oldest = max(0, 1 - self.base) if keep else 0  # the system turn is no history
            h = max(min(oldest, i), bisect_left(self.sums, self.sums[i] - max(0, min(self.history, left - first))))
            room = left - (self.sums[i] - self.sums[h])
            j = max(i + 1, bisect_right(self.sums, self.sums[i] + room) - 1)
            if j >= n and not last:
                return
            yield self._formatted(keep, h, i, j, self.sums[j] - self.sums[h] + self.budget - left)
            self.next += j - i
            drop = bisect_left(self.sums, self.sums[j] - self.history)
            if drop:
                self.turns, self.sums, self.base = self.turns[drop:], self.sums[drop:], self.base + drop

    def _formatted(self, keep, h: int, i: int, j: int, tokens: int) -> dict:
        parts, at, start, end = [], 0, [], []
        shown = ([keep] if keep else []) + self.turns[h:j]
        repeated = len(shown) - (j - i)
        for k, (role, text) in enumerate(shown):
            head = f"{TURN}{role}{TEXT}"
            if k >= repeated and role == "assistant":
                start.append(at + len(head))
                end.append(at + len(head) + len(text))
            parts += [head, text, END]
            at += len(head) + len(text) + len(END)
        row = {"conv_id": self.conv_id, "window": self.window, "first_turn": self.next, "n_turns": j - i,
               "n_repeated": repeated, "n_tokens": tokens, "over_budget": tokens > self.budget,
               "formatted": "".join(parts), "loss_start": start, "loss_end": end}
        self.window += 1
        return row


def windows(rows: DataFrame, vocabulary_path: str | None = None, budget: int = BUDGET,
            history: int = HISTORY) -> DataFrame:
    """Training windows: ``formatted`` text, the code point spans under the loss mask, and how
    many of the window's first turns are repeats."""

    def cut(rows) -> Iterator[dict]:
        now = None
        for conv_id, role, text, tokens in rows:
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield from now.windows()
                now = _Conversation(conv_id, budget, history)
            yield from now.add(role, text, tokens)
        if now is not None:
            yield from now.windows()

    def run(batches):
        rows = stream(batches, "conv_id", "role", "text", "tokens")
        yield from flushed(cut(rows), WINDOW, lambda r: len(r["formatted"]))

    return ordered(counted(rows, vocabulary_path), "turn", "role", "text").mapInArrow(run, WINDOW_DDL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    out = []
    for turn in formatted.split(TURN)[1:]:
        role, _, text = turn.removesuffix(END).partition(TEXT)
        out.append((unescape(role), unescape(text)))
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest per conversation from its windows (in their order, as ``windows`` returns them)."""

    def digests(rows) -> Iterator[dict]:
        now, turns, loss = None, hashlib.sha256(), hashlib.sha256()
        for conv_id, window, repeated, text, start, end in rows:
            if now is None or window == 0:
                if now is not None:
                    yield now | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}
                now = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_windows": 0}
                turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, said in read_turns(text)[repeated:]:
                turns.update(f"{role}\n{said}\n".encode())
                now["n_turns"] += 1
            for a, b in zip(start, end, strict=True):
                said = unescape(text[a:b])
                loss.update(said.encode())
                now["loss_chars"] += len(said)
            now["formatted_chars"] += len(text)
            now["n_windows"] += 1
        if now is not None:
            yield now | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}

    def run(batches):
        rows = stream(batches, "conv_id", "window", "n_repeated", "formatted", "loss_start", "loss_end",
                      text="formatted")
        yield from flushed(digests(rows), DIGEST, lambda r: 300)

    return formatted.mapInArrow(run, DIGEST_DDL)


def planted(spark) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
