"""Operator 7, SentencePiece encoding and decoding by Aho-Corasick and Viterbi.

An Aho-Corasick automaton over the UTF-8 bytes of all pieces reads a text once; at every
position the chain of output links lists the pieces that end there, and each relaxes the
position's best score (the sum of the pieces' scores, as in the unigram algorithm; of equal
scores the longer last piece wins). A character that is no piece costs the lowest score
minus 10 and is written as byte pieces. No piece has a space mark after another character,
so a text splits before each run of spaces into segments that are solved independently:
a worker solves the distinct new segments of a batch together, one byte position at a time
in numpy, and keeps a bounded cache segment -> ids.

The model's pieces, scores and kinds are read as given; it is not trained here. A text gets
the model's prefix space; decoding takes it off again and restores the text exactly, but for
the space mark itself (U+2581), which reads back as a space.

Defined cases: a null or empty text has no ids and decodes to the empty text. Rows are
independent, so repeated rows get equal ids.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.textops import small_batches, utf8
from gridmart.llm.token_ids import _Index, _Table

MARK = "▁".encode()
_SEGMENT = re.compile(rb" *[^ ]+| +")
UNKNOWN_COST = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_model(spark: SparkSession, path: str | None = None):
    """The model file (under a MB, fixed by the tokenizer) as a broadcast."""
    with open(path or default_model(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


class Automaton:
    """Aho-Corasick over byte strings with a full transition table.

    ``piece[s]`` is the piece that ends in state s (or -1), ``link[s]`` the next state on the
    suffix chain where a piece ends (or 0)."""

    def __init__(self, pieces: list[tuple[int, bytes]]):
        children: list[dict[int, int]] = [{}]
        ends = {}
        for number, raw in pieces:
            at = 0
            for c in raw:
                to = children[at].get(c)
                if to is None:
                    to = children[at][c] = len(children)
                    children.append({})
                at = to
            ends[at] = number
        n = len(children)
        self.next = np.zeros((n, 256), np.int32)
        self.piece = np.full(n, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        self.link = np.zeros(n, np.int32)
        fail = np.zeros(n, np.int64)
        level = []
        for c, to in children[0].items():
            self.next[0, c] = to
            level.append(to)
        while level:
            below = []
            for s in level:
                f = fail[s]
                self.link[s] = f if self.piece[f] >= 0 else self.link[f]
                self.next[s] = self.next[f]
                for c, to in children[s].items():
                    fail[to] = self.next[f, c]
                    below.append(to)
                for c, to in children[s].items():
                    self.next[s, c] = to
            level = below


class Codec:
    """Encoder and decoder of one model with a cache of at most ``max_segments`` segments."""

    def __init__(self, model: bytes, max_segments: int = 400_000):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        kinds = [(sp.is_byte(i), sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        text = [sp.id_to_piece(i).encode() for i in range(n)]
        self.byte_id = np.zeros(256, np.int64)
        shown, normal = [], []
        for i, (is_byte, hidden) in enumerate(kinds):
            if is_byte:
                value = int(text[i][3:5], 16)
                self.byte_id[value] = i
                shown.append(bytes([value]))
            elif hidden:
                shown.append(b"")
            else:
                shown.append(text[i].replace(MARK, b" "))
                normal.append((i, shown[-1]))
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.size = np.array([len(t) for t in shown], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(shown) + b"\0", np.uint8)
        self.unknown = min(self.score[i] for i, _ in normal) - UNKNOWN_COST
        self.machine = Automaton(normal)
        self.max_segments = max_segments
        self.clear()

    def clear(self) -> None:
        self.index, self.table = _Index(), _Table()

    def solve(self, segments: list[bytes]) -> list[list[int]]:
        """Best segmentation of every segment (the longest first, so active ones are a prefix)."""
        order = sorted(range(len(segments)), key=lambda k: -len(segments[k]))
        size = np.array([len(segments[k]) for k in order], np.int64)
        data = np.frombuffer(b"".join(segments[k] for k in order), np.uint8)
        begin = np.cumsum(size) - size
        # Row p of a segment holds the best score and last piece of its first p bytes.
        base = begin + np.arange(len(order))
        best = np.full(int(size.sum()) + len(order), -np.inf)
        last = np.full(len(best), -1, np.int32)
        back = np.zeros(len(best), np.int32)
        best[base] = 0.0
        state = np.zeros(len(order), np.int32)
        char = np.zeros(len(order), np.int64)  # byte position where the current character began
        m = self.machine
        for p in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -p, side="left"))
            c = data[begin[:n] + p]
            state = m.next[state[:n], c]
            char = np.where((c & 0xC0) != 0x80, p, char[:n])
            here = base[:n] + p + 1
            alone = np.zeros(n, bool)
            node = np.where(m.piece[state] >= 0, state, m.link[state])
            who = np.flatnonzero(node)
            while len(who):
                piece = m.piece[node[who]]
                length = self.size[piece]
                alone[who] |= length == p + 1 - char[who]
                score = best[here[who] - length] + self.score[piece]
                better = score > best[here[who]]
                at = here[who[better]]
                best[at], last[at], back[at] = score[better], piece[better], length[better]
                node[who] = m.link[node[who]]
                who = who[node[who] > 0]
            # The end of a character that is no piece by itself.
            stop = begin[:n] + p + 1
            ends = (p + 1 == size[:n]) | ((data[np.minimum(stop, len(data) - 1)] & 0xC0) != 0x80)
            odd = np.flatnonzero(ends & ~alone)
            if len(odd):
                length = p + 1 - char[odd]
                score = best[here[odd] - length] + self.unknown
                better = score > best[here[odd]]
                at = here[odd[better]]
                best[at], last[at], back[at] = score[better], -1, length[better]
        return self._paths(segments, order, base, size, last, back)

    def _paths(self, segments, order, base, size, last, back) -> list[list[int]]:
        out: list = [None] * len(segments)
        for k, b, n in zip(order, base.tolist(), size.tolist(), strict=True):
            ids, p = [], n
            while p:
                piece, length = int(last[b + p]), int(back[b + p])
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += [int(self.byte_id[c]) for c in reversed(segments[k][p - length:p])]
                p -= length
            out[k] = ids[::-1]
        return out

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a batch of texts."""
        if len(self.index) > self.max_segments:
            self.clear()
        data, off = utf8(texts)
        parts: list[bytes] = []
        count = np.zeros(len(off) - 1, np.int64)
        for d in range(len(off) - 1):
            raw = data[off[d]:off[d + 1]].tobytes().replace(MARK, b" ")
            if raw:
                found = _SEGMENT.findall(b" " + raw)
                count[d] = len(found)
                parts += found
        row = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
        new, self.index.new = self.index.new, []
        for a in range(0, len(new), 20_000):  # bounded memory
            self.table.add(self.solve(new[a:a + 20_000]))
        size = self.table.size[row]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.table.start[row] - (ends - size), size)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        return self.table.ids[at], bounds.astype(np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The texts (UTF-8) of a batch of id sequences."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.bytes[np.arange(total) + np.repeat(self.start[ids] - (ends - size), size)].tobytes()
        cut = np.concatenate([[0], ends])[offsets].tolist()
        return [raw[a + 1:b] if b > a else b"" for a, b in zip(cut[:-1], cut[1:], strict=True)]


_CODECS: dict[int, Codec] = {}


def codec(model: bytes) -> Codec:
    """The worker's codec for a model (kept between tasks of the same worker)."""
    key = hash(model)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def encode_documents(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers) per row."""
    model = load_model(docs.sparkSession, model_path)

    def run(batches):
        c = codec(model.value)
        for b in small_batches(batches):
            ids, off = c.encode(b["text"])
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "ids": pa.array(
                [raw[4 * x:4 * y] for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, text of rows of ``encode_documents``."""
    model = load_model(encoded.sparkSession, model_path)

    def run(batches):
        c = codec(model.value)
        for b in small_batches(batches, "ids"):
            rows = [np.frombuffer(v or b"", "<u4") for v in b["ids"].to_pylist()]
            off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
            texts = c.decode(np.concatenate([np.zeros(0, np.uint32), *rows]).astype(np.int64), off)
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"],
                                              "text": pa.array([t.decode() for t in texts], pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (unsigned, of the 32-bit ids), decoded_sha256 and restored
    (the decoded text equals the text, space marks read as spaces) per row."""
    model = load_model(docs.sparkSession, model_path)

    def run(batches):
        c = codec(model.value)
        for b in small_batches(batches):
            ids, off = c.encode(b["text"])
            texts = c.decode(ids, off)
            data, at = utf8(b["text"])
            raw = memoryview(ids.astype("<u4")).cast("B")
            bounds = list(zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
            same = [t == data[at[d]:at[d + 1]].tobytes().replace(MARK, b" ") for d, t in enumerate(texts)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b["doc_id"], "n_tokens": np.diff(off),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in bounds], pa.int64()),
                "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                "restored": pa.array(same, pa.bool_())})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, restored boolean")
