"""Operator 5, personal data: base patterns and a character-level BiLSTM with CRF.

Base spans are those of the four patterns (leftmost, without overlap per kind, dropped when
they fail their check). The model is trained in numpy on windows around labelled spans: base
spans of a bounded sample of windows, with variants of them that the patterns miss (a phone
number without its country code, parts split by other signs, spaces around ``@``). A text
is cut into overlapping windows; each is decoded by the CRF's best path and a character takes
its tag from the window in whose middle it lies deepest, so spans are reconciled over the
whole text. A model span is added when it overlaps no base span and its kind's check holds.
Every kind needs a digit or ``@``, so windows without either hold no span and are not decoded.

Defined cases: a null or empty text has no span. Rows are independent, so repeated rows get
equal spans. Without any labelled span (an empty table) the model adds nothing.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.textops import small_batches

# The kinds in output order and their patterns.
KINDS = ["email", "ip", "card", "phone"]
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

WINDOW, STRIDE = 64, 32
SAMPLE_WINDOWS = 1800
_DOMAIN = re.compile(EMAIL.partition("@")[2])
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])" + IP)
_CARD = re.compile(CARD)
_PHONE = re.compile(PHONE)
_TRIGGER = re.compile(r"[0-9@]")
N_TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _valid_card(text: str) -> bool:
    d = _digits(text)
    return 13 <= len(d) <= 19 and luhn(d)


def _valid_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _emails(text: str):
    """(start, end) of the pattern's matches, found from each ``@`` in linear time: the local
    part is the run of its characters before the ``@`` (no earlier than the last match)."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _TRIGGER.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _valid_ip(m[0])]
        out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if _valid_card(m[0])]
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if _valid_phone(m[0])]
    return out


def _codes(text: str) -> np.ndarray:
    """Character classes: ASCII as itself, every other character 127; 0 pads."""
    raw = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.where((raw < 127) & (raw > 0), raw, 127).astype(np.int64)


class Tagger:
    """Embedding, one LSTM per direction, a linear layer and CRF transitions."""

    def __init__(self, hidden: int = 18, size: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        h, e = hidden, size
        self.h = h
        p = {"embed": rng.normal(0, 0.3, (128, e)), "out": rng.normal(0, 0.2, (2 * h, N_TAGS)),
             "bias": np.zeros(N_TAGS), "move": np.zeros((N_TAGS, N_TAGS))}
        for way in "fb":
            p["x" + way] = rng.normal(0, 1 / np.sqrt(e), (e, 4 * h))
            p["h" + way] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h)) * 0.5
            p["c" + way] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        # Transitions that break begin/inside order are impossible.
        self.allowed = np.zeros((N_TAGS, N_TAGS), np.float32)
        for a in range(N_TAGS):
            for k in range(len(KINDS)):
                if a not in (1 + 2 * k, 2 + 2 * k):
                    self.allowed[a, 2 + 2 * k] = -1e4

    def _lstm(self, x: np.ndarray, way: str, keep: bool):
        """x: time x batch x embedding. Hidden states (and what the gradient needs)."""
        p, h = self.p, self.h
        steps, n = x.shape[:2]
        pre = x @ p["x" + way] + p["c" + way]
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out, tape = np.empty((steps, n, h), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = pre[t] + state @ p["h" + way]
            g = 0.5 + 0.5 * np.tanh(0.5 * z[:, :3 * h])  # the logistic function, without overflow
            u = np.tanh(z[:, 3 * h:])
            before, old = state, cell
            cell = g[:, h:2 * h] * cell + g[:, :h] * u
            top = np.tanh(cell)
            state = g[:, 2 * h:] * top
            out[t] = state
            if keep:
                tape.append((t, g, u, old, top, before))
        return out, tape

    def _lstm_back(self, x, way, tape, d_out, grad):
        p, h = self.p, self.h
        n = x.shape[1]
        d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        d_pre = np.empty((x.shape[0], n, 4 * h), np.float32)
        for t, g, u, old, top, before in reversed(tape):
            d = d_out[t] + d_state
            i, f, o = g[:, :h], g[:, h:2 * h], g[:, 2 * h:]
            d_cell = d_cell + d * o * (1 - top * top)
            dz = np.concatenate([d_cell * u * i * (1 - i), d_cell * old * f * (1 - f),
                                 d * top * o * (1 - o), d_cell * i * (1 - u * u)], 1)
            d_pre[t] = dz
            grad["h" + way] += before.T @ dz
            d_state = dz @ p["h" + way].T
            d_cell = d_cell * f
        flat = d_pre.reshape(-1, 4 * h)
        grad["x" + way] += x.reshape(-1, x.shape[2]).T @ flat
        grad["c" + way] += flat.sum(0)
        return d_pre @ p["x" + way].T

    def scores(self, codes: np.ndarray, keep: bool = False):
        """Tag scores, time x batch x tags, of a time x batch matrix of character codes."""
        x = self.p["embed"][codes]
        f, tape_f = self._lstm(x, "f", keep)
        b, tape_b = self._lstm(x, "b", keep)
        both = np.concatenate([f, b], 2)
        return both @ self.p["out"] + self.p["bias"], (x, both, tape_f, tape_b)

    def gradient(self, codes: np.ndarray, tags: np.ndarray):
        """Gradient of the mean negative log-likelihood of the tag paths."""
        s, (x, both, tape_f, tape_b) = self.scores(codes, keep=True)
        steps, n, k = s.shape
        move = np.exp(self.p["move"] + self.allowed)
        emit = np.exp(s - s.max(2, keepdims=True))
        # Scaled forward and backward sums over all tag paths.
        alpha, scale = np.empty_like(s), np.empty((steps, n, 1), s.dtype)
        for t in range(steps):
            a = emit[t] if t == 0 else (alpha[t - 1] @ move) * emit[t]
            scale[t] = a.sum(1, keepdims=True)
            alpha[t] = a / scale[t]
        beta = np.ones_like(s)
        grad = {name: np.zeros_like(v) for name, v in self.p.items()}
        for t in range(steps - 2, -1, -1):
            after = emit[t + 1] * beta[t + 1] / scale[t + 1]
            beta[t] = after @ move.T
            grad["move"] += alpha[t].T @ after
        grad["move"] *= move
        d = alpha * beta
        np.subtract.at(d, (np.arange(steps)[:, None], np.arange(n)[None, :], tags), 1)
        np.subtract.at(grad["move"], (tags[:-1], tags[1:]), 1)
        d /= n
        grad["move"] /= n
        grad["out"] = both.reshape(-1, both.shape[2]).T @ d.reshape(-1, k)
        grad["bias"] = d.sum((0, 1))
        d_both = d @ self.p["out"].T
        dx = self._lstm_back(x, "f", tape_f, d_both[:, :, :self.h], grad)
        dx += self._lstm_back(x, "b", tape_b, d_both[:, :, self.h:], grad)
        one_hot = np.zeros((codes.size, len(grad["embed"])), np.float32)
        one_hot[np.arange(codes.size), codes.ravel()] = 1
        grad["embed"] = one_hot.T @ dx.reshape(-1, dx.shape[2])
        return grad

    def fit(self, codes: np.ndarray, tags: np.ndarray, epochs: int = 11, batch: int = 96, seed: int = 3) -> Tagger:
        """Adam over shuffled batches; codes and tags are examples x time."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        total = epochs * -(-len(codes) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for a in range(0, len(order), batch):
                step += 1
                pick = order[a:a + batch]
                grad = self.gradient(codes[pick].T, tags[pick].T)
                rate = 0.012 * (1 - step / (total + 1)) + 5e-4
                for k, g in grad.items():
                    g = np.clip(g, -5, 5)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - np.float32(rate) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tag path (time x batch) of a time x batch matrix of codes."""
        s, _ = self.scores(codes)
        move = self.p["move"] + self.allowed
        best, back = s[0], []
        for t in range(1, len(s)):
            trial = best[:, :, None] + move
            back.append(trial.argmax(1))
            best = trial.max(1) + s[t]
        path = [best.argmax(1)]
        rows = np.arange(codes.shape[1])
        for choice in reversed(back):
            path.append(choice[rows, path[-1]])
        return np.stack(path[::-1])


def _tags(length: int, spans) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, a, b in spans:
        a, b = max(a, 0), min(b, length)
        if a < b:
            tags[a:b] = 2 + 2 * kind
            tags[a] = 1 + 2 * kind
    return tags


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), WINDOW), np.int64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r[:WINDOW]
    return out


def _variant(kind: int, text: str, rng) -> str | None:
    """A form of a labelled span that the patterns miss."""
    if kind == 0:
        return text.replace("@", " @ ", 1)
    if kind == 2:
        d = _digits(text)
        return ".".join(d[k:k + 4] for k in range(0, len(d), 4))
    if kind == 3:
        d = _digits(text)[-10:]
        if len(d) < 9:
            return None
        a, b, c = d[:-7], d[-7:-4], d[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"][int(rng.integers(3))]
    return None


def training_set(windows: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 1):
    """(codes, tags) of labelled windows and of their variants."""
    rng = np.random.default_rng(seed)
    codes, tags = [], []
    for text, spans in windows:
        codes.append(_codes(text))
        tags.append(_tags(len(text), spans))
        for kind, a, b in spans[:1]:
            other = _variant(kind, text[a:b], rng)
            if other and 0 <= a and b <= len(text):
                changed = text[:a] + other + text[b:]
                codes.append(_codes(changed))
                tags.append(_tags(len(changed), [(kind, a, a + len(other))]))
    return _padded(codes), _padded(tags)


def labelled_windows(docs: DataFrame, limit: int = SAMPLE_WINDOWS) -> list:
    """At most ``limit`` windows around digits or ``@``, those of the lowest content hash,
    half of them with a span if there are as many."""

    def run(batches):
        best: dict[bool, list] = {True: [], False: []}
        for b in small_batches(batches):
            for text in b["text"].to_pylist():
                spans = base_spans(text) if text else []
                at = -WINDOW
                for m in _TRIGGER.finditer(text or ""):
                    if m.start() < at + WINDOW:
                        continue
                    seed = hashlib.blake2b(text[m.start():m.start() + 24].encode(), digest_size=7).digest()
                    order = int.from_bytes(seed, "big")
                    at = max(0, m.start() - 6 - order % 30)
                    inside = [(k, a - at, e - at) for k, a, e in spans if a < at + WINDOW and e > at]
                    best[bool(inside)].append((order, text[at:at + WINDOW], str(sorted(inside, key=lambda s: s[1]))))
            best = {k: sorted(set(v))[:limit] for k, v in best.items()}
        rows = [(k, *x) for k, v in best.items() for x in v]
        yield pa.RecordBatch.from_pydict({
            "found": pa.array([r[0] for r in rows], pa.bool_()), "rank": pa.array([r[1] for r in rows], pa.int64()),
            "text": pa.array([r[2] for r in rows], pa.string()), "spans": pa.array([r[3] for r in rows], pa.string())})

    rows = docs.select("text").mapInArrow(run, "found boolean, rank long, text string, spans string")
    out = []
    for found in (True, False):
        out += rows.filter(F.col("found") == F.lit(found)).orderBy("rank", "text", "spans").limit(limit // 2).collect()
    pattern = re.compile(r"\((\d+), (-?\d+), (\d+)\)")
    return [(r.text, [tuple(map(int, m.groups())) for m in pattern.finditer(r.spans)]) for r in out]


def train(docs: DataFrame) -> dict | None:
    """The fitted weights (a few thousand numbers), or None without a labelled span."""
    windows = labelled_windows(docs)
    if not any(s for _, s in windows):
        return None
    return Tagger().fit(*training_set(windows)).p


def _windows_of(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or ``@``."""
    starts: list[int] = []
    last = -1
    for m in _TRIGGER.finditer(text):
        k = m.start() // STRIDE
        for j in (k - 1, k):
            if j > last and j >= 0:
                starts.append(j * STRIDE)
                last = j
    return starts


def _model_spans(tagger: Tagger, texts: list[str], batch: int = 256) -> list[list[tuple[int, int, int]]]:
    """Spans of every text, reconciled over its overlapping windows."""
    jobs = [(d, a) for d, t in enumerate(texts) for a in _windows_of(t)]
    votes: dict[int, list[tuple[int, np.ndarray]]] = {}
    for k in range(0, len(jobs), batch):
        part = jobs[k:k + batch]
        paths = tagger.decode(_padded([_codes(texts[d][a:a + WINDOW]) for d, a in part]).T).T
        for (d, a), path in zip(part, paths, strict=True):
            votes.setdefault(d, []).append((a, np.asarray(path[:len(texts[d]) - a], np.int64)))
    tags: dict[int, dict[int, tuple[int, int]]] = {}
    for d, windows in votes.items():
        if not any(path.any() for _, path in windows):
            continue
        # Every window votes at every character that it covers, "outside" too; the one in which
        # the character lies deepest decides (the earlier of two).
        deepest = np.full(len(texts[d]), -1, np.int64)
        chosen = np.zeros(len(texts[d]), np.int64)
        for a, path in windows:
            at = np.arange(len(path))
            depth = np.minimum(at if a else WINDOW, WINDOW - at)
            better = depth > deepest[a:a + len(path)]
            deepest[a:a + len(path)][better] = depth[better]
            chosen[a:a + len(path)][better] = path[better]
        tags[d] = {pos: (0, int(chosen[pos])) for pos in np.flatnonzero(chosen).tolist()}
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, own in tags.items():
        spans = out[d]
        for pos in sorted(own):
            tag = own[pos][1]
            if not tag:
                continue
            kind = (tag - 1) // 2
            if tag % 2 == 0 and spans and spans[-1][0] == kind and spans[-1][2] == pos:
                spans[-1] = (kind, spans[-1][1], pos + 1)
            else:
                spans.append((kind, pos, pos + 1))
    return out


def _acceptable(kind: int, text: str) -> bool:
    if kind == 0:
        return re.fullmatch(r"\S+ ?@ ?\S+\.\S+", text) is not None
    if kind == 1:
        return _IP.fullmatch(text) is not None and _valid_ip(text)
    if not re.fullmatch(r"\+?[\x20().0-9-]+", text):
        return False
    return _valid_card(text) if kind == 2 else _valid_phone(text) and len(re.findall(r"[().-]", text)) > 0


def _all_spans(texts: list[str], tagger: Tagger | None):
    """(base spans, base and added spans by kind then start) per text."""
    base = [base_spans(t) for t in texts]
    added = _model_spans(tagger, texts) if tagger else [[] for _ in texts]
    both = []
    for text, own, more in zip(texts, base, added, strict=True):
        spans = list(own)
        for kind, a, b in more:
            while a < b and text[a].isspace():
                a += 1
            while a < b and text[b - 1].isspace():
                b -= 1
            if _acceptable(kind, text[a:b]) and not any(a < e and s < b for _, s, e in spans):
                spans.append((kind, a, b))
        both.append(sorted(spans))
    return base, both


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _loaded(weights: dict | None) -> Tagger | None:
    if weights is None:
        return None
    tagger = Tagger()
    tagger.p = weights
    return tagger


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, base_sha256, spans (base and added), n_added per row."""
    weights = train(docs)

    def run(batches):
        tagger = _loaded(weights)
        for b in small_batches(batches):
            base, both = _all_spans([t or "" for t in b["text"].to_pylist()], tagger)
            out = {"doc_id": b["doc_id"]}
            for k, name in enumerate(KINDS):
                out["n_" + name] = pa.array([sum(s[0] == k for s in own) for own in base], pa.int64())
            out["base_sha256"] = pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base], pa.string())
            out["spans"] = pa.array([_joined(s) for s in both], pa.string())
            out["n_added"] = pa.array([len(s) - len(o) for o, s in zip(base, both, strict=True)], pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def _masked(text: str | None, spans) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind, e.g. ``<EMAIL>``; other
    columns unchanged, a null text stays null."""
    weights = train(docs)
    names = docs.columns

    def run(batches):
        tagger = _loaded(weights)
        for b in small_batches(batches):
            texts = b["text"].to_pylist()
            _, both = _all_spans([t or "" for t in texts], tagger)
            clean = pa.array([_masked(t, s) for t, s in zip(texts, both, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([clean if c == "text" else b[c] for c in names], names=names)

    return docs.mapInArrow(run, docs.schema)
