"""Cross-tokenizer alignment against brute force over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gridmart.llm import token_alignment

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizers():
    """(A token ids and bytes, B token ids and bytes) of a text, or None where they do not join to it."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    byte = {c: i for i, c in enumerate(token_alignment.byte_alphabet())}
    name = {i: n for n, i in a.get_vocab().items()}

    def encode(text):
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in name[i]) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return None
        return ids_a, np.cumsum([len(x) for x in bytes_a]).tolist(), ids_b, np.cumsum([len(x) for x in bytes_b]).tolist()

    return encode


def _brute(rows, encode):
    found = []
    for doc, text in rows:
        got = encode(text)
        if got is None:
            found.append((doc, 0, 0, [], ""))
            continue
        a, ends_a, b, ends_b = got
        groups, pairs, i, j = [], [], 0, 0
        at_a, at_b = ({end: k + 1 for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = at_a[end], at_b[end]
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            pairs += [(a[x - 1], b[y - 1])]
            i, j = x, y
        found.append((doc, len(a), len(b), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    total = Counter(p for row in found for p in row[3])
    best = {}
    for (_, y), n in total.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(str((doc, n_a, n_b, len(pairs), len(pairs), sum(total[p] == best[p[1]] for p in pairs),
                       sum(total[p] for p in pairs), sha)) for doc, n_a, n_b, pairs, sha in found)


def _got(frame):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(str(tuple(r[c] for c in names)) for r in frame.collect())


def _strange(rng, n):
    letters = "ab cdXY  \n\n\t\r.,;:'!?-_()[]{}<>0123éÉüß×÷  　▁日本😀é\u0085\x0b\x1c|"
    parts = ["the", "ing", "é", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "'s", "'ll", ".\n", ",\r\n", "  ",
             "\n\n", " . ", ".\r", "');\r", " "]
    return ["".join(rng.choice(letters) if rng.random() < 0.6 else rng.choice(parts) for _ in range(rng.randrange(60)))
            for _ in range(n)]


def test_alignment(spark, documents, odd_rows, tokenizers):
    rng = random.Random(6)
    prose = ["The quick brown fox, " * k + "jumps." for k in range(12)]
    rows = [(k, t) for k, t in enumerate(_strange(rng, 600) + prose)] + odd_rows
    got = _got(token_alignment.align(documents(rows)))
    assert got == _brute(rows, tokenizers)


def test_batches_share_counts(spark, documents, tokenizers, monkeypatch):
    """Several batches a partition: counts are of the whole corpus."""
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choices(["alpha", "beta,", "gamma.", "naïve", "x1"], k=40))) for k in range(50)]
    whole = _got(token_alignment.align(documents(rows)))
    assert whole == _brute(rows, tokenizers)
    assert whole == _got(token_alignment.align(documents(rows).repartition(11)))


def test_empty_and_clashing_columns(spark, documents):
    assert token_alignment.align(documents([])).count() == 0
    rows = documents([(1, "one two"), (2, None)])
    extra = rows
    for name in ("grp", "pairs", "counts", "links", "n_a", "b", "total", "pair"):
        extra = extra.selectExpr("*", f"'clash' AS `{name}`")
    assert _got(token_alignment.align(extra)) == _got(token_alignment.align(rows))


def test_diagonal_groups():
    rng = random.Random(9)
    for _ in range(400):
        n = rng.randrange(0, 60)
        dense = rng.random()
        a = [k for k in range(1, n) if rng.random() < dense] + [n] * (n > 0)
        b = [k for k in range(1, n) if rng.random() < 0.9] + [n] * (n > 0)
        cut_a, cut_b = token_alignment.diagonal_groups(a, b)
        common = sorted(set(a) & set(b))
        assert cut_a.tolist() == [a.index(x) for x in common] and cut_b.tolist() == [b.index(x) for x in common]
    long = list(range(1, 100_000))
    cut_a, cut_b = token_alignment.diagonal_groups(long, long[:500] + long[501:])
    assert len(cut_a) == len(long) - 1 and cut_b[-1] == len(long) - 2
