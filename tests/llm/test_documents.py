"""Document operators against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from gridmart.llm import (hmm_lm, minhash_dedup, packing, pii, quality_classifier, quality_rules,
                          sentencepiece_viterbi, substring_dedup, token_files, token_ids)
from gridmart.llm.scratch import shared_dir

WORD = re.compile("[^\x20\x09-\x0D]+")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture()
def corpus():
    rng = random.Random(4)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, rng.randrange(5, 200))) for i in range(40)]
    rows += [(100 + i, prose(rng, 30) + " " + shared + "\n" + prose(rng, 20)) for i in range(6)]
    base = prose(rng, 150)
    for i in range(12):
        words = base.split()
        for _ in range(i % 5):
            words[rng.randrange(150)] = f"edit{i}"
        rows.append((200 + i, " ".join(words)))
    return rows


def test_substring_dedup(documents, corpus, odd_rows):
    rows = corpus + odd_rows
    got = substring_dedup.repeated_spans(documents(rows)).collect()
    last = 2**63
    first = {}
    for i, t in sorted(rows, key=lambda r: last if r[0] is None else r[0]):
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), last if i is None else i)
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < (last if i is None else i):
                gone[k:k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((str(i), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    assert any(r.n_removed for r in got)
    cleaned = substring_dedup.remove_repeats(documents(rows))
    assert cleaned.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    digests = sorted(hashlib.sha256(" ".join(WORD.findall(r.text or "")).encode()).hexdigest() for r in cleaned.collect())
    assert digests == sorted(w[3] for w in want)


def test_quality_rules(documents, corpus, odd_rows):
    rows = corpus + odd_rows + [(300, "a b c " * 30), (301, "l one\nl one\n\nl one"), (302, "#a |b <c> " * 20)]
    led = quality_rules.apply_policy(quality_rules.ledger(documents(rows)))
    want = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((str(i), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                     len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    got = led.collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                   r.base_failed) for r in got) == sorted(want)
    assert all(not r.kept for r in got if r.base_failed)
    kept = quality_rules.keep_documents(documents(rows))
    assert kept.count() == sum(r.kept for r in got)
    report = {r.rule: r for r in quality_rules.ablation(led).collect()}
    alone = Counter(r.failed_bits for r in got)
    for k, rule in enumerate(quality_rules.RULES):
        assert report[rule].rejected == sum(r.failed_bits >> k & 1 for r in got)
        assert report[rule].rejected_alone == alone[1 << k]


def test_hmm_base_score_and_exact_likelihood(documents, corpus, odd_rows):
    rows = [(i, (t or "").upper() if i and i % 3 == 0 else t) for i, t in corpus + odd_rows]
    got = hmm_lm.score(documents(rows)).collect()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(i, [*WORD.findall((t or "").translate(fold)), None]) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in tokens if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(t), sum(c[w] > 0 for w in t), n, sum(log10((c[w] + 1) / (n + v + 1)) for w in t))
                  for i, t in tokens)
    have = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [w[:4] for w in want] == [h[:4] for h in have]
    assert np.allclose([w[4] for w in want], [h[4] for h in have])
    assert all(np.isfinite(r.score) for r in got)
    # The scaled forward recursion equals the sum over all state paths.
    model = hmm_lm.Model.initial(1)
    seq = np.array([3, 700, hmm_lm.CLASSES])
    total = 0.0
    for path in np.ndindex(*([hmm_lm.STATES] * 3)):
        p = model.start[path[0]] * model.emit[path[0], seq[0]]
        for a, b, x in zip(path, path[1:], seq[1:], strict=False):
            p *= model.move[a, b] * model.emit[b, x]
        total += p
    assert np.isclose(hmm_lm.log10_likelihood(model, seq, np.array([0, 3]))[0], log10(total))


def test_baum_welch_never_lowers_the_likelihood():
    rng = np.random.default_rng(0)
    seqs = [rng.integers(0, 50, rng.integers(1, 40)) + 100 * (k % 2) for k in range(60)]
    flat, off = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    model, before = hmm_lm.Model.initial(), -np.inf
    for _ in range(6):
        now = hmm_lm.log10_likelihood(model, flat, off).sum()
        assert now > before - 1.0  # the small prior may cost a little
        before = now
        model = hmm_lm.Model.from_counts(hmm_lm.expected_counts(model, flat, off, np.ones(60, bool)))


def test_expected_counts_equal_brute_force():
    rng = np.random.default_rng(3)
    model = hmm_lm.Model.initial(2)
    seqs = [rng.integers(0, 9, n) for n in (3, 1, 4)]
    flat, off = np.concatenate(seqs), np.array([0, 3, 4, 8])
    k, cells = hmm_lm.STATES, model.emit.shape[1]
    want, like = np.zeros(k + k * k + k * cells), 0.0
    for i, seq in enumerate(seqs):
        paths = np.array(list(np.ndindex(*([k] * len(seq)))))
        p = model.start[paths[:, 0]] * model.emit[paths, seq].prod(1) * model.move[paths[:, :-1], paths[:, 1:]].prod(1)
        like, p = like + np.log10(p.sum()), p / p.sum()
        if i != 1:  # the second sequence does not open its text
            np.add.at(want, paths[:, 0], p)
        for t in range(len(seq)):
            np.add.at(want, k + k * k + paths[:, t] * cells + seq[t], p)
            if t:
                np.add.at(want, k + paths[:, t - 1] * k + paths[:, t], p)
    got = hmm_lm._expected(model, flat, off, np.array([True, False, True]))
    assert np.allclose(got[0], want) and np.isclose(got[1], like)


def test_expected_counts_of_long_sequences_of_unlikely_words():
    rng = np.random.default_rng(4)
    model = hmm_lm.Model.initial(3)
    model.emit[:, :40] *= 1e-20
    seqs = [rng.integers(0, 60, n) for n in (100, 17, 16, 15, 9, 8, 7, 1, 100)]
    flat, off = np.concatenate(seqs), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    k, cells = hmm_lm.STATES, model.emit.shape[1]
    want = np.zeros(k + k * k + k * cells)
    for seq in seqs:  # every step scaled
        alpha, scale = [], []
        for t, x in enumerate(seq):
            now = (alpha[-1] @ model.move if t else model.start) * model.emit[:, x]
            scale.append(now.sum())
            alpha.append(now / scale[-1])
        beta = np.ones(k)
        for t in range(len(seq) - 1, -1, -1):
            want[k + k * k + np.arange(k) * cells + seq[t]] += alpha[t] * beta
            if t:
                after = model.emit[:, seq[t]] * beta / scale[t]
                want[k:k + k * k] += (alpha[t - 1][:, None] * model.move * after).ravel()
                beta = model.move @ after
        want[:k] += alpha[0] * beta
    got = hmm_lm._expected(model, flat, off, np.ones(len(seqs), bool))
    assert np.allclose(got[0], want, rtol=1e-10, atol=1e-12)
    assert np.isclose(got[1], hmm_lm.log10_likelihood(model, flat, off).sum(), rtol=1e-12)


def test_hmm_counts_travel_in_the_bytes_that_they_need():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 1 << 16, (3000, hmm_lm.STATES))
    rows[2500, 3] = 1 << 50  # one slice needs all its bytes
    cuts = np.array([0, 1000, 1000, 2000, 3000])
    packed = hmm_lm._packed_rows(rows, cuts)
    assert np.array_equal(hmm_lm._unpacked_rows(pa.chunked_array([packed])), rows)
    assert [len(v.as_py()) for v in packed] == [1 + hmm_lm.STATES * n for n in (2000, 0, 2000, 7000)]


def test_hmm_groups_are_coded_once_and_never_shuffled_again(documents):
    rows = [(i, f"a{i % 7} b c{i}") for i in range(40)]
    got = hmm_lm.score(documents(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "text#" not in plan  # only the answers move
    assert sorted(r.doc_id for r in got.collect()) == list(range(40))


def alternating(rng, n, vocabulary):
    """Words of two sets in turn, the first of each set the most frequent."""
    return " ".join(f"{'ab'[k % 2]}{int(vocabulary * rng.random() ** 2)}" for k in range(n))


def held_out_gain(rows):
    """log10 a token that the model's score of the held-out texts is above the base score."""
    rows = [r for r in rows if r.held_out]
    return sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)


def test_hmm_tells_words_apart_in_a_large_vocabulary(documents):
    rng = random.Random(5)
    got = hmm_lm.score(documents([(i, alternating(rng, 300, 3000)) for i in range(600)])).collect()
    # The states know the set of the next word, worth log10(2); sets share no words, only hash buckets.
    assert held_out_gain(got) > 0.25


def test_hmm_rounds_cover_all_texts_until_the_likelihood_settles(documents, monkeypatch):
    rng, seen, sums = random.Random(6), [], hmm_lm._sums
    monkeypatch.setattr(hmm_lm, "_sums", lambda answers: seen.append(sums(answers)) or seen[-1])
    rows = [(i, "copy " * 300) for i in range(60)] + [(100 + i, alternating(rng, 100, 200)) for i in range(60)]
    got = hmm_lm.score(documents(rows)).collect()
    assert {s.n for s in seen} == {got[0].train_tokens}
    ends = [s.likelihood for s in seen[1:]]  # the first sums are those of the start
    gains = [(b - a) / abs(a) for a, b in zip(ends, ends[1:], strict=False)]
    assert gains[-1] <= 1e-4 < min(gains[:-1])


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def test_minhash_components(documents, corpus, odd_rows):
    rows = corpus + odd_rows
    got = {}
    for r in minhash_dedup.near_duplicates(documents(rows)).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    shingles = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        if w and i is not None:
            shingles[i] = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(shingles)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if weighted_jaccard(shingles[a], shingles[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {i: got[i] for i in root if i is not None} == {i: {find(i)} for i in root if i is not None}
    kept = minhash_dedup.keep_documents(documents(rows)).collect()
    assert len(kept) == len({find(i) for i in root if i is not None}) + 1  # and the null id


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    universe = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = universe[:2000], universe[400:2400]
    doc = np.repeat([0, 1], 2000)
    s = minhash_dedup.dart_signatures(doc, np.concatenate([a, b]), 3, k=2000)
    assert abs((s[0] == s[1]).mean() - 1600 / 2400) < 0.04
    assert not s[2].any()


def test_pii(documents, odd_rows):
    rng = random.Random(2)
    rows = list(odd_rows)
    for i in range(60):
        rows.append((100 + i, f"{prose(rng, 12)} mail{i}@host{i}.example.com {prose(rng, 5)} +1 ({200 + i}) 555-{1000 + i} "
                              f"{prose(rng, 9)} 10.0.{i}.300 10.1.{i}.9 x 4111 1111 1111 1111 a.b@c.d_e@f.g"))
    got = pii.find(documents(rows)).collect()
    by_id = {(str(r.doc_id), r.base_sha256) for r in got}
    checks = [lambda m: True, pii._valid_ip, pii._valid_card, pii._valid_phone]
    for i, t in rows:
        want = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in
                zip(pii.KINDS, (pii.EMAIL, pii.IP, pii.CARD, pii.PHONE), checks, strict=True)
                for m in re.finditer(p, t or "") if ok(m[0])]
        assert (str(i), hashlib.sha256(",".join(want).encode()).hexdigest()) in by_id
    row = next(r for r in got if r.doc_id == 130)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (3, 1, 1, 1)
    assert set(row.spans.split(",")) >= {"ip:" + s.split("ip:")[1] for s in row.spans.split(",") if s.startswith("ip:")}
    masked = {r.doc_id: r.text for r in pii.mask(documents(rows)).collect()}
    assert "<EMAIL>" in masked[130] and "555-" not in masked[130] and masked[501] is None


def test_tagger_gradient():
    tagger = pii.Tagger(hidden=3, size=2)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(1, 128, (5, 4)), np.array([[0, 1, 0, 3], [0, 2, 1, 4], [1, 2, 2, 0], [2, 0, 0, 1], [0, 0, 5, 2]])
    tags = np.where(tags == 0, 0, tags)
    tagger.allowed = np.zeros_like(tagger.allowed)

    def loss():
        s, _ = tagger.scores(codes)
        total = 0.0
        for b in range(4):
            f = s[0, b]
            path = s[0, b, tags[0, b]]
            for t in range(1, 5):
                f = np.log(np.exp(f[:, None] + tagger.p["move"]).sum(0)) + s[t, b]
                path += tagger.p["move"][tags[t - 1, b], tags[t, b]] + s[t, b, tags[t, b]]
            total += np.log(np.exp(f).sum()) - path
        return total / 4

    grad = tagger.gradient(codes, tags)
    for name in ("xf", "hb", "out", "move", "bias"):
        at = tuple(d // 2 for d in tagger.p[name].shape)
        start = tagger.p[name][at]
        tagger.p[name][at] = start + 1e-4
        up = loss()
        tagger.p[name][at] = start - 1e-4
        down = loss()
        tagger.p[name][at] = start
        assert np.isclose((up - down) / 2e-4, grad[name][at], atol=2e-4), name


def test_sentencepiece_against_library(documents, odd_rows):
    import sentencepiece

    with open(sentencepiece_viterbi.default_model(), "rb") as f:
        raw = f.read()
    at = raw.rfind(b"\x18\x02 \x80\xfa\x01")  # the model kind: 2 is BPE, 1 is unigram
    unigram = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2:])
    codec = sentencepiece_viterbi.Codec(raw)
    rng = random.Random(1)
    letters = "abcdehiorstéß日 ,.☃"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(120)] + ["the", "hello world"]
    ids, off = codec.encode(pa.array(texts))
    for d, t in enumerate(texts):
        mine = ids[off[d]:off[d + 1]].tolist()
        best = unigram.nbest_encode(t, nbest_size=1)[0]
        assert sum(codec.score[mine]) >= sum(codec.score[best]) - 1e-6, t
    assert [x.decode() for x in codec.decode(ids, off)] == texts
    got = sentencepiece_viterbi.round_trip(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(r.restored for r in got)
    encoded = sentencepiece_viterbi.encode_documents(documents(odd_rows))
    back = sentencepiece_viterbi.decode_documents(encoded).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in odd_rows)


def token_lists(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids + [1] for e in t.encode_batch([x or "" for _, x in rows], add_special_tokens=False)]


def test_token_files_round_trip(spark, documents, corpus, odd_rows):
    rows = corpus + odd_rows + [(900, "It's <|endoftext|>x A,b.C é1Σ don't ÀB. ﬁ İstanbul")]
    path = f"{shared_dir(spark)}/test-token-files"
    token_files.write_token_files(documents(rows), path)
    got = token_files.read_token_files(spark, path, with_ids=True).collect()
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == sorted(
        (str(i), np.array(x, "<u4").tobytes()) for (i, _), x in zip(rows, token_lists(rows), strict=True))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])


def test_rank_codes():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    for n in range(len(values) + 1):
        control, data = token_files.pack_ranks(values[:n])
        assert (token_files.unpack_ranks(control, data, n) == values[:n]).all()


def test_packing(documents, corpus, odd_rows):
    rows = corpus + odd_rows
    got = packing.pack_documents(documents(rows)).collect()
    lists = {}
    for (i, _), x in zip(rows, token_lists(rows), strict=True):
        lists.setdefault(i, []).append(x)
    bins = {}
    for r in got:
        assert any(zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                   for x in lists[r.doc_id]) and r.start == 4096 * r.piece
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(got) == sum(-(-len(x) // 4096) for v in lists.values() for x in v)
    rng = random.Random(0)
    for _ in range(30):
        sizes = [rng.randrange(1, 101) for _ in range(rng.randrange(1, 200))]
        left = []
        for s in sorted(sizes, reverse=True):  # one by one
            fit = min((x for x in left if x >= s), default=None)
            left.append((100 if fit is None else fit) - s)
            if fit is not None:
                left.remove(fit)
        slots = packing.plan_slots(dict(Counter(sizes)), 100)
        assert max(f + n for _, _, n, f, _ in slots) == len(left)


def test_quality_classifier_held_out(spark, documents):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        words = prose(rng, 60, 300).split()
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words])))
        labels.append((i, int(good), 0))
    rows += [(1000, None), (1001, "")]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_classifier.classify(documents(rows), table).collect()
    assert len(got) == 302 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 300]
    assert held and np.mean([r.predicted == (r.doc_id % 3 > 0) for r in held]) > 0.95
    none = quality_classifier.classify(documents(rows[:5]), table.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_empty_tables(spark, documents):
    empty = documents([(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for frame in (substring_dedup.repeated_spans(empty), substring_dedup.remove_repeats(empty),
                  quality_rules.ledger(empty), quality_rules.keep_documents(empty), hmm_lm.score(empty),
                  minhash_dedup.near_duplicates(empty), minhash_dedup.keep_documents(empty), pii.find(empty),
                  pii.mask(empty), sentencepiece_viterbi.round_trip(empty), token_files.token_file_digest(empty),
                  packing.pack_documents(empty), quality_classifier.classify(empty, labels)):
        assert frame.count() == 0


def test_remove_repeats_keeps_clashing_columns(spark, documents, corpus):
    docs = documents(corpus).selectExpr("*", "doc_id * 7 AS grp", "'b' AS bucket", "'k' AS `keys`", "lang AS `a.b`")
    plain = {r.doc_id: r.text for r in substring_dedup.remove_repeats(documents(corpus)).collect()}
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        assert (r.grp, r.bucket, r["keys"], r["a.b"], r.text) == (r.doc_id * 7, "b", "k", "en", plain[r.doc_id])


def test_pii_deepest_window_decides():
    """A window's "outside" counts as much as its tags."""
    class Stub:
        def decode(self, codes):
            out = np.zeros(codes.shape, np.int64)
            if codes.shape[1] > 1:
                out[pii.STRIDE + 6 - pii.STRIDE, 1] = 1  # the second window tags a character near its start
            return out

    text = "1" * (pii.WINDOW + pii.STRIDE)
    assert pii._windows_of(text)[:2] == [0, pii.STRIDE]
    assert pii._model_spans(Stub(), [text]) == [[]]


def test_classifier_learns_one_row_of_a_repeated_id(spark, documents):
    rng = random.Random(12)
    rows = [(i, prose(rng, 30)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    extra = [(7, "zzz " * 30)] * 50  # repeats of one id, all after its own text
    a, b = (quality_classifier.train(documents(r), labels, quality_classifier.context_vectors(documents(rows)))
            for r in (rows, rows + extra))
    x = np.random.default_rng(1).normal(size=(5, len(a.mean)))
    assert np.allclose(a.probability(x), b.probability(x))


def test_near_dedup_deletes_its_tables(spark, documents, corpus):
    import glob

    folder = shared_dir(spark).removeprefix("file:").rstrip("/")
    before = set(glob.glob(f"{folder}/*"))
    kept = minhash_dedup.keep_documents(documents(corpus))
    new = set(glob.glob(f"{folder}/*")) - before
    assert len(new) == 1 and "gone-or-repeated" in new.pop()
    assert kept.count() == kept.select("doc_id").distinct().count() < len(corpus)


def test_word_encoder_cache_takes_few_bytes_a_word_and_keeps_words_apart(monkeypatch):
    """The cache held Python objects of some 300 bytes a word; ids stay the library's, also
    where first hashes collide and after the cache is cleared."""
    text = " ".join(f"kep{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)}"
                    for k in range(40_000))
    with open(token_ids.default_vocabulary(), encoding="utf-8") as f:
        vocabulary = f.read()
    enc = token_ids.WordEncoder(vocabulary)
    enc.encode(pa.array(["a"]))
    tracemalloc.start()
    for k in range(0, len(text), 8_000 * 8):
        enc.encode(pa.array([text[k:k + 8_000 * 8]]))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 40_000 * 120

    texts = ["one two two. Two, \tone", None, "", "don't ÀÉ. 日本 😀 </s> <|endoftext|> İstanbul " + text[:80], " two\n"]
    expect = [[*(enc.tokenizer.encode(t or "", add_special_tokens=False).ids), 1] for t in texts]
    for hashes in (token_ids.span_hashes, lambda raw, a, b, *second: real(raw, a, b, *second) * np.uint64(bool(second))):
        real = token_ids.span_hashes
        monkeypatch.setattr(token_ids, "span_hashes", hashes)
        enc = token_ids.WordEncoder(vocabulary, max_words=6)
        for _ in range(3):
            ids, off = enc.encode(pa.array(texts))
            assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == expect
        monkeypatch.setattr(token_ids, "span_hashes", real)
