import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkloom.llm import lm_score, toxicity

from . import cases

INSULTS = ["grumblefrog", "snotwit", "dunderpate", "Übelkopf"]


def toxic_corpus(spark, n=300):
    rows, labels = [], []
    for i in range(n):
        words = cases.prose(20_000 + i, 80).split()
        toxic = i % 4 == 0
        if toxic:
            for k in range(3):
                words[(i * 7 + k * 23) % 80] = [INSULTS[(i + k) % 4], INSULTS[(i + k) % 4].upper() + "!!"][i % 2]
        rows.append((1000 + i, " ".join(words), "en", "src0"))
        labels.append((1000 + i, 1, int(toxic)))
    labels += [(1000, 1, 1), (None, 1, 1), (1001, 1, None), (99_999, 0, 0)]
    return cases.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {d: t for d, _, t in labels[:n]}


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    odds, moves = rng.standard_normal(9) * 2, np.array([[0.0, -0.7], [0.4, 1.1]])
    edges = np.array([0, 4, 4, 9])
    got = toxicity.marginals(odds, edges, moves)
    pairs = np.zeros(3)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        n = b - a
        if not n:
            continue
        total, mass, edge = 0.0, np.zeros(n), np.zeros(3)
        for state in range(2**n):
            y = [state >> i & 1 for i in range(n)]
            w = math.exp(sum(odds[a + i] * y[i] for i in range(n)) + sum(moves[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            mass += w * np.array(y)
            for i in range(n - 1):
                edge += w * np.array([y[i : i + 2] == [0, 1], y[i : i + 2] == [1, 0], y[i : i + 2] == [1, 1]])
        assert got[a:b] == pytest.approx(mass / total)
        pairs += edge / total
    inside = np.array([1, 2, 3, 5, 6, 7, 8])
    assert toxicity.pair_marginals(odds, got, inside, moves) == pytest.approx(pairs.tolist())


def test_toxicity_holds_out_and_finds_spans(spark):
    docs, labels, truth = toxic_corpus(spark)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect() if r.doc_id is not None}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc, label in truth.items():
        assert got[doc].held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert got[doc].predicted == label, (doc, got[doc].score)
        for s in got[doc].spans:
            assert texts[doc][s.start : s.end].lower() in {x.lower() for x in INSULTS} | {x.upper().lower() for x in INSULTS}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[200].predicted == got[201].predicted == 0
    assert got[200].score == got[201].score == got[202].score


def brute_toxicity(model, text):
    """The document score by a plain walk: features from a dictionary, marginals from sums over forward and backward messages."""
    weights = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    words = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")
    hashes = [int(toxicity.tokens_of(toxicity.text_slices([w])[0])[3][0]) for w in words]
    odds = []
    for i in range(len(words)):
        before = np.uint64(hashes[i - 1]) if i else toxicity.EDGE
        after = np.uint64(hashes[i + 1]) if i + 1 < len(words) else toxicity.EDGE
        keys = (hashes[i], int(toxicity.mix(np.array([before + toxicity.ROLE_SALT[1]]))[0]), int(toxicity.mix(np.array([after + toxicity.ROLE_SALT[2]]))[0]))
        odds.append(model.bias + sum(weights.get(k, 0.0) for k in keys))
    forward, backward = [], [(0.0, 0.0)] * len(words)
    for i, o in enumerate(odds):
        own = (0.0, o)
        forward.append(own if not i else tuple(own[b] + np.logaddexp(forward[-1][0] + model.moves[0, b], forward[-1][1] + model.moves[1, b]) for b in (0, 1)))
    for i in range(len(words) - 2, -1, -1):
        backward[i] = tuple(np.logaddexp(model.moves[a, 0] + backward[i + 1][0], model.moves[a, 1] + odds[i + 1] + backward[i + 1][1]) for a in (0, 1))
    p = [1 / (1 + math.exp(min(700, f[0] + b[0] - f[1] - b[1]))) for f, b in zip(forward, backward, strict=True)]
    x = (1.0, math.log1p(sum(v for v in p if v > 0.05)), max(p, default=0.0))
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.document.tolist(), strict=True))))


def test_toxicity_scores_equal_brute_force(spark):
    docs, labels, _ = toxic_corpus(spark, 120)
    model = toxicity.train(docs, labels)
    rows = docs.where("length(text) < 5000 OR text IS NULL").collect()
    want = sorted((repr(r.doc_id), round(brute_toxicity(model, r.text), 9)) for r in rows)
    got = toxicity.score_documents(docs.where("length(text) < 5000 OR text IS NULL"), labels, model=model).collect()
    assert [g for g, _ in want] == [g for g, _ in sorted((repr(r.doc_id), r.score) for r in got)]
    assert sorted((repr(r.doc_id), r.score) for r in got) == [(d, pytest.approx(v, abs=1e-8)) for d, v in want]


def test_sample_keeps_its_bounds(spark):
    docs, labels, _ = toxic_corpus(spark, 120)
    seen = {}
    own = toxicity.fit
    try:
        toxicity.fit = lambda texts, toxic, totals, bounds_: seen.update(n=(int(toxic.sum()), int((~toxic).sum())), bytes=sum(len(t.encode()) for t in texts), totals=totals) or own(texts, toxic, totals, bounds_)
        for bounds_ in (toxicity.Fit(toxic=5, clean=9), toxicity.Fit(bytes=4000)):
            toxicity.train(docs, labels, bounds_)
            assert seen["n"][0] <= bounds_.toxic and seen["n"][1] <= bounds_.clean and 0 < seen["bytes"] <= bounds_.bytes
            assert seen["totals"][0] + seen["totals"][1] > 80
    finally:
        toxicity.fit = own


def test_long_texts_count_to_their_end(spark):
    docs, labels, _ = toxic_corpus(spark)
    long = cases.prose(3, 50_000) + " grumblefrog snotwit dunderpate"
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(5, long)], "doc_id long, text string").where("doc_id = 5"))
    row = [r for r in toxicity.score_documents(more, labels).collect() if r.doc_id == 5 and r.predicted]
    assert row and long[row[0].spans[-1].start : row[0].spans[-1].end].endswith("dunderpate")


def test_toxicity_stage_and_degenerate_labels(spark):
    docs, labels, truth = toxic_corpus(spark)
    out = toxicity.clean_documents(docs, labels)
    assert out.schema.simpleString() == docs.schema.simpleString()
    gone = {d for d, t in truth.items() if t}
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(repr(r.doc_id) for r in docs.collect() if r.doc_id not in gone)
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        assert len({r.score for r in toxicity.score_documents(docs, few).collect()}) == 1
    for job in (toxicity.score_documents, toxicity.clean_documents):
        assert job(cases.empty(spark), labels).count() == 0


def tokens(text):
    up = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(up)), None]


@pytest.mark.parametrize("head", [None, 600])
def test_scores_equal_brute_force(spark, monkeypatch, head):
    if head:
        monkeypatch.setattr(lm_score, "HEAD", head)
    docs = cases.documents(spark, [(700 + i, "The same words again, the SAME words.", "en", "a") for i in range(20)])
    rows = docs.collect()
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2 for r in rows]
    count = Counter(w for r, h in zip(rows, held, strict=True) if not h for w in tokens(r.text))
    total, distinct = sum(count.values()), len(count)
    want = defaultdict(list)
    for r, h in zip(rows, held, strict=True):
        t = tokens(r.text)
        want[r.doc_id].append((h, len(t), sum(count[w] > 0 for w in t), total, sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t)))
    got = lm_score.score_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any((r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4] and r.base_score == pytest.approx(w[4], rel=1e-9) for w in want[r.doc_id])
        assert r.score < 0
    assert sum(r.score for r in got if r.doc_id and r.doc_id >= 700) > sum(r.base_score for r in got if r.doc_id and r.doc_id >= 700)


def test_model_scores_equal_brute_force(spark, monkeypatch):
    """log10 probabilities of texts, token by token from the vectors: a softmax among brothers at each level, then add-one in a bucket."""
    monkeypatch.setattr(lm_score, "HEAD", 300)
    docs = spark.createDataFrame([(i, cases.prose(i % 9, 40) + f" own{i}") for i in range(60)] + [(900, None), (901, "Unseen WORDS only,")], "doc_id long, text string").coalesce(2)
    counts = lm_score.counted(docs)
    known = lm_score.vocabulary_of(counts)
    model = lm_score.trained(docs, known)
    seen = {int(np.int64(r.h).view(np.uint64)): r.c for r in counts.collect()}
    got = {r.doc_id: r.score for r in lm_score.score_documents(docs).collect()}
    for doc, text in [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in (0, 3, 31, 58, 900, 901)]:
        stream, _, _ = lm_score.token_stream(lm_score.slices(lm_score.pa.array([text or ""], lm_score.pa.large_string())).__next__())
        total, before = 0.0, (known.outputs, known.outputs)
        for key in stream.tolist():
            out = int(known.known(np.array([key], np.uint64))[0][0])
            q = model.before[before[0]] @ model.first + model.before[before[1]] @ model.second
            for level, (after, bias) in enumerate(model.levels):
                node = out // model.branch**level
                base = node // model.branch * model.branch
                z = (getattr(model, after)[base : base + model.branch] @ q + getattr(model, bias)[base : base + model.branch]).astype(float)
                total += (z[node - base] - np.log(np.exp(z).sum())) / math.log(10)
            if known.bucket_at[out] >= 0:
                b = known.bucket_at[out]
                total += math.log10((seen.get(key, 0) + 1) / (known.bucket_total[b] + known.bucket_distinct[b] + 1))
            before = (out, before[0])
        assert got[doc] == pytest.approx(total, rel=1e-4)


def test_frequent_words_are_found_without_a_search_for_each_token(monkeypatch):
    rng = np.random.default_rng(4)
    head = np.unique(np.r_[rng.integers(0, 1 << 63, 3000).astype(np.uint64) << np.uint64(1), np.arange(5, 400, 7).astype(np.uint64), np.uint64(2**64 - 9)])
    known = lm_score.Vocabulary(10, 10, head, np.arange(1, len(head) + 1), np.ones(lm_score.BUCKETS, np.int64), np.ones(lm_score.BUCKETS, np.int64))
    keys = np.r_[head, head + np.uint64(1), head - np.uint64(1), np.array([0, 2**64 - 1, 2**64 - 8], np.uint64)]
    place = {k: i for i, k in enumerate(head.tolist())}
    monkeypatch.setattr(np, "searchsorted", None)
    out, count = known.known(keys)
    assert count.tolist() == [place.get(k, -2) + 1 for k in keys.tolist()]
    assert out.tolist() == [known.place[place.get(k, len(head) + k % lm_score.BUCKETS)] for k in keys.tolist()]


@pytest.mark.parametrize("size", [0.5, 3.0, 40.0])
def test_chances_of_short_and_long_vectors_equal_a_softmax(size):
    """Beyond SAFE the largest logit is taken off; up to it nothing is, and both are the softmax in double precision."""
    rng = np.random.default_rng(6)
    model = lm_score.LogBilinear(np.arange(60.0, 0, -1), depth=3)
    for name in ("before", *[a for a, _ in model.levels]):
        setattr(model, name, (rng.standard_normal(getattr(model, name).shape) * size).astype(np.float32))
    one, two, word = rng.integers(0, 61, 500), rng.integers(0, 61, 500), rng.integers(0, 60, 500)
    want = np.zeros(500)
    q = model.before[one].astype(float) @ model.first + model.before[two].astype(float) @ model.second
    for level, (after, bias) in enumerate(model.levels):
        z = q @ getattr(model, after).T.astype(float) + getattr(model, bias)
        for i, node in enumerate(word // model.branch**level):
            base = node // model.branch * model.branch
            z_i = z[i, base : base + model.branch]
            want[i] += z[i, node] - z_i.max() - np.log(np.exp(z_i - z_i.max()).sum())
    assert model.log_chances(one, two, word) == pytest.approx(want, rel=1e-4, abs=1e-3 * max(1, size))


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    counts = np.array([50.0, 30, 20, 10, 5])
    model = lm_score.LogBilinear(counts)
    word = np.tile([0, 1, 2, 3, 4], 4000)
    one, two = lm_score.contexts(word, np.array([0, len(word)]), 5)
    squares = {n: np.full(getattr(model, n).shape, 0.1, np.float32) for n in model.NAMES}
    for _ in range(30):
        model.train(one, two, word, rng, squares)
    s1, s2, norm = model.tables()
    p = np.exp(s1[:, None, :] + s2[None, :, :] - norm[:, :, None])
    assert p.sum(axis=2) == pytest.approx(np.ones((6, 6)), abs=1e-4)
    assert p[0, 4, 1] > 0.9 and p[1, 0, 2] > 0.9


def test_empty_tables_and_no_training_texts(spark):
    assert lm_score.score_documents(cases.empty(spark)).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    rows = lm_score.score_documents(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows} == {(3, 0, 0, 0.0)}
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_tree_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    counts = np.arange(30.0, 0, -1)
    model = lm_score.LogBilinear(counts, depth=3)
    word = np.tile(np.arange(30), 2000)
    one, two = lm_score.contexts(word, np.array([0, len(word)]), 30)
    squares = {n: np.full(getattr(model, n).shape, 0.1, np.float32) for n in model.NAMES}
    for _ in range(30):
        model.train(one, two, word, rng, squares)
    p = np.exp([[model.log_chances(np.array([a]), np.array([b]), np.array([w]))[0] for w in range(30)] for a, b in ((3, 2), (29, 28), (30, 30))])
    assert p.sum(axis=1) == pytest.approx(np.ones(3), abs=1e-4)
    assert p[0, 4] > 0.8 and p[1, 0] > 0.8


def test_words_beyond_the_most_frequent_are_learnt(spark):
    """600 words a and b occur alike often, in pairs: only vectors of their own tell which follows which."""
    pairs = [(f"left{i}x", f"right{i * 7 % 600}y") for i in range(600)]
    rng = np.random.default_rng(3)
    train = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(5000, 5500) if zlib.crc32(str(i).encode()) % 7 == 2][:60]
    text = lambda order: " ".join(f"{pairs[k][0]} {pairs[k][1]}" for k in order)
    rows = [(i, text(rng.integers(0, 600, 60))) for i in train] + [(i, text(rng.integers(0, 600, 60))) for i in held]
    got = lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).where("held_out").collect()
    assert len(got) >= len(held) and sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)
