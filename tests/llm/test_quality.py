import math
import re
from collections import Counter

import numpy as np

from sparkloom.llm import quality

from . import cases

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            duplicates += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(again), failed


def junk(spark):
    p = cases.prose
    return [
        (300, " ".join(w + "***" for w in p(50, 200).split()), "en", "a"),
        (301, " ".join(["same"] * 300), "en", "a"),
        (302, "line one here\n" * 80 + "line one here\r\nline one here\n \n \n", "en", "a"),
        (303, " ".join(w.upper() + "!!" for w in p(51, 200).split()), "en", "a"),
        (304, " | ".join(p(52, 200).split()), "en", "a"),
    ]


def test_counts_equal_brute_force(spark):
    docs = cases.documents(spark, junk(spark))
    got = quality.judge_quality(docs).collect()
    found = sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got)
    assert found == sorted(repr((r.doc_id, *brute(r.text))) for r in docs.collect())
    assert all(not r.kept for r in got if r.base_failed)
    assert quality.judge_quality(cases.empty(spark)).count() == 0


def brute_votes(text):
    """What each rule says of a text: 0 abstains, 1 good, 2 bad."""
    text = text or ""
    words = re.findall(WORD, text)
    n, chars, symbols, duplicates, again, _ = brute(text)
    some = max(n, 1)
    lines = sum(bool(re.search(WORD, line)) for line in text.split("\n"))
    letters = lambda w: sum(not (c.isascii() and not c.isalpha()) for c in w)
    mean = chars / some
    values = {
        "symbols_per_word": symbols / some,
        "repeated_share": again / some,
        "duplicate_line_share": duplicates / max(lines, 1),
        "capital_word_share": sum(len(re.findall("[A-Z]", w)) >= 2 and not re.search("[a-z]", w) for w in words) / some,
        "shouted_share": sum(w[-1] in "!?" for w in words) / some,
        "length_oddity": max(3 / max(mean, 0.1), mean / 10) if n else 9.0,
        "plain_word_share": sum(len(w) - letters(w) <= (w[-1] in ".,;:?!'\")") for w in words) / some,
    }
    return [vote if (values[m] >= limit if way == ">=" else values[m] <= limit) else 0 for _, m, way, limit, vote in quality.VOTES]


def test_posteriors_equal_a_plain_walk_over_texts(spark):
    """Expectation-maximisation text by text, without patterns or matrices."""
    docs = cases.documents(spark, junk(spark) + [(2000 + i, cases.prose(3000 + i, 90), "en", "a") for i in range(60)])
    rows = docs.collect()
    votes = [brute_votes(r.text) for r in rows]
    good = [0.1 if 2 in v else 0.9 for v in votes]
    for _ in range(100):
        share = [[1 - g for g in good], good]
        prior = [(sum(c) + 1) / (len(rows) + 2) for c in share]
        rates = [[[1.0 + sum(w for w, v in zip(c, votes, strict=True) if v[j] == k) for k in range(3)] for j in range(len(quality.VOTES))] for c in share]
        chance = [[p * math.prod(rates[c][j][v[j]] / sum(rates[c][j]) for j in range(len(v))) for c, p in enumerate(prior)] for v in votes]
        now = [b / (a + b) for a, b in chance]
        done = max(abs(a - b) for a, b in zip(now, good, strict=True)) < 1e-10
        good = now
        if done:
            break
    got = sorted((repr(r.doc_id), r.n_words, round(r.p_good, 6), r.kept) for r in quality.judge_quality(docs).collect())
    want = sorted((repr(r.doc_id), brute(r.text)[0], round(g, 6), not brute(r.text)[5] and g >= 0.5) for r, g in zip(rows, good, strict=True))
    assert got == want
    assert {k for *_, k in got} == {True, False}


def test_stage_keeps_rows_and_columns(spark):
    docs = cases.documents(spark, junk(spark))
    out = quality.good_documents(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = sorted(repr(r.doc_id) for r in quality.judge_quality(docs).collect() if r.kept)
    assert sorted(repr(r.doc_id) for r in out.collect()) == kept
    assert quality.good_documents(cases.empty(spark)).count() == 0


def test_votes_find_junk_and_leave_prose(spark):
    rows = [(i, cases.prose(i, 150), "en", "a") for i in range(400)]
    p = cases.prose
    for i in range(60):
        w = p(1000 + i, 150).split()
        rows.append((1000 + i, [" ".join(x + "***" for x in w), " ".join(x.upper() + "!!" for x in w), " | ".join(w)][i % 3], "en", "a"))
    docs = spark.createDataFrame([(d, t) for d, t, _, _ in rows], "doc_id long, text string")
    kept = {r.doc_id for r in quality.judge_quality(docs).collect() if r.kept}
    assert kept == set(range(400))


def test_expectation_maximisation_recovers_rates():
    rng = np.random.default_rng(3)
    n, bad = 60_000, 0.2
    truth = rng.random(n) < bad
    pattern = np.zeros(n, np.int64)
    for *_, vote in quality.VOTES:
        p = np.where(truth, 0.5, 0.02) if vote == quality.BAD else np.where(truth, 0.1, 0.9)
        pattern = pattern * 3 + np.where(rng.random(n) < p, vote, 0)
    values, counts = np.unique(pattern, return_counts=True)
    good, accuracy = quality.fit_votes(values, counts.astype(float))
    assert abs(float((counts * (1 - good)).sum() / n) - bad) < 0.01
    assert abs(accuracy[0, 0, quality.BAD] - 0.5) < 0.03 and abs(accuracy[0, 1, quality.BAD] - 0.02) < 0.01
