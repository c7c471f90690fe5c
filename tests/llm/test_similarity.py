import random

import numpy as np
import pytest

from sparkloom import store
from sparkloom.llm import blocks, components, embedding_dedup, ngram_join
from sparkloom.llm.components import connected_components, spanning_labels

from . import cases


@pytest.mark.parametrize("few", [0, 500_000])
def test_components_of_paths_stars_and_cliques(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_LINKS", few)
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(7, 7), (None, 3)]
    edges += [(2000 + a, 2000 + b) for a in range(6) for b in range(a)] + [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    words = connected_components(spark.createDataFrame([("b", "c"), ("c", "a")], "u string, v string")).collect()
    assert {r.node: r.component for r in words} == dict.fromkeys("abc", "a")


def test_few_links_take_no_rounds(spark, monkeypatch):
    """Links within FEW_LINKS are two tables, the links and what they connect, however long the path; others once rounds leave so few."""
    tags = []
    monkeypatch.setattr(components, "written", lambda df, tag="step", path=None: tags.append(tag) or store.written(df, tag, path))
    path = [(f"n{i:02}", f"n{i + 1:02}") for i in range(90)] + [("a", "n05"), ("y", "z")]
    got = connected_components(spark.createDataFrame(path, "u string, v string")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted([(f"n{i:02}", "a") for i in range(91)] + [("a", "a"), ("y", "y"), ("z", "y")])
    assert tags == ["components", "components-solved"]
    tags.clear()
    monkeypatch.setattr(components, "FEW_LINKS", 50)
    got = connected_components(spark.createDataFrame([(a, b) for a in range(15) for b in range(a)], "u long, v long")).collect()
    assert sorted((r.node, r.component) for r in got) == [(a, 0) for a in range(15)]
    assert tags[-1] == "components-solved" and tags.count("components") > 1


def brute_vectors(rows, least=0.95):
    n = len(rows)
    sound = [v is not None and v[1] is not None and v[0] is not None and len(v[1]) > 0 and None not in v[1] and bool(np.isfinite(v[1]).all()) and any(v[1]) for v in rows]
    unit = [np.array(v[1], np.float64) / np.linalg.norm(np.array(v[1], np.float64) / np.abs(v[1]).max()) / np.abs(v[1]).max() if s else None for v, s in zip(rows, sound, strict=True)]
    p, q = [], []
    for i in range(n):
        for j in range(i):
            if sound[i] and sound[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                p.append(i)
                q.append(j)
    links = np.bincount(p, minlength=n) + np.bincount(q, minlength=n) if p else np.zeros(n, int)
    label = spanning_labels(np.array(p, int), np.array(q, int), n)
    smallest = {}
    for i in range(n):
        if sound[i]:
            smallest[label[i]] = min(smallest.get(label[i], rows[i][0]), rows[i][0])
    return [(v[0], int(k), smallest[label[i]] if sound[i] else v[0], v[0] == smallest[label[i]] if sound[i] and v[0] is not None else True) for i, (v, k) in enumerate(zip(rows, links, strict=True))]


@pytest.mark.parametrize("cells", [None, 1, 7])
def test_vectors_equal_brute_force(spark, cells):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 16))
    near = base[:40] + rng.standard_normal((40, 16)) * 0.2
    dense = base[0] + rng.standard_normal((60, 16)) * 0.12
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, dense]))]
    rows += [(900 - i, base[3].tolist()) for i in range(5)] + [(910, (base[3] * 1e-200).tolist()), (911, (base[3] * 1e200).tolist()), rows[9], rows[9]]
    rows += [(920, None), (921, [0.0] * 16), (922, [float("nan")] * 16), (923, [None] * 16), (924, [float("inf")] + [1.0] * 15), (925, []), (926, [1.0, 0.0]), (927, [1.0, 0.01]), (None, base[3].tolist())]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "vec_id long, embedding array<double>, node string, cell string, label int")
    got = embedding_dedup.near_duplicates(df, cells=cells).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_vectors(rows)))


def test_large_cells_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "GUESTS", 8)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.standard_normal((80, 8)), rng.standard_normal(8) + rng.standard_normal((90, 8)) * 0.15])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = embedding_dedup.near_duplicates(df, cells=3).select("vec_id", "n_links", "component_id", "kept").collect()
    rows32 = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_vectors(rows32)))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def grams(text, n=5):
    words = (text or "").encode().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute_join(rows, threshold=0.8):
    sets = [grams(t) if d is not None else set() for d, t in rows]
    n, p, q = len(rows), [], []
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= threshold:
                p.append(i)
                q.append(j)
    links = np.bincount(p, minlength=n) + np.bincount(q, minlength=n) if p else np.zeros(n, int)
    label = spanning_labels(np.array(p, int), np.array(q, int), n)
    smallest = {}
    for i in range(n):
        if rows[i][0] is not None:
            smallest[label[i]] = min(smallest.get(label[i], rows[i][0]), rows[i][0])
    return [(d, int(k), None if d is None else smallest[label[i]], d is None or d == smallest[label[i]]) for i, ((d, _), k) in enumerate(zip(rows, links, strict=True))]


def near_copies(seed, count, words, edits):
    rng = random.Random(seed)
    base = cases.prose(seed, words).split()
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def corpus(spark):
    extra = [(400 + i, t, "en", "src0") for i, t in enumerate(near_copies(1, 40, 120, 1) + near_copies(2, 30, 200, 5) + near_copies(3, 10, 12, 1))]
    passage = cases.prose(5000, 60)
    extra += [(600 + i, cases.prose(6000 + i, 40) + " " + passage, "en", "src1") for i in range(40)]
    extra += [(700, "only  three words", "en", "a"), (701, "only three\nwords", "en", "a"), (702, "only three word", "en", "a")]
    return cases.documents(spark, extra)


def small_blocks(monkeypatch, block):
    if block:
        for name in ("SIGNATURE_BLOCK", "SET_BLOCK", "PART"):
            monkeypatch.setattr(ngram_join, name, block)
        monkeypatch.setattr(ngram_join, "SET_BYTES", 4000 * block)


@pytest.mark.parametrize("block", [None, 8])
def test_join_equals_brute_force(spark, monkeypatch, block):
    small_blocks(monkeypatch, block)
    docs = corpus(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_join(rows)
    got = ngram_join.ngram_join(docs).select("doc_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    connected = ngram_join.judged_rows(docs, 0.8, 5, 0.99999, count_links=False).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, connected))) == sorted(repr((d, c, k)) for d, _, c, k in want)


def test_one_of_each_group_stays(spark, monkeypatch):
    small_blocks(monkeypatch, 8)
    docs = corpus(spark)
    out = ngram_join.one_of_each(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = {d for d, _, _, k in brute_join([(r.doc_id, r.text) for r in docs.collect()]) if k}
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(map(repr, kept))
    for job in (ngram_join.ngram_join, ngram_join.one_of_each):
        assert job(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_crossing_blocks_bring_all_components_together(spark, seed):
    rng = random.Random(seed)
    rows = [(g, k, rng.choice([0, 0, 0, 1, 2, 3])) for g in range(4) for k in range(rng.randint(1, 60))] + [(9, k, 5) for k in range(30)]
    tasks = blocks.crossing_blocks(spark.createDataFrame(rows, "g long, k long, c long"), "g", "k", "c", 8).collect()
    met = set()
    held = {}
    for r in tasks:
        held.setdefault((r.g, r.bi, r.bj), []).append(r)
    for (g, bi, bj), members in held.items():
        met |= {(g, min(x.k, y.k), max(x.k, y.k)) for x in members if x.own == bi for y in members if y.own == bj}
    component = {(g, k): c for g, k, c in rows}
    want = {(g, a, b) for g, a in component for h, b in component if g == h and a < b and component[g, a] != component[g, b]}
    assert want <= met and not any(g == 9 for g, _, _ in met)


def test_texts_under_one_id_are_each_judged(spark):
    texts = near_copies(9, 2, 100, 1)
    docs = spark.createDataFrame([(1, texts[0]), (1, cases.prose(10, 90)), (2, texts[1])], "doc_id long, text string")
    got = ngram_join.ngram_join(docs)
    assert got.where("doc_id = 2").select("component_id", "kept").first() == (1, False)
    assert ngram_join.one_of_each(docs).count() == 2


def test_only_the_copy_goes_under_a_repeated_id(spark):
    own, other = cases.prose(21, 100), cases.prose(22, 90)
    docs = spark.createDataFrame([(1, own, "a"), (5, own, "b"), (5, other, "c"), (5, "", "d"), (None, own, "e")], "doc_id long, text string, source string")
    out = ngram_join.one_of_each(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert sorted(r.source for r in out.collect()) == ["a", "c", "d", "e"]


def test_bands_reach_the_target_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands = ngram_join.Bands(threshold, 0.9999)
        assert 1 - (1 - threshold**bands.rows) ** bands.bands >= 0.9999 > 1 - (1 - threshold**bands.rows) ** (bands.bands - 1)


def test_shared_counts_equal_set_sizes(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(9)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = ngram_join.shared_counts(sets)
    off = ~np.eye(9, dtype=bool)
    assert (got[off] == np.array(want)[off]).all()
