import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkloom.llm import packing, token_counts
from sparkloom.llm.tokens import tidy

from . import cases


def pieces(spark, docs):
    return packing.pack(docs).collect()


def test_token_counts_equal_the_library(spark, tmp_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_tokenizer())
    docs = cases.documents(spark)
    want = sorted((repr((r.doc_id, len((r.text or "").encode()), n := len(model.encode(r.text or "")), n > 4096)) for r in docs.collect()))
    for cache in (None, str(tmp_path / "cache"), str(tmp_path / "cache")):
        assert sorted(repr(tuple(r)) for r in token_counts.count_tokens(docs, cache=cache).collect()) == want
    assert token_counts.count_tokens(cases.empty(spark)).count() == 0


def test_cache_encodes_only_what_it_lacks(spark, tmp_path):
    cache = str(tmp_path / "c")
    docs = cases.documents(spark)
    token_counts.count_tokens(docs, cache=cache).count()
    stored = spark.read.parquet(cache).count()
    assert stored == docs.fillna("", "text").select("text").distinct().count()
    more = cases.documents(spark, [(900, "quite new words", "en", "src0")])
    token_counts.count_tokens(more, cache=cache).count()
    assert spark.read.parquet(cache).count() == stored + 1
    assert spark.read.parquet(cache).select("tokenizer_digest").distinct().count() == 1


def test_pieces_hold_every_id_once_and_sequences_are_gapless(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.default_tokenizer())
    docs = cases.documents(spark)
    rows = pieces(spark, docs)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append([*model.encode(r.text or "", add_special_tokens=False).ids, 1])
    assert by_doc.keys() == texts.keys()
    for doc, found in by_doc.items():
        ids, copies = texts[doc][0], len(texts[doc])
        assert {r.doc_tokens for r in found} == {len(ids)}
        by_start = defaultdict(list)
        for r in found:
            by_start[r.start].append(r)
        assert all(len(v) == copies for v in by_start.values())
        at = 0
        for start in sorted(by_start):
            assert start == at
            for r in by_start[start]:
                assert zlib.crc32(np.array(ids[start : start + r.length], "<u4").tobytes()) == r.ids_crc32
            at += by_start[start][0].length
        assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in rows)
    assert len(sequences) <= -(-used // 2048) + 1
    assert packing.pack(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fullest_bin_is_the_best_subset(seed):
    rng = np.random.default_rng(seed)
    lengths = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 40, 6)}
    capacity = int(rng.integers(20, 90))
    chosen = packing.fullest(lengths, capacity)
    assert all(n <= lengths[length] for length, n in chosen.items())
    reach = {0}
    for length, n in lengths.items():
        for _ in range(n):
            reach |= {s + length for s in reach if s + length <= capacity}
    assert sum(k * v for k, v in chosen.items()) == max(reach)


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(1)
    counts = {k: int(v) for k, v in enumerate(rng.integers(1, 5000, 2047), 1)}
    plan = packing.plan_bins(counts, 2048)
    used = defaultdict(int)
    for times, pattern in plan:
        assert sum(k * v for k, v in pattern.items()) <= 2048
        for length, n in pattern.items():
            used[length] += times * n
    assert used == counts
    bins, total = sum(t for t, _ in plan), sum(k * v for k, v in counts.items())
    least = max(total / 2048, sum(v for k, v in counts.items() if k > 1024))  # two such pieces never share a bin
    assert bins <= 1.01 * least


def test_words_encode_as_whole_texts_do():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    model = Tokenizer.from_file(path)
    texts = ["don't WE'LL a\u0301b \u0301x", "ΝΑΟΣ ΝΑΟΣ, x\u00a0y\u2028z", "<|startoftext|>a <|endoftext|> b<|endoftext|>", "\x1c\x85 a\x1fb \u200d 12 34,5", "😀😀 ﬁne İstanbul \u0130", "", " ", "It's. IT'S!? 'S. x'. é., ½. »., ... a.b., ۳! <|ENDOFTEXT|>, <|endoftext|>. a<|endoftext|>|", "ß. Σ. ΑΣ, e\u0301."]
    for text, ids in zip(texts, packing.encode([t.encode() for t in texts], path), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_ids_of_random_strings_equal_the_library():
    """100,000 strings of letters that compose, change their length in lower case or close words, contractions and special tokens."""
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    model = Tokenizer.from_file(path)
    rng = random.Random(4)
    marks = "\u0301\u0308\u030a\u030c\u0323\u0327\u0331\u0345"
    odd = "\u0130\u0131\u212a\u212b\u017f\u1e9e\u0149\ufb01\u00df\u00d7\u00f7\u03a3\u03c2\u0390\u1f80\u00b4\u00b5\u200d\u2028\u00a0\u3000\u1100\u1161\u11a8\uac00\u0958\U0001f600\x1c\x85"
    pieces = [*"TJHYWaeioustdmlv019", *"ÀÉÎõüÿßØñçÅ", *marks, *odd, *".,;:!?*#$%&|'-/<>", "'s", "'LL", "'Re", "<|", "|>", "<|endoftext|>", "<|startoftext|>", *" \t\n\r\x0b\x0c   "]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(100_000)]
    for at in range(0, len(texts), 5000):
        some = texts[at : at + 5000]
        want = [e.ids for e in model.encode_batch(some, add_special_tokens=False)]
        got = [np.frombuffer(x, "<u4").tolist() for x in packing.encode([t.encode() for t in some], path)]
        assert [t for t, a, b in zip(some, got, want, strict=True) if a != b] == []


def test_other_tokenizers_encode_whole_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.by_words(packing.default_tokenizer()) and not packing.by_words(path)
    model = Tokenizer.from_file(path)
    texts = ["It's  A test.\n\nOf T\u0308 <|endoftext|> x", "", "a" * 5000]
    for text, ids in zip(texts, packing.encode([t.encode() for t in texts], path), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer=path).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(model.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    packing.forget()


def test_other_operators_drop_what_packing_remembers():
    path = packing.default_tokenizer()

    def nothing(batches):
        yield from batches

    packing.encode([b"Some words, words."], path)
    assert len(packing._memory.keys)
    list(tidy(nothing, packing.OWNER)([]))
    assert len(packing._memory.keys)
    list(tidy(nothing)([]))
    assert not len(packing._memory.keys) and not packing._encoder
    assert packing.encode([b"Some words, words."], path) == packing.encode([b"some  words, words."], path)
