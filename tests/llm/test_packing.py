from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from playmart.llm import bfd_packing, retrieval_packing
from playmart.llm.tokens import Vocabulary, default_path

from .conftest import ODD


@pytest.fixture(scope="module")
def expected():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("text", ["", "Hello  world\n\n x", "don't <|endoftext|> 12,5", "\U0001f600é世界   a", " " * 3000 + "z", "ab" * 5000])
def test_ids_are_those_of_the_vocabulary_file(expected, text):
    assert [*Vocabulary(default_path()).encoder()(text), 0] == expected(text)


def test_runs_of_white_space_that_the_fast_way_refuses(expected):
    assert [*Vocabulary(default_path()).encoder()(" " * 1_500_000), 0] == expected(" " * 1_500_000)


def tiled(pieces, window):
    """Token ids by document, after the checks that every packing must pass."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length and p.length > 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return by_doc, by_sequence


@pytest.mark.parametrize("shard", [1_000_000, 900])
def test_every_token_lies_in_one_piece(docs, expected, shard):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("alpha beta gamma delta eps zeta".split(), k=rng.choice((0, 3, 40, 400))))) for i in range(60)]
    by_doc, by_sequence = tiled(retrieval_packing.pack(docs(rows), window=128, shard_tokens=shard).collect(), 128)
    for i, text in rows:
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in own]).tolist()
        assert ids == expected(text) and {p.doc_tokens for p in own} == {len(ids)}
    short = [s for s, own in by_sequence.items() if sum(p.length for p in own) < 128]
    assert len(short) <= len({s >> 32 for s in by_sequence})


def test_neighbours_follow_their_seed():
    """Two topics in turn: with the index each window stays with its topic."""
    docs = [np.array([10 + 100 * (i % 2) + j for j in range(20)] + [500 + i], np.uint16) for i in range(24)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=600)
    idf = np.maximum(0, np.log((30 - df + 0.5) / (df + 0.5))) * (df > 0)
    pieces = retrieval_packing.pack_shard(docs, idf, 21.0, 84)
    windows = defaultdict(set)
    for doc, _, _, sequence, _ in pieces:
        windows[sequence].add(doc % 2)
    assert sum(len(t) == 2 for t in windows.values()) <= 1


def test_scores_are_bm25():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 30, n).astype(np.uint16) for n in (5, 9, 40, 1, 17)]
    idf, mean = rng.random(30), 14.4
    idf[3] = 0
    index = retrieval_packing.ShardIndex(docs, idf, mean)
    k1, b = retrieval_packing.K1, retrieval_packing.B
    for q, query in enumerate(docs):
        want = [sum(idf[t] * (n := int((d == t).sum())) * (k1 + 1) / (n + k1 * (1 - b + b * len(d) / mean))
                    for t in set(query.tolist()) if (d == t).any()) for d in docs]
        assert np.allclose(index.scores(q), want)


def test_ranking_equals_a_full_sort():
    rng = np.random.default_rng(8)
    for n in (1, 7, 100, 1000):
        scores, unused = rng.integers(0, 6, n).astype(float), rng.random(n) < 0.7
        want = sorted((i for i in range(n) if unused[i] and scores[i] > 0), key=lambda i: (-scores[i], i))
        assert list(retrieval_packing._ranked(scores, unused)) == want


def test_best_fit_decreasing_equals_plain_search():
    rng = random.Random(6)
    for _ in range(60):
        window = rng.choice((1, 2, 7, 16, 1000))
        lengths = [rng.randint(0, 3 * window) for _ in range(rng.randint(0, 60))]
        rooms, pieces = [], sorted((-min(window, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, window))
        for n, _, _ in pieces:
            fits = [r for r in rooms if r >= -n]
            best = min(fits) if fits else window
            if fits:
                rooms.remove(best)
            rooms.append(best + n)
        got = bfd_packing.pack_lengths(lengths, window)
        assert sorted(window - sum(n for _, _, n in q) for q in got) == sorted(rooms)


def test_matrices_give_every_document_back(docs, expected):
    rows = [(i, f"text number {i} " * (i * 7 % 50)) for i in range(50)]
    got = bfd_packing.pack(docs(rows), window=64, shard_bytes=4000).collect()
    for r in got:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.tokens <= 64
        assert r.position_resets == r.cu_seqlens[:-1] and not ids[r.tokens :].any()
    back = bfd_packing.unpacked(got)
    assert {d: x.tolist() for d, x in back.items()} == {i: expected(t) for i, t in rows}


def test_matrices_are_written(docs, tmp_path, spark):
    path = str(tmp_path / "m")
    bfd_packing.write_matrices(bfd_packing.pack(docs([(1, "a b c")]), window=8), path)
    assert spark.read.parquet(path).first().tokens == 4


def test_odd_documents(odd, nothing, expected):
    total = sum(len(expected(t)) for _, t in ODD)
    pieces = retrieval_packing.pack(odd).collect()
    assert sum(p.length for p in pieces) == total and sum(p.doc_id is None and p.start == 0 for p in pieces) == 2
    matrices = bfd_packing.pack(odd).collect()
    assert sum(r.tokens for r in matrices) == total
    assert retrieval_packing.pack(nothing).count() == 0 and bfd_packing.pack(nothing).count() == 0
