"""Token counts, packing and the tiktoken codec against the libraries themselves."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from txnguard.llm.byte_bpe import ByteBpe, WordStore
from txnguard.llm.packing import best_fit_packing, cut, vector_best_fit
from txnguard.llm.tiktoken_codec import Codec, tiktoken_digests
from txnguard.llm.token_counts import PrefixCounts, longest_prefix, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [*"ab st'relvmd \n\t\r123²½é漢!?.,-_<|>\0", "'s", "'ll", "'re", " ", "　", "\x1c", "\x85", "​", "😀", "<|endoftext|>", "  ", "\n\n", "٣", "tion", " of"]


def odd_texts(n, most, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_ids_are_the_library_s(library):
    bpe = ByteBpe(JSON).check()
    texts = odd_texts(3000, 40)
    flat, at = bpe.ids(texts)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_store_that_begins_anew_gives_the_same_ids(library):
    bpe = ByteBpe(JSON)
    bpe.store = WordStore(bpe._encode, most=50)
    for k in range(0, 300, 30):
        texts = odd_texts(30, 30, seed=k)
        flat, at = bpe.ids(texts)
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_count_of_every_prefix(library):
    texts = odd_texts(400, 25)
    for text, counts in zip(texts, PrefixCounts(JSON).counts(texts)):
        assert counts.tolist() == [len(library.encode(text[:p], add_special_tokens=False).ids) for p in range(len(text) + 1)]


def test_token_counts_query(awkward, make_docs, library):
    rows = token_counts(make_docs(awkward, clash=True), JSON, limit=7, prefixes=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == Counter(
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 7) for i, t in awkward
    )
    for r in rows:
        assert r.prefix_tokens[-1] == r.n_tokens and r.limit_chars == longest_prefix(np.array(r.prefix_tokens), 7)
    assert token_counts(make_docs([]), JSON).count() == 0


def test_cut():
    for n in (1, 2, 9, 10, 11, 20, 21, 35):
        pieces = cut(n, 10)
        assert sum(x for _, x in pieces) == n and all(x == 10 for _, x in pieces[1:]) and 0 < pieces[0][1] <= 10
        assert [s for s, _ in pieces] == [sum(x for _, x in pieces[:i]) for i in range(len(pieces))]


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    lengths = np.random.default_rng(0).integers(1, 300, 2000)
    bins, offsets = vector_best_fit(lengths, 512, 4, 90_000, (1.0, 0.1, 0.1), score)
    for b in range(bins.max() + 1):
        own = lengths[bins == b]
        assert own.sum() <= 512 and len(own) <= 4 and (own**2).sum() <= 90_000
        at = np.argsort(offsets[bins == b])
        assert (np.cumsum(np.append(0, own[at]))[:-1] == offsets[bins == b][at]).all()


def test_packing_is_dense():
    lengths = np.minimum(2047, np.maximum(1, np.random.default_rng(0).lognormal(6, 1, 5000).astype(int)))
    bins, _ = vector_best_fit(lengths, 2048, 2048, 2048**2, (1.0, 0.01, 0.01))
    assert bins.max() + 1 <= math.ceil(lengths.sum() / 2048) * 1.01 + 1


def test_packing_query(awkward, make_docs, library):
    rows = best_fit_packing(make_docs(awkward, clash=True), JSON, tokens=64, group_pieces=50).collect()
    expected = []
    for i, t in awkward:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected += [(i, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for p, (s, n) in enumerate(cut(len(ids), 64))]
    assert Counter(tuple(r)[:5] for r in rows) == Counter(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 64
    assert best_fit_packing(make_docs([]), JSON).count() == 0


def test_tiktoken_query(awkward, make_docs):
    import base64

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = tiktoken_digests(make_docs(awkward, clash=True), RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    expected = Counter()
    for i, t in awkward:
        ids = library.encode_ordinary(t or "")
        expected[i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert Counter(tuple(r)[:4] for r in rows) == expected
    assert tiktoken_digests(make_docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_texts_split_at_safe_places():
    small, whole = Codec(RANKS, public_tokenizers.PATTERN, part_chars=20), Codec(RANKS, public_tokenizers.PATTERN)
    for text in odd_texts(300, 200, seed=9):
        assert small.encode(text) == whole.encode(text)
        assert small.decode(small.encode(text)) == text.encode()
