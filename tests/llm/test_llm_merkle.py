"""The Merkle manifest against a plain recursion and its SQL."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pytest

from txnguard.llm import oracle_sql
from txnguard.llm.merkle_manifest import merkle_manifest, without_newlines


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(levels, at, fanout):
    for level in levels[:-1]:
        first = at - at % fanout
        yield level[first:at], level[at + 1 : first + fanout]
        at //= fanout


def brute(rows, fanout=3):
    """``rows`` are (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources]
    trees = [levels_of([leaf_of(r) for r in part], fanout) for part in held]
    top = levels_of([t[-1][0] for t in trees], fanout)
    out = Counter()
    for j, (part, tree) in enumerate(zip(held, trees)):
        for i, r in enumerate(part):
            near = [*siblings(tree, i, fanout), *siblings(top, j, fanout)]
            cut = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now = leaf_of((*r[:4], r[4].replace("\n", ""))) if cut else leaf_of(r)
            for before, after in near:
                now = digest(*before, now, *after)
            out[r[0], tree[0][i], tree[-1][0], top[-1][0], digest(*(x for b, a in near for x in b + a)), now, now == top[-1][0]] += 1
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_awkward_rows(awkward, make_docs):
    df = make_docs(awkward, clash=True)
    got = merkle_manifest(df, tampered=without_newlines(), levels=2).collect()
    assert Counter(map(tuple, got)) == brute(rows_of(df))
    assert merkle_manifest(make_docs([]), tampered=without_newlines()).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28])
def test_sizes_around_full_trees(spark, n):
    rows = [(i, "only", "en", 1, f"a{i}\nb") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, merkle_manifest(df, tampered=without_newlines(), levels=1).collect())) == brute(rows)


def test_many_groups_and_one_that_holds_most(spark):
    rng = random.Random(5)
    sources = [None, "", "é", "z", "=", *(f"s{i}" for i in range(30))]
    rows = [(rng.randint(0, 300), "hot" if rng.random() < 0.5 else rng.choice(sources), rng.choice(["en", None]), None, rng.choice(["x\ny", "", None])) for _ in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert Counter(map(tuple, merkle_manifest(df, tampered=without_newlines(), levels=3).collect())) == brute(rows)


def test_sql(spark, awkward, make_docs):
    df = make_docs(awkward)
    documents = df.toArrow()
    con = duckdb.connect()
    con.register("documents", documents)
    expected = con.execute(oracle_sql.merkle_manifest()).fetchall()
    assert Counter(map(tuple, expected)) == brute(rows_of(df))


def test_other_fanout_proofs_and_nothing_tampered(spark):
    rows = [(i, "a", "en", 3, f"t{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle_manifest(df, fanout=2, levels=2, with_proof=True).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter({k[:5] + (k[3], True): n for k, n in brute(rows, 2).items()})
    assert all(r.group_rows == 12 and len(r.proof) % 64 == 0 and digest(r.proof) == r.proof_sha256 for r in got)
    assert sorted(r.position for r in got) == list(range(12))
