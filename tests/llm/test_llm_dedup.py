"""SimHash, components, suffix dedup and phrase fingerprints against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import as_key
from txnguard.llm import simhash, suffix_dedup
from txnguard.llm.components import connected_components
from txnguard.llm.lz_fingerprint import lz_fingerprints


def least_of_component(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in nodes}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def near(points, distance=2):
    return [(a, b) for k, a in enumerate(points) for b in points[k + 1 :] if (a ^ b).bit_count() <= distance]


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(200, 300)]
    star = [(1000, i) for i in range(1001, 1400)]
    edges = chain + star + [(rng.randint(0, 199), rng.randint(0, 199)) for _ in range(120)] + [(5, 5), (200, 201)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == least_of_component(nodes, edges)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query(awkward, make_docs):
    rng = random.Random(1)
    words = ["a", "B", "é", "the", "\x0b", "ÀB", "x\x1cy", "　", "foo"]
    rows = awkward + [(1000 + i, rng.choice([" ", "\t", "\n "]).join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(1200)]
    got = simhash.simhash_components(make_docs(rows, clash=True)).collect()
    fps = {t: brute_fingerprint(t) for _, t in rows}
    root = least_of_component(points := sorted(set(fps.values())), near(points))
    least = {}
    for i, t in rows:
        if i is not None:
            least[root[fps[t]]] = min(least.get(root[fps[t]], 1 << 62), i)
    assert Counter(map(tuple, got)) == Counter((i, format(fps[t], "016x"), least.get(root[fps[t]])) for i, t in rows)
    assert simhash.simhash_components(make_docs([])).count() == 0


def test_crowded_keys_lose_no_link(spark):
    rng = random.Random(2)
    points = set()
    for _ in range(2):
        base = rng.getrandbits(64)
        for _ in range(500):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            points.add(x)
    points = sorted(points)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in points}
    found = simhash.links(spark.createDataFrame([(s,) for s in signed.values()], "fp long"), few=4, part=100)
    got = {r.node: r.root for r in connected_components(found).collect()}
    root = least_of_component(points, near(points))
    groups = {}
    for p in points:
        groups.setdefault(root[p], set()).add(got.get(signed[p], signed[p]))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_one_of_each_group(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(30)]
    near_copy = rows[3][1].split()
    near_copy[50] = "changed"
    rows += [(100, rows[1][1]), (101, rows[1][1]), (102, " ".join(near_copy)), (103, rows[4][1] + " more"), (None, "on its own"), (104, None), (105, "")]
    rows += [rows[7]] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in simhash.one_of_each_group(df).collect()]
    assert sorted((as_key(i), t or "") for i, t in out) == sorted((as_key(i), t or "") for i, t in [*rows[:30], (None, "on its own"), (104, None)])


def brute_removed(rows, length):
    raw = [(as_key(i), (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in raw:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            least[s] = min(least.get(s, i), i)
    out = Counter()
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out[i, len(b), sum(gone), sum(1 for j in range(len(gone)) if gone[j] and not (j and gone[j - 1])), hashlib.sha256(kept).hexdigest()] += 1
    return out


def passages(seed=5, n=250):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 120))) for _ in range(30)]

    def text():
        out = ""
        for _ in range(rng.randint(0, 8)):
            x = rng.random()
            if x < 0.5:
                p = rng.choice(shared)
                out += p[rng.randint(0, 20) : len(p) - rng.randint(0, 20)]
            elif x < 0.7:
                out += rng.choice(["a", "ab"]) * rng.randint(0, 150)
            else:
                out += "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 80)))
        return out

    return [(i * 2, text() if i % 13 else None) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 2000, "bucket_strings": 50, "held": 100}])
def test_suffix_dedup(make_docs, options):
    rows = passages()
    rows += rows[:3] + [(None, rows[5][1]), (None, rows[7][1]), (rows[9][0], rows[5][1]), (900, "x" * 5000), (901, "x" * 60), (902, "")]
    got = suffix_dedup.suffix_dedup(make_docs(rows, clash=True), length=50, **options).collect()
    assert Counter((as_key(r[0]), *r[1:5]) for r in got) == brute_removed(rows, 50)


def test_suffix_dedup_long_text_in_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 4000)
    rows = passages(n=60)
    rows += [(1001 + i, "".join(t or "" for _, t in rows[i * 10 :])) for i in range(3)]
    got = suffix_dedup.suffix_dedup(make_docs(rows), length=50).collect()
    assert Counter((as_key(r[0]), *r[1:5]) for r in got) == brute_removed(rows, 50)
    assert suffix_dedup.suffix_dedup(make_docs([])).count() == 0


def test_remove_repeats(make_docs):
    passage = "a passage of well over fifty bytes, é, that two documents have in common, word for word"
    rows = [(1, f"first {passage} end"), (2, f"other {passage} text"), (3, passage), (4, None), (5, "")]
    df = make_docs(rows, clash=True)
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns
    assert {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()} == {(1, rows[0][1]), (2, "other" + "text"), (4, None), (5, "")}


def phrases(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen | ({text[start:]} if start < len(text) else set())


@pytest.mark.parametrize("range_bytes", [8 << 20, 3000])
def test_lz_fingerprints(awkward, make_docs, range_bytes):
    rows = [(i, t) for i, t in awkward if len(t or "") < 10_000]
    got = lz_fingerprints(make_docs(rows, clash=True), size=100_000, range_bytes=range_bytes).collect()
    order = sorted((as_key(i), t or "") for i, t in rows)
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    expected = Counter()
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        p = phrases(t)
        expected[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(share(p, phrases(edited)), 9), round(share(p, phrases(after)), 9)] += 1
    assert Counter((as_key(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == expected
    assert lz_fingerprints(make_docs([])).count() == 0


def test_equal_texts_have_equal_fingerprints(make_docs):
    rows = [(i, ["some text that repeats itself, some text", "something else altogether"][i % 2]) for i in range(10)]
    got = lz_fingerprints(make_docs(rows)).collect()
    assert len({(r.doc_id % 2, r.fingerprint) for r in got}) == 2 and all(0 <= r.near_next < r.near_edited <= 1 for r in got)


def test_tree_links_reach_what_pairs_reach():
    rng = np.random.default_rng(0)
    points = np.unique(rng.integers(0, 1 << 10, 200).astype(np.uint64))
    a, b = simhash.tree_links(points, 1)
    nodes = [int(x) for x in points]
    assert least_of_component(nodes, list(zip(a.tolist(), b.tolist()))) == least_of_component(nodes, near(nodes, 1))


def edited(rng, words, share):
    """``words`` with some replaced, so that the Jaccard of 5-word shingles is about ``share``."""
    out, missing = list(words), (1 - share) / (1 + share) * (len(words) - 4)
    for k in rng.sample(range(5, len(words) - 5), max(1, round(missing / 5))):
        out[k] = f"x{rng.random()}"
    return out


def jaccard(a, b):
    x, y = (set(simhash.shingle_set(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def test_copies_of_many_differing_bits_go(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows, due = [], set()
    for i in range(150):
        base = [rng.choice(words) for _ in range(rng.randint(100, 400))]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, base, 0.81 + 0.1 * rng.random())))]
        if jaccard(rows[-2][1], rows[-1][1]) >= 0.8:
            due.add(2 * i + 1)
    bits = [(simhash.fingerprint(a[1]) ^ simhash.fingerprint(b[1])).bit_count() for a, b in zip(rows[::2], rows[1::2]) if b[0] in due]
    assert len(due) > 100 and sum(n > 5 for n in bits) > 30
    kept = {r.doc_id for r in simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, _ in rows} - kept == due


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    for share in (0.8, 0.85, 0.95):
        for _ in range(300):
            n = int(rng.integers(100, 500))
            both = rng.integers(-(1 << 62), 1 << 62, n)
            own = rng.integers(-(1 << 62), 1 << 62, int(n * (1 / share - 1)))
            (k, s), (m, t) = (simhash.sketch(np.unique(np.concatenate([both, x]))) for x in (own[::2], own[1::2]))
            assert (k == m).any() and int(np.bitwise_count((s ^ t).view(np.uint64)).sum()) <= simhash.SKETCH_BITS


def test_sketch_trees_link_alike_only():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(-(1 << 62), 1 << 62, 200)) for _ in range(3)]
    rows = np.stack([simhash.sketch(x[cut:])[1] for x in sets for cut in (0, 10, 20)]).view(np.uint64)
    a, b = simhash.sketch_trees(np.arange(9), rows)
    assert least_of_component(range(9), list(zip(a.tolist(), b.tolist()))) == {i: i // 3 * 3 for i in range(9)}


def test_every_subgroup_of_a_component_is_judged(spark):
    rng = random.Random(9)
    rows = []
    for g in range(40):  # one component of 40 groups unlike each other, three alike texts in each
        own = [rng.getrandbits(62) for _ in range(100)]
        rows += [(1, (3 * g + k, k), [*own, *(rng.getrandbits(62) for _ in range(k))]) for k in range(3)]
    pending = spark.createDataFrame(rows, "root long, key struct<_id: long, _hash: long>, set array<long>")
    for most in (4, 32):
        gone = {r.key._id for r in simhash.near_copies(pending, 0.8, most).collect()}
        assert gone == {3 * g + k for g in range(40) for k in (1, 2)}


def test_many_unlike_rows_of_a_component_take_few_rounds(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(1, (i, i), [rng.getrandbits(62) for _ in range(5)]) for i in range(300)]
    pending = spark.createDataFrame(rows, "root long, key struct<_id: long, _hash: long>, set array<long>")
    written, write = [], simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda df, tag, **kw: written.append((tag, out := write(df, tag, **kw))) or out)
    assert simhash.near_copies(pending, 0.8).isEmpty()
    assert [t for t, _ in written].count("judged") <= 6


def test_a_round_leaves_only_what_later_ones_read(spark, monkeypatch):
    from txnguard.llm import common, components

    left, delete = [], common.fs.delete
    monkeypatch.setattr(common.fs, "delete", lambda s, path: left.append(path.rsplit("/", 1)[1].split("-")[0]) or delete(s, path))
    with common.scratch_scope(spark):
        edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
        found = components.connected_components(edges)
        assert "large" in left and "least" in left and "small" not in left
        assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(10)}
    assert "small" in left


def test_settled_anchors_count_as_shared():
    rng = random.Random(11)
    passage = bytes(rng.randrange(97, 123) for _ in range(300))
    own = [bytes(rng.randrange(97, 123) for _ in range(200)) for _ in range(3)]
    # Document 9 stands before 1 in one flush and again, alone and elsewhere, in another.
    flushes = [[(9, own[0][:77] + passage), (1, passage + own[1])], [(9, own[2] + passage)]]
    out = []
    for rows in flushes:
        batch = pa.record_batch({"_key": pa.array([k for k, _ in rows], pa.int64()), "_tag": pa.array([0] * len(rows), pa.int32()), "text": pa.array([t for _, t in rows], pa.binary())})
        out += suffix_dedup.anchor_rows(50, 20, 1, 300_000)([batch])
    got = suffix_dedup.surviving(pa.Table.from_batches(out)).to_pydict()
    found = suffix_dedup.Anchors([own[2] + passage], 50, 20)
    inside = {p for p, a in zip(found.place.tolist(), found.first.tolist()) if a >= 200}
    assert inside and inside <= {p for k, p in zip(got["_key"], got["place"]) if k == 9}


@pytest.mark.parametrize("held", [20, 300_000])
def test_suffix_dedup_repeated_rows_in_falling_order(spark, held):
    rows = [r for r in passages(seed=7, n=120)[::-1] if r[1]]
    rows = [*rows, *((i, t[len(t) // 3 :] + u) for (i, t), (_, u) in zip(rows[::3], rows[1::3]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = suffix_dedup.suffix_dedup(df, length=50, held=held).collect()
    assert Counter((as_key(r[0]), *r[1:5]) for r in got) == brute_removed(rows, 50)


def test_frequent_anchor_is_dealt_by_its_surroundings(spark):
    rng = random.Random(12)
    other = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    phrase, side = other(20), other(15)
    texts = [other(60) + phrase + other(60) for _ in range(400)] + [other(60) + side + phrase + other(60) for _ in range(3)]
    df = spark.createDataFrame([(k, t.decode()) for k, t in enumerate(texts)], "doc_id long, text string")
    spread = suffix_dedup.keyed_text(df, "doc_id", "text").coalesce(1)
    every = F.udf(lambda t: [(int(p) << 2) | 3 for p in suffix_dedup.Anchors([bytes(t)], 50, 20).place], "array<long>")
    contents = spread.withColumn("places", every("text")).mapInArrow(suffix_dedup.content_rows(50, 20, 300_000), suffix_dedup.CONTENT)
    known = suffix_dedup.judged(contents)
    assert known.where("NOT top OR f_one IS NOT NULL").count() == 0  # all contents are distinct
    keys = suffix_dedup.dealt_keys(known).collect()
    a = suffix_dedup.Anchors([texts[-1]], 50, 20)
    inside = 75 in a.place.tolist()  # the phrase is an anchor in all texts or in none
    assert Counter(r.key for r in keys) == ({keys[0].key: 3} if inside else {}) and {r["_one"] for r in keys} == ({400, 401, 402} if inside else set())
    table = suffix_dedup.string_rows(suffix_dedup.dealt_keys(known), spread, 50, 20, 7)
    for r in table.collect():  # the bytes of the key's side, where they are in the text
        at = (r.place >> suffix_dedup.START) + r.offset
        assert bytes(r.part) == texts[r["_one"]][at : at + len(r.part)] and side + phrase in bytes(r.part)


def test_rows_without_ids_and_repeated_rows(make_docs):
    rows = [(None, t) for _, t in passages(seed=3, n=60)] + [(7, t) for _, t in passages(seed=3, n=60)]
    rows += rows[:10] + [(9, rows[5][1] or "")]
    got = suffix_dedup.suffix_dedup(make_docs(rows), length=50).collect()
    assert Counter((as_key(r[0]), *r[1:5]) for r in got) == brute_removed(rows, 50)


def test_string_rows_follow_the_strings():
    """Contents leave as a row each, however many buckets and flushes there are."""
    rows = [(k, (t or "").encode()) for k, (_, t) in enumerate(passages(seed=5, n=40))]
    every = [[(int(p) << 2) | 3 for p in suffix_dedup.Anchors([t], 50, 20).place] for _, t in rows]
    zero = pa.array([0] * len(rows), pa.int32())
    batch = pa.record_batch({"_key": pa.array([k for k, _ in rows]), "_tag": zero, "_id": zero, "text": pa.array([t for _, t in rows]), "places": pa.array(every, pa.list_(pa.int64()))})
    for held in (10, 100_000):
        out = pa.Table.from_batches(list(suffix_dedup.content_rows(50, 20, held)([batch])))
        assert out.num_rows == sum(map(len, every))


def test_close_fingerprints_go_as_simhash_links_them(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(30):  # a passage repeated, then repeated less often before other words: close, yet of few distinct shingles in common
        base = [rng.choice(words) for _ in range(40)]
        rows += [(2 * i, " ".join(base * 12)), (2 * i + 1, " ".join(base * 11 + [rng.choice(words) for _ in range(60)]))]
    rows += [(90, "\t"), (91, ""), (92, "one more"), (93, "ONE  more\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    linked = {r.doc_id for r in simhash.simhash_components(df).collect() if r.doc_id != r.component_id}
    assert len(linked) > 5 and not any(jaccard(a[1], b[1]) >= 0.8 for a, b in zip(rows[:60:2], rows[1:60:2]))
    kept = {r.doc_id for r in simhash.one_of_each_group(df).collect()}
    assert {i for i, _ in rows} - kept == linked


def test_a_written_table_leaves_no_shuffles(spark):
    from txnguard.llm import common

    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if re.search(r"/shuffle_\d+_\d+_\d+\.data$", f)}

    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) is None  # as in any session that doesn't set it
    before = shuffles()
    rows = common.materialise(spark.range(5000).repartition(4, "id").groupBy((F.col("id") % 50).alias("k")).count(), "counted")
    for _ in range(50):  # files go in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) is None
    assert {tuple(r) for r in rows.collect()} == {(k, 100) for k in range(50)}


def test_suffix_dedup_leaves_only_what_its_result_reads(make_docs, monkeypatch):
    from txnguard.llm import common

    left, delete = [], common.fs.delete
    monkeypatch.setattr(common.fs, "delete", lambda s, path: left.append(path.rsplit("/", 1)[1].split("-")[0]) or delete(s, path))
    rows = passages(seed=9, n=40)
    found = suffix_dedup.suffix_dedup(make_docs(rows), length=50)
    assert left == ["places"]
    assert Counter((as_key(r[0]), *r[1:5]) for r in found.collect()) == brute_removed(rows, 50)
