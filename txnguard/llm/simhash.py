"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has a bit where more than half of the hashes of a text's word
shingles have it. Fingerprints that differ in at most ``distance`` of 64 bits
agree in at least ``blocks - distance`` of ``blocks`` blocks, so each fingerprint
is dealt out under each such choice of blocks, fingerprints with a key in common
are candidates, and candidates link after their Hamming distance is verified.

Rows with the same fingerprint are one node from the start, so exact copies cost
nothing. A key's few fingerprints are compared by a join; a crowded key is
searched breadth-first in parts of bounded size, which finds all links that
matter for reachability but returns a tree, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from txnguard.llm.common import arrow_schema, batch_of, id_text, lean, materialise, schema_with, scratch_scope, text_batches
from txnguard.llm.components import connected_components

BITS = 64


def fingerprint(text: str, words: int = 3, seed: int = 42, part: int = 65536) -> int:
    """64 bits, unsigned; 0 for a text without words."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not found:
        return 0
    line, ends = b" ".join(found), []
    at = -1
    for w in found:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest, n = xxhash.xxh64_intdigest, max(1, len(found) - words + 1)
    stops = ends[words - 1 :] or ends[-1:]
    count = np.zeros(BITS, np.int64)
    for i in range(0, n, part):
        h = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[i : i + part], stops[i : i + part])), np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long) for each row."""
    source = id_text(docs, id_col, text_col)
    schema = schema_with(source, "fp long")
    arrow = arrow_schema(schema)

    def run(batches):
        for ids, texts in text_batches(batches):
            found = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield batch_of(arrow, [ids, found])

    return source.mapInArrow(run, schema)


def tree_links(points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first trees over ``points`` (distinct, unsigned) linked at up to ``distance`` bits."""
    rest, a, b = points, [], []
    queue: list = []
    while len(rest):
        if not queue:
            queue.append(rest[0])
            rest = rest[1:]
        x = queue.pop()
        near = np.bitwise_count(rest ^ x) <= distance
        if near.any():
            a.append(np.full(int(near.sum()), x))
            b.append(rest[near])
            queue.extend(rest[near])
            rest = rest[~near]
    none = points[:0]
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def block_keys(fp, distance: int, blocks: int):
    """Array column of keys: the value of each choice of ``blocks - distance`` blocks."""
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    if blocks <= distance:
        raise ValueError("more blocks than distance are needed")
    keys = []
    for i, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << (edge[c + 1] - edge[c])) - 1) << edge[c] for c in chosen)
        mask = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def links(points: DataFrame, distance: int = 2, blocks: int = 4, few: int = 16, part: int = 8192) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that reach what all
    pairs at up to ``distance`` bits reach. Keys are hashed: equal keys that come from
    other blocks only add candidates, which are verified like any."""
    # Dealt by key once: counting and joining the counts back both use that dealing.
    keyed = points.select("fp", F.explode(block_keys(F.col("fp"), distance, blocks)).alias("key")).repartition("key")
    sizes = keyed.groupBy("key").agg(F.count("fp").alias("n")).where("n > 1")
    shared = materialise(keyed.join(sizes, "key"), "shared")
    small = shared.where(F.col("n") <= few).select("key", "fp")
    pairs = (
        small.select("key", F.col("fp").alias("a"))
        .join(small.select("key", F.col("fp").alias("b")), "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    # Crowded keys: every two parts of a key meet in one group of at most two parts.
    n_parts = F.ceil(F.col("n") / part).cast("int")
    own = F.pmod(F.xxhash64("fp"), n_parts).cast("int")
    crowded = shared.where(F.col("n") > few).select("key", "fp", n_parts.alias("parts"), own.alias("own"))
    met = crowded.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    met = met.select("key", "fp", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))

    def search(group: pa.Table) -> pa.Table:
        a, b = tree_links(np.unique(group["fp"].to_numpy()).view(np.uint64), distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    trees = met.groupBy("key", "p", "q").applyInArrow(search, "a long, b long")
    return pairs.union(trees)


def simhash_components(
    docs: DataFrame, words: int = 3, distance: int = 2, blocks: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest doc_id
    reachable by links, the row's own included. A text of fewer than ``words`` words
    is one shingle; one without words, or a null text, has fingerprint zero, linked
    like any other. Null ids are never a component's smallest (null if all are);
    repeated rows give repeated rows; an empty table gives none; other columns are
    ignored.
    """
    found = materialise(fingerprints(docs, words, id_col, text_col), "fingerprints")
    points = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = materialise(connected_components(links(points.select("fp"), distance, blocks)), "roots")
    # Few fingerprints link to others; only those need their component's smallest id looked up.
    rooted = points.join(roots, points["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.select("fp", "root").join(materialise(smallest, "smallest"), "root").select("fp", "component_id"), "named")
    return found.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: str, words: int) -> np.ndarray:
    """Distinct hashes of a text's word shingles; of all its words if there are fewer."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.int64)
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(found[i : i + words])) for i in range(n)), np.uint64).view(np.int64))


MINIMA = 256  # min-wise values of a text
BAND, BANDS = 5, 24  # values in a band key, band keys
SKETCH_BITS = 47  # most differing bits of a sketch; at a Jaccard of 0.8 the mean is 26, the deviation 5
_rng = np.random.default_rng(42)
_ODD = _rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 1 << 63, MINIMA, np.uint64)


def sketch(shingles: np.ndarray, part: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and sketch (one bit of each min-wise value) of a set that isn't empty."""
    h = shingles.view(np.uint64)[:, None]
    least = np.full(MINIMA, np.iinfo(np.uint64).max)
    for i in range(0, len(h), part):
        x = (h[i : i + part] ^ _XOR) * _ODD
        x ^= x >> np.uint64(32)
        least = np.minimum(least, x.min(0))
    keys = np.arange(1, BANDS + 1).astype(np.uint64)
    for values in least[: BAND * BANDS].reshape(BANDS, BAND).T:
        keys = (keys ^ values) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    bits = (least * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)
    return keys.view(np.int64), np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketch_trees(fps: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first trees over rows whose sketches (unsigned) are close, as links of their fingerprints."""
    rest, a, b = np.arange(len(fps)), [fps[:0]], [fps[:0]]
    queue: list = []
    while len(rest):
        if not queue:
            queue.append(rest[0])
            rest = rest[1:]
        x = queue.pop()
        near = np.bitwise_count(sketches[rest] ^ sketches[x]).sum(1) <= SKETCH_BITS
        if near.any():
            a.append(np.full(int(near.sum()), fps[x]))
            b.append(fps[rest[near]])
            queue.extend(rest[near])
            rest = rest[~near]
    return np.concatenate(a), np.concatenate(b)


SKETCH = [f"s{i}" for i in range(MINIMA // 64)]


def sketches(docs: DataFrame, words: int, check_words: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fp, keys`` and sketch columns for each row; no keys for a text without words."""
    source = id_text(docs, id_col, text_col)
    schema = schema_with(source, "fp long, keys array<long>, " + ", ".join(f"{n} long" for n in SKETCH))
    arrow = arrow_schema(schema)
    none = np.zeros(0, np.int64), np.zeros(len(SKETCH), np.int64)

    def run(batches):
        for ids, texts in text_batches(batches):
            found = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            keys, bits = zip(*(sketch(s) if len(s := shingle_set(t, check_words)) else none for t in texts))
            yield batch_of(arrow, [ids, found, [k.tolist() for k in keys], *np.stack(bits).T])

    return source.mapInArrow(lean(run), schema)


def shingle_links(points: DataFrame, few: int = 16, part: int = 4096) -> DataFrame:
    """``a, b``: links of the fingerprints of texts (``sketches``, distinct) that are alike in their shingles.

    Texts that agree in a band of min-wise values are candidates; those with close
    sketches link. Of the pairs at a Jaccard of 0.8 one in ten thousand shares no
    band, of those above fewer.
    """
    names = SKETCH
    keyed = points.select("fp", *names, F.explode("keys").alias("key")).repartition("key")
    sizes = keyed.groupBy("key").agg(F.count("fp").alias("n")).where("n > 1")
    shared = materialise(keyed.join(sizes, "key"), "alike")
    small = shared.where(F.col("n") <= few)
    other = small.select("key", F.col("fp").alias("b"), *(F.col(n).alias(f"o{n}") for n in names))
    apart = sum(F.bit_count(F.col(n).bitwiseXOR(F.col(f"o{n}"))) for n in names)
    pairs = small.join(other, "key").where((F.col("fp") < F.col("b")) & (apart <= SKETCH_BITS)).select(F.col("fp").alias("a"), "b")
    # Crowded keys: every two parts of a key meet in one group of at most two parts.
    n_parts = F.ceil(F.col("n") / part).cast("int")
    own = F.pmod(F.xxhash64("fp", *names), n_parts).cast("int")
    crowded = shared.where(F.col("n") > few).select("key", "fp", *names, n_parts.alias("parts"), own.alias("own"))
    met = crowded.select("key", "fp", *names, "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    met = met.select("key", "fp", *names, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))

    def search(group: pa.Table) -> pa.Table:
        a, b = sketch_trees(group["fp"].to_numpy(), np.stack([group[n].to_numpy().view(np.uint64) for n in names], 1))
        return pa.table({"a": a, "b": b})

    return pairs.union(met.groupBy("key", "p", "q").applyInArrow(search, "a long, b long").where("a != b")).distinct()


def beaten(group: pa.Table) -> pa.Table:
    """Of links (larger ``key``, smaller ``lead``) of one component: keys alike to a smaller one that leads."""
    smaller: dict = {}
    for k, lead in zip(group["key"].to_pylist(), group["lead"].to_pylist()):
        smaller.setdefault(tuple(k.values()), []).append(tuple(lead.values()))
    lost: set = set()
    for k in sorted(smaller):
        if any(x not in lost for x in smaller[k]):
            lost.add(k)
    return pa.table({"_id": pa.array([k[0] for k in lost], pa.int64()), "_hash": pa.array([k[1] for k in lost], pa.int64())})


def near_copies(pending: DataFrame, least: float, most: int = 512) -> DataFrame:
    """``key`` of the rows of ``pending`` (root, key, set) that are alike to a smaller
    one of their root that stays; run until no row is left to judge.

    The first rows of each root lead: one, then four times as many each round, up to
    ``most``, so a root of many unlike rows takes few rounds. Which rows stay doesn't
    depend on how many lead at a time.
    """
    gone, leads = pending.select("key").limit(0), 1
    common = F.size(F.array_intersect("set", "lead.set"))
    alike = common >= least * (F.size("set") + F.size("lead.set") - common)
    while not pending.isEmpty():
        place = F.row_number().over(Window.partitionBy("root").orderBy("key"))
        with scratch_scope(pending.sparkSession):  # of a round only what it judged and left stays
            lead = materialise(pending.withColumn("place", place).where(F.col("place") <= leads).select("root", F.struct("key", "set").alias("lead")), "lead")
            if leads > 1:
                heads = lead.select("root", "lead.*")
                links = heads.join(lead, "root").where((F.col("lead.key") < F.col("key")) & alike).select("root", "key", F.col("lead.key").alias("lead"))
                lost = links.groupBy("root").applyInArrow(beaten, "_id long, _hash long").select(F.struct("_id", "_hash").alias("key"))
                lead = materialise(heads.join(lost, "key", "left_anti").select("root", F.struct("key", "set").alias("lead")), "lead")
            led = F.col("key") == F.col("lead.key")
            judged = pending.join(lead, "root").select("key", led.alias("led"), alike.alias("alike")).where("led OR alike")
            judged = materialise(judged.select("key", "led").distinct(), "judged", keep=True)
        gone = gone.union(judged.where("NOT led").select("key"))
        pending = materialise(pending.join(judged.select("key"), "key", "left_anti").select("root", "key", "set"), "pending")
        leads = min(4 * leads, most)
    return gone


def one_of_each_group(
    docs: DataFrame,
    words: int = 3,
    distance: int = 5,
    blocks: int = 8,
    check_words: int = 5,
    least: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    close: int = 2,
    close_blocks: int = 4,
) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row of smallest id stays.

    Fingerprints (``words``-word shingles) of up to ``close`` differing bits link as in
    ``simhash_components``: of each such component the row of smallest id stays. Wider
    components of SimHash links (up to ``distance`` bits) and of ``shingle_links``
    (``check_words``-word shingles) hold candidates, which are checked as well. Of each
    text in one, the row of smallest id stays. Then the component's smallest id leads:
    texts that share at least ``least`` of their ``check_words``-word shingles with it
    (Jaccard, exact) go; of the rest the smallest leads next, until none is left. What
    is like no leader, and close to no smaller row, stays.

    Of repeated rows (same id and text) one stays. Null texts count as empty; a null
    id is the smallest. Ids are integers. All columns stay as they are.
    """
    # Columns of the input stand inside a struct, under names that can't clash.
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("_doc")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    id_ = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    tagged = docs.select(row, id_.alias("_id"), F.xxhash64(text).alias("_hash"))
    key, text_at = F.struct("_id", "_hash"), docs.columns.index(text_col)
    found = materialise(sketches(tagged.select(key.alias("k"), F.col(f"_doc.c{text_at}").alias("t")), words, check_words, "k", "t"), "fingerprints")
    points = materialise(found.select("fp").distinct(), "points")
    close_roots = materialise(connected_components(links(points, close, close_blocks)), "close")
    near = found.join(close_roots, found["fp"] == close_roots["node"], "left").select(F.col("doc_id").alias("key"), F.coalesce("root", "fp").alias("root"))
    near = materialise(near, "near")
    linked = near.join(near.groupBy("root").agg(F.min("key").alias("first")), "root").where("key != first").select("key")
    alike = shingle_links(materialise(found.select("fp", "keys", *SKETCH).distinct(), "sketches"))
    roots = materialise(connected_components(links(points, distance, blocks).union(alike)), "roots")
    named = found.join(roots, found["fp"] == roots["node"], "left").select(F.col("doc_id").alias("key"), F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "named")
    texts = materialise(named.groupBy("root", F.col("key._hash").alias("hash")).agg(F.min("key").alias("first")), "texts")
    copies = named.join(texts.select("hash", "first"), named["key"]["_hash"] == texts["hash"]).where("key != first").select("key")
    several = materialise(texts.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root"), "several")
    members = materialise(texts.join(several, "root").select("root", F.col("first").alias("key")), "members")
    wanted = members.select("key.*").groupBy("_id").agg(F.collect_set("_hash").alias("_wanted"))
    spread = tagged.repartition("_id")

    def sets(batches):
        for batch in batches:
            texts = pa.compute.struct_field(batch.column("_doc"), [text_at]).to_pylist()
            rows = zip(*(batch.column(c).to_pylist() for c in ("_id", "_hash", "_wanted")), texts)
            out = [(i, h, shingle_set(t or "", check_words)) for i, h, w, t in rows if h in w]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["_id", "_hash", "set"])

    shingles = spread.join(wanted, "_id").mapInArrow(lean(sets), "_id long, _hash long, set array<long>").dropDuplicates(["_id", "_hash"])
    pending = materialise(members.join(shingles.select(key.alias("key"), "set"), "key").select("root", "key", "set"), "pending")
    gone = copies.union(linked).union(near_copies(pending, least))
    gone = materialise(gone.select("key.*").distinct(), "gone")
    gone = gone.groupBy("_id").agg(F.collect_set("_hash").alias("_gone"))
    left = spread.join(gone, "_id", "left").where(F.col("_gone").isNull() | ~F.array_contains("_gone", F.col("_hash")))
    return left.dropDuplicates(["_id", "_hash"]).select(*(F.col(f"_doc.c{i}").alias(c) for i, c in enumerate(docs.columns)))
