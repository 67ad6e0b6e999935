"""Removal of repeated byte strings by bucket-pointer refinement.

Suffix sorting by bucket pointers begins with buckets of equal q-grams and refines
them by sorting on the bucket identifiers at later offsets; each round's
identifiers are the next round's keys, so the length that a bucket stands for
grows geometrically. Here only strings of ``length`` bytes matter, and only buckets
that hold more than one document, so refinement stops at ``length`` and a place
leaves as soon as its bucket has one document.

Three steps:

1. Initial buckets. Of the q-grams in each string of ``length`` bytes the one of
   least hash is its anchor, so equal strings have equal anchors at the same
   offset, and few places are anchors. Anchors are dealt by hash, with a few bits
   of the bytes on either side: strings that are equal beyond the anchor agree on
   at least half of what surrounds it. Anchors alone in their document go.
2. Refinement. All strings of a surviving anchor are one content. Contents meet by
   96 bits of two hashes: of those that are equal, all but the smallest document's
   are to be removed whole, and one row of it goes on. Of these distinct contents only
   those that share the anchor and the whole side of it inside their strings with
   another send their bytes. They are dealt by that, so that a frequent anchor's strings
   part by what surrounds it, and buckets are refined to ``length``. A string's smallest document is then known, and where it
   starts in a larger one it is to be removed, at all places of the content.
3. Cutting. Each text meets its intervals.

Before each shuffle a task settles what it can on its own rows: all but the first
occurrence it holds need not meet the others, so what meets for a very frequent
passage is a few rows a task. Rows follow the strings, and each place is sent once.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from txnguard.llm.common import batch_of, lean, materialise, scratch_scope, text_batches
from txnguard.llm.span_hash import MULTIPLIER, SpanHash

PLACE_BITS = 17  # a slice has fewer bytes than this allows; its arrays fit a core's cache
SLICE = 1 << (PLACE_BITS - 1)
NULL_ID = -(1 << 63)


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal significance together, so that shuffle compression sees the zeros."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unplanes(raw: memoryview, n: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T).reshape(-1).view(dtype)


def pack(*columns: np.ndarray) -> bytes:
    return np.array([len(columns[0])], "<i8").tobytes() + b"".join(map(planes, columns))


def unpack(raw: bytes, dtypes: list) -> tuple[list[np.ndarray], bytes]:
    """The columns that ``pack`` wrote, and what follows them."""
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for d in dtypes:
        out.append(unplanes(memoryview(raw)[at:], n, d))
        at += n * np.dtype(d).itemsize
    return out, raw[at:]


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)


def shared(keys: np.ndarray, docs: np.ndarray, real: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is held by more than one document, and for one place of each
    key, that it stands for it. Where ``real`` is false the place has no key; where ``known`` is
    true its key is known to be shared, whatever other places stand here."""
    many, first = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    at = np.flatnonzero(real)
    order = at[np.argsort(keys[at])]
    begin = runs(keys[order])
    if len(begin):
        least, most = np.minimum.reduceat(docs[order], begin), np.maximum.reduceat(docs[order], begin)
        several = least < most if known is None else (least < most) | np.logical_or.reduceat(known[order], begin)
        many[order] = np.repeat(several, np.diff(np.append(begin, len(order))))
        first[order[begin]] = True
    return many, first


class Anchors:
    """Anchors of the documents of one slice: place, first and last string it stands for."""

    def __init__(self, raw: list[bytes], length: int, q: int):
        self.buffer = np.frombuffer(b"".join(raw) + bytes(length), np.uint8)
        sizes = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        grams = {1: (self.buffer.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)}
        grams[1] ^= grams[1] >> np.uint64(29)
        self.grams, width = grams, 1
        while 2 * width <= q:
            grams[2 * width] = self._joined(grams[width][:-width], grams[width][width:], width)
            width *= 2
        h = self.hash_at(slice(None), q)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        self.hashes = h
        span = length - q + 1  # q-grams in a string
        low = np.uint64((1 << PLACE_BITS) - 1)
        best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        got = 1
        while 2 * got <= span:
            best = np.minimum(best[:-got], best[got:])
            got *= 2
        if got < span:
            best = np.minimum(best[: len(best) - (span - got)], best[span - got :])
        # Strings inside one document.
        starts = np.ones(n, bool)
        tail = np.minimum(sizes, length - 1)
        past = np.repeat(ends - tail, tail) + np.arange(tail.sum()) - np.repeat(np.cumsum(tail) - tail, tail)
        starts[past] = False
        starts = np.flatnonzero(starts)
        doc = np.repeat(np.arange(len(sizes)), sizes - tail)
        place = (best[starts] & low).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        self.first, self.last = starts[begin], starts[np.append(begin[1:], len(starts)) - 1] if len(starts) else starts
        self.place, self.doc = place[begin], doc[begin]
        self.doc_start, self.doc_end = (ends - sizes)[self.doc], ends[self.doc]

    @staticmethod
    def _joined(a: np.ndarray, b: np.ndarray, width_of_b: int) -> np.ndarray:
        return a * np.uint64(pow(MULTIPLIER, width_of_b, 1 << 64)) + b

    def hash_at(self, at, width: int) -> np.ndarray:
        """Hash of ``width`` bytes from each place in ``at`` (an array, or all places)."""
        out, done = None, 0
        for w in sorted(self.grams, reverse=True):
            while done + w <= width:
                g = self.grams[w]
                part = g[done : len(self.buffer) - width + 1 + done] if isinstance(at, slice) else g[at + done]
                out, done = part if out is None else self._joined(out, part, w), done + w
        return out

    def sides(self, q: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """8 bits of the ``reach`` bytes before and after each anchor; 0 if the document has fewer."""
        out = []
        for at, real in ((self.place - reach, self.place - reach >= self.doc_start), (self.place + q, self.place + q + reach <= self.doc_end)):
            h = self.hash_at(np.where(real, at, 0), reach)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)
            out.append(np.where(real, h % np.uint64(255) + np.uint64(1), 0).astype(np.uint8))
        return out[0], out[1]


def slices(batches, columns: tuple[str, ...], length: int):
    """Slices of Arrow batches (column ``text`` as bytes): for each piece of a document its
    row's other columns, where the piece begins, and its bytes. Strings are dealt to
    pieces by where they start, so each string is whole in one piece."""
    rows, sizes = [], 0
    for batch in batches:
        others = [batch.column(c).to_pylist() for c in columns]
        k = 0
        for _, texts in text_batches([batch.rename_columns(["doc_id" if n == "_key" else n for n in batch.schema.names])], SLICE):
            for raw in texts:
                for base in range(0, max(1, len(raw) - length + 1), SLICE - length):
                    piece = raw[base : base + SLICE - 1]
                    if sizes + len(piece) > SLICE and rows:
                        yield rows
                        rows, sizes = [], 0
                    rows.append((tuple(c[k] for c in others), base, piece))
                    sizes += len(piece)
                k += 1
    if rows:
        yield rows


ANCHOR_TYPES = [np.uint32, np.uint16, np.uint8, np.uint8, np.int64, np.uint32, np.int64, np.uint8]


def anchor_rows(length: int, q: int, buckets: int, held: int):
    """Step 1, map side: rows ``bucket, blob`` of anchors; ``bucket`` -1 marks anchors
    that are settled already."""
    reach = (length - q) // 2

    def flush(parts):
        h, left, right, doc, tag, place = (np.concatenate(x) for x in zip(*parts))
        wide = (h >> np.uint64(16)) << np.uint64(8)
        a, first_a = shared(wide | left, doc, left > 0)
        b, first_b = shared(wide | right, doc, right > 0)
        settled = a | b
        kept = ~settled | first_a | first_b
        gone = settled & ~kept
        out = [(-1, pack(doc[gone], tag[gone], place[gone]))] if gone.any() else []
        at = np.flatnonzero(kept)
        bucket = ((h[at] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        at, bucket = at[order], bucket[order]
        begin = runs(bucket)
        for s, e in zip(begin, np.append(begin[1:], len(at))):
            i = at[s:e]
            low = (h[i] >> np.uint64(16)).astype(np.uint32)
            high = (h[i] >> np.uint64(48)).astype(np.uint16)
            out.append((int(bucket[s]), pack(low, high, left[i], right[i], doc[i], tag[i], place[i], a[i] + 2 * b[i].astype(np.uint8))))
        return out

    schema = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])

    def run(batches):
        parts, n = [], 0
        for rows in slices(batches, ("_key", "_tag"), length):
            found = Anchors([r[2] for r in rows], length, q)
            key, tag = np.array([r[0][0] for r in rows], np.int64)[found.doc], np.array([r[0][1] for r in rows], np.uint32)[found.doc]
            base = np.array([r[1] for r in rows], np.int64)[found.doc] - found.doc_start
            left, right = found.sides(q, reach)
            parts.append((found.hashes[found.place], left, right, key, tag, found.place + base))
            n += len(key)
            if n >= held:
                yield batch_of(schema, list(map(list, zip(*flush(parts)))))
                parts, n = [], 0
        if n:
            yield batch_of(schema, list(map(list, zip(*flush(parts)))))

    return run


def surviving(group: pa.Table) -> pa.Table:
    """Step 1, reduce side: ``_key, _tag, place, sides`` of anchors that more than one document shares;
    sides is 1 if it's shared with its left side, 2 with its right one, 3 with either."""
    keys, tags, places, either, columns = [], [], [], [], []
    for bucket, raw in zip(group["bucket"].to_pylist(), group["blob"].to_pylist()):
        if bucket < 0:
            (doc, tag, place), _ = unpack(raw, [np.int64, np.uint32, np.int64])
            keys.append(doc)
            tags.append(tag)
            places.append(place)
            either.append(np.full(len(place), 3))
        else:
            columns.append(unpack(raw, ANCHOR_TYPES)[0])
    if columns:
        low, high, left, right, doc, tag, place, settled = (np.concatenate(x) for x in zip(*columns))
        wide = ((high.astype(np.uint64) << np.uint64(32)) | low) << np.uint64(8)
        # A settled place stands for others of its key, which may be of other documents.
        sides = shared(wide | left, doc, left > 0, settled & 1 > 0)[0] + 2 * shared(wide | right, doc, right > 0, settled & 2 > 0)[0].astype(np.int64)
        keys.append(doc[sides > 0])
        tags.append(tag[sides > 0])
        places.append(place[sides > 0])
        either.append(sides[sides > 0])
    none = [np.zeros(0, np.int64)]
    return pa.table({"_key": np.concatenate(keys or none), "_tag": np.concatenate(tags or none).astype(np.int32), "place": np.concatenate(places or none), "sides": np.concatenate(either or none)})


SECOND = 0xD1342543DE82EF95  # multiplier of the second hash
CONTENT = "h1 long, h2 int, _one long, who long, place long, left long, right long"
NO_ID = 1 << 16  # tags from here on are those of rows without an id
# Bits of ``place``: start of the content, its size, where the anchor is in it, the sides, whether it's settled.
START, SIZE, AT, SIDES = 20, 12, 4, 1


def content_rows(length: int, q: int, held: int):
    """Step 2, map side: a row for each surviving anchor with the bytes around it, as
    hashes of 64 and 32 bits (``h1, h2``) of all strings it stands for. ``who`` is the
    text's ``_id`` and ``_tag``, ``place`` as the bits above say; the last marks what a
    smaller document here holds too. ``left`` and ``right`` are hashes of the anchor with
    the whole of one side. Column ``places`` has four times each place, plus its sides."""
    reach = (length - q) // 2
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32()}[c.split()[1]]) for c in CONTENT.split(", ")])

    def flush(parts):
        h1, h2, one, who, place, left, right = (np.concatenate(x) for x in zip(*parts))
        key = np.where(who & (2 * NO_ID - 1) >= NO_ID, NULL_ID, one)
        # Only contents whose first hash is here twice can have equals.
        order = np.argsort(h1)
        like = h1[order][1:] == h1[order][:-1]
        order = order[np.append(like, False) | np.append(False, like)]
        order = order[np.lexsort((place[order], who[order], one[order], key[order], h2[order], h1[order]))]
        new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))[: len(order)]
        gone, again = np.zeros(len(h1), bool), np.zeros(len(h1), bool)
        gone[order] = key[order] > np.repeat(key[order][new], np.diff(np.append(np.flatnonzero(new), len(order))))
        # Repeated rows give a place more than once: once is enough.
        again[order[1:]] = ~new[1:] & np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in (one, who, place >> START)])
        # What is settled needn't meet its like: it is dealt anywhere, and its hashes say nothing.
        h1 = np.where(gone, (one ^ place * 0x5851F42D4C957F2D).view(np.uint64) * np.uint64(MULTIPLIER), h1).view(np.int64)
        h2, left, right = (np.where(gone, 0, c) for c in (h2, left, right))
        return batch_of(schema, [pa.array(c[~again]) for c in (h1, h2, one, who, place + gone, left, right)])

    def run(batches):
        first_hash, second_hash = SpanHash(), SpanHash(SECOND)
        parts, n = [], 0
        for rows in slices(batches, ("_key", "_tag", "_id", "places"), length):
            found = Anchors([r[2] for r in rows], length, q)
            base = np.array([r[1] for r in rows], np.int64)[found.doc] - found.doc_start
            alive = np.sort(np.concatenate([np.array(r[0][3], np.int64) + (k << 42) for k, r in enumerate(rows)]))
            begin = runs(alive >> 2)
            sides_of = np.bitwise_or.reduceat(alive & 3, begin) if len(begin) else alive
            alive = alive[begin] >> 2
            where = found.place + base + (found.doc << 40)
            i = np.minimum(np.searchsorted(alive, where), max(len(alive) - 1, 0))
            sides = np.where(alive[i] == where, sides_of[i], 0) if len(alive) else np.zeros(len(where), np.int64)
            # A string holds the bytes on the left of its anchor if it starts there or before, else those on the right.
            turn = found.place - reach
            real = (found.first <= turn) + 2 * (found.last > turn)
            c = np.flatnonzero(sides & real)
            if not len(c):
                continue
            start, end, place = found.first[c], found.last[c] + length, found.place[c]
            one, tag, id_ = (np.array([r[0][k] for r in rows], np.int64)[found.doc[c]] for k in range(3))
            h1, h2 = first_hash.spans(found.buffer, start, end), (second_hash.spans(found.buffer, start, end) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            with_side = []
            for bit, at in ((1, np.maximum(turn[c], 0)), (2, place + q)):
                h = found.hash_at(at, reach)
                h = (found.hashes[place] ^ (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(MULTIPLIER)
                h = (h ^ h >> np.uint64(32)) & ~np.uint64(1) | np.uint64(bit - 1)  # the two sides apart
                with_side.append(np.where(real[c] & bit, h, 0).view(np.int64))
            bits = (start + base[c] << START) + (end - start << SIZE) + (place - start << AT) + ((sides & real)[c] << SIDES)
            parts.append((h1, h2, one, (id_ << 32) + tag, bits, *with_side))
            n += len(c)
            if n >= held:
                yield flush(parts)
                parts, n = [], 0
        if n:
            yield flush(parts)

    return run


def field_of(place, shift: int, bits: int) -> Column:
    return F.shiftright(place, shift).bitwiseAND((1 << bits) - 1).cast("int")


def judged(contents: DataFrame) -> DataFrame:
    """``_one, who, place`` of each content; ``top`` if the smallest document that holds it
    anywhere is the row's, all else is to be removed whole. The first row of those
    represents the content: it has ``left`` and ``right`` where that side is shared, the
    others have its ``f_one, f_who, f_place``.

    Before the shuffle each task keeps one document of a content, so the rows of a
    content are those of as many tasks' flushes, however many documents hold it.
    """
    none = F.col("who").bitwiseAND(2 * NO_ID - 1) >= NO_ID
    same = Window.partitionBy("h1", "h2").orderBy(~none, "_one", "who", "place")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {f"f_{c.strip('_')}": F.first(c).over(whole) for c in ("_one", "who", "place")}
    out = contents.withColumns(first | {"sides": F.bit_or("place").over(whole), "nth": F.row_number().over(same)})
    f_none = F.col("f_who").bitwiseAND(2 * NO_ID - 1) >= NO_ID
    # Without an id is one document, and less than any.
    top = (F.col("place").bitwiseAND(1) == 0) & F.when(f_none, none).otherwise(~none & (F.col("_one") == F.col("f_one")))
    rep = F.col("nth") == 1
    return out.select(
        "_one",
        "who",
        F.col("place").bitwiseAND(-1 << AT).alias("place"),
        top.alias("top"),
        *(F.when(top & rep & (field_of("sides", SIDES, 2).bitwiseAND(b) > 0) & (F.col(c) != 0), F.col(c)).alias(c) for c, b in (("left", 1), ("right", 2))),
        *(F.when(top & ~rep, F.col(c).bitwiseAND(-1 << AT) if c == "f_place" else F.col(c)).alias(c) for c in first),
    )


def dealt_keys(reps: DataFrame) -> DataFrame:
    """``key, _one, who, place`` for each anchor with one whole side (``key``) that several
    distinct contents hold: only they can share a string with another."""
    sides = F.filter(F.array("left", "right"), lambda k: k.isNotNull())
    each = reps.select(F.explode(sides).alias("key"), "_one", "who", "place")
    return each.withColumn("_n", F.count("*").over(Window.partitionBy("key"))).where("_n > 1").drop("_n")


def string_rows(keys: DataFrame, spread: DataFrame, length: int, q: int, parts: int) -> DataFrame:
    """``bucket, key, _own, _one, who, place, offset, part``: the bytes of each content on the
    side of its key, dealt by the key: the anchor and the whole side of it that lies
    inside all strings of the part."""
    reach = (length - q) // 2
    by_doc = keys.withColumn("_doc", doc_of("_one", "who")).groupBy("_doc").agg(F.collect_list(F.struct("key", "who", "place")).alias("keys"))
    own = F.filter("keys", lambda r: r["who"] == who_of("_id", "_tag"))

    def cut(r: Column) -> Column:
        start, size, turn = F.shiftright(r["place"], START).cast("int"), field_of(r["place"], SIZE, 8), field_of(r["place"], AT, 8) - reach
        is_right = r["key"].bitwiseAND(1) == 1
        offset = F.when(is_right, F.greatest(turn + 1, F.lit(0))).otherwise(F.lit(0))
        end = F.when(is_right, size).otherwise(F.least(size - length, turn) + length)
        bytes_ = F.substr(F.col("text"), start + offset + 1, end - offset)
        return F.struct(r["key"].alias("key"), r["who"].alias("who"), r["place"].alias("place"), offset.alias("offset"), bytes_.alias("part"))

    key = F.when(F.col("_tag") < NO_ID, F.col("_key")).otherwise(F.lit(NULL_ID)).alias("_own")
    each = spread.join(by_doc, "_doc").select(F.col("_key").alias("_one"), key, F.inline(F.transform(own, cut)))
    return each.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(parts)))


def refined(buffer: np.ndarray, docs: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int, first: int = 8) -> np.ndarray:
    """The smallest document that holds the string of ``length`` bytes at each of ``starts``.

    ``docs`` has the document of each byte, ``ends`` where the text that it is in ends. Buckets begin as equal ``first``-grams and are
    refined by the bucket identifiers ``width`` bytes on, then 2 ``width``, ...; places
    alone in their document take no further part. Buckets hold equal bytes, exactly.
    """
    n = len(buffer) - first + 1
    alive = np.arange(max(n, 0))
    alive = alive[alive + first <= ends[alive]]
    key = np.zeros(len(alive), np.uint64)
    for i in range(min(first, 8)):
        key = (key << np.uint64(8)) | buffer[alive + i].astype(np.uint64)
    pointer = np.full(len(buffer) + length, -1, np.int64)
    width = first
    while True:
        order = np.argsort(key)
        begin = runs(key[order])
        sizes = np.diff(np.append(begin, len(order)))
        owner = docs[alive[order]]
        many = np.repeat(np.minimum.reduceat(owner, begin) < np.maximum.reduceat(owner, begin), sizes) if len(begin) else np.zeros(0, bool)
        identifier = np.repeat(np.arange(len(begin)), sizes)
        pointer[:] = -1
        if width == length:
            least = np.full(len(buffer) + 1, np.iinfo(np.int64).max)
            if len(begin):
                least[alive[order]] = np.repeat(np.minimum.reduceat(owner, begin), sizes)
            return np.minimum(least[starts], docs[starts])
        alive = alive[order[many]]
        pointer[alive] = identifier[many]
        further = min(width, length - width)
        later = pointer[alive + further]
        width += further
        held = (later >= 0) & (alive + width <= ends[alive])
        alive, later = alive[held], later[held]
        key = pointer[alive].astype(np.uint64) << np.uint64(32) | later.astype(np.uint64)


def runs_of(length: int):
    """Step 2, reduce side: ``_one, who, place, from, to``, what is to be removed of a content."""

    def run(group: pa.Table) -> pa.Table:
        key, own, one, who, place, offset = (group[c].to_numpy().astype(np.int64) for c in ("key", "_own", "_one", "who", "place", "offset"))
        # Rows of one document that repeats send a part again.
        order = np.lexsort((place, who, one, key))
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in (key, one, who, place)])
        row = order[new]
        raw = group["part"].take(pa.array(row)).to_pylist()
        sizes = np.array([len(r) for r in raw], np.int64)
        buffer = np.frombuffer(b"".join(raw), np.uint8)
        begin = np.append(0, np.cumsum(sizes))
        docs, strings = np.repeat(own[row], sizes), sizes - length + 1
        first = np.append(0, np.cumsum(strings))
        at = np.arange(first[-1]) - np.repeat(first[:-1], strings)
        starts = at + np.repeat(begin[:-1], strings)
        remove = refined(buffer, docs, np.repeat(begin[1:], sizes), starts, length) < docs[starts]
        of = np.repeat(np.arange(len(row)), strings)
        new, end = remove.copy(), remove.copy()
        new[1:] &= ~(remove[:-1] & (of[1:] == of[:-1]))
        end[:-1] &= ~(remove[1:] & (of[1:] == of[:-1]))
        i = row[of[new]]
        return pa.table({"_one": one[i], "who": who[i], "place": place[i], "from": offset[i] + at[new], "to": offset[i] + at[end] + length})

    return run


def keyed_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``_doc, _key, _tag, _id, text``. ``_key`` is the id (for rows without one, a hash of
    the text), ``_tag`` and ``_id`` are bits of a hash of id and text, and ``_doc``, by which
    rows are dealt, is a hash of ``_key`` and ``_tag``: rows that share an id, or have none, are
    many keys, and what is sent of a row says little more than its id."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    id_ = F.col(f"`{id_col}`").cast("long")
    each = F.xxhash64(F.coalesce(id_, F.lit(NULL_ID)), text)
    rows = docs.select(id_.alias("_own"), each.alias("_each"), text.cast("binary").alias("text"), *more)
    key, tag = F.coalesce("_own", "_each"), (F.col("_each").bitwiseAND(NO_ID - 1) + F.when(F.col("_own").isNull(), NO_ID).otherwise(0)).cast("int")
    rows = rows.withColumns({"_key": key, "_tag": tag, "_id": F.shiftright("_each", 32).cast("int")})
    return rows.withColumn("_doc", F.xxhash64("_key", "_tag")).drop("_own", "_each")


def who_of(id_: str, tag: str) -> Column:
    return F.shiftleft(F.col(id_).cast("long"), 32) + F.col(tag)


def doc_of(one: str, who: str) -> Column:
    """``_doc`` of a text, from what is sent of it."""
    return F.xxhash64(F.col(one), F.col(who).bitwiseAND(2 * NO_ID - 1).cast("int"))


def true_id(batch: pa.RecordBatch) -> list:
    """The rows' ids, None where there is none."""
    return [k if t < NO_ID else None for k, t in zip(batch.column("_key").to_pylist(), batch.column("_tag").to_pylist())]


def repeated_intervals(
    source: DataFrame, spread: DataFrame, length: int = 50, q: int = 20, bucket_bytes: int = 4 << 20, bucket_strings: int = 10_000, held: int = 300_000
) -> DataFrame:
    """``_doc, spans`` (_id; 256 times the start, plus the size) of documents with bytes to remove.

    ``source`` is ``keyed_text`` as read, ``spread`` the same dealt out by ``_doc``.
    """
    if not q < length <= (255 + q) // 2:
        raise ValueError(f"length must be over {q} and at most {(255 + q) // 2}")  # sizes are sent as bytes
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    anchors = source.select("_key", "_tag", "text").mapInArrow(lean(anchor_rows(length, q, buckets, held)), "bucket long, blob binary")
    # Settled anchors are dealt evenly: their bucket is negative and only marks them.
    deal = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("blob"), F.lit(buckets))).otherwise(F.col("bucket"))
    alive = anchors.withColumn("bucket", deal).groupBy("bucket").applyInArrow(surviving, "_key long, _tag int, place long, sides long")
    place = F.shiftleft("place", 2).bitwiseOR(F.col("sides"))
    with scratch_scope(source.sparkSession):  # places are read for the contents alone
        # As many places as a text has anchors, at most.
        places = materialise(alive.groupBy(F.xxhash64("_key", "_tag").alias("_doc")).agg(F.collect_set(place).alias("places")), "places")
        n = places.agg(F.sum(F.size("places"))).first()[0] or 0
        contents = spread.join(places, "_doc").mapInArrow(lean(content_rows(length, q, held)), CONTENT)
        known = materialise(judged(contents), "contents", keep=True)
    keys = dealt_keys(known.where("top AND f_one IS NULL"))
    strings = string_rows(keys, spread, length, q, max(1, math.ceil(n / bucket_strings)))
    cuts = strings.groupBy("bucket").applyInArrow(runs_of(length), "_one long, who long, place long, from long, to long")
    # Where the smallest document holds a content again, the same goes there.
    others = known.where("f_one IS NOT NULL").select(
        "_one", "who", "place", F.col("f_one").alias("_f1"), F.col("f_who").alias("_f2"), F.col("f_place").alias("_f3")
    )
    same = [F.col("c._one") == F.col("_f1"), F.col("c.who") == F.col("_f2"), F.col("c.place") == F.col("_f3")]
    again = others.alias("o").join(cuts.alias("c"), same).select("o._one", "o.who", "o.place", "from", "to")
    whole = known.where("NOT top").select("_one", "who", "place", F.lit(0).cast("long").alias("from"), field_of("place", SIZE, 8).cast("long").alias("to"))
    found = whole.unionByName(cuts).unionByName(again)
    # Start and size in one number.
    span = F.shiftleft(F.shiftright("place", START) + F.col("from"), 8) + (F.col("to") - F.col("from"))
    found = found.select(doc_of("_one", "who").alias("_doc"), F.shiftright("who", 32).cast("int").alias("_id"), span.alias("span")).repartition("_doc")
    return found.groupBy("_doc").agg(F.collect_set(F.struct("_id", "span")).alias("spans"))


def removed(batch: pa.RecordBatch):
    """Text and runs of bytes to remove, row by row."""
    spans = batch.column("spans")
    counts = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    own, found = batch.column("_id").to_numpy(zero_copy_only=False), spans.flatten()
    row = np.repeat(np.arange(len(counts)), counts)
    id_, span = (found.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    mine = id_ == own[row]
    row, span = row[mine], span[mine]
    order = np.lexsort((span, row))
    row, span = row[order].astype(np.int64) << 42, span[order]
    start, end = row + (span >> 8), row + (span >> 8) + (span & 255)
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])[: len(start)]
    last = np.append(new[1:], True)[: len(start)]
    row, start, end = row[new] >> 42, start[new] - row[new], reach[last] - row[new]
    at = np.searchsorted(row, np.arange(len(counts) + 1))
    runs_ = list(zip(start.tolist(), end.tolist()))
    for k, raw in enumerate(batch.column("text").to_pylist()):
        yield raw, runs_[at[k] : at[k + 1]]


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the bytes that ``suffix_dedup`` finds cut out of the texts.

    Characters that a cut goes through are dropped. Rows whose text was all cut out
    go; null and empty texts stay. All other columns stay as they are.
    """
    source = keyed_text(docs, id_col, text_col)
    others = [c for c in docs.columns if c != text_col]
    null = F.col(f"`{text_col}`").isNull().alias("null")
    row = F.struct(null, *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others))).alias("_row")
    spread = keyed_text(docs, id_col, text_col, row).repartition("_doc")
    spans = repeated_intervals(source, spread, length, **options)

    def cut(batches):
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            texts = []
            for raw, gone in removed(batch):
                ends = [0, *(e for _, e in gone)]
                kept = b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in gone), len(raw)]))
                texts.append(kept.decode("utf-8", "ignore") if kept or not raw else None)
            if texts:
                yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], ["_row", "text"])

    schema = T.StructType([spread.schema["_row"], T.StructField("text", T.StringType())])
    left = spread.join(spans, "_doc", "left").mapInArrow(lean(cut), schema).where("text IS NOT NULL")
    columns = {c: F.col(f"_row.c{i}") for i, c in enumerate(others)} | {text_col: F.when(~F.col("_row.null"), F.col("text"))}
    return left.select(*(columns[c].alias(c) for c in docs.columns))


def suffix_dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Removed is each byte covered by a string of ``length`` bytes that also starts in a
    document of smaller id; strings are judged on the input. ``n_spans`` counts maximal
    removed runs. ``with_kept=True`` adds ``kept`` (binary, what remains) and ``spans``.

    ``length`` is between 21 and 137. Ids are integers; a null id is smaller than all others and stays null. Rows of
    one id don't remove each other's bytes. A null text counts as empty: 0 bytes,
    nothing removed. Repeated rows give repeated rows; an empty table gives none;
    other columns are ignored.
    """
    source = keyed_text(docs, id_col, text_col)
    spread = source.repartition("_doc")  # one shuffle of the texts serves all joins
    spans = repeated_intervals(source, spread, length, **options)
    more = ", kept binary, spans array<struct<start: long, end: long>>" if with_kept else ""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + more

    struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary(), struct] * with_kept
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "spans"] * with_kept

    def cut(batches):
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for id_, (raw, gone) in zip(true_id(batch), removed(batch)):
                ends = [0, *(e for _, e in gone)]
                kept = b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in gone), len(raw)]))
                spans = [{"start": s, "end": e} for s, e in gone]
                out.append((id_, len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept, spans))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return spread.join(spans, "_doc", "left").mapInArrow(lean(cut), schema)
