"""Merkle manifest of a dataset by lag and lead windows.

Rows are leaves of one tree for each group, the groups' roots are the leaves of one
more. A node's children are ``fanout`` consecutive nodes of the level below, so with a
leaf's position everything about its place in the tree is arithmetic: at level k the
node of position p begins at leaf p - p % fanout^k, its siblings begin whole multiples
of fanout^k away, and the length of its run follows from how many leaves there are.

Positions are cut into chunks of fanout^``levels``, which no run of those levels
crosses. Inside a chunk, for each level, lag and lead columns at that fixed distance,
masked by slot and run length, hold a node's siblings on the row of its first leaf, and
rows of first children hash the parents. A running last value hands them to the other
leaves. All levels of a chunk share one shuffle and one sort; what remains, one row a
chunk, goes through the same step until every group is down to its root. No window
holds more than a chunk, whatever the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.llm.common import materialise

DIGEST = 64  # characters of a digest


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def positioned(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (column ``g`` and others) with ``p``, each row's place in its group by
    ``order``, and ``n``, the group's rows.

    Rows are dealt by ranges of (group, order), so a large group is many tasks' work;
    ties are split further, since their places may be swapped. Written before they are
    counted: a range, once dealt, stays.
    """
    keys = ["g", *order]
    ranged = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys)
    ranged = materialise(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.spark_partition_id()), "ranged")
    # One row for each group and task that holds some of it.
    parts = ranged.groupBy("g", "_task").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    by_task = Window.partitionBy("g").orderBy("_task")
    parts = parts.select(
        "g",
        "_task",
        (F.sum("_rows").over(by_task) - F.col("_rows") - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("g")).alias("n"),
    )
    return ranged.join(parts, ["g", "_task"]).withColumn("p", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift")


def climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (g, p, n, h and others) with ``path``, the siblings of the node and its
    ancestors inside its chunk (binary digests, level by level, left to right), and
    ``top``, the digest ``levels`` higher, on the rows of the chunk's first nodes."""
    chunk = Window.partitionBy("g", "_chunk").orderBy("p")
    out = nodes.withColumn("_chunk", F.expr(f"p div {fanout**levels}")).withColumn("_h", F.col("h"))
    away = [d for d in range(1 - fanout, fanout) if d]
    for k in range(levels):
        step = fanout**k
        count = F.expr(f"(n + {step - 1}) div {step}")
        place = F.expr(f"p div {step}")
        slot = place % fanout
        run = F.least(F.lit(fanout), count - (place - slot))
        here = (F.col("p") % step == 0) & (count > 1)  # a node's first leaf, below the root
        out = out.select("*", *((F.lag("_h", -d * step) if d < 0 else F.lead("_h", d * step)).over(chunk).alias(f"_n{d}") for d in away))
        masked = {d: F.when((slot + d >= 0) & (slot + d < run), F.col(f"_n{d}")).otherwise("") for d in away}
        parent = digest(F.col("_h"), *(masked[d] for d in away if d > 0))
        out = out.withColumns(
            {
                f"_s{k}": F.when(here, F.concat(*masked.values())),
                "_h": F.when(here & (slot == 0), parent).when((F.col("p") == 0) & (count <= 1), F.col("_h")),
            }
        ).drop(*(f"_n{d}" for d in away))
    # The latest node of a level is the ancestor; levels from the root on are null throughout.
    so_far = chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = [f"_s{k}" for k in range(levels)]
    out = out.withColumns({s: F.last(s, ignorenulls=True).over(so_far) for s in path})
    siblings = F.concat(*(F.coalesce(F.col(s), F.lit("")) for s in path))
    return out.select(*nodes.columns, F.unhex(siblings).alias("path"), F.col("_h").alias("top"))


def tree(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """The trees over ``nodes`` (g, p, n, h and others), one for each ``g``.

    First ``nodes`` with ``path``, all siblings up to the group's root (binary digests);
    then ``g, root``. Each step leaves one row of a chunk, so steps are few.
    """
    size = fanout**levels
    steps, left = [], nodes
    while True:
        step = materialise(climbed(left, fanout, levels), "climbed")
        steps.append(step)
        left = step.where(F.col("p") % size == 0).select(
            "g", F.expr(f"p div {size}").alias("p"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("h")
        )
        if not (left.agg(F.max("n")).first()[0] or 1) > 1:
            break
    above = None
    for step in reversed(steps[1:]):
        above = _under(step.drop("h", "top"), above, size)
    return _under(steps[0].drop("top"), above, size), left.select("g", F.col("h").alias("root"))


def _under(nodes: DataFrame, above: DataFrame | None, size: int) -> DataFrame:
    """``nodes`` with the path of their chunk's own node appended to theirs."""
    if above is None:
        return nodes
    above = above.select("g", F.col("p").alias("_chunk"), F.col("path").alias("_above"))
    joined = nodes.withColumn("_chunk", F.expr(f"p div {size}")).join(above, ["g", "_chunk"])
    return joined.withColumn("path", F.concat("path", "_above")).drop("_chunk", "_above")


def folded(leaf: Column, path: Column, places: list[tuple[Column, Column]], fanout: int) -> Column:
    """The root that ``leaf`` and the siblings in ``path`` (hex) give, for a leaf at
    ``places``: (position, nodes) in each tree that it goes through."""
    units = F.array(*(F.lit(fanout**k).cast("long") for k in range(64) if fanout**k < 1 << 62))

    def levels(p: Column, n: Column) -> Column:
        """Slot and length of the run at each level below the root."""

        def at(unit: Column) -> Column:
            slot = F.floor(p / unit) % fanout
            count = F.floor((n - 1) / unit) + 1
            return F.struct(slot.cast("int").alias("slot"), F.least(F.lit(fanout), count - (F.floor(p / unit) - slot)).cast("int").alias("run"))

        return F.transform(F.filter(units, lambda unit: unit < n), at)

    def up(state: Column, level: Column) -> Column:
        before, after = level["slot"] * DIGEST, (level["run"] - 1 - level["slot"]) * DIGEST
        h = digest(F.substr(path, state["at"], before), state["h"], F.substr(path, state["at"] + before, after))
        return F.struct(h.alias("h"), (state["at"] + before + after).alias("at"))

    return F.aggregate(F.concat(*(levels(p, n) for p, n in places)), F.struct(leaf.alias("h"), F.lit(1).alias("at")), up, lambda s: s["h"])


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    tampered: dict[str, Column] | None = None,
    fanout: int = 3,
    levels: int = 7,
    with_proof: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified``.

    A leaf is the digest (lower-case hex SHA-256) of ``columns``, each as ``field`` writes
    it. In each group leaves ascend by id, a null id first, rows of one id by their leaf;
    groups ascend by UTF-8 bytes, the null group first. ``proof_sha256`` is the digest of
    all siblings from the leaf up to the root, level by level, left to right;
    ``folded_root`` the root that the siblings give with the leaf of a row whose columns
    were replaced by ``tampered`` (expressions by column name; nothing by default), and
    ``verified`` whether it is the root. ``with_proof=True`` adds ``proof``, the siblings
    themselves (hex, concatenated), and ``position`` and ``group_rows``.

    Null values count as ``-``; empty and very long texts like any other; repeated rows
    are leaves of their own; a table with no rows gives none; other columns are ignored.
    ``levels`` sets how many levels one shuffle covers: a chunk of fanout^levels rows.
    """
    col = {c: F.col(f"`{c}`") for c in columns}
    changed = {c: (tampered or {}).get(c, col[c]) for c in columns}
    leaf = digest(*(field(col[c]) for c in columns))
    same = F.lit(True)
    for c in tampered or {}:
        same = same & changed[c].eqNullSafe(col[c])
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"),
        F.col(f"`{id_col}`").alias("doc_id"),
        leaf.alias("h"),
        F.when(~same, digest(*(field(changed[c]) for c in columns))).alias("other"),
    )
    # Written, since dealing by ranges reads its input twice: the texts are hashed once.
    own, subroots = tree(positioned(materialise(leaves, "leaves"), ["doc_id", "h"]), fanout, levels)
    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("h"))
    over, top = tree(positioned(groups, ["name"]), fanout, levels)
    top = top.first()
    over = over.select(
        F.col("name").alias("g"), F.col("h").alias("subroot"), F.col("p").alias("_p"), F.col("n").alias("_n"), F.col("path").alias("_path")
    )
    placed = own.join(over, "g").withColumn("root", F.lit(top and top["root"])).withColumn("proof", F.lower(F.hex(F.concat("path", "_path"))))
    root = folded(F.coalesce("other", "h"), F.col("proof"), [(F.col("p"), F.col("n")), (F.col("_p"), F.col("_n"))], fanout)
    more = [F.col("proof"), F.col("p").alias("position"), F.col("n").alias("group_rows")] if with_proof else []
    return (
        placed.withColumn("folded_root", root)
        .withColumn("proof_sha256", digest(F.col("proof")))
        .select("doc_id", F.col("h").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), *more)
    )


def without_newlines(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """``tampered`` for ``merkle_manifest``: texts lose their line feeds where 2 divides the CRC-32 of the id as text."""
    text = F.col(f"`{text_col}`")
    even = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 2 == 0
    return {text_col: F.when(F.coalesce(even, F.lit(False)), F.translate(text, "\n", "")).otherwise(text)}
