"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern in every text. Their values' hashes are then
counted over the corpus by distinct repositories and owners: a value that several
owners hold is a copied example; one that stays with its owner and looks random is
a live credential, however many of the owner's repositories hold it. Patterns of known token formats add
spans of their own where the value isn't a copied example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.llm.common import materialise

# The base kinds in order; pattern, group that holds the value, least
# length of that value. The letter runs carry their least length in the pattern:
# a run matches whole or not at all.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = (
    ("assign", ASSIGN, 2, 6, r"(?i)passw|secret|token|api_?key"),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20, "AKIA"),
    ("hex", "[0-9a-f]{24,}", 0, 24, "[0-9a-f]{24}"),
)
# Published formats of credentials, found beside the base kinds.
ADDED_KINDS = (
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh[pousr]_"),
    ("slack", "xox[abposr]-[A-Za-z0-9-]{10,}", 0, 15, "xox[abposr]-"),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 39, "AIza"),
    ("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 24, "[rs]k_live_"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 25, "eyJ"),
    ("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 27, "PRIVATE KEY-----"),
)
CANDIDATES = "array<struct<ord:int,i:int,gap:int,size:int,value_size:int,hash:string,live:boolean>>"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|1234567|abcdef"


def _candidates(text: Column, order: int, kind: str, pattern: str, group: int, least: int, gate: str) -> Column:
    """Matches of one kind, leftmost and non-overlapping: how far each begins after the
    one before (``gap``), its size in code points and that of its value, and the value's
    hash (null if it's too short). ``gate`` is a cheap test that all texts with a match pass.
    """
    between, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pairs = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("b"), whole.alias("w"), value.alias("v"))

    def candidate(x: Column, i: Column) -> Column:
        v = x["v"]
        size = F.char_length(v)
        live = F.lit(kind == "pem") | ((size >= 16) & v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike(PLACEHOLDER))
        return F.struct(
            F.lit(order).alias("ord"), i.alias("i"), F.char_length(x["b"]).alias("gap"), F.char_length(x["w"]).alias("size"),
            size.alias("value_size"), F.when(size >= least, F.sha2(v, 256)).alias("hash"), live.alias("live"),
        )

    return F.when(text.rlike(gate), F.transform(pairs, candidate)).otherwise(F.array().cast(CANDIDATES))


def find_candidates(text: Column) -> Column:
    """All candidates of a text, kind by kind."""
    kinds = [*BASE_KINDS, *ADDED_KINDS]
    return F.concat(*(_candidates(text, i, *k) for i, k in enumerate(kinds)))


def spans_of(found: DataFrame) -> DataFrame:
    """A row for each span: ``_row, _owner, _repo, start, ord, end, kind, value_start, hash, live``.

    Places are running sums of gaps and sizes over a text's matches of one kind, so the
    work follows the matches, however many a text has.
    """
    each = found.where(F.size("_found") > 0).select("_row", "_owner", "_repo", F.inline("_found"))
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("_row", "ord").orderBy("i")).cast("int")
    kinds = F.array(*(F.lit(k[0]) for k in (*BASE_KINDS, *ADDED_KINDS)))
    placed = each.withColumn("end", end).where("hash IS NOT NULL")
    return placed.select(
        "_row", "_owner", "_repo", (F.col("end") - F.col("size")).alias("start"), "ord", "end", F.get(kinds, F.col("ord")).alias("kind"),
        (F.col("end") - F.col("value_size")).alias("value_start"), "hash", "live",
    )


def ownership(spans: DataFrame, max_owners: int) -> DataFrame:
    """``hash, n_repos, n_owners, copied`` over all spans of all rows.

    A value is a copied example if more than ``max_owners`` owners hold it. In how many
    repositories of one owner it stands says nothing of that. Aggregated map-side at
    each step, so a value in a third of all rows is one row a task before it is
    shuffled. A repository belongs to its owner.
    """
    each = spans.groupBy("hash", "_owner", "_repo").agg(F.lit(1).alias("one"))
    owners = each.groupBy("hash", "_owner").agg(F.count("*").alias("repos"))
    counts = owners.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
    return counts.withColumn("copied", F.col("n_owners") > max_owners)


def _judged(spans: DataFrame, max_owners: int) -> DataFrame:
    """The spans with the corpus's verdict (``copied``)."""
    # Written first: the join then deals both sides itself, and Spark can split a hot value's rows.
    verdict = materialise(ownership(spans, max_owners), "ownership")
    return spans.drop("_owner", "_repo").join(verdict.select("hash", "copied"), "hash")


def _prepared(docs: DataFrame, text_col: str, owner_col: str, repo_col: str, *keep: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        *keep, F.monotonically_increasing_id().alias("_row"), F.col(owner_col).alias("_owner"), F.col(repo_col).alias("_repo"), find_candidates(text).alias("_found")
    )


def _places(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    max_owners: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_live, n_copied``.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) of all base spans
    and of added ones whose value isn't a copied example; ``base_sha256`` is of the
    base spans' list. ``n_copied`` counts listed spans whose value more than
    ``max_owners`` owners hold, ``n_live`` those of the rest that look like live
    credentials.

    A null text counts as empty (no spans; the hash of an empty list). Null owners
    or repositories count as one of that name. Null ids stay null; repeated rows
    give repeated rows; an empty table gives none; other columns are ignored.
    """
    kept = _prepared(docs, text_col, owner_col, repo_col, F.col(id_col).alias("doc_id"))
    found = materialise(kept, "secrets")
    judged = _judged(materialise(spans_of(found), "spans"), max_owners)
    base = F.col("ord") < len(BASE_KINDS)
    sorted_places = lambda of: _places(F.array_sort(F.collect_list(F.when(of, F.struct("start", "ord", "end", "kind")))))
    listed = base | ~F.col("copied")
    by_row = judged.groupBy("_row").agg(
        *(F.count_if(F.col("ord") == i).alias(f"n_{k[0]}") for i, k in enumerate(BASE_KINDS)),
        sorted_places(base).alias("base"),
        sorted_places(listed).alias("spans"),
        F.count_if(F.col("live") & ~F.col("copied")).alias("n_live"),
        F.count_if(base & F.col("copied")).alias("n_copied"),
    )
    counts = ["n_assign", "n_access", "n_hex", "n_live", "n_copied"]
    some = found.where(F.size("_found") > 0).select("_row", "doc_id").join(by_row, "_row", "left")
    none = found.where(F.size("_found") == 0).select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in by_row.drop("_row").dtypes))
    rows = some.drop("_row").unionByName(none)
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in counts} | {c: F.coalesce(c, F.lit("")) for c in ("base", "spans")})
    return rows.select("doc_id", *counts[:3], F.sha2("base", 256).alias("base_sha256"), "spans", *counts[3:])


def redact_secrets(
    docs: DataFrame,
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    max_owners: int = 2,
    mark: str = "[secret]",
) -> DataFrame:
    """``docs`` with the values of all candidates but copied examples replaced by ``mark``.

    A value with a single owner is replaced however many repositories hold it.
    Overlapping spans are replaced once. All columns stay, under their names; rows
    without such spans are unchanged (null texts too); repeated rows and null ids are
    rows like any other; an empty table gives none.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    found = materialise(_prepared(docs, text_col, owner_col, repo_col, whole), "redact")
    secret = _judged(materialise(spans_of(found), "spans"), max_owners).where("NOT copied")
    # Where the text goes on before each span: the furthest end of those before it.
    before = Window.partitionBy("_row").orderBy("value_start", "end").rowsBetween(Window.unboundedPreceding, -1)
    cut = secret.select("_row", "value_start", "end", F.coalesce(F.max("end").over(before), F.lit(0)).alias("at"))
    cut = cut.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.when(F.col("value_start") >= F.col("at"), F.struct("value_start", "at")))).alias("_cuts"),
        F.max("end").alias("_rest"),
    )
    text = F.col(f"_doc.`{text_col}`")
    # Code points, so that each piece costs its own length.
    letters = F.split(text, "", -1)
    # Only rows with candidates meet the verdicts; some of them have no span to replace.
    some = found.where(F.size("_found") > 0).join(cut, "_row", "left").withColumn("_letters", F.when(F.col("_cuts").isNotNull(), letters))
    pieces = F.transform("_cuts", lambda c: F.concat(F.array_join(F.slice("_letters", c["at"] + 1, c["value_start"] - c["at"]), ""), F.lit(mark)))
    rest = F.array_join(F.slice("_letters", F.col("_rest") + 1, F.size("_letters")), "")
    changed = some.select("_doc", F.when(F.col("_cuts").isNotNull(), F.concat(F.array_join(pieces, ""), rest)).otherwise(text).alias("_text"))
    same = found.where(F.size("_found") == 0).select("_doc", text.alias("_text"))
    columns = [F.col("_text").alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    return same.unionByName(changed).select(*columns)
