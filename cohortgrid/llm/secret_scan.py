"""Secret scan with corpus-wide ownership frequency.

Pattern matches become candidates with spans. The hash of each candidate's
value is counted over the whole corpus by distinct owners and
repositories: a value that many owners hold is a widely copied example
(documentation keys, test tokens), one that a single owner holds looks
like a live credential. DataFrame functions only.

Spans come from Spark's own regular expressions: the text between two
matches (``split``) and the matches alternate, so a match starts after the
lengths of all that stands before it, a running sum over narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortgrid.llm.storage import kept, scratch, written

# The base patterns (kind, pattern, least length of the value).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = (("assign", ASSIGN, 12), ("access", ACCESS, 18), ("hex", HEX, 16))
# Added by the method: long mixed-case tokens with a digit that no pattern names.
MIXED = r"[A-Za-z0-9+/_-]{24,}"
KINDS = (*BASE_KINDS, ("mixed", MIXED, 24))

SALTS = 16


def _found(text: Column, pattern: str) -> Column:
    """All matches, leftmost and not overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _rows_of(kind: int, found: str, text: Column, pattern: str) -> Column:
    """The matches with the length of the text before each since the last."""
    matches = F.col(found)
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    pairs = F.arrays_zip(matches.alias("match"), gaps.alias("gap"))
    one = lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("nth"), F.length(p["gap"]).cast("long").alias("gap"), p["match"].alias("match"))
    return F.when(F.size(matches) > 0, F.transform(pairs, one))


def _candidates(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """One row per document: its narrow columns and the raw matches."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), text.alias("text"))
    none = F.array().cast("array<string>")
    has = {
        "assign": F.col("text").rlike(r"(?i:password|passwd|secret|token|api_?key)"),
        "access": F.col("text").contains("AKIA"),
    }
    for kind, pattern, _ in KINDS:
        found = _found(F.col("text"), pattern)
        narrow = narrow.withColumn(f"found_{kind}", F.when(has[kind], found).otherwise(none) if kind in has else found)
    rows = [F.coalesce(_rows_of(k, f"found_{kind}", F.col("text"), pattern), F.array().cast("array<struct<kind:int,nth:int,gap:bigint,match:string>>")) for k, (kind, pattern, _) in enumerate(KINDS)]
    return narrow.select("uid", "id", "owner", "repository", F.concat(*rows).alias("found"))


def _spans(base: DataFrame) -> DataFrame:
    """Candidates with code-point spans; matches that are too short, or of
    the added kind without all three character classes, are dropped here,
    after they took part in the positions."""
    rows = base.select("uid", "owner", "repository", F.explode("found").alias("f")).select("uid", "owner", "repository", "f.*")
    size = F.length("match").cast("long")
    so_far = W.partitionBy("uid", "kind").orderBy("nth").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap") + size).over(so_far)
    rows = rows.select("uid", "owner", "repository", "kind", "match", (end - size).alias("start"), end.alias("end"))
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 1)).otherwise(F.col("match"))
    rows = rows.withColumn("value", value)
    least = F.element_at(F.array(*(F.lit(n) for _, _, n in KINDS)), F.col("kind") + 1)
    mixed = F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[0-9]")
    rows = rows.filter((F.length("value") >= least) & ((F.col("kind") != len(BASE_KINDS)) | mixed))
    return rows.select("uid", "owner", "repository", "kind", "start", "end", F.sha2("value", 256).alias("hash"))


def ownership(candidates: DataFrame) -> DataFrame:
    """Per candidate hash its distinct owners and repositories, and its
    rows. Three levels of partial counts, so a hash that a third of all
    rows share is folded before each shuffle. A null owner or repository
    is one more unknown owner or repository."""
    by_repository = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("uses"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("uses").alias("n_uses"))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, on end."""
    names = F.array(*(F.lit(k) for k, _, _ in KINDS))
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def _count_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def _clear(judged: DataFrame) -> Column:
    """Whether a span overlaps no base span of its row: of the base spans
    that start up to it none reaches it, and the next starts behind it."""
    is_base = F.col("kind") < len(BASE_KINDS)
    by_start = W.partitionBy("uid").orderBy("start")
    reach = F.max(F.when(is_base, F.col("end"))).over(by_start.rangeBetween(W.unboundedPreceding, W.currentRow))
    following = F.min(F.when(is_base, F.col("start"))).over(by_start.rangeBetween(1, W.unboundedFollowing))
    return (F.coalesce(reach, F.col("start")) <= F.col("start")) & (F.coalesce(following, F.col("end")) >= F.col("end"))


def _scan(docs: DataFrame, owner: Column, repository: Column, max_owners: int, max_repositories: int, id_col: str, text_col: str) -> DataFrame:
    base = written(_candidates(docs, id_col, text_col, owner, repository), "secret-candidates")
    spans = _spans(base)
    salt = F.pmod(F.xxhash64("uid"), F.lit(SALTS))
    frequency = ownership(spans).select("hash", "n_owners", "n_repositories", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    judged = spans.withColumn("salt", salt).join(frequency, ["hash", "salt"])
    owned, spread = F.col("n_owners") <= max_owners, F.col("n_repositories") > max_repositories
    judged = judged.select("uid", "start", "kind", "end", (owned & ~spread).alias("live"), (owned & spread).alias("spread"))
    judged = judged.withColumn("listed", (F.col("kind") < len(BASE_KINDS)) | (F.col("live") & _clear(judged)))
    listed = judged.filter("listed")
    per_doc = listed.groupBy("uid").agg(F.collect_list(F.struct("start", "kind", "end", "live", "spread")).alias("listed"))
    per_doc = per_doc.withColumn("base", F.filter("listed", lambda s: s["kind"] < len(BASE_KINDS)))
    per_doc = per_doc.select(
        "uid",
        *(_count_of(k).alias(f"n_{kind}") for k, (kind, _, _) in enumerate(BASE_KINDS)),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("listed")).alias("spans"),
        F.size(F.filter("listed", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("listed", lambda s: ~s["live"])).cast("long").alias("n_copied"),
        F.size(F.filter("listed", lambda s: s["spread"])).cast("long").alias("n_spread"),
    )
    counts = [f"n_{kind}" for kind, _, _ in BASE_KINDS]
    out = base.select("uid", "id").join(per_doc, "uid", "left")
    return out.select(
        F.col("id").alias(id_col),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied", "n_spread")),
    )


def secret_scan(docs: DataFrame, owner: Column, repository: Column, max_owners: int = 1, max_repositories: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_assign, n_access, n_hex, base_sha256,
    spans, n_live, n_copied, n_spread).

    A candidate is live if at most ``max_owners`` owners hold its value, in
    at most ``max_repositories`` of their repositories (a repository belongs
    to its owner), else copied. ``base_sha256`` digests the base spans whatever
    the frequencies say. ``spans`` lists the base spans and the added ones:
    live mixed tokens outside base spans. ``n_live`` and ``n_copied`` count
    the listed candidates of either kind, ``n_spread`` those copied ones that
    few owners hold in too many repositories.

    A null text is empty, and a text without candidates has counts of 0 and
    empty lists. Ids may be null or repeated: rows are kept apart. Other
    columns are ignored; an empty table gives no rows. Assignments keep
    their span from keyword to value; their hash is the value's.
    """
    with scratch(docs.sparkSession):
        return kept(_scan(docs, owner, repository, max_owners, max_repositories, id_col, text_col), "secret-result")
