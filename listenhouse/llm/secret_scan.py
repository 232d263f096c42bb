"""Secret scan with corpus-wide ownership frequency.

Candidates are found by pattern in whole texts, natively. The hash of each
candidate's value is counted over the corpus by distinct repositories and
distinct owners: a value that at least ``WIDE_OWNERS`` owners hold, or that lies in at least ``WIDE_REPOSITORIES``
repositories, whoever owns them, is a widely copied
example; one of fewer is live-looking and owner-specific. Both counts are returned.

Kinds ``assign``, ``access`` and ``hex`` are always reported. Kind ``live`` adds
mixed-case tokens with digits that no base span covers, where their ownership
says that they are owner-specific.

Spans are kind:start:end in code points, end exclusive. Matches of one kind do
not overlap and go from the left; what fails the length rule is dropped after
matching, and text it covered is not matched again.

Defined results: null text has no spans; null owner or repository count as one
owner or repository, the empty one; rows that repeat an id are scanned each on its own
text. Other columns play no part. A value that a third of all rows hold costs one
row per task and owner in the count, as it combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenhouse.llm.staging import stage

#: A value held by at least so many owners is a widely copied example.
WIDE_OWNERS = 3
#: So is one that lies in so many repositories.
WIDE_REPOSITORIES = 20

# The patterns of the base kinds, in the order in which ties are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(.*)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA and more, 20 characters at least
HEX = r"[0-9a-f]{24,}"
#: Candidates of the added kind: such words that have a digit, a lower-case and an upper-case letter.
LIVE = r"[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "live")

_BLOCK = 256
_SPAN = "struct<start:int,kind:int,stop:int,value:string>"


def _running(items: Column, start: Column, step, kind: str) -> Column:
    """What ``step`` (state at, item) -> (state, result) makes of an array, results in an array of type ``kind``."""
    empty = F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def add(state: Column, x: Column) -> Column:
        at, result = step(state["at"], x)
        return F.struct(at.alias("at"), F.concat(state["out"], F.array(result.cast(kind))).alias("out"))

    return F.aggregate(items, empty, add, lambda state: state["out"])


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often a lambda in it needs it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str, kind: int, value: str | None = None, least: int = 0) -> Column:
    """Array of (start, kind, stop, value) of all matches: pieces between the matches give the places.

    Places are running sums, taken in blocks of ``_BLOCK`` matches: first where each block begins, then within the blocks. An array that grows
    by a match at a time is copied each time, so none grows beyond a block, or beyond the number of blocks.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), hit.alias("hit")))
    def step(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + x["gap"]
        stop = begin + F.char_length(x["hit"])
        own = F.regexp_extract(x["hit"], value, 1) if value else x["hit"]
        return stop, F.struct(begin.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), own.alias("value"))

    def places(blocks: Column) -> Column:
        length = lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + F.char_length(x["hit"]))
        begins = _running(F.transform(blocks, length), F.lit(0), lambda at, n: (at + n, at), "int")
        return F.flatten(F.zip_with(blocks, begins, lambda block, at: _running(block, at, step, _SPAN)))

    def in_blocks(pairs: Column) -> Column:
        count = F.ceil(F.size(pairs) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(pairs, i * _BLOCK + 1, _BLOCK))

    spans = _bound(_bound(pairs, in_blocks), places)
    if least:
        spans = F.filter(spans, lambda s: F.char_length(s["value"]) >= least)
    # Most texts have no match; one cheap search decides.
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Per row: doc_id, repository, owner, row key, base spans, and candidates of the added kind; values are SHA-256."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.xxhash64(t).alias("text_hash"),
        matches(t, ASSIGN, 0, ASSIGN_VALUE, 6).alias("a"), matches(t, ACCESS, 1).alias("k"), matches(t, HEX, 2).alias("h"), matches(t, LIVE, 3).alias("l"),
    )
    hashed = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"), F.sha2(s["value"], 256).alias("value")))
    base = F.array_sort(F.concat("a", "k", "h"))
    looks = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    free = F.filter("l", lambda x: looks(x["value"]) & ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])))
    return (
        rows.withColumn("base", base).withColumn("added", free)
        .select("doc_id", "repository", "owner", "text_hash", hashed(F.col("base")).alias("base"), hashed(F.col("added")).alias("added"))
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """Per value: in how many repositories and by how many owners it is held, and whether it is widely copied."""
    by_owner = candidates.groupBy("value", "owner").agg(F.lit(1).alias("one"))
    by_repository = candidates.groupBy("value", "repository").agg(F.lit(1).alias("one"))
    owners = by_owner.groupBy("value").agg(F.count("one").alias("owners"))
    repositories = by_repository.groupBy("value").agg(F.count("one").alias("repositories"))
    return owners.join(repositories, "value").withColumn("wide", (F.col("owners") >= WIDE_OWNERS) | (F.col("repositories") >= WIDE_REPOSITORIES))


def joined(spans: Column) -> Column:
    """kind:start:stop by start, then kind, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Per row the base and all spans, their counts by kind, how many values are owner-specific (n_live) or widely copied (n_wide),
    and the owners and repositories of the row's most widely held value."""
    rows = stage(scan(docs, doc_id, text, repository, owner), "secrets")
    candidates = rows.select("doc_id", "text_hash", "repository", "owner", F.explode(F.concat("base", "added")).alias("s")).select("*", "s.value")
    judged = candidates.join(ownership(candidates), "value").select("doc_id", "text_hash", "owner", "s", "wide", "owners", "repositories")
    per_row = judged.groupBy("doc_id", "text_hash", "owner").agg(
        F.collect_set(F.when(~F.col("wide") & (F.col("s.kind") == 3), F.col("s"))).alias("live"),
        F.count_distinct(F.when(~F.col("wide"), F.col("s.value"))).alias("n_live"), F.count_distinct(F.when(F.col("wide"), F.col("s.value"))).alias("n_wide"),
        F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"),
    )
    k = "__key"
    left = rows.withColumn(k, F.struct(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text_hash", "owner"))
    right = per_row.select(F.struct(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text_hash", "owner").alias(k), "live", "n_live", "n_wide", "most_owners", "most_repositories")
    every = F.array_sort(F.concat("base", F.coalesce("live", F.array().cast("array<struct<start:int,kind:int,stop:int,value:string>>"))))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return left.join(right, k, "left").select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(every).alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_wide", F.lit(0)).alias("n_wide"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("most_owners", "most_repositories")],
    )
