"""MinHash near-dedup by a signature-coordinate inverted join.

Documents are posted under each (coordinate, value) of their MinHash
signature. Two documents that agree in ``MATCHES`` of ``COORDINATES``
coordinates are a candidate pair, and are confirmed on their full shingle
sets. A pair with Jaccard 0.75 misses that threshold with probability 4e-8.

* Prefix: a document is posted only under its rarest values, as many as any
  partner must share one of (``COORDINATES - MATCHES + 1``, values that occur
  once counting as rarest and never posted).
* Skip: equal sets are one node from the start, and members of a posting list
  that are known to be in one component are not paired again. First every
  member meets the least one of its list; then members outside the list's
  largest component meet one of its members. What is still apart goes through
  the same join once more with full shingle sets in place of signatures: its
  prefixes are exact and short, so documents that share a passage but are not
  similar do not meet. A list of n copies thus costs some n pairs, not n squared.

No list is cut, and nothing of the corpus reaches the driver.

Defined results: null or blank text has no shingles and no links; a document
with fewer than five words is one shingle of all of them; rows that repeat a
doc_id are one document, which shares the links of all its texts; a null doc_id is linked with nothing,
has component null and is kept. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from listenhouse.llm.components import components
from listenhouse.llm.staging import drop, stage
from listenhouse.llm.texts import filter_bits, packed_texts, parts, passing, place, unpack
from listenhouse.llm.words import MinHash, mix, shingles, slices, words

SHINGLE = 5
COORDINATES = 48
MATCHES = 19
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75

_FEATURES = "doc_id long, n_shingles long, set_a long, set_b long, signature array<long>"


def _features(batches):
    sketch = MinHash(COORDINATES)
    for part in slices(batches, 1):
        sizes, first, second, signatures = [], [], [], []
        for items in shingles(words(part.column(1), lower=True), SHINGLE):
            sizes.append(len(items))
            first.append(items.sum(dtype=np.uint64))
            second.append(mix(items ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            signatures.append(sketch(items))
        yield pa.RecordBatch.from_arrays([
            part.column(0), pa.array(sizes, pa.int64()),
            pa.array(np.array(first, np.uint64).view(np.int64)), pa.array(np.array(second, np.uint64).view(np.int64)),
            pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * COORDINATES, pa.array(np.concatenate(signatures).view(np.int64))),
        ], ["doc_id", "n_shingles", "set_a", "set_b", "signature"])


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, a 128-bit digest of the shingle set and the signature of every row."""
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(_features, _FEATURES)


def _confirm(batches):
    for part in parts(batches, 2, 3):
        left, right = (shingles(words(unpack(part.column(c)), lower=True), SHINGLE) for c in (2, 3))
        linked = []
        for a, b in zip(left, right):
            common = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common))
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])


def confirm(pairs: DataFrame, signatures: DataFrame, texts: DataFrame, matches: int = MATCHES) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``matches`` coordinates and whose full shingle sets are similar enough; staged.

    With ``matches`` 0 the full sets alone decide.
    """
    left, right = (signatures.select(F.col("doc_id").alias(k), F.col("n_shingles").alias(f"n_{k}"), *([F.col("signature").alias(f"s_{k}")] if matches else [])) for k in "ab")
    likely = pairs.join(left, "a").join(right, "b").where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    if matches:
        likely = likely.where(F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x == y), lambda x: x)) >= matches)
    likely = stage(likely.select("a", "b").distinct(), "likely")
    wanted = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    packed = packed_texts(texts, wanted)
    of = {k: packed.select(F.col("doc_id").alias(k), F.col("packed").alias(f"packed_{k}")) for k in "ab"}
    with_text = likely.join(of["a"], "a").join(of["b"], "b").select("a", "b", "packed_a", "packed_b")
    links = stage(with_text.mapInArrow(_confirm, "a long, b long").distinct(), "links")
    drop(likely)
    return links


def ranked_lists(posts: DataFrame) -> DataFrame:
    """``posts`` (key, d) of keys that others have too, with the rank of the key in its document, rarest first, and how many of them the document has."""
    common = posts.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    own = Window.partitionBy("d")
    return (
        posts.join(common, "key")
        .withColumn("rank", F.row_number().over(own.orderBy("f", "key")))
        .withColumn("shared", F.count("*").over(own))
        .drop("f")
    )


def in_prefix(required: Column) -> Column:
    """Whether a ranked post belongs to its document's prefix.

    Partners share at least ``required`` keys with a document, hence one of any
    (keys of the document - required + 1). Those are its rarest; keys that no
    other document has come first, and need not be posted.
    """
    return F.col("rank") <= F.col("shared") - (required - 1)


def _shingle_rows(bits: np.ndarray):
    def run(batches):
        for part in slices((passing(b, bits, 2) for b in batches), 1):
            sets = list(shingles(words(part.column(1), lower=True), SHINGLE))
            sizes = [len(x) for x in sets]
            keys = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(part.column(0).to_numpy(), sizes))], ["key", "d"])

    return run


def apart(unmet: DataFrame, sizes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents of different components that share one of the shingles of both prefixes; staged.

    The exact way for what the turns leave: full shingle sets in place of signatures; ``sizes`` has (d, n), how many shingles a
    document has. A document is posted only if
    others hold as many of its shingles as a partner must. Members of the largest component of a list do not meet each other; k others of
    it do, under the shingles of their prefixes, so the join is bounded by the sum over those shingles of k times the list.
    No text is moved: a filter of fixed size spares documents that are not wanted, what it lets through besides is only counted.
    """
    nodes = stage(unmet.select("d", "label").distinct().join(sizes, "d").distinct(), "unmet")
    source = texts.select("doc_id", F.col("text").cast("string"), place("doc_id").alias("place"))
    bits = filter_bits(nodes.select(F.col("d").alias("doc_id")))
    posts = stage(source.mapInArrow(_shingle_rows(bits), "key long, d long"), "shingles")
    # |a & b| >= PERCENT % of the larger; and of the smaller, 2 PERCENT / (100 + PERCENT).
    least, least_small = (F.expr(f"(n * {up} + {down} - 1) div {down}") for up, down in ((PERCENT, 100), (2 * PERCENT, 100 + PERCENT)))
    lists = ranked_lists(posts).join(nodes, "d").where(in_prefix(least)).withColumn("short", in_prefix(least_small))
    lists = lists.withColumn("left", F.col("shared") - F.col("rank"))
    most = lists.groupBy("key", "label").agg(F.count("*").alias("m")).groupBy("key").agg(F.max_by("label", "m").alias("largest"), F.count("*").alias("labels"))
    lists = stage(lists.join(most.where("labels > 1").drop("labels"), "key"), "prefixes")
    drop(posts)
    x, y = (lists.select("key", "largest", *[F.col(c).alias(f"{c}_{k}") for c in ("d", "label", "n", "short", "left")]) for k in "ab")
    # The first shingle that a pair has in common bounds the rest: what comes behind it, in either document.
    fits = f"""
        label_a <> label_b and (d_a > d_b or label_b = largest)
        and if(n_a < n_b or n_a = n_b and d_a < d_b, short_a, short_b)
        and 100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)
        and {100 + PERCENT} * (1 + least(left_a, left_b)) >= {PERCENT} * (n_a + n_b)
    """
    found = x.where("label_a <> largest").join(y.drop("largest"), "key").where(fits)
    pairs = stage(found.select(F.col("d_a").alias("a"), F.col("d_b").alias("b")).distinct(), "apart")
    drop(nodes, lists)
    return pairs


def _unmet(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of lists that hold several components: key, d, label, the largest component of the list and a member of it that differs by key."""
    labelled = lists.join(groups.withColumnRenamed("node", "d"), "d", "left").select("key", "d", F.coalesce("component", "d").alias("label"))
    held = labelled.groupBy("key", "label").agg(F.count("*").alias("n"), F.min_by("d", F.xxhash64("d", "key")).alias("member"))
    split = (
        held.groupBy("key").agg(F.max_by("label", "n").alias("largest"), F.max_by("member", "n").alias("pivot"), F.count("*").alias("labels"))
        .where("labels > 1").drop("labels")
    )
    return labelled.join(split, "key")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept and the two halves of the set digest."""
    # The row number is settled by the write; of repeated rows one stands for its set.
    rows = stage(features(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "features")
    sets = stage(
        rows.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"), F.min_by("row", "doc_id").alias("row")), "sets"
    )
    nodes = rows.join(sets.select("row"), "row", "left_semi")
    signatures = nodes.select("doc_id", "n_shingles", "signature")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")

    posts = signatures.select(F.col("doc_id").alias("d"), F.posexplode("signature")).select(F.xxhash64("pos", "col").alias("key"), "d")
    lists = stage(ranked_lists(posts).where(in_prefix(F.lit(MATCHES))).select("key", "d"), "lists")
    least = lists.groupBy("key").agg(F.min("d").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    to_pivot = lists.join(least, "key").where("d <> pivot").select(F.col("d").alias("a"), F.col("pivot").alias("b")).distinct()
    links = confirm(to_pivot, signatures, texts)
    groups = components(links)
    drop(links)

    # One member of the largest component, another one for every list, meets the members of the others.
    unmet = _unmet(lists, groups)
    links = confirm(unmet.where("label <> largest").select(F.col("d").alias("a"), F.col("pivot").alias("b")).distinct(), signatures, texts)
    groups = components(links, groups)
    drop(links)
    # What is still apart: their sets alone decide.
    pairs = apart(_unmet(lists, groups), signatures.select(F.col("doc_id").alias("d"), F.col("n_shingles").alias("n")), texts)
    links = confirm(pairs, signatures, texts, matches=0)
    groups = components(links, groups)
    drop(lists, pairs, links)

    per_set = sets.join(groups, "node", "left").select("set_a", "set_b", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        rows.drop("signature", "row").join(per_set, ["set_a", "set_b", "n_shingles"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "set_a", "set_b")
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, and one of rows that repeat a doc_id and a shingle set.

    The columns are those of ``docs``. Documents without words all stay.
    """
    kept = near_duplicates(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("kept_id")).where("kept_id is not null").distinct()
    identified = docs.where(F.col(doc_id).isNotNull()).join(kept, F.col(doc_id).cast("long") == F.col("kept_id"), "left_semi")
    first = F.row_number().over(Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.lit(1)))
    once = identified.withColumn("__row", first).where("__row = 1").drop("__row")
    return once.unionByName(docs.where(F.col(doc_id).isNull()))
