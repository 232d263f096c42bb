"""Document fingerprints by MinHash, banded in Spark and verified by Jaccard.

A fingerprint is the hex form of ``SIZE`` MinHash values of 16 bits over the distinct five-word
shingles, computed with universal hash functions in numpy. Its likeness to
another is the share of equal values, an estimate of Jaccard.

``near_classes`` posts fingerprints under their bands and verifies pairs on their full shingle sets.
Equal sets are one node. Each node meets the least one of each of its bands; members of a band
that are in different components then meet a member of its largest component, and what is
still apart meets by exact prefixes of full sets. A pair of Jaccard 0.75 shares no band with
probability 0.0023 (0.8: 0.0002); one that shares a band is lost with probability 2e-6 or its
documents are in one class.
``with_next`` brings every document together with the one that follows it by
doc_id, in one shuffle: ranges of doc_id are cut at quantiles, and the first
document of a range is also given to the range before.

Defined results: null text is empty; an empty or blank text has the fingerprint
of the empty set, which is like itself only; texts of fewer than five words
are one shingle of all words. Documents follow each other by doc_id, nulls first, then by
text; the last is followed by the first. A table of one row follows itself.
Repeated rows follow each other. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenhouse.llm.components import components
from listenhouse.llm.near_dedup import _unmet, apart
from listenhouse.llm.staging import drop, partitions, stage
from listenhouse.llm.texts import packed_texts, parts, unpack
from listenhouse.llm.words import MinHash, mix, shingles, slices, words

SHINGLE = 5
SIZE = 64
BANDS = 16
THRESHOLD = 0.75
LIKELY = 0.5
_SKETCH = MinHash(SIZE, seed=10)


def values(texts: list[str] | pa.Array) -> np.ndarray:
    """One row of SIZE values of 16 bits per text."""
    column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
    rows = [_SKETCH(items) >> np.uint64(48) for items in shingles(words(column, lower=True), SHINGLE)]
    return np.array(rows, ">u2").reshape(len(texts), SIZE)


def edited(text: str, follower: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``follower``."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def _cuts(rows: DataFrame, n: int) -> list[int]:
    """At most n keys that cut the table into even ranges; the first is the least key."""
    found = rows.agg(F.percentile_approx("key", [i / n for i in range(n)], 10 * n)).first()[0]
    return sorted(set(found or []))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many cuts but the first are at or below the key, by binary search."""
    known = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    fits = lambda at: (at <= len(cuts)) & (F.get(known, at - 1) <= key)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at + step), at + step).otherwise(at)) - 1


def with_next(docs: DataFrame, near: DataFrame) -> DataFrame:
    """Sorted partitions of (range, follows, key, doc_id, packed, near_id, n_near, class_id).

    Each range ends with the row that follows its last one. Before a document come its rows of ``near`` (doc_id, near_id,
    n_near, class_id), so that these need no join with the wide results.
    """
    n = partitions(docs.sparkSession)
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    cuts = _cuts(docs.select(key.alias("key")), 4 * n)
    rows = packed_texts(docs).withColumn("key", key).withColumn("range", _range_of(F.col("key"), cuts))
    place = lambda r, follows: F.struct(r.cast("int").alias("range"), F.lit(follows).alias("follows"))
    own = place(F.col("range"), False)
    before = place(F.when(F.col("range") > 0, F.col("range") - 1).otherwise(max(0, len(cuts) - 1)), True)
    first = F.coalesce(F.get(F.from_json(F.lit(json.dumps(cuts)), "array<bigint>"), "range") == F.col("key"), F.lit(False))
    dealt = rows.withColumn("place", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))))
    dealt = dealt.select("place.range", "place.follows", "key", "doc_id", "packed", *[F.lit(None).cast("long").alias(c) for c in _NEAR])
    found = near.select(
        _range_of(F.col("doc_id"), cuts).cast("int").alias("range"), F.lit(False).alias("follows"), F.col("doc_id").alias("key"), "doc_id",
        F.lit(None).cast("binary").alias("packed"), *_NEAR,
    )
    order = ["range", "follows", "key", F.col("n_near").isNull(), "packed"]
    return dealt.union(found).repartition(n, "range").sortWithinPartitions(*order)


def _fingerprints(batches):
    waiting: list[tuple[int | None, str, tuple[int | None, int, int | None]]] = []
    size, known, none = 0, (None, (None, 0, None)), (None, 0, None)

    def flush(last: str | None) -> tuple[pa.RecordBatch, list]:
        """Results of all that wait and whose follower is known."""
        texts = [t for _, t, _ in waiting] + ([last] if last is not None else [])
        ready = len(texts) - 1
        changed = [edited(t, f) for t, f in zip(texts, texts[1:])]
        own, other = values(texts), values(changed)
        batch = pa.RecordBatch.from_arrays([
            pa.array([d for d, *_ in waiting[:ready]], pa.int64()), pa.array([len(t) for t in texts[:ready]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([v.tobytes().hex() for v in own[:ready]], pa.string()), pa.array([v.tobytes().hex() for v in other], pa.string()),
            pa.array((own[:ready] == other).mean(axis=1)), pa.array((own[:ready] == own[1:]).mean(axis=1)),
            *[pa.array([near[c] for *_, near in waiting[:ready]], pa.int64()) for c in range(3)],
        ], _COLUMNS)
        return batch, waiting[ready:]

    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            texts = unpack(part.column(2)).fill_null("").to_pylist()
            for follows, doc, text, near, n_near, group in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, *(part.column(c).to_pylist() for c in (3, 4, 5))):
                if n_near is not None:
                    known = (doc, (near, n_near, group))
                    continue
                if follows:
                    if waiting:  # else an equal key of the next range, behind its first
                        result, waiting = flush(text)
                        yield result
                        size = 0
                    continue
                waiting.append((doc, text, known[1] if doc is not None and doc == known[0] else none))
                size += len(text)
                if len(waiting) > 1 and (size > 1 << 20 or len(waiting) > 512):
                    result, waiting = flush(None)
                    yield result
                    size = len(waiting[0][1])


_NEAR = ["near_id", "n_near", "class_id"]
_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", *_NEAR]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, near_id long, n_near long, class_id long"


_SET = ["n_shingles", "set_a", "set_b"]


def _prints(batches):
    """Fingerprint, size and 128-bit digest of the shingle set."""
    for part in slices(batches, 1):
        prints, sizes, first, second = [], [], [], []
        for items in shingles(words(part.column(1), lower=True), SHINGLE):
            prints.append((_SKETCH(items) >> np.uint64(48)).astype(">u2").tobytes())
            sizes.append(len(items))
            first.append(items.sum(dtype=np.uint64))
            second.append(mix(items ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
        digests = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (first, second)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()), *digests], ["doc_id", "print", *_SET])


def _alike(batches):
    """Pairs whose fingerprints are like enough; a pair of Jaccard THRESHOLD misses LIKELY with probability 2e-6."""
    for batch in batches:
        a, b = (np.array([np.frombuffer(x, ">u2") for x in batch.column(c).to_pylist()]).reshape(-1, SIZE) for c in (2, 3))
        keep = pa.array((a == b).mean(axis=1) >= LIKELY)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])


def _verify(batches):
    for part in parts(batches, 2, 3):
        left, right = (shingles(words(unpack(part.column(c)), lower=True), SHINGLE) for c in (2, 3))
        common = [(len(np.intersect1d(a, b, assume_unique=True)), len(a) + len(b)) for a, b in zip(left, right)]
        likeness = [c / (n - c) if n else 0.0 for c, n in common]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(likeness, pa.float64())], ["doc_id", "near_id", "jaccard"])


def verified(pairs: DataFrame, prints: DataFrame, texts: DataFrame, likely: bool = True) -> DataFrame:
    """The pairs (a, b) of Jaccard THRESHOLD or more on full sets, of those whose fingerprints are alike; staged.

    Unless ``likely``, the full sets alone decide.
    """
    left, right = (prints.select(F.col("d").alias(k), F.col("n_shingles").alias(f"n_{k}"), *([F.col("print").alias(f"print_{k}")] if likely else [])) for k in "ab")
    candidates = pairs.join(left, "a").join(right, "b").where(F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b"))
    if likely:
        candidates = candidates.select("a", "b", "print_a", "print_b").mapInArrow(_alike, "a long, b long")
    candidates = stage(candidates.select(F.col("a").alias("doc_id"), F.col("b").alias("near_id")).distinct(), "pairs")
    wanted = candidates.select("doc_id").union(candidates.select("near_id")).distinct()
    packed = packed_texts(texts, wanted)
    both = candidates.join(packed, "doc_id").join(packed.select(F.col("doc_id").alias("near_id"), F.col("packed").alias("near_packed")), "near_id")
    found = both.select("doc_id", "near_id", "packed", "near_packed").mapInArrow(_verify, "doc_id long, near_id long, jaccard double")
    links = stage(found.where(F.col("jaccard") >= THRESHOLD).select(F.col("doc_id").alias("a"), F.col("near_id").alias("b")).distinct(), "links")
    drop(candidates)
    return links


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, near_id, n_near, class_id) of documents that have a near-duplicate; staged.

    A class is what verified links connect. A band that many documents share gives some pair for each of them, not for each two.
    Only bands that two documents share are joined with their documents.
    """
    identified = docs.where("doc_id is not null")
    every = stage(identified.mapInArrow(_prints, "doc_id long, print binary, n_shingles long, set_a long, set_b long").where("n_shingles > 0"), "prints")
    ids = every.select("doc_id", *_SET).distinct()
    sets = stage(ids.groupBy(*_SET).agg(F.min("doc_id").alias("d"), F.count("*").alias("copies")), "sets")
    prints = stage(every.join(sets.select("d", *_SET), [every.doc_id == F.col("d"), *[every[c] == sets[c] for c in _SET]]).select("d", "print", every.n_shingles).distinct(), "nodes")
    width = 2 * SIZE // BANDS
    bands = prints.select("d", F.posexplode(F.array(*[F.substring("print", 1 + i * width, width) for i in range(BANDS)])).alias("band", "part"))
    bands = bands.select(F.xxhash64("band", "part").alias("key"), "d")
    shared = stage(bands.groupBy("key").agg(F.min("d").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n"), "shared")
    lists = stage(bands.join(shared, "key").distinct(), "lists")
    links = verified(lists.where("d <> pivot").select(F.col("d").alias("a"), F.col("pivot").alias("b")).distinct(), prints, identified)
    groups = components(links)
    # Members of a band that are in different components meet one of the largest; what is still apart, by exact prefixes.
    unmet = _unmet(lists.drop("pivot"), groups).where("label <> largest").select(F.col("d").alias("a"), F.col("pivot").alias("b"))
    more = verified(unmet.distinct(), prints, identified)
    groups = components(more, groups)
    pairs = apart(_unmet(lists.drop("pivot"), groups), prints.select("d", F.col("n_shingles").alias("n")), identified)
    rest = verified(pairs, prints, identified, likely=False)
    groups = components(rest, groups)
    drop(shared, lists, pairs, prints)

    links = links.union(more).union(rest)
    below = links.select(F.greatest("a", "b").alias("d"), F.least("a", "b").alias("least")).groupBy("d").agg(F.min("least").alias("least"))
    labelled = sets.join(groups.withColumnRenamed("node", "d"), "d", "left").join(below, "d", "left")
    labelled = stage(labelled.withColumn("class_id", F.coalesce("component", "d")).where("component is not null or copies > 1").select(*_SET, F.coalesce("least", "d").alias("least"), "copies", "class_id"), "classes")
    sizes = labelled.groupBy("class_id").agg((F.sum("copies") - 1).alias("n_near"))
    of = ids.join(labelled.join(sizes, "class_id"), _SET)
    near = F.min(F.when(F.col("least") < F.col("doc_id"), F.col("least"))).alias("near_id")
    return stage(of.groupBy("doc_id").agg(near, F.min_by("n_near", "class_id").alias("n_near"), F.min("class_id").alias("class_id")), "near")


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its fingerprint, that of its edited text, the likeness to the edited text and to the next document, the least
    verified near-duplicate before it that it met (near_id, null if none), the least document of its class of near-duplicates
    (class_id, null if it is alone; the least member has it too) and how many others are in the class (n_near)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return with_next(rows, near_classes(rows)).select("follows", "doc_id", "packed", *_NEAR).mapInArrow(_fingerprints, _SCHEMA)
