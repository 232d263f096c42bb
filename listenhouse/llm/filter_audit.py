"""What filters take away alone, together and in every order, by contractions of a contingency tensor.

Five filters judge every document once. Per part of the corpus the documents
are counted by which filters they fail; the 32 counts are a tensor of shape
2 x 2 x 2 x 2 x 2 with one axis per filter (0 passes, 1 fails). What an order of
filters keeps and removes at a step is that tensor contracted with one vector
per axis: ``PASS`` for filters applied before, ``FAIL`` or ``PASS`` for the own one, ``ALL``
for those to come. One ``einsum`` does it for all steps of all orders.

Judging and counting are Spark aggregations that combine map-side; what reaches a
tensor is 32 counts per part, whatever the size of the corpus. Copies are found
by a digest of the text: of each text and part there is one row with the least doc_id
and the rows that carry it, so a text that a third of all documents share is
a few rows by the time its copies meet.

Defined results: null text is empty, and an empty text equals other empty texts; null
source is the part ''. A null doc_id is neither smaller nor larger than another, so
it fails no copy and makes none fail; rows that repeat a doc_id and text are all first
if one is. Each row of documents counts. A document is good or toxic if any of its
label rows says so; one without label rows, or without doc_id, is neither. Other columns
play no part. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
#: Parts whose tensors are contracted at once.
_PARTS = 64

_WORD = r"[^\x20\x09-\x0D]+"
_MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _MEASURES)


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails A (short), B (repetitive), C (upper case), D (symbols)."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the set of filters they fail, bit i for the i-th."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text))]
    judged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = judged.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(says("quality"), says("toxic"))
    # Rows without id match no label; they are dealt by their digest instead of meeting under one key.
    key = F.coalesce("doc_id", F.xxhash64("digest"))
    labelled = rows.withColumn("key", key).join(known, (F.col("key") == F.col("label_id")) & F.col("doc_id").isNotNull(), "left")
    one = labelled.select("doc_id", "part", "mask", "digest", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic")])
    per_text = one.groupBy("digest", "mask", "part", "quality", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by(F.when(F.col("doc_id").isNotNull(), F.col("n")), "doc_id").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    passing = F.col("no_id") + F.when(F.col("least") == first, F.col("at_least")).otherwise(0)
    both = per_text.withColumn("passing", passing).select(
        "part", "quality", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
            F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )).alias("of"),
    )
    only = lambda c: F.sum(F.when(F.col(c), F.col("of.n")).otherwise(0))
    return both.groupBy("part", "of.mask").agg(F.sum("of.n").alias("n"), only("quality").alias("good"), only("toxic").alias("toxic"))


def _vectors(own: tuple[int, int], before: tuple[int, int], after: tuple[int, int]) -> list[np.ndarray]:
    """For each axis, a row per step of each order."""
    chosen = np.empty((len(ORDERS) * len(FILTERS), len(FILTERS), 2), np.int64)
    for i, order in enumerate(ORDERS):
        for step in range(len(FILTERS)):
            for place, name in enumerate(order):
                chosen[i * len(FILTERS) + step, FILTERS.index(name)] = own if place == step else before if place < step else after
    return list(chosen.transpose(1, 0, 2))


def _contract(tensors: np.ndarray, vectors: list[np.ndarray]) -> np.ndarray:
    """(part, step of an order, count) from (part, a, b, c, d, e, count)."""
    return np.einsum("pabcdek,sa,sb,sc,sd,se->psk", tensors, *vectors, optimize="greedy")


def audit(tensors: np.ndarray) -> np.ndarray:
    """(part, step of an order, measure) from tensors of (part, 2, 2, 2, 2, 2, (all, good, toxic)); measures as in ``_MEASURES``."""
    kept = _contract(tensors, _vectors(PASS, PASS, ALL))[..., 0]
    removed = _contract(tensors, _vectors(FAIL, PASS, ALL))
    failing = _contract(tensors, _vectors(FAIL, ALL, ALL))[..., 0]
    alone = _contract(tensors, _vectors(FAIL, PASS, PASS))[..., 0]
    own = np.array([FILTERS.index(name) for order in ORDERS for name in order])
    shapley = np.stack([removed[:, own == i, 0].sum(axis=1) for i in range(len(FILTERS))], axis=1)[:, own]
    return np.stack([kept, removed[..., 0], failing - removed[..., 0], alone, removed[..., 1], removed[..., 2], shapley], axis=2)


def _audits(batches):
    steps = len(ORDERS) * len(FILTERS)
    orders, numbers = np.repeat(ORDERS, len(FILTERS)), np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    for batch in batches:
        for i in range(0, batch.num_rows, _PARTS):
            part = batch.slice(i, _PARTS).to_pydict()
            counts = np.zeros((len(part["part"]), 2 ** len(FILTERS), 3), np.int64)
            for p, found in enumerate(part["counts"]):
                for x in found:
                    counts[p, x["mask"]] = x["n"], x["good"], x["toxic"]
            # The first filter is the lowest bit, hence the last axis of the counts.
            tensors = counts.reshape(-1, *[2] * len(FILTERS), 3).transpose(0, *range(len(FILTERS), 0, -1), len(FILTERS) + 1)
            found = audit(tensors).reshape(-1, len(_MEASURES))
            n = len(part["part"])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array(part["part"], object), steps), pa.string()), pa.array(np.tile(orders, n), pa.string()),
                pa.array(np.tile(numbers, n)), *[pa.array(found[:, c]) for c in range(len(_MEASURES))],
            ], ["part", "filter_order", "step", *_MEASURES])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    counts = failure_counts(docs, labels)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return parts.mapInArrow(_audits, _SCHEMA)
