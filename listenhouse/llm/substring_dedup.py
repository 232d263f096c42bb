"""Exact substring dedup with fixed-block anchors.

Every text has non-overlapping reference blocks of ``BLOCK`` words. Any window of
``WINDOW`` words contains a whole block, so of two equal windows each holds a
block that the other one has at some place. The index of the blocks is probed
with every rolling window of ``BLOCK`` words of every text; a block that other
documents hold too is an anchor. Around the anchors, windows are extended to
``WINDOW`` words and compared exactly by 64-bit hashes; overlapping repeats
merge to maximal ones. A window is a repeat unless it is the first of its kind by
(doc_id, place).

Probes are many, so they travel packed: for each slice of texts and each bucket of
hashes one row with the hashes of all its documents, ``PROBE_BYTES`` each, without
places. A bucket answers each document with the hashes that are anchors, packed the
same way by buckets of documents, and the document finds their places again. Equal hashes of one slice are combined before
they are sent, so a passage that a third of all documents share reaches its bucket
once per slice.

Defined results: words are runs of anything but \\x20 and \\x09-\\x0D, unchanged;
null or blank text has no words; a text of fewer words than a window loses
nothing; rows that repeat a doc_id are judged each by its own text, equal places of
theirs are both first. Null ids come before all others. Other columns play
no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenhouse.llm.staging import partitions, stage
from listenhouse.llm.texts import packed_texts, unpack
from listenhouse.llm.words import mix, slices, windows, words

WINDOW = 20
BLOCK = 10  # 2 * BLOCK - 1 <= WINDOW: every window contains a whole block
PROBE_BYTES = 5
SLICE = 8 << 20
_NULL_ID = -(1 << 63)

_SENT = "bucket int, kind int, docs binary, counts binary, hashes binary"
_ANSWER = "doc_id long, hashes binary"


def _narrow(hashes: np.ndarray, width: int) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _rows(bucket: np.ndarray, kind: int, docs: np.ndarray, hashes: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its documents, how many hashes of each, and the hashes."""
    if not len(hashes):
        return
    order = np.lexsort((docs, bucket))
    bucket, docs, hashes = bucket[order], docs[order], hashes[order]
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    rows = []
    for a, b in zip(cut, np.append(cut[1:], len(bucket))):
        heads = a + np.flatnonzero(np.concatenate(([True], docs[a + 1 : b] != docs[a : b - 1])))
        counts = np.diff(np.append(heads, b))
        rows.append((int(bucket[a]), kind, docs[heads].tobytes(), counts.astype(np.uint32).tobytes(), _narrow(hashes[a:b], width)))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "kind", "docs", "counts", "hashes"])


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(n)).astype(np.int32)


def _distinct(docs: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of the distinct (hash, doc); of equal ones that with the greatest ``first`` flag."""
    order = np.lexsort((~first, docs, hashes))
    d, h = docs[order], hashes[order]
    return order[np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))] if len(order) else order


_PROBE, _BLOCK, _KNOWN = 0, 1, 2


def _probes(n: int):
    """Blocks and rolling windows of BLOCK words. Anchors that a slice knows by itself are answered as kind _KNOWN, and sent once."""

    def run(batches):
        for part in slices(batches, 1, SLICE):
            w = words(part.column(1))
            ids = part.column(0).to_numpy(zero_copy_only=False)
            h = windows(w.hashes, BLOCK)
            text = np.repeat(np.arange(len(ids)), w.counts)[: len(h)]
            place = np.arange(len(h)) - w.bounds[text]
            whole = place + BLOCK <= w.counts[text]
            h, doc, block = h[whole], ids[text[whole]], place[whole] % BLOCK == 0
            at = _distinct(doc, h, block)
            h, doc, block = h[at], doc[at], block[at]  # sorted by hash
            if not len(h):
                continue
            cut = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            size = np.diff(np.append(cut, len(h)))
            anchor = np.repeat((size > 1) & (np.add.reduceat(block, cut) > 0), size)
            once = np.zeros(len(h), bool)
            once[cut] = True
            yield from _rows(_bucket(h[anchor], n), _KNOWN, doc[anchor], h[anchor], PROBE_BYTES)
            send = ~anchor | once
            block = block | anchor
            for kind, of in ((_PROBE, send & ~block), (_BLOCK, send & block)):
                yield from _rows(_bucket(h[of], n), kind, doc[of], h[of], PROBE_BYTES)

    return run


def _read(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for bucket, kind, docs, counts, hashes in zip(*(batch.column(i).to_pylist() for i in range(5))):
        yield bucket, kind, np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32)), _wide(hashes, width)


def _answers(docs: np.ndarray, hashes: np.ndarray, width: int, n: int) -> Iterator[pa.RecordBatch]:
    """Answers on their way back: packed by bucket of documents."""
    yield from _rows((mix(docs.view(np.uint64)) % np.uint64(n)).astype(np.int32), 0, docs, hashes, width)


def _by_bucket(batches, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Kinds, docs and hashes of one bucket after another."""
    now, held = None, []
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for bucket, kind, docs, hashes in _read(batch.slice(i, 256), width):
                if bucket != now and held:
                    yield tuple(map(np.concatenate, zip(*held)))
                    held = []
                now = bucket
                held.append((np.full(len(docs), kind, np.int8), docs, hashes))
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _anchors(n: int):
    """The hashes of a bucket that are a block of some document and stand in another one, told to all documents that sent them."""

    def run(batches):
        for kind, docs, hashes in _by_bucket(batches, PROBE_BYTES):
            known = kind == _KNOWN
            yield from _answers(docs[known], hashes[known], PROBE_BYTES, n)
            kind, docs, hashes = kind[~known], docs[~known], hashes[~known]
            order = np.argsort(hashes, kind="stable")
            kind, docs, hashes = kind[order], docs[order], hashes[order]
            if not len(hashes):
                continue
            cut = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            size = np.diff(np.append(cut, len(hashes)))
            hit = np.repeat((size > 1) & (np.add.reduceat(kind == _BLOCK, cut) > 0), size)
            yield from _answers(docs[hit], hashes[hit], PROBE_BYTES, n)

    return run


def _gather(width: int):
    """All answers to a document in one row."""

    def run(batches):
        for _, docs, hashes in _by_bucket(batches, width):
            order = np.argsort(docs, kind="stable")
            docs, hashes = docs[order], hashes[order]
            cut = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
            values = [_narrow(hashes[a:b], width) for a, b in zip(cut, np.append(cut[1:], len(docs)))]
            yield pa.RecordBatch.from_arrays([pa.array(docs[cut]), pa.array(values, pa.binary())], ["doc_id", "hashes"])

    return run


def _texts(batch: pa.RecordBatch, column: int, step: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows in parts, their packed texts unpacked."""
    for i in range(0, batch.num_rows, step):
        part = batch.slice(i, step)
        yield part.set_column(column, "text", unpack(part.column(column)))


def _candidates(n: int):
    """Windows of WINDOW words that contain an anchor. Of equal ones in a part only the least document asks; the others are repeats."""

    def run(batches):
        for batch in batches:
            for part in _texts(batch, 1):
                w = words(part.column(1))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                docs, found = [], []
                for doc, a, b, anchors in zip(ids, w.bounds, w.bounds[1:], part.column(2).to_pylist()):
                    if b - a < WINDOW:
                        continue
                    known = np.unique(_wide(anchors, PROBE_BYTES))
                    mask = np.uint64((1 << 8 * PROBE_BYTES) - 1)
                    hit = np.isin(windows(w.hashes[a:b], BLOCK) & mask, known)
                    upto = np.concatenate(([0], np.cumsum(hit)))
                    last = WINDOW - BLOCK
                    covers = upto[last + 1 :] - upto[: -last - 1] > 0  # any anchor that starts in [i, i + last]
                    h = np.unique(windows(w.hashes[a:b], WINDOW)[covers])
                    docs.append(np.full(len(h), doc, np.int64))
                    found.append(h)
                if not docs:
                    continue
                doc, h = np.concatenate(docs), np.concatenate(found)
                order = np.lexsort((doc, h))
                doc, h = doc[order], h[order]
                start = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
                least = doc[np.flatnonzero(start)][np.cumsum(start) - 1] if len(h) else doc
                yield from _rows(_bucket(h[doc > least], n), _KNOWN, doc[doc > least], h[doc > least], 8)
                yield from _rows(_bucket(h[start], n), _PROBE, doc[start], h[start], 8)

    return run


def _repeats(n: int):
    """Windows that an earlier document has too, told to each later document that asked."""

    def run(batches):
        for kind, docs, hashes in _by_bucket(batches, 8):
            known = kind == _KNOWN
            yield from _answers(docs[known], hashes[known], 8, n)
            docs, hashes = docs[~known], hashes[~known]
            order = np.lexsort((docs, hashes))
            docs, hashes = docs[order], hashes[order]
            if not len(docs):
                continue
            start = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            later = docs > docs[np.flatnonzero(start)][np.cumsum(start) - 1]
            yield from _answers(docs[later], hashes[later], 8, n)

    return run


def removed(hashes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Which words of one text lie in a window that is in ``repeats`` or starts earlier in the same text."""
    n = len(hashes)
    if n < WINDOW:
        return np.zeros(n, bool)
    h = windows(hashes, WINDOW)
    first = np.zeros(len(h), bool)
    first[np.unique(h, return_index=True)[1]] = True
    again = np.isin(h, repeats) | ~first
    edges = np.zeros(n + 1, np.int64)
    edges[: len(h)] += again
    edges[WINDOW : WINDOW + len(h)] -= again
    return np.cumsum(edges[:-1]) > 0


def _finish(batches):
    for batch in batches:
        for part in _texts(batch, 1):
            w = words(part.column(1))
            n_removed, kept, spans = [], [], []
            data = w.data.tobytes()
            for a, b, repeats in zip(w.bounds, w.bounds[1:], part.column(2).to_pylist()):
                gone = removed(w.hashes[a:b], _wide(repeats or b"", 8))
                n_removed.append(int(gone.sum()))
                stay = np.flatnonzero(~gone) + a
                kept.append(hashlib.sha256(b" ".join(data[s:e] for s, e in zip(w.starts[stay], w.ends[stay]))).hexdigest())
                step = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
                spans.append(np.stack((np.flatnonzero(step == 1), np.flatnonzero(step == -1)), axis=1).tolist())
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(w.counts, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
            ], ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, spans of removed words (maximal exact repeats, merged)."""
    n = partitions(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = lambda df: df.repartition(n, "bucket").sortWithinPartitions("bucket")
    sent = dealt(rows.mapInArrow(_probes(n), _SENT)).mapInArrow(_anchors(n), _SENT)
    anchors = stage(dealt(sent).mapInArrow(_gather(PROBE_BYTES), _ANSWER), "anchors")
    texts = packed_texts(rows, anchors.select("doc_id"))
    asked = anchors.join(texts, "doc_id").select("doc_id", "packed", "hashes").mapInArrow(_candidates(n), _SENT)
    repeats = dealt(dealt(asked).mapInArrow(_repeats(n), _SENT)).mapInArrow(_gather(8), _ANSWER)
    found = packed_texts(rows).join(repeats, "doc_id", "left").select("doc_id", "packed", "hashes").mapInArrow(_finish, _RESULT)
    return found.withColumn("doc_id", F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")))


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<array<int>>"
