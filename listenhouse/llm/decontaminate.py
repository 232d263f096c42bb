"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents of one task. Its words become symbols,
its suffixes are sorted, and the Burrows-Wheeler transform goes into a wavelet
matrix. All test phrases are searched backwards at once; occurrences are
located by walking to sampled suffix positions, and their spans are merged.

Only words of the phrases can be part of an occurrence. Each stretch of other
words is one separator, and stretches of phrase words that are shorter than
the shortest phrase are left out before the index is built.

The benchmark is the query set: it goes through in blocks of ``BLOCK_BYTES``
of text, each against all rows, so what a task holds is bounded however
large the benchmark is. Documents are read where they lie; with one block
nothing is shuffled. With several, what the blocks find is put together by doc_id, hash and
length of the text, and each row takes what was found for its own.

Defined results: null or empty text has no words; an item without words has
no window; rows that repeat a doc_id are judged each by its own text; an
item_id that repeats counts once per row; a null item_id is written as an
empty string. Other columns of the documents are kept out of the way. Empty
tables give empty or all-clean results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenhouse.llm.staging import stage
from listenhouse.llm.words import ALNUM, mix, running, slices, words

WINDOW = 13
#: Contaminated: at least one word of SHARE is hit.
SHARE = 20
#: Words of a shard.
SHARD_WORDS = 1 << 20
#: UTF-8 bytes of benchmark text searched in one pass.
BLOCK_BYTES = 8 << 20
#: Every so many text positions a suffix position is kept.
SAMPLE = 16


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit row per binary digit, most significant first."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.digits = max(1, int(largest).bit_length())
        self.ones, self.zeros = [], []
        row = symbols
        for digit in reversed(range(self.digits)):
            bits = (row >> digit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bits))).astype(np.int32))
            self.zeros.append(int(len(bits) - self.ones[-1][-1]))
            row = np.concatenate((row[bits == 0], row[bits == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start = np.zeros_like(end)
        for level, digit in enumerate(reversed(range(self.digits))):
            one = ((symbol >> digit) & 1).astype(bool)
            ones, zeros = self.ones[level], self.zeros[level]
            start, end = (np.where(one, zeros + ones[p], p - ones[p]) for p in (start, end))
        return end - start


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling; settled suffixes drop out."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    length = 1
    # Ranks are the first place of their group, so a group's members can be sorted on their own.
    first = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
    place = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = place
    while True:
        single = np.concatenate((first[1:], [True])) & first
        open_places = np.flatnonzero(~single)
        if not len(open_places):
            return order
        members = order[open_places]
        behind = members + length
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        by = np.lexsort((second, rank[members]))
        members, second = members[by], second[by]
        order[open_places] = members
        group = rank[members]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])))
        first[open_places] |= new
        place = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[order] = place
        length *= 2


class FMIndex:
    """Backward search over a sequence of symbols >= 1; 0 ends it."""

    def __init__(self, symbols: np.ndarray, largest: int):
        text = np.append(symbols, 0)
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        self.matrix = WaveletMatrix(self.bwt, largest)
        self.kept = order % SAMPLE == 0
        self.kept_rank = np.concatenate(([0], np.cumsum(self.kept)))
        self.positions = order[self.kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of equally long phrases the range [low, high) of suffixes that begin with it."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.bwt))
        for column in phrases.T[::-1]:
            low = self.before[column] + self.matrix.rank(column, low)
            high = self.before[column] + self.matrix.rank(column, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step back in the text until one is sampled."""
        rows, steps, found = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        walking = np.arange(len(rows))
        while len(walking):
            at = rows[walking]
            known = self.kept[at]
            done = walking[known]
            found[done] = self.positions[self.kept_rank[rows[done]]] + steps[done]
            walking, at = walking[~known], at[~known]
            symbol = self.bwt[at]
            rows[walking] = self.before[symbol] + self.matrix.rank(symbol, at)
            steps[walking] += 1
        return found


@dataclass
class Phrases:
    """Test phrases as symbols: per length the distinct phrases, and the items of each."""

    vocabulary: np.ndarray  # sorted word hashes; symbol is place + 2, 1 separates
    by_length: dict[int, tuple[np.ndarray, list[np.ndarray]]]
    ids: list[str]

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=WINDOW)


def phrases(ids: list[str], texts: list[str]) -> Phrases:
    w = words(pa.array(texts, pa.string()), ALNUM, lower=True)
    vocabulary, symbol = np.unique(w.hashes, return_inverse=True)
    symbol = symbol.astype(np.int64) + 2
    found: dict[int, dict[bytes, set[int]]] = {}
    for item, (a, b) in enumerate(zip(w.bounds[:-1], w.bounds[1:])):
        size = min(WINDOW, int(b - a))
        for i in range(a, b - size + 1 if size else a):
            found.setdefault(size, {}).setdefault(symbol[i : i + size].tobytes(), set()).add(item)
    by_length = {
        size: (np.array([np.frombuffer(k, np.int64) for k in of]), [np.array(sorted(v)) for v in of.values()])
        for size, of in found.items()
    }
    return Phrases(vocabulary, by_length, ids)


def _symbols(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Symbol of each word, 1 for words of no phrase."""
    if not len(vocabulary):
        return np.ones(len(hashes), np.int64)
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[place] == hashes, place + 2, 1)


def _stretches(symbols: np.ndarray, bounds: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of phrase words within one text, at least ``shortest`` long."""
    inside = symbols > 1
    change = np.concatenate(([True], inside[1:] != inside[:-1])) if len(inside) else np.zeros(0, bool)
    heads = bounds[:-1][bounds[:-1] < len(inside)]
    change[heads] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(inside))[: len(starts)]
    keep = inside[starts] & (ends - starts >= shortest) if len(starts) else np.zeros(0, bool)
    return starts[keep], ends[keep]


class Shard:
    """Documents whose phrase words wait to be indexed together."""

    def __init__(self, known: Phrases):
        self.known, self.rows, self.counts, self.pieces, self.origins, self.size, self.words = known, [], [], [], [], 0, 0

    def add(self, rows: pa.RecordBatch, w) -> None:
        symbols = _symbols(w.hashes, self.known.vocabulary)
        starts, ends = _stretches(symbols, w.bounds, self.known.shortest)
        lengths = ends - starts
        at = np.repeat(starts, lengths) + running(lengths)
        # One separator behind each stretch.
        into = np.arange(len(at)) + np.repeat(np.arange(len(starts)), lengths)
        piece, origin = np.ones(len(at) + len(starts), np.int64), np.full(len(at) + len(starts), -1)
        piece[into], origin[into] = symbols[at], at + self.words
        self.pieces.append(piece)
        self.origins.append(origin)
        self.rows.append(rows)
        self.counts.append(w.counts)
        self.words += len(w.hashes)
        self.size += len(piece)

    def finish(self) -> pa.RecordBatch:
        symbols, origin = np.concatenate(self.pieces), np.concatenate(self.origins)
        counts = np.concatenate(self.counts)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        edges = np.zeros(self.words + 1, np.int64)  # +1 where a span starts, -1 behind its end
        items: list[set[int]] = [set() for _ in counts]
        if len(symbols):
            index = FMIndex(symbols, len(self.known.vocabulary) + 1)
            for size, (rows, of) in self.known.by_length.items():
                low, high = index.search(rows)
                hits = high - low
                begin = origin[index.locate(np.repeat(low, hits) + running(hits))]
                np.add.at(edges, begin, 1)
                np.add.at(edges, begin + size, -1)
                doc = np.searchsorted(bounds, begin, "right") - 1
                pairs = np.unique(np.stack((doc, np.repeat(np.arange(len(rows)), hits))), axis=1)
                for d, phrase in pairs.T:
                    items[d].update(of[phrase].tolist())
        hit = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]) > 0)))
        ids = [sorted(self.known.ids[i] for i in found) for found in items]
        rows = pa.Table.from_batches(self.rows)
        spans = _spans(np.cumsum(edges[:-1]) > 0, bounds)
        return pa.RecordBatch.from_arrays([
            rows.column(0).combine_chunks(), pa.array(counts, pa.int64()), pa.array(hit[bounds[1:]] - hit[bounds[:-1]], pa.int64()),
            pa.array(ids, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
        ], ["row", "n_words", "n_hit", "items", "spans"])


def _spans(hit: np.ndarray, bounds: np.ndarray) -> list[list[list[int]]]:
    """Per text the merged spans of hit words, [first, behind the last]."""
    out: list[list[list[int]]] = [[] for _ in bounds[1:]]
    for d in np.unique(np.searchsorted(bounds, np.flatnonzero(hit), "right") - 1):
        own = np.concatenate(([False], hit[bounds[d] : bounds[d + 1]], [False])).astype(np.int8)
        step = np.diff(own)
        out[d] = np.stack((np.flatnonzero(step == 1), np.flatnonzero(step == -1)), axis=1).tolist()
    return out


def _search(known: Phrases):
    def run(batches):
        shard = Shard(known)
        for part in slices(batches, 1):
            shard.add(part.select([0]), words(part.column(1), ALNUM, lower=True))
            if shard.words >= 8 * SHARD_WORDS or shard.size >= SHARD_WORDS:
                yield shard.finish()
                shard = Shard(known)
        if shard.rows:
            yield shard.finish()

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> tuple[int, Iterator[list]]:
    """The number of blocks, and the benchmark in blocks of at most BLOCK_BYTES, or one item; read from the driver one block at a time."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-total // (BLOCK_BYTES // 2)) or 1
    return n, (items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect() if n > 1 else items.collect() for b in range(n))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", keep: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, items, spans (merged word spans to remove), contaminated; ``keep`` adds ``row``, the whole input row."""
    kept = F.struct(*([F.col(f"`{c}`") for c in docs.columns] if keep else [F.col(doc_id)]))
    n, blocks = _blocks(benchmark, item_id, "text")
    own_text = F.col(text).cast("string")
    key = F.struct(F.col(doc_id).cast("string").alias("id"), F.xxhash64(own_text).alias("hash"), F.coalesce(F.octet_length(own_text), F.lit(-1)).alias("size"))
    source = docs.select((kept if n == 1 else key).alias("row"), own_text)
    schema = f"row {source.schema['row'].dataType.simpleString()}, n_words long, n_hit long, items array<string>, spans array<array<int>>"
    parts = []
    for block in blocks:
        found = source.mapInArrow(_search(phrases([r.id for r in block], [r.text for r in block])), schema)
        parts.append(found if n == 1 else stage(found, "block"))
    whole = parts[0] if n == 1 else _merged(parts, docs.select(kept.alias("row"), key.alias("key")))
    hit = (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    out = whole.withColumn("contaminated", hit).withColumn("doc_id", F.col(f"row.`{doc_id}`"))
    names = ["doc_id", "n_words", "n_hit", "items", "spans", "contaminated"]
    return out.select(*names, "row") if keep else out.select(*names)


def _merged(parts: list[DataFrame], rows: DataFrame) -> DataFrame:
    """Blocks of one corpus put together for each of ``rows`` (row, key): spans merge, items add up."""
    columns = ["n_words", "items", "spans"]
    # Rows of one key have the same text, so that any of them tells what a block finds.
    once = [p.groupBy("row").agg(*[F.first(c).alias(c) for c in columns]) for p in parts]
    every = once[0]
    for p in once[1:]:
        every = every.union(p)
    grouped = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("all"),
    )
    start = F.array().cast("array<array<int>>")
    merged = F.aggregate(
        "all", start,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)[1] >= s[0]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.array(F.element_at(done, -1)[0], F.greatest(F.element_at(done, -1)[1], s[1])))),
        ).otherwise(F.concat(done, F.array(s))),
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    found = (
        grouped.withColumn("items", F.sort_array("items")).withColumn("spans", F.when(F.size("all") > 0, merged).otherwise(start)).withColumn("n_hit", n_hit)
        .select(*[F.col(f"row.{c}").alias(c) for c in ("id", "hash", "size")], "n_words", "n_hit", "items", "spans")
    )
    same = F.col("key.id").eqNullSafe(F.col("id")) & (F.col("key.hash") == F.col("hash")) & (F.col("key.size") == F.col("size"))
    return rows.join(found, same).select("row", "n_words", "n_hit", "items", "spans")


def digest(found: DataFrame) -> DataFrame:
    """The counts and the hash of the item ids, without the ids."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    found = contamination(docs, benchmark, doc_id, text, item_id, keep=True)
    return found.where("not contaminated").select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
