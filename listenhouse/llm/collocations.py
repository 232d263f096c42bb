"""Collocations by set-oriented mining of phrase relations.

Phrases of a length are a relation (place, group): where they occur and which phrase it is. It is
persisted in order of places, and three steps that are each a relational one give the next length:

* merge-join: occurrences that stand at adjacent places of one piece give a longer one;
* group-count: its groups are counted over the whole corpus;
* semi-join: occurrences of frequent groups stay, all others go before anything is extended.

Occurrences lie in blocks of some megabytes of text of one language, dictionary and codes packed, in a table bucketed
by block: the joins of blocks with their relations never move it again. Blocks are sorted, so the merge-join is one
of arrays inside a block. Groups are counted in Spark: a block sends each distinct group once, with its
count, packed by bucket of the group; a bucket adds up, and answers each block with one bit per group. A very frequent word
or passage is one entry per block, wherever it stands. Buckets are so many that one holds about ``BUCKET`` entries, at
any size of the corpus, and a task holds one bucket or block at a time.

Frequent phrases, each told by one block, are a table; cuts, scores and maximality are joins over it, and
arithmetic is of 38 decimal digits.

Defined results: text is lower-cased (A-Z only), pieces end at ``.,;:!?`` and \\x0A-\\x0D, words
are runs of anything but space and tab; null or empty text has none; null lang is ``und``. Every row of the table
counts, repeated ones and such without id too. Other columns play no part. An empty table gives
an empty result. Groups are known by 64-bit hashes of language and words.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from listenhouse.llm.staging import delete_on_exit, partitions, stage
from listenhouse.llm.words import mix, powers, slices, words
from listenhouse.session import scratch_path

LONGEST = 5
LEAST = 100
FIRST = 2000
SLICE = 8 << 20
BUCKET = 1 << 19

#: floor(1000 a n / (l r)) by decimals of 38 digits.
SCORE = """cast(cast(a as decimal(19, 0)) * cast(n as decimal(15, 0)) * cast(1000 as decimal(4, 0))
    div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as bigint)"""

_BYTES = np.arange(256)
_BREAK = np.isin(_BYTES, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_IN_WORD = ~(_BREAK | (_BYTES == 0x20) | (_BYTES == 0x09))
_STEP = np.uint64(0xA0761D6478BD642F)

_BLOCK = "block long, lang string, n long, dictionary binary, codes binary"
_SENT = "bucket int, block long, groups binary, counts binary"
_ANSWER = "block long, bucket int, frequent binary, told binary, totals binary"
_FOUND = "block long, alive binary, lang string, words int, group long, phrase string, f long, lefts array<long>, rights array<long>"


# -- blocks

def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _codes(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """For each word the number of it in the dictionary, -1 between pieces; and the dictionary, frequent words first."""
    w = words(column, _IN_WORD, lower=True)
    if not len(w.starts):
        return np.zeros(0, np.int32), []
    breaks = np.concatenate(([0], np.cumsum(_BREAK[w.data])))
    text = np.repeat(np.arange(len(column)), w.counts)
    apart = (breaks[w.starts[1:]] != breaks[w.ends[:-1]]) | (text[1:] != text[:-1])
    _, example, number, times = np.unique(w.hashes, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    codes = np.insert(place[number].astype(np.int32), np.flatnonzero(apart) + 1, -1)
    return codes, [w.data[w.starts[i] : w.ends[i]].tobytes().lower() for i in example[order]]


def _blocks(batches):
    partition, serial = TaskContext.get().partitionId(), 0
    for part in slices(batches, 1, SLICE):
        of = np.array(part.column(0).to_pylist(), object)
        for lang in sorted(set(of)):
            codes, dictionary = _codes(part.column(1).take(pa.array(np.flatnonzero(of == lang))))
            if dictionary:
                row = ((partition << 32) + serial, lang, int((codes >= 0).sum()), _pack(b"\n".join(dictionary)), _pack(codes.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()))], ["block", "lang", "n", "dictionary", "codes"])
                serial += 1


class _Block:
    """Words of a block by place, and where the phrases of some length stand that are alive."""

    def __init__(self, lang: str, dictionary: bytes, codes: bytes, alive: bytes | None):
        joined = _unpack(dictionary)
        self.dictionary = joined.split(b"\n")
        seed = np.frombuffer(hashlib.sha256(lang.encode()).digest()[:8], np.uint64)[0]
        hashes = mix(words(pa.array([joined.decode()], pa.string()), _IN_WORD).hashes ^ seed)
        self.codes = np.frombuffer(_unpack(codes), np.int32)
        self.hashes = np.append(hashes, np.uint64(0))[self.codes]
        self.alive = None if alive is None else np.unpackbits(np.frombuffer(_unpack(alive), np.uint8), count=len(self.codes)).view(bool)

    def extended(self) -> np.ndarray:
        """Merge-join: places where a phrase is alive and another one at the next place; at first, all words."""
        return np.flatnonzero(self.codes >= 0) if self.alive is None else np.flatnonzero(self.alive[:-1] & self.alive[1:])

    def groups(self, places: np.ndarray, length: int) -> np.ndarray:
        """The group of the phrase of ``length`` words at each place."""
        total = np.full(len(places), length, np.uint64)
        for j, p in enumerate(powers(_STEP, length)):
            total += self.hashes[places + j] * p
        return mix(total)

    def phrase(self, place: int, length: int) -> str:
        return b" ".join(self.dictionary[c] for c in self.codes[place : place + length]).decode()


def _cuts(groups: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted groups; buckets are ranges of hashes."""
    bounds = -(-(np.arange(1, buckets, dtype=object) << 64) // buckets)
    return np.concatenate(([0], np.searchsorted(groups, np.array(bounds, np.uint64)), [len(groups)])).astype(np.int64)


# -- group-count

def _send(length: int, buckets: int):
    def run(batches):
        for batch in batches:
            for block, lang, dictionary, codes, alive in zip(*(batch.column(i).to_pylist() for i in range(5))):
                of = _Block(lang, dictionary, codes, alive)
                groups, counts = np.unique(of.groups(of.extended(), length), return_counts=True)
                cuts = _cuts(groups, buckets)
                used = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays([
                    pa.array(used, pa.int32()), pa.array(np.full(len(used), block), pa.int64()),
                    pa.array([groups[cuts[b] : cuts[b + 1]].tobytes() for b in used], pa.binary()),
                    pa.array([counts[cuts[b] : cuts[b + 1]].astype(np.uint32).tobytes() for b in used], pa.binary()),
                ], ["bucket", "block", "groups", "counts"])

    return run


def _by_bucket(batches) -> Iterator[tuple[int, list[tuple[int, bytes, bytes]]]]:
    now, held = None, []
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for bucket, *row in zip(*(part.column(c).to_pylist() for c in range(4))):
                if bucket != now and held:
                    yield now, held
                    held = []
                now = bucket
                held.append(row)
    if held:
        yield now, held


def _answer(least: int):
    """Which groups of each block are frequent; the first block that has one is to tell it, with its total."""

    def run(batches):
        for bucket, rows in _by_bucket(batches):
            groups = [np.frombuffer(g, np.uint64) for _, g, _ in rows]
            counts = np.concatenate([np.frombuffer(c, np.uint32) for *_, c in rows]).astype(np.int64)
            _, first, number = np.unique(np.concatenate(groups), return_index=True, return_inverse=True)
            totals = np.zeros(len(first), np.int64)
            np.add.at(totals, number, counts)
            frequent = totals[number] >= least
            told = np.zeros(len(number), bool)
            told[first] = True
            told &= frequent
            ends, out = np.cumsum([len(g) for g in groups]), []
            for (block, *_), a, b in zip(rows, np.concatenate(([0], ends[:-1])), ends):
                if frequent[a:b].any():
                    out.append((block, bucket, np.packbits(frequent[a:b]).tobytes(), np.packbits(told[a:b]).tobytes(), totals[number[a:b][told[a:b]]].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["block", "bucket", "frequent", "told", "totals"])

    return run


# -- semi-join

def _keep(length: int, buckets: int):
    """The relation of the next length, and the frequent phrases that a block is to tell."""

    def run(batches):
        for batch in batches:
            for block, lang, dictionary, codes, alive, answers in zip(*(batch.column(i).to_pylist() for i in range(6))):
                of = _Block(lang, dictionary, codes, alive)
                places = of.extended()
                groups, example, number = np.unique(of.groups(places, length), return_index=True, return_inverse=True)
                cuts = _cuts(groups, buckets)
                frequent, told = np.zeros((2, len(groups)), bool)
                totals = np.zeros(len(groups), np.int64)
                for x in answers:
                    a, b = cuts[x["bucket"]], cuts[x["bucket"] + 1]
                    frequent[a:b], told[a:b] = (np.unpackbits(np.frombuffer(x[c], np.uint8), count=b - a).view(bool) for c in ("frequent", "told"))
                    totals[a:b][told[a:b]] = np.frombuffer(x["totals"], np.int64)
                now = np.zeros(len(of.codes), bool)
                now[places] = frequent[number]
                at = places[example[told]]
                n = len(at)
                # Both parts of each cut; groups of shorter phrases are known by their words.
                lefts, rights = (np.array(x, np.uint64).T.reshape(-1).view(np.int64) for x in (
                    [of.groups(at, j) for j in range(1, length)], [of.groups(at + j, length - j) for j in range(1, length)]
                ))
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * (length - 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * (n + 1), pa.int64()), pa.array([_pack(np.packbits(now).tobytes())] + [None] * n, pa.binary()),
                    pa.array([lang] * (n + 1), pa.string()), pa.array([length] * (n + 1), pa.int32()),
                    pa.array([None, *groups[told].view(np.int64).tolist()], pa.int64()), pa.array([None, *(of.phrase(p, length) for p in at)], pa.string()),
                    pa.array([None, *totals[told].tolist()], pa.int64()),
                    *[pa.concat_arrays([pa.array([None], pa.list_(pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64()))]) for x in (lefts, rights)],
                ], ["block", "alive", "lang", "words", "group", "phrase", "f", "lefts", "rights"])

    return run


# -- the whole

def _bucketed(blocks: DataFrame) -> tuple[DataFrame, str]:
    """The blocks as a table of the catalog, bucketed by block, and its name."""
    spark = blocks.sparkSession
    n, name, path = partitions(spark), f"blocks_{uuid.uuid4().hex[:12]}", scratch_path(spark, "blocks")
    blocks.repartition(n, "block").write.bucketBy(n, "block").sortBy("block").option("path", path).saveAsTable(name)
    delete_on_exit(spark, path)
    return spark.table(name), name


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, group, phrase, f, lefts, rights) of phrases of 1 to ``longest`` words that occur ``least`` times; and (lang, n).

    ``lefts`` and ``rights`` are the groups of both parts of every cut, behind the first word to before the last.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string"))
    blocks, name = _bucketed(source.mapInArrow(_blocks, _BLOCK))
    sizes = stage(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    n = partitions(spark)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = max(n, -(-total // BUCKET))

    alive, found = None, None
    for length in range(1, longest + 1):
        now = blocks.withColumn("alive", F.lit(None).cast("binary")) if alive is None else blocks.join(alive, "block")
        now = now.select("block", "lang", "dictionary", "codes", "alive")
        sent = now.mapInArrow(_send(length, buckets), _SENT)
        dealt = sent.repartitionById(n, F.pmod("bucket", F.lit(n)).cast("int")).sortWithinPartitions("bucket", "block")
        answers = stage(dealt.mapInArrow(_answer(least), _ANSWER), "answers")
        per_block = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "frequent", "told", "totals")).alias("answers"))
        kept = stage(now.join(per_block, "block").mapInArrow(_keep(length, buckets), _FOUND), "relation")
        alive = kept.where("alive is not null").select("block", "alive")
        phrases = kept.where("phrase is not null").drop("block", "alive")
        found = phrases if found is None else found.union(phrases)
    spark.sql(f"DROP TABLE {name}")
    return found, sizes


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """Per language the best phrases by the score of their weakest cut: lang, rank, phrase, a, l, r, n, score."""
    found, sizes = frequent_phrases(docs, least, longest)
    counts = found.select("group", "f")
    several = found.where("words > 1").withColumnRenamed("f", "a")
    part = lambda side, f: counts.select(F.col("group").alias(side), F.col("f").alias(f))
    cuts = several.select("lang", "group", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut"))
    cuts = cuts.select("lang", "group", "a", "k", "cut.lefts", "cut.rights").join(part("lefts", "l"), "lefts").join(part("rights", "r"), "rights").join(sizes, "lang")
    weakest = cuts.withColumn("score", F.expr(SCORE)).groupBy("group").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut"))
    # A phrase lies in a longer one as frequent as itself exactly if it does in one that is longer by a word.
    around = several.where("words > 2").select(F.explode(F.array(F.element_at("lefts", -1), F.element_at("rights", 1))).alias("group"), F.col("a").alias("longer"))
    around = around.groupBy("group").agg(F.max("longer").alias("longer"))
    whole = several.join(around, "group", "left").where("longer is null or longer < a").select("lang", "group", "phrase", "a")
    scored = whole.join(weakest, "group").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
