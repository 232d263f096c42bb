"""Token ids of a corpus in compact binary files, written and read as a Spark data source.

Ids are replaced by their rank by frequency in the whole corpus, so that common ones
are small numbers, and these are coded in whole bytes: one to four data bytes each, with the
lengths, two bits each, in separate control bytes. Decoding looks each control
byte up in a table that says where its four values lie, and gathers all of a block at
once. The table of ranks, as long as the vocabulary at most, lies beside the files.

* Counting reads all texts once; per task and id one number is shuffled.
* Writing deals texts by ranges of (doc_id, hash of the text) and sorts each range; a task encodes its range and
  writes it block by block, so it holds one block and no more. Rows of one doc_id, or
  of none, are spread by the hash.
* A file counts only when the manifest names it, and the manifest is written last, when all tasks have
  ended: tries that fail or run twice leave files that nobody reads.

Texts are encoded by the tokenizers library. Its split of a text into pre-tokens cuts before a single
space, around a single line break and before a stop that follows a letter, whatever else stands
there; each distinct piece between such cuts is encoded once per worker and looked up by a 64-bit hash.

A file is a sequence of blocks of whole documents. A block has, in little-endian numbers: documents,
ids and data bytes (three of 64 bits); doc_ids (64 bits each), 1 or 0 for known or null doc_ids (a byte each), ids of each
document (64 bits each); control bytes; data bytes.

Defined results: null text is empty; every document, an empty one too, gets the end id behind
its ids. Documents lie in ascending doc_id order, nulls first, rows of one doc_id by the hash
of their text; each repeated row is written. Strings of special tokens in a text are ordinary text. Other columns play no part. An
empty table gives a manifest without files.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from listenhouse.llm.staging import partitions
from listenhouse.llm.words import SLICE_BYTES, mix, powers, slices, utf8

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 2
#: Ids of a file, and of a block; a longer document is a block by itself.
FILE_IDS = 1 << 28
BLOCK_IDS = 1 << 18
#: Distinct pieces, and ids of theirs, that a worker remembers before it starts anew.
KNOWN_PIECES, KNOWN_IDS = 1 << 21, 1 << 24
#: Places of the table of pieces, a power of two.
PLACES = 1 << 23

_MANIFEST, _RANKS = "manifest.json", "ids-by-rank.bin"
_SCHEMA = "doc_id long, start long, ids binary"

# -- numbers to bytes and back

_CODES = np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3
#: Data bytes of the four values of a control byte.
_SIZES = (_CODES + 1).sum(axis=1)
#: For each control byte, where the 16 bytes of its four values lie in its data; 16 stands for a zero byte.
_PLACES = np.full((256, 4, 4), 16, np.int64)
for _control in range(256):
    _first = np.cumsum(_CODES[_control] + 1) - _CODES[_control] - 1
    for _value in range(4):
        _PLACES[_control, _value, : _CODES[_control, _value] + 1] = _first[_value] + np.arange(_CODES[_control, _value] + 1)
_PLACES = _PLACES.reshape(256, 16)


def encode_numbers(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes, one for four numbers of 32 bits, and data bytes. The last group is filled up with zeros."""
    numbers = np.concatenate((numbers, np.zeros(-len(numbers) % 4, np.uint32))).astype("<u4")
    codes = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    control = (codes.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    return control, numbers.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]


def decode_numbers(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The first n numbers, by table lookup of the control bytes."""
    sizes = _SIZES[control]
    first = np.cumsum(sizes) - sizes
    places = _PLACES[control]
    at = np.where(places < 16, places + first[:, None], len(data))
    return np.append(data, np.uint8(0))[at].view("<u4").ravel()[:n]


# -- texts to ids

_OF_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_IN_PIECE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ASCII = np.arange(256)
_SOLID = (_ASCII > 0x20) & (_ASCII < 0x7F)
#: First bytes of characters of two bytes, white space not among them.
_PAIR = (_ASCII >= 0xC3) & (_ASCII <= 0xDF)
_LETTER = np.isin(_ASCII, np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
_STOP = np.isin(_ASCII, np.frombuffer(b".,;:!?", np.uint8))


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: no pre-token of the byte-level pattern crosses such a place, and none depends on what lies beyond it."""
    n = len(data)
    solid, pair = _SOLID[data], _PAIR[data]
    before, behind = np.zeros((2, n + 1), bool)
    before[1:] = solid  # the character that ends here is no white space
    before[2:] |= pair[:-1]
    behind[:n] = solid | pair  # the character that begins here is none
    starts = np.zeros(n + 1, bool)
    space, line = np.flatnonzero(data == 0x20), np.flatnonzero(data == 0x0A)
    starts[space[before[space] & behind[space + 1]]] = True
    line = line[before[line] & behind[line + 1]]
    starts[line] = starts[line + 1] = True
    starts[1:n] |= _LETTER[data[:-1]] & _STOP[data[1:]]
    starts[offsets] = True
    return np.flatnonzero(starts[:n])


class Encoder:
    """Ids of texts by a tokenizer file.

    Pieces met before are found by a table with one place per low bits of the hash; the others of a slice are encoded, each
    distinct one once, and take their places.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.powers = powers(_IN_PIECE, SLICE_BYTES + 1)
        self.inverse = powers(_BACK, SLICE_BYTES + 1)
        self.forget()

    def forget(self) -> None:
        """Start anew; numbers of pieces given out before no longer hold."""
        self.places = np.zeros(PLACES, np.uint64)
        self.number = np.zeros(PLACES, np.int32)
        # Ids of piece i: ids[ends[i]:ends[i + 1]]. The buffers grow by doubling.
        self.ids, self.ends, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    def full(self) -> bool:
        return self.n > KNOWN_PIECES or self.ends[self.n] > KNOWN_IDS

    def _learn(self, pieces: list[str]) -> None:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        new = np.fromiter(chain.from_iterable(found), np.uint32)
        ends = self.ends[self.n] + np.cumsum([len(x) for x in found])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while len(self.ends) <= self.n + len(found):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        self.ids[self.ends[self.n] : ends[-1]] = new
        self.ends[self.n + 1 : self.n + 1 + len(found)] = ends
        self.n += len(found)

    def _hashes(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of the bytes of every piece, by one running sum over the slice."""
        n = len(data)
        if n > len(self.powers) - 1:
            self.powers, self.inverse = powers(_IN_PIECE, n + 1), powers(_BACK, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_OF_BYTE[data] * self.powers[:n], out=total[1:])
        ends = np.append(starts[1:], n)
        return mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts one after another, and how many each text has."""
        data, offsets = utf8(column)
        starts = piece_starts(data, offsets)
        per_text = np.diff(np.searchsorted(starts, offsets))
        if not len(starts):
            return np.zeros(0, np.int32), per_text
        hashes = self._hashes(data, starts)
        place = (hashes & np.uint64(PLACES - 1)).astype(np.int64)
        number = self.number[place]
        unknown = np.flatnonzero(self.places[place] != hashes)
        if len(unknown):
            new, example, same = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            at = unknown[example]
            first, ends = self.n, np.append(starts[1:], len(data))
            self._learn([data[a:b].tobytes().decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            number[unknown] = first + same
            self.places[place[at]], self.number[place[at]] = new, first + np.arange(len(new))
        return number, per_text

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if self.full():
            self.forget()
        number, per_text = self.pieces(column)
        first = self.ends[number]
        size = self.ends[number + 1] - first
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate(([0], np.cumsum(per_text)))])

    def id_counts(self, times: np.ndarray) -> np.ndarray:
        """How often each id occurs, if piece i occurs ``times[i]`` times."""
        size = np.diff(self.ends[: len(times) + 1])
        return np.bincount(self.ids[: self.ends[len(times)]], np.repeat(times, size)).astype(np.int64)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1


# -- counting

def _count(path: str, end: int):
    def run(batches):
        total, times = np.zeros(end + 1, np.int64), np.zeros(0, np.int64)
        coder = encoder(path)

        def add(more: np.ndarray) -> None:
            nonlocal total
            total = np.pad(total, (0, max(0, len(more) - len(total))))
            total[: len(more)] += more

        for part in slices(batches, 0):
            if coder.full():
                add(coder.id_counts(times))
                coder.forget()
                times = np.zeros(0, np.int64)
            number, _ = coder.pieces(part.column(0))
            times = np.pad(times, (0, coder.n - len(times)))
            times += np.bincount(number, minlength=coder.n)
            total[end] += part.num_rows
        add(coder.id_counts(times))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return run


def id_counts(docs: DataFrame, path: str = TOKENIZER, end: int = END_ID, text: str = "text") -> DataFrame:
    """(id, n) of the whole corpus, the end id of every document included."""
    found = docs.select(F.col(text).cast("string")).mapInArrow(_count(path, end), "id long, n long")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


# -- the data source

def _folder(path: str) -> tuple[fs.FileSystem, str]:
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner.rstrip("/")


def _read(path: str, name: str) -> bytes:
    system, folder = _folder(path)
    with system.open_input_stream(f"{folder}/{name}") as source:
        return source.read()


def _write(path: str, name: str, data: bytes) -> None:
    system, folder = _folder(path)
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/{name}") as target:
        target.write(data)


@dataclass
class Written(WriterCommitMessage):
    """The files of a task: name, documents, ids."""

    partition: int
    files: list[tuple[str, int, int]]


class _Block:
    """Documents of one block, until it is full."""

    def __init__(self):
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.ids: list[np.ndarray] = []
        self.n = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.ids.append(ids)
        self.n += len(ids)

    def to_bytes(self, rank_of_id: np.ndarray) -> bytes:
        control, data = encode_numbers(rank_of_id[np.concatenate(self.ids)])
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], "<i8")
        return b"".join(x.tobytes() for x in (np.array([len(ids), self.n, len(data)], "<u8"), ids, known, np.array(self.counts, "<u8"), control, data))


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, tokenizer: str, end: int):
        self.path, self.tokenizer, self.end = path, tokenizer, end

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _folder(self.path)
        ranked = np.frombuffer(_read(self.path, _RANKS), "<u4")
        rank_of_id = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
        rank_of_id[ranked] = np.arange(len(ranked), dtype=np.uint32)
        partition = TaskContext.get().partitionId()
        files: list[tuple[str, int, int]] = []
        block, target, name, n_docs, n_ids = _Block(), None, "", 0, 0

        def flush() -> None:
            nonlocal block, target, name, n_docs, n_ids
            if block.doc_ids:
                if target is None:
                    name, n_docs, n_ids = f"ids-{partition:06d}-{len(files):04d}-{uuid.uuid4().hex[:8]}.bin", 0, 0
                    target = system.open_output_stream(f"{folder}/{name}")
                target.write(block.to_bytes(rank_of_id))
                n_docs, n_ids, block = n_docs + len(block.doc_ids), n_ids + block.n, _Block()

        def close() -> None:
            nonlocal target
            flush()
            if target is not None:
                target.close()
                files.append((name, n_docs, n_ids))
                target = None

        for part in slices(iterator, 1):
            ids, counts = _with_end(*encoder(self.tokenizer)(part.column(1)), self.end)
            ends = np.cumsum(counts)
            for doc_id, a, b in zip(part.column(0).to_pylist(), (ends - counts).tolist(), ends.tolist()):
                if block.n and block.n + b - a > BLOCK_IDS:
                    flush()
                if n_ids > FILE_IDS:
                    close()
                block.add(doc_id, ids[a:b])
        close()
        return Written(partition, files)

    def commit(self, messages: list[Written | None]) -> None:
        files, start = [], 0
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            for name, n_docs, n_ids in message.files:
                files.append([name, n_docs, n_ids, start])
                start += n_ids
        _write(self.path, _MANIFEST, json.dumps({"end": self.end, "files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = _folder(self.path)
        for message in messages:
            for name, _, _ in message.files if message is not None else []:
                system.delete_file(f"{folder}/{name}")


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        files = json.loads(_read(self.path, _MANIFEST))["files"]
        return [InputPartition((name, start)) for name, _, _, start in files] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        name, start = partition.value
        system, folder = _folder(self.path)
        id_of_rank = np.frombuffer(_read(self.path, _RANKS), "<u4")
        with system.open_input_stream(f"{folder}/{name}") as source:
            while head := source.read(24):
                n_docs, n_ids, n_data = np.frombuffer(head, "<u8").tolist()
                take = lambda kind, n: np.frombuffer(source.read(n * np.dtype(kind).itemsize), kind)  # noqa: E731, B023
                doc_ids, known, counts = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs).astype(np.int64)
                ids = id_of_rank[decode_numbers(take("u1", -(-n_ids // 4)), take("u1", n_data), n_ids)]
                ends = np.cumsum(counts)
                offsets = pa.py_buffer((4 * np.concatenate(([0], ends))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64(), mask=known == 0), pa.array(start + ends - counts, pa.int64()),
                    pa.Array.from_buffers(pa.binary(), n_docs, [None, offsets, pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]),
                ], ["doc_id", "start", "ids"])
                start += n_ids


class TokenFiles(DataSource):
    """Format ``token_files``. Options: path; for writing also tokenizer and end."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options["tokenizer"], int(self.options["end"]))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents to a new folder (a path or URI that driver and executors reach)."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # As many rows as the vocabulary has ids.
    ranked = id_counts(rows, tokenizer, end).orderBy(F.desc("n"), "id").select("id").toArrow().column(0).to_numpy()
    _write(folder, _RANKS, ranked.astype("<u4").tobytes())
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    dealt.write.format("token_files").option("tokenizer", tokenizer).option("end", str(end)).mode("append").save(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it) and ids (little-endian, 32 bits each)."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(folder)


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of every document read back."""
    return tokens.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
