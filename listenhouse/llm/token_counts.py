"""Token counts by unigram dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a slice of texts go into a trie, level by level.
A node's forward score is the least cost of any segmentation of its prefix into
pieces of the vocabulary; it is computed once and shared by all pre-tokens
below. Each pre-token's token count is stored where it ends, and texts add up
the counts of theirs.

A pre-token is a run of anything but white space (\\x20, \\x09-\\x0D) with the one
space before it, if there is one. It counts once and is segmented as a whole, whatever its length; those of
more than ``LONGEST`` bytes go outside the trie, by the same recurrence with a rolling window of scores. Every white space
character that no pre-token takes is one
token. A piece of rank r costs round(1000 ln(r + 2)), a single byte as much as
a piece behind the last one; of equal costs the segmentation with fewer tokens
counts.

The vocabulary is a public file of byte pieces and ranks; its path is a
parameter and its size is fixed, whatever the corpus. Nothing is shuffled.

Defined results: null or empty text has no tokens; repeated rows and ties are
each counted; other columns play no part.
"""

from __future__ import annotations

import base64
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenhouse.llm.words import powers, slices, utf8, words

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LONGEST = 64
SLICE = 8 << 20
_ROLL = np.uint64(0xA24BAED4963EE407)
#: Places of a long pre-token handled at once.
_BLOCK = 1 << 16
_TOKEN = 4096  # a cost is milli-nats * _TOKEN + tokens


@dataclass
class Vocabulary:
    """Costs of pieces by length: sorted hashes and, alongside, costs."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray]]


def pieces_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def cost(piece: bytes, rank: int, size: int) -> int:
    return round(1000 * math.log((size if len(piece) == 1 else rank) + 2))


def vocabulary(pieces: dict[bytes, int]) -> Vocabulary:
    size = max(pieces.values(), default=0) + 1
    for byte in range(256):
        pieces = pieces if bytes([byte]) in pieces else pieces | {bytes([byte]): size}
    lengths: dict[int, list[tuple[int, int]]] = {}
    for piece, rank in pieces.items():
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for byte in piece:
                value = value * _ROLL + np.uint64(byte + 1)
        lengths.setdefault(len(piece), []).append((int(value), cost(piece, rank, size)))
    return Vocabulary({
        n: (np.array([v for v, _ in sorted(of)], np.uint64), np.array([c for _, c in sorted(of)], np.int64)) for n, of in lengths.items()
    })


def terminal_counts(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, known: Vocabulary) -> np.ndarray:
    """Tokens of each pre-token ``data[start:start + length]``, by one trie of all of them."""
    result = np.zeros(len(starts), np.int64)
    base = powers(_ROLL, int(lengths.max(initial=0)) + 1)
    # The root is the only node of level 0.
    parents, best, rolled = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.uint64)]
    alive, node = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    depth = 0
    while len(alive):
        byte = data[starts[alive] + depth].astype(np.int64)
        keys, node = np.unique(node * 256 + byte, return_inverse=True)
        depth += 1
        parent = keys >> 8
        roll = rolled[-1][parent] * _ROLL + (keys & 255).astype(np.uint64) + np.uint64(1)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        above = parent
        for n in range(1, depth + 1):
            if n in known.by_length:
                hashes, costs = known.by_length[n]
                value = roll - rolled[depth - n][above] * base[n]
                at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
                found = hashes[at] == value
                total = best[depth - n][above[found]] + costs[at[found]] * _TOKEN + 1
                least[found] = np.minimum(least[found], total)
            if n < depth:
                above = parents[depth - n][above]
        parents.append(parent)
        best.append(least)
        rolled.append(roll)
        ends = lengths[alive] == depth
        result[alive[ends]] = least[node[ends]] % _TOKEN
        alive, node = alive[~ends], node[~ends]
    return result


def long_count(data: np.ndarray, known: Vocabulary) -> int:
    """Tokens of one pre-token of any length: the same recurrence, block by block."""
    longest = max(known.by_length)
    base = powers(_ROLL, longest + 1)
    best = [0]  # costs and tokens at the last places, up to the block's first
    for first in range(0, len(data), _BLOCK):
        stop = min(first + _BLOCK, len(data))
        begin = max(0, first - longest)
        rolled = [0]
        for byte in data[begin:stop].tolist():
            rolled.append((rolled[-1] * int(_ROLL) + byte + 1) & 0xFFFFFFFFFFFFFFFF)
        roll = np.array(rolled, np.uint64)
        ends, sizes, prices = [], [], []
        for n, (hashes, costs) in known.by_length.items():
            end = np.arange(max(first + 1, begin + n), stop + 1)  # places behind a piece
            value = roll[end - begin] - roll[end - begin - n] * base[n]
            at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            found = hashes[at] == value
            ends.append(end[found])
            sizes.append(np.full(len(ends[-1]), n))
            prices.append(costs[at[found]])
        ends, sizes, prices = (np.concatenate(x) for x in (ends, sizes, prices))
        order = np.argsort(ends, kind="stable")
        place, least = first, None
        for end, n, price in zip(ends[order].tolist(), sizes[order].tolist(), prices[order].tolist()):
            if end != place + 1:  # every place is the end of a single byte
                best.append(least)
                place, least = place + 1, None
            total = best[len(best) - 1 - (place - (end - n))] + (price << 40) + 1
            least = total if least is None or total < least else least
        best.append(least)
        best = best[-longest - 1 :]
    return best[-1] & ((1 << 40) - 1)


def counts(column: pa.Array, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens and tokens of every text."""
    w = words(column)
    n = len(column)
    text = np.repeat(np.arange(n), w.counts)
    size = w.ends - w.starts
    # A space before a word, in the same text, belongs to it.
    _, offsets = utf8(column)
    spaced = w.starts > offsets[text]
    spaced[spaced] = w.data[w.starts[spaced] - 1] == 32
    hashes = np.where(spaced, ~w.hashes, w.hashes)
    _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
    starts, lengths = w.starts[first] - spaced[first], size[first] + spaced[first]
    tokens, long = np.zeros(len(first), np.int64), size[first] > LONGEST
    tokens[~long] = terminal_counts(w.data, starts[~long], lengths[~long], known)
    for i in np.flatnonzero(long):
        tokens[i] = long_count(w.data[starts[i] : starts[i] + lengths[i]], known)
    total, covered, pre = np.zeros((3, n), np.int64)
    for into, values in ((total, tokens[same]), (covered, size + spaced), (pre, 1)):
        np.add.at(into, text, values)
    return pre, total + np.diff(offsets) - covered


def _count(known: Vocabulary):
    def run(batches):
        for part in slices(batches, 1, SLICE):
            pre, tokens = counts(part.column(1), known)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    return run


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Per row: doc_id, n_pretokens, n_tokens."""
    known = vocabulary(pieces_of(path))
    source = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return source.mapInArrow(_count(known), "doc_id long, n_pretokens long, n_tokens long")
