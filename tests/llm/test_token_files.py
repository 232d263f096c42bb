"""Token files: coding, pieces and whole tables against the tokenizer itself."""

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from listenhouse.llm import token_files as tf
from listenhouse.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR, table


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(tf.TOKENIZER)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, tf.END_ID]


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc32) in the order of the rows."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = ids_of(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24])))
def test_numbers_round_trip(numbers):
    values = np.array(numbers, np.uint32)
    control, data = tf.encode_numbers(values)
    assert len(control) == -(-len(values) // 4)
    assert (tf.decode_numbers(control, data, len(values)) == values).all()


PARTS = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "A b", "été", " é", "ß.", "x.", "...", "'s", "'", "n't", "12", "3.5", "-", " ", "　", " ", "\u0085",
         "日本", "😀", "\x00", "\x1c", "\x7f", "<|endoftext|>", "#!", "?", ";x", "ъ", " ́", "á"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text(max_size=3)), max_size=4))
def test_pieces_do_not_change_the_ids(texts):
    texts = ["".join(t) for t in texts]
    coder = tf.encoder(tf.TOKENIZER)
    ids, counts = coder(pa.array(texts, pa.string()))
    cut = np.split(ids, np.cumsum(counts)[:-1]) if len(texts) else []
    assert [c.tolist() for c in cut] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_few_places_and_little_memory(tokenizer, monkeypatch):
    """Pieces that fight for a place, and a worker that forgets."""
    monkeypatch.setattr(tf, "PLACES", 2)
    monkeypatch.setattr(tf, "KNOWN_PIECES", 20)
    r = random.Random(1)
    texts = [" ".join(r.choice(["ab", "cd", "été", "x.", "the", "of"]) + str(r.randrange(9)) for _ in range(40)) for _ in range(20)]
    coder = tf.Encoder(tf.TOKENIZER)
    for i in range(0, 20, 5):
        ids, counts = coder(pa.array(texts[i : i + 5]))
        assert ids.tolist() == [x for t in texts[i : i + 5] for x in ids_of(tokenizer, t)[:-1]]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 5])], ["text"]) for i in range(0, 20, 5)]
    monkeypatch.setattr(tf, "encoder", lambda path: coder)
    found = next(iter(tf._count("", tf.END_ID)(batches))).to_pydict()
    every = [x for t in texts for x in ids_of(tokenizer, t)]
    assert dict(zip(found["id"], found["n"])) == {i: every.count(i) for i in set(every)}


def test_whole_table(spark, tokenizer, texts):
    found = QUERIES["op11_token_files"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found)) == expected(tokenizer, texts)


def test_edges(spark, tokenizer, folder, monkeypatch):
    long = "word " * 50_000 + "x" * 300_000
    rows = [(5, "b"), (None, "second"), (2, None), (1, long), (3, ""), (None, None), (9, " \n "), (4, "<|endoftext|> été"), (5, "b"), (5, "a")]
    docs = table(spark, rows)
    tf.write_tokens(docs, f"{folder}/t")
    found = sorted((tuple(r) for r in tf.digest(tf.read_tokens(spark, f"{folder}/t")).collect()), key=lambda r: r[1])
    # Nulls first; rows of one doc_id in some order of their texts.
    assert [r[0] for r in found] == [None, None, 1, 2, 3, 4, 5, 5, 5, 9]
    crc = lambda text: zlib.crc32(np.array(ids_of(tokenizer, text), "<u4").tobytes())
    assert sorted((r[0] or 0, r[3]) for r in found) == sorted((i or 0, crc(t)) for i, t in rows)
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found)])[:-1].tolist()
    manifest = json.loads(tf._read(f"{folder}/t", "manifest.json"))
    assert sum(f[1] for f in manifest["files"]) == len(rows)
    ranks = np.frombuffer(tf._read(f"{folder}/t", "ids-by-rank.bin"), "<u4")
    every = [x for _, t in rows for x in ids_of(tokenizer, t)]
    assert ranks.tolist() == sorted(set(every), key=lambda i: (-every.count(i), i))


def test_empty_table_and_unfinished_write(spark, folder):
    none = table(spark, [(1, "x")]).where("false")
    tf.write_tokens(none, f"{folder}/none")
    assert tf.read_tokens(spark, f"{folder}/none").count() == 0
    # Without a manifest there is nothing to read, whatever files lie there.
    tf._write(f"{folder}/half", "ids-000000-0000-x.bin", b"rest of a task that died")
    with pytest.raises(Exception, match="manifest"):
        tf.read_tokens(spark, f"{folder}/half").count()
