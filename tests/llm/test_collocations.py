"""Collocations against plain counting, and edge cases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from listenhouse.llm import collocations as co
from tests.llm import brute
from tests.llm.conftest import table


def plain(rows, least, longest=5, first=2000):
    """rows: (text, lang)"""
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    f = {k: v for k, v in f.items() if v >= least}
    inner = defaultdict(int)
    for (lang, w), v in f.items():
        for k in range(1, len(w)):
            for i in range(len(w) - k + 1):
                inner[lang, w[i : i + k]] = max(inner[lang, w[i : i + k]], v)
    out = defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) > 1 and inner[lang, w] < a:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, of in out.items() for i, (s, a, p, l, r) in enumerate(sorted(of)[:first]))


def documents(spark, rows):
    return table(spark, [(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])


@pytest.mark.parametrize("seed, bucket", [(1, co.BUCKET), (2, 50)])
def test_against_counting(spark, monkeypatch, seed, bucket):
    """Few words, so that phrases of all lengths repeat and overlap; with small buckets as well."""
    monkeypatch.setattr(co, "BUCKET", bucket)
    r = random.Random(seed)
    w = ["a", "b", "A", "été", "c-d", "日本", "x", "y'"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"]
    text = lambda: "".join(r.choice(w) + r.choices(ends, [40, 2, 2, 3, 3, 2, 1, 1])[0] for _ in range(r.randrange(60)))
    rows = [(text(), r.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [(rows[0][0], "en")] * 5 + [("new york city hall of a " * 30, "fr")]
    for least, first in ((3, 2000), (20, 7)):
        found = co.collocations(documents(spark, rows), least, first=first)
        assert sorted(map(tuple, found.collect())) == plain(rows, least, first=first)


def test_edges(spark):
    none = documents(spark, [("x", "en")]).where("false")
    assert co.collocations(none).count() == 0
    nothing = [(None, "en"), ("", None), (" \t. ,!", "en"), ("one", "de")]
    assert co.collocations(documents(spark, nothing), 1).count() == 0
    repeated = [("a a a a", None)] * 3
    assert sorted(map(tuple, co.collocations(documents(spark, repeated), 3).collect())) == plain(repeated, 3)
    found = co.collocations(documents(spark, repeated), 3)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(kind == "bigint" for c, kind in found.dtypes if c not in ("lang", "phrase"))


def test_very_long_text(spark):
    """A text beyond a slice, with a word of a megabyte."""
    r = random.Random(4)
    rows = [(" ".join(r.choice(["p", "q", "r", "s"]) for _ in range(30_000)) + " " + "z" * 1_000_000 + " p q.", "en"), ("p q r", "en")]
    assert sorted(map(tuple, co.collocations(documents(spark, rows), 100).collect())) == plain(rows, 100)


def test_products_beyond_64_bits(spark):
    row = spark.sql("SELECT 9000000000000 a, 90000000000000 n, 10000000000000 l, 30000000000000 r")
    import pyspark.sql.functions as F

    score = F.expr(co.SCORE)
    assert row.select(score).first()[0] == 1000 * 9_000_000_000_000 * 90_000_000_000_000 // (10_000_000_000_000 * 30_000_000_000_000)
