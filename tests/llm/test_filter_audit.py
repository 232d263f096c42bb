"""The filter audit against filters applied one after the other."""

import random
import re
from collections import defaultdict
from itertools import permutations

from listenhouse.llm import filter_audit as fa
from tests.llm import brute
from tests.llm.conftest import table


def failing(rows):
    """rows: (doc_id, text, source); per row the letters it fails."""
    out = []
    for doc_id, text, _ in rows:
        t = text or ""
        w = brute.spaced(t)
        fails = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        fails += "D" * bool(re.search("[#$%&*|]", t))
        out.append(fails + "E" * any(d is not None and doc_id is not None and d < doc_id and (x or "") == t for d, x, _ in rows))
    return out


def plain(rows, labels):
    fails, out = failing(rows), []
    says = lambda i, c: any(d is not None and d == i and x[c] == 1 for d, *x in labels)
    for part in {s or "" for *_, s in rows}:
        mine = [(i, f) for (i, _, s), f in zip(rows, fails) if (s or "") == part]
        shapley, steps = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone, left = [x for x in left if name in x[1]], [x for x in left if name not in x[1]]
                shapley[name] += len(gone)
                redundant = sum(name in f for _, f in mine) - len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), redundant, sum(f == name for _, f in mine), sum(says(i, 0) for i, _ in gone), sum(says(i, 1) for i, _ in gone), name))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def labels_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'x' text", "'y' source", "1 mask")


def test_against_filters_in_turn(spark):
    r = random.Random(7)
    text = lambda: " ".join(r.choice(["a", "B", "c#", "d", "été", "F&"] if r.random() < 0.3 else [f"w{i}" for i in range(400)]) for _ in range(r.choice([0, 5, 150, 230])))
    rows = [(i, text(), r.choice(["s1", "s2", None, ""])) for i in range(50)]
    rows += [(100 + i, rows[i][1], "s1") for i in range(20)]  # copies
    rows += [(None, rows[0][1], "s2"), (None, rows[0][1], "s2"), (3, rows[3][1], "s2"), (-1, rows[5][1], "s3"), (200, None, "s3"), (201, None, None), (202, "", "s3"), (203, "\x0b \t", "s3")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = table(spark, [(i, t, "en", s) for i, t, s in rows])
    found = fa.filter_audit(docs, labels_table(spark, labels))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.collect())) == plain(rows, labels)


def test_empty_tables_and_long_texts(spark):
    docs = table(spark, [(1, "#" + "A " * 100_000, "en", "s"), (2, "x" * 2_000_000, "en", "s")])
    labels = labels_table(spark, [(1, 1, 1)])
    assert fa.filter_audit(docs.where("false"), labels).count() == 0
    rows = [(1, "#" + "A " * 100_000, "s"), (2, "x" * 2_000_000, "s")]
    assert sorted(map(tuple, fa.filter_audit(docs, labels.where("false")).collect())) == plain(rows, [])


def test_a_text_in_many_parts(spark):
    """More parts than are contracted at once; all but one of the copies fail."""
    rows = [(i, "same", f"p{i}") for i in range(150)]
    found = fa.filter_audit(table(spark, [(i, t, "en", s) for i, t, s in rows]), labels_table(spark, [(0, 1, 0)])).collect()
    assert sorted(map(tuple, found)) == plain(rows, [(0, 1, 0)])
