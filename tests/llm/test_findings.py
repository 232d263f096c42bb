"""Small cases of what reviews found missing."""

import random

import pyarrow as pa
import pytest

from listenhouse.llm import decontaminate, fingerprints, html_text, language, token_counts
from tests.llm import brute
from tests.llm.conftest import SF_DIR, table
from tests.llm.test_edges import BASE, changed, prose

_LONG = [f"This is paragraph number {i} of the story, with quite a few words, so that it is content by any measure." for i in range(4)]
_BODY = "".join(f"<p>{p}</p>" for p in _LONG)
_TEXT = "\n\n".join(_LONG)


@pytest.mark.parametrize("name", ["content no-sidebar", "has-sidebar", "withComments", "social", "page-header-fixed", "share-story"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_html_hint_on_a_wrapper(name, inner):
    page = f"<body><nav>Home</nav><div class='{name}'><{inner}>{_BODY}</{inner}></div><div class=sidebar><p>Words that stand aside.</p></div></body>"
    assert html_text.main_text(page) == _TEXT


def test_html_hint_of_small_elements():
    """Each paragraph in a widget: the word names most of the content, so it tells nothing. Comments and teasers still go."""
    widgets = "".join(f"<div class='builder-widget'><p>{p}</p></div>" for p in _LONG)
    assert html_text.main_text(f"<body><div>{widgets}</div><div class=comments><p>I like it.</p></div></body>") == _TEXT
    comments = "<div id=comments><article><p>A comment of some words, longer than nothing.</p></article></div>"
    assert html_text.main_text(f"<body><div class=social><article>{_BODY}</article>{comments}</div></body>") == _TEXT
    teaser = "<div class=sidebar><article><p>Another story, in a few words of its own.</p></article></div>"
    assert html_text.main_text(f"<body><div>{_BODY}</div>{teaser}</body>") == _TEXT
    assert html_text.main_text(f"<body><div><p>{_LONG[0]} <span class=share>Share it</span></p>{_BODY}</div></body>") == f"{_LONG[0]}\n\n{_TEXT}"


def test_html_all_of_the_content():
    """Neither a quarter of the content nor a second marked part is cut."""
    a, b, c, d = _LONG
    page = f"<div class=post><h1>Title</h1><p>lead</p><div class=text><p>{a}</p><p>{b}</p></div></div>"
    assert html_text.main_text(page) == f"Title\n\nlead\n\n{a}\n\n{b}"
    assert html_text.main_text(f"<nav>Home</nav><div><section>{_BODY * 2}</section><section><p>{a}</p></section></div>") == f"{_TEXT}\n\n{_TEXT}\n\n{a}"
    for first, second in (("article", "article"), ("div itemprop=articleBody", "div itemprop=articleBody")):
        parts = f"<{first}><p>{a}</p><p>{b}</p></{first.split()[0]}><p>x</p><{second}><p>{c}</p><p>{d}</p></{second.split()[0]}>"
        assert html_text.main_text(parts) == _TEXT
    assert html_text.main_text(f"<div><h1>Title</h1><p>By me</p><div itemprop=articleBody>{_BODY}</div></div>") == f"Title\n\n{_TEXT}"


def test_fingerprint_classes(spark):
    """Copies, near copies around the threshold whose least member is far from most, and documents with a passage in common."""
    r = random.Random(12)
    rows = [(i, changed(BASE, r.sample(range(300), 12))) for i in range(40)]
    rows += [(100 + i, prose(150, 1000 + i) + " " + " ".join(BASE.split()[:150])) for i in range(20)] + [(200, rows[7][1]), (201, None), (202, "")]
    half = prose(150, 5)
    rows += [(300, half + " " + prose(150, 6))] + [(301 + i, changed(half + " " + prose(120, 7), [i])) for i in range(4)]
    group = brute.components(rows)
    size = brute.Counter(group.values())
    texts = dict(rows)
    for x in fingerprints.fingerprint(table(spark, rows)).collect():
        alone = size[group[x.doc_id]] == 1
        assert (x.class_id, x.n_near) == ((None, 0) if alone else (group[x.doc_id], size[group[x.doc_id]] - 1))
        assert x.near_id is None or (x.near_id < x.doc_id and brute.jaccard(texts[x.doc_id], texts[x.near_id]) >= 0.75)


def test_language_rejects_noise(spark):
    """Foreign scripts and noise go, short clean documents stay."""
    r = random.Random(4)
    of = lambda letters, n: "".join(r.choices(letters, k=n))
    latin = "abcdefghijklmnopqrstuvwxyz"
    odd = [of(letters, n) for letters in ("абвгдежзиклмнопрстуфхцчшыьэюя ", "".join(map(chr, range(0x4E00, 0x9000))), latin, latin + latin.upper() + "0123456789+/") for n in (100, 400, 2000)]
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = documents.select("doc_id", "text", "lang")
    short = [(10**9 + 100 + i, x.text[:60], None) for i, x in enumerate(documents.where("length(text) > 200").orderBy("doc_id").limit(40).collect())]
    more = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(odd)] + short, "doc_id long, text string, lang string")
    found = {x.doc_id: x.rejected for x in language.identify(learned.union(more)).where(f"doc_id >= {10**9}").collect()}
    assert [i for i in range(len(odd)) if not found[10**9 + i]] == []
    assert [t for i, t, _ in short if found[i]] == []


@pytest.mark.parametrize("size", [8 << 20, 200])
def test_decontaminate_rows_of_one_id(spark, monkeypatch, size):
    """Rows without id, and rows that repeat an id, are judged by their own texts, with one block and with several."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
    items = [(i, " ".join(BASE.split()[20 * i : 20 * i + 20])) for i in range(6)]
    rows = [(None, BASE), (None, prose(300, 41)), (None, None), (1, BASE), (1, BASE), (1, prose(90, 42)), (2, changed(BASE, range(30, 300))), (3, "")]
    found = decontaminate.contamination(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=key) == sorted(((i, *brute.contamination(t, items)) for i, t in rows), key=key)
    kept = decontaminate.drop_contaminated(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    clean = [(i, t) for i, t in rows for n, hit, _ in [brute.contamination(t, items)] if not (hit and 20 * hit >= n)]
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted((i or 0, t or "") for i, t in clean)


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_tokens_of_long_runs(monkeypatch, block):
    """One Viterbi search over the whole run; no piece ends at a place because of its number."""
    monkeypatch.setattr(token_counts, "_BLOCK", block)
    pieces = token_counts.pieces_of(token_counts.VOCABULARY)
    known = token_counts.vocabulary(dict(pieces))
    size = max(pieces.values()) + 1
    r = random.Random(6)
    runs = ["internationalization" * 12, "日本語の文章には空白がない" * 9, " " + "function(a){return(a+1)}" * 20, "=" * 130, "-" * 1000, "".join(r.choices("abcdefgh/+XYZ019", k=700))]
    runs += [max(pieces, key=len).decode().strip() or "x" * 90]
    for text, n in zip(runs, token_counts.counts(pa.array(runs, pa.string()), known)[1].tolist()):
        data = text.encode()
        best = [(0, 0)]
        for end in range(1, len(data) + 1):
            of = ((data[a:end], best[a]) for a in range(max(0, end - 128), end))
            best.append(min((b[0] + token_counts.cost(p, pieces.get(p, size), size), b[1] + 1) for p, b in of if len(p) == 1 or p in pieces))
        assert n == best[-1][1], text


def test_language_of_few_readable_rows(spark):
    """The sample is bounded by the readable rows; a language of mostly letterless rows is learned."""
    few = [(i, prose(20, i), "aa") for i in range(5)] + [(10 + i, prose(20, 50 + i), "bb") for i in range(5)]
    blank = spark.range(100, 20_000).selectExpr("id as doc_id", "'12 --' as text", "'aa' as lang")
    model = language.fit(spark.createDataFrame(few, "doc_id long, text string, lang string").union(blank), sample=5)
    assert set(model.langs) == {"aa", "bb"}


def test_html_needs_its_clusters(spark, monkeypatch):
    """With every line taken for content, pages keep what the method leaves out; without the article's mark it still finds it."""
    import re

    import numpy as np

    pages = [r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    found = [html_text.main_text(p) for p in pages]
    unmarked = [html_text.main_text(re.sub(r"(</?)article", r"\1div", p)) for p in pages]
    assert sum(u == f for u, f in zip(unmarked, found)) >= 0.95 * len(pages)  # but for articles shorter than a menu
    monkeypatch.setattr(html_text, "clustered", lambda lines, *_: np.ones(len(lines), bool))
    assert all(html_text.main_text(p) != f for p, f in zip(pages, found))


def test_html_with_many_open_tags():
    import time

    began = time.time()
    assert html_text.main_text("<p>" + "<span>x" * 32_000 + "</q>" * 32_000) == "x" * 32_000
    assert html_text.main_text("<div>" * 3_000 + "y" + "</li>" * 30_000) == "y"
    assert time.time() - began < 5


def test_html_hints_and_marks_only_weigh():
    """A hinted block with the ratio of an article stays; a short one goes; a mark does not keep a page from its text."""
    long = "A long paragraph of text with many words that goes on and on for a while, and then some more of it."
    assert html_text.main_text(f"<div><h1>Head</h1><p>{long}</p><div class=share>Share this</div><p>{long}</p></div><div class=sidebar>Other things</div>") == f"Head\n\n{long}\n\n{long}"
    assert html_text.main_text(f"<div class=widget><p>{long}</p><p>{long}</p></div>") == f"{long}\n\n{long}"
