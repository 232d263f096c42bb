"""Queries without SQL twins, against plain Python over whole tables."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from listenhouse.llm import fingerprints, html_text, token_counts
from listenhouse.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SF_DIR


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def test_token_counts(spark, texts):
    pieces = token_counts.pieces_of(token_counts.VOCABULARY)
    found = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in rows(spark, "op3_token_counts")}
    assert found == {i: brute.tokens(t, pieces, token_counts.cost) for i, t in texts}


def test_shards(spark, texts):
    found = rows(spark, "op5_shards")
    whole = dict(texts)
    assert Counter(r.doc_id for r in found) == Counter(whole.keys())
    assert all(r.size == len((whole[r.doc_id] or "").encode()) + 1 and r.text_crc32 == brute.crc(whole[r.doc_id]) for r in found)
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    bytes_of, slots = Counter(), {}
    for r in found:
        bytes_of[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(bytes_of) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # No shard is farther from the mean than the largest document of each level of splits.
    largest = max(r.size for r in found)
    assert max(bytes_of.values()) - min(bytes_of.values()) <= 2 * 3 * largest


def test_html(spark):
    """An independent reading of the pages: the blocks of their article."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = rows(spark, "op7_html_text")
    assert len(found) == len(pages)
    for r in found:
        body = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", body))
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_language(spark, documents):
    """Accuracy on the held-out fold, of documents long enough to tell."""
    known = {r.doc_id: (r.lang, len(r.text)) for r in documents.collect()}
    found = rows(spark, "op9_language")
    assert all(r.held_out == (brute.crc(str(r.doc_id)) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang_pred == known[r.doc_id][0] for r in held) >= 0.98 * len(held)
    assert not any(r.rejected for r in found)


@pytest.fixture(scope="module")
def prints(spark):
    return rows(spark, "op10_fingerprints")


def test_fingerprints(prints, texts):
    whole, changed = dict(texts), brute.edited(texts)
    follower = {i: texts[(k + 1) % len(texts)][1] for k, (i, _) in enumerate(texts)}
    assert sorted(r.doc_id for r in prints) == sorted(whole)
    for r in prints:
        assert r.n_chars == len(whole[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(changed[r.doc_id].encode()).hexdigest()
        own = fingerprints.values([whole[r.doc_id], changed[r.doc_id], follower[r.doc_id]])
        assert (r.fingerprint, r.edited_fingerprint) == tuple(v.tobytes().hex() for v in own[:2])
        assert (r.near_edited, r.near_next) == ((own[0] == own[1]).mean(), (own[0] == own[2]).mean())
        assert abs(r.near_edited - brute.jaccard(whole[r.doc_id], changed[r.doc_id])) < 0.3
    errors = [r.near_edited - brute.jaccard(whole[r.doc_id], changed[r.doc_id]) for r in prints]
    assert abs(np.mean(errors)) < 0.02


def test_near_ids(prints, texts):
    """Verified pairs are near; pairs that are nearly equal are found."""
    whole = dict(texts)
    for r in prints:
        if r.near_id is not None:
            assert brute.jaccard(whole[r.doc_id], whole[r.near_id]) >= 0.75
    first = {}
    for i, t in texts:
        if brute.shingles(t):
            first.setdefault(frozenset(brute.shingles(t)), i)
    near = {r.doc_id: r.near_id for r in prints}
    assert all(near[i] is not None for i, t in texts if brute.shingles(t) and first[frozenset(brute.shingles(t))] != i)


def test_html_without_marks():
    page = """<body><div class=sidebar>some words that stand aside and are long enough</div><div id=c><h1>Head</h1><p>A long paragraph of text with
    many words,&nbsp;and &lt;more&gt;.<p>Short.<p>Another long paragraph of text follows, it goes on for a while.<form>Mail</form></div>
    <div class="comments"><p>I like this very much indeed, thank you for it</div><footer>the end</footer>"""
    assert html_text.main_text(page) == "Head\n\nA long paragraph of text with many words, and <more>.\n\nShort.\n\nAnother long paragraph of text follows, it goes on for a while."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>", ""), ("<article></article><p>x", "x"), ("<article><p>a<nav>b</nav><p>c</article><p>d", "a\n\nc"),
    ("<p>x <script>bad</script>y<textarea>q</textarea> z &eacute;</p>", "x y z é"), ("<![bad<p>u", "u"), ("<p>a<![CDATA[b]]>c</b></p>", "ac"),
])
def test_html_edges(page, text):
    assert html_text.main_text(page) == text
