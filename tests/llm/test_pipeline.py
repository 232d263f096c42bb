"""The pipeline, stage by stage against plain Python."""

import hashlib
from collections import Counter

import corpus_pipeline
from listenhouse.llm import mixing
from tests.llm import brute
from tests.llm.conftest import SF_DIR


def test_stages(spark, documents):
    docs, columns = documents, documents.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = step(spark, docs, SF_DIR).cache()
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(after) and set(after) <= set(before)
        assert all(after[i][c] == before[i][c] for i in after for c in columns)
        if name == "language_id":
            assert set(after) == set(before)  # every document here has a language
        elif name == "near_dedup":
            groups = brute.components(sorted((i, r.text) for i, r in before.items()))
            assert set(after) == set(groups.values())
        elif name == "decontamination":
            dirty = {i for i, r in before.items() for n, hit, _ in [brute.contamination(r.text, items)] if hit and 20 * hit >= n}
            assert dirty and set(after) == set(before) - dirty
        elif name == "mixing":
            assert set(after) == mixed(before)
        else:
            assert docs.columns == [*columns, "shard", "slot"] and set(after) == set(before)
            size = Counter()
            for r in after.values():
                size[r.shard] += len(r.text.encode()) + 1
            assert len(size) == 8 and max(size.values()) - min(size.values()) <= 6 * max(len(r.text.encode()) for r in after.values())


def mixed(rows):
    """Nine tenths of the tokens by water-filling, with fractions, then prefixes in seeded order."""
    def domain(source):
        return f"d{ord(hashlib.md5(source.encode()).hexdigest()[0]) % 3}"

    leaves, total = {}, 0
    for r in rows.values():
        n = len(brute.spaced(r.text))
        total += n
        leaves.setdefault(domain(r.source), {}).setdefault(r.lang, {}).setdefault(r.source, []).append((hashlib.md5(f"7:0:{r.doc_id}".encode()).hexdigest(), n, r.doc_id))

    def capacity(node):
        return sum(map(capacity, node.values())) if isinstance(node, dict) else sum(n for _, n, _ in node)

    def share(children, budget):
        """Integer water-filling in name order."""
        out, left = {}, dict(children)
        while True:
            rest, weight = budget - sum(out.values()), len(left)
            full = [k for k, node in left.items() if capacity(node) * weight <= rest]
            if not full:
                break
            for k in full:
                out[k] = capacity(left.pop(k))
        for i, k in enumerate(sorted(left)):
            out[k] = rest * (i + 1) // weight - rest * i // weight
        return out

    chosen = set()
    for d, b in share(leaves, total * 9 // 10).items():
        for l, c in share(leaves[d], b).items():
            for s, budget in share(leaves[d][l], c).items():
                own, upto = sorted(leaves[d][l][s]), 0
                if budget == sum(n for _, n, _ in own):
                    chosen |= {i for _, n, i in own if n}
                    continue
                for _, n, i in own:
                    upto += n
                    if n and upto <= budget:
                        chosen.add(i)
    return chosen


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns[-2:] == ["shard", "slot"] and found.count() > 0


def test_mixing_epochs_without_documents(spark, documents):
    assert mixing.keep_mixed(documents, (0, 1)).count() == 0
