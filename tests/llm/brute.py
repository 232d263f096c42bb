"""The plainest forms of what the operators compute, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = spaced(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """doc_id -> smallest doc_id reachable over links of Jaccard 0.75."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i, _ in rows}


def contamination(text, items):
    """n_words, n_hit, item ids."""
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, hit, found = find(text), set(), []
    for item, body in items:
        b = find(body)
        size, here = min(13, len(b)), False
        wanted = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                here = True
        found += [str(item)] * here
    return len(w), len(hit), sorted(found)


def spans(text):
    """Base spans (start, kind, stop)."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ia:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "") if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def repeats(rows):
    """doc_id -> (n_words, n_removed, sha256 of the rest); rows sorted by doc_id."""
    seen, out = set(), {}
    for i, text in rows:
        w, gone = spaced(text), set()
        for at in range(len(w) - 19):
            key = tuple(w[at : at + 20])
            if key in seen:
                gone.update(range(at, at + 20))
            seen.add(key)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def tokens(text, pieces, cost):
    """Pre-tokens and tokens by one Viterbi search per pre-token."""
    size = max(pieces.values()) + 1
    data, count, covered, pre = (text or "").encode(), 0, 0, 0
    longest = max(map(len, pieces))
    for m in re.finditer(rb" ?[^\x20\x09-\x0D]+", data):
        token = m[0]
        best = [(0, 0)] + [(float("inf"), 0)] * len(token)
        for end in range(1, len(token) + 1):
            for start in range(max(0, end - longest), end):
                piece = token[start:end]
                if len(piece) == 1 or piece in pieces:
                    c = cost(piece, pieces.get(piece, size), size)
                    best[end] = min(best[end], (best[start][0] + c, best[start][1] + 1))
        pre, count, covered = pre + 1, count + best[-1][1], covered + len(token)
    return pre, count + len(data) - covered


def edited(rows):
    """doc_id -> edited text; rows sorted."""
    out = {}
    for k, (i, t) in enumerate(rows):
        t, follower = t or "", rows[(k + 1) % len(rows)][1] or ""
        out[i] = t[: len(t) - len(t) // 2] + follower[: len(t) // 2]
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


__all__ = ["Counter", "components", "contamination", "crc", "edited", "jaccard", "lower", "repeats", "shingles", "spaced", "spans", "tokens"]
