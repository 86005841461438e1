"""Plain single-process versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import xxhash


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bucket(doc_id, divisor):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def exact_groups(rows):
    """rows: (doc_id, text). Sorted (doc_id, keep_id, size, kept, sha)."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for text, docs in groups.items():
        known = [d for d in docs if d is not None]
        keep = max(known) if known else None
        out += [(d, keep, len(docs), d == keep, sha(text)) for d in docs]
    return out


BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def line_results(rows, min_docs):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    keys = [[ascii_lower(line.strip(BLANK)) for line in lines] for _, lines in split]
    found = defaultdict(set)
    for n, (row, own) in enumerate(zip(rows, keys, strict=True)):
        for k in own:
            found[k].add(n)
    gone = {k for k, docs in found.items() if k and len(docs) >= min_docs}
    out = []
    for (doc, lines), own in zip(split, keys, strict=True):
        kept = [line for line, k in zip(lines, own, strict=True) if k not in gone]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def simhash(text, words=4):
    tokens = ascii_lower(text or "").encode().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows, max_bits=4):
    prints = [simhash(t) for _, t in rows]
    distinct = sorted(set(prints))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= max_bits]
    root = components(distinct, links)
    first = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            first[root[p]] = min(doc, first.get(root[p], doc))
    return [(doc, f"{p:016x}", first.get(root[p])) for (doc, _), p in zip(rows, prints, strict=True)]


def vector_links(rows, least):
    """rows: (vec_id, vector, label), ids distinct and set. (vec_id, n_links, component, kept)."""

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        a = np.array(v, np.float32).astype(float)
        return a / np.sqrt(a @ a) if a @ a > 0 else None

    units = {i: (unit(v), label) for i, v, label in rows}
    links = [
        (i, j)
        for i, (u, a) in units.items()
        for j, (v, b) in units.items()
        if i != j and u is not None and v is not None and a is not None and a == b and u @ v >= least
    ]
    root = components(list(units), links)
    return [(i, sum(a == i for a, _ in links), root[i], root[i] == i) for i in units]
