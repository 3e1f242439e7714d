"""Plain versions of the operators, for small tables."""

import collections
import math
import re
import zlib


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def jaccard(rows):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = {}
    for i, text in rows:
        w = words(lower(text))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def pack_faults(pieces, ids, length=2048):
    """How many documents or sequences of a packing are not as the contract says."""
    faults = 0
    docs, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for doc_id, found in ids.items():
        at = 0
        for p in sorted(docs[doc_id], key=lambda p: p.start):
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in found[p.start : p.start + p.length]))
            faults += (p.start, p.ids_crc32, p.doc_tokens) != (at, crc, len(found))
            at += p.length
        faults += at != len(found)
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            faults += p.offset != at
            at += p.length
        faults += at > length
    return faults


def interpolated(rows, weights, bucket):
    """{doc_id: score} of the interpolated bigram model with the given weights; START is None."""
    train = [words(lower(t)) + [0] for i, t in rows if fold(i, 7) != 2]
    one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
    for w in train:
        one.update(w)
        two.update(zip([None, *w], w))
        context.update([None, *w[:-1]])
    total, types = sum(one.values()), len(one)
    out = {}
    for i, t in rows:
        w, z = words(lower(t)) + [0], 0.0
        for u, x in zip([None, *w], w):
            c = context[u]
            a = weights[bucket(c)]
            z += math.log10(a[0] * (two[u, x] / c if c else 0) + a[1] * one[x] / total + a[2] / (types + 1))
        out[i] = z
    return out
