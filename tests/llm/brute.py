"""Plain versions of the set-based operators."""

import re
from itertools import combinations

import numpy as np
import xxhash
from tallyspark.llm.common import _P, mix


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def similar(a, b, threshold=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= threshold * len(a | b)


def classes(sets: dict, threshold=80) -> dict:
    """id -> smallest id reachable over links, comparing all pairs that share a member."""
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for a, b in {p for ids in by.values() if len(ids) > 1 for p in combinations(sorted(ids), 2)}:
        if similar(sets[a], sets[b], threshold):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def paragraphs(text, reach=6):
    """(start, words) of the content-defined paragraphs of a text, word pair by word pair."""
    w = words(text)
    pair = [xxhash.xxh3_64_intdigest(a) * int(_P[0]) + xxhash.xxh3_64_intdigest(b) * int(_P[1]) for a, b in zip(w, w[1:])]
    pair = mix(np.array([x % 2**64 for x in pair], np.uint64)).tolist()
    cut = [i for i in range(reach, len(pair) - reach) if min(pair[i - reach : i]) > pair[i] <= min(pair[i + 1 : i + reach + 1])]
    begins = [0, *cut] if w else []
    return [(a, w[a:b]) for a, b in zip(begins, [*cut, len(w)])]


def repeats(rows, k=5, threshold=80, least=16):
    """(doc_id, start) -> (n_words, run_words, copies, first, kept) of the paragraphs in repeated passages; no two rows share an id here."""
    all_of = {(d, a): w for d, t in rows if d is not None for a, w in paragraphs(t)}
    found = classes({p: shingles(b" ".join(w).decode(), k) for p, w in all_of.items()}, threshold)
    members = {}
    for p, c in found.items():
        members.setdefault(c, []).append(p)
    again = {p: members[c] for p, c in found.items() if len(members[c]) > 1}
    out, run, end = {}, [], None
    for p in [*sorted(again), None]:
        if run and (p is None or p != end):
            total = sum(len(all_of[q]) for q in run)
            if total >= least:
                out |= {q: (len(all_of[q]), total, len(again[q]), min(again[q]), q == min(again[q])) for q in run}
            run = []
        if p:
            run.append(p)
            end = p[0], p[1] + len(all_of[p])
    return out


def without(text, gone):
    """The text without the words of these paragraphs and the white space after each."""
    at = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text.encode())] + [len(text.encode())]
    for start, n in sorted(gone, reverse=True):
        text = (text.encode()[: at[start]] + text.encode()[at[start + n] :]).decode()
    return text
