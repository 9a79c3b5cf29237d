"""Plain versions of the operators' definitions, and awkward documents."""

from __future__ import annotations

import re
from collections import defaultdict

LONG = "ja " * 40_000 + "end"
AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", None, 0),
    (3, "   \n\t ", None, "b", 5),
    (4, LONG, "en", "b", len(LONG)),
    (5, "One two three.\nOne two three.\n", "fr", "c", 30),
    (5, "One two three.\nOne two three.\n", "fr", "c", 30),
    (6, "Ünïcödé wörds ünd mehr € x y \U0001f600", "de", "c", None),
    (None, "nobody owns this text but it has words enough to count", "en", "d", 50),
    (7, "nobody owns this text but it has words enough to count", "en", "d", 50),
    (-8, "a negative id\r\nwith carriage returns \x0b and \x0c feeds", "en", "d", 50),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(rows, chars=40, documents=5):
    """[(id, text)] -> [(id, lines, dropped, kept text)]"""
    holders = defaultdict(set)
    keys = [[lower(line.strip(" \t\n\x0b\x0c\r")) for line in (text or "").split("\n")] for _, text in rows]
    for (doc, _), own in zip(rows, keys, strict=True):
        for key in own:
            if len(key) >= chars and doc is not None:
                holders[key].add(doc)
    out = []
    for (doc, text), own in zip(rows, keys, strict=True):
        lines = (text or "").split("\n")
        gone = [doc is not None and len(holders[k]) >= documents and doc != max(holders[k]) if len(k) >= chars else False for k in own]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return out


def shingles(text, size=5):
    own = words(text)
    n = min(size, len(own))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()


def near(rows, threshold=0.8, size=5):
    """[(id, text)] -> {id: (class, links)}; ids are unique."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}
    links = dict.fromkeys(ids, 0)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= threshold * len(x | y):
                links[a] += 1
                links[b] += 1
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {i: (top(i), links[i]) for i in ids}


def benchmark_hits(text, items, window=10):
    """(words, hit words, item names)"""
    own = words(text)
    hit, names = set(), set()
    for name, item in items:
        theirs = words(item)
        n = min(window, len(theirs))
        grams = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(own) - n + 1) if n else ():
            if tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                names.add(name)
    return len(own), hit, names


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: size} -> {source: target}"""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_sources, left = {}, set(order), float(sum(sizes.values()))
    while open_sources:
        share = left / sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if weight[s] * share > most * sizes[s]}
        if not above:
            target |= {s: weight[s] * share for s in open_sources}
            break
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_sources -= above
    return target
