"""Plain versions of the operators for small inputs."""

import collections
import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width):
    words = WORDS.findall(low(text))
    width = min(width, len(words))
    return frozenset(tuple(words[k: k + width]) for k in range(len(words) - width + 1)) if words else frozenset()


def components(rows, width, threshold=80):
    """{doc_id: (set size, smallest linked id)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        shared = collections.Counter(j for g in s for j in holders[g])
        for g in s:
            holders[g].append(i)
        for j, n in shared.items():
            if 100 * n >= threshold * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def line_dedup(rows, min_chars=40, min_docs=5):
    """[(doc_id, lines, dropped, kept text)] of (doc_id, text) rows; a null id is smaller than all."""
    def key(line):
        return low(line.strip(" \t\n\x0b\x0c\r"))

    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add((i is not None, i or 0))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs
                or max(holders[key(x)]) == (i is not None, i or 0)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def passages(rows, items, window=13):
    """{doc_id: (words, hit words, items, items hash, contaminated)}."""
    windows, sizes = collections.defaultdict(set), set()
    for item, text in items:
        words = ITEM_WORDS.findall(low(text))
        n = min(window, len(words))
        if n:
            sizes.add(n)
            for k in range(len(words) - n + 1):
                windows[tuple(words[k: k + n])].add("" if item is None else str(item))
    out = {}
    for i, text in rows:
        words, hit, found = ITEM_WORDS.findall(low(text)), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                own = windows.get(tuple(words[k: k + n]))
                if own:
                    found |= own
                    hit.update(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out
