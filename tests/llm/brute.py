"""Plain Python versions of the operators, one row at a time."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, shingle=3):
    words = SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, bits=2):
    """{fp: smallest fp reachable}, unsigned."""
    left = sorted(set(fps))
    root = {}
    for f in left:
        if f in root:
            continue
        todo = [f]
        root[f] = f
        while todo:
            a = todo.pop()
            for b in left:
                if b not in root and bin(a ^ b).count("1") <= bits:
                    root[b] = f
                    todo.append(b)
    return root


def repeats(rows, length=50):
    first, out = {}, {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        cover = bytearray(len(b))
        windows = [b[i:i + length] for i in range(len(b) - length + 1)]
        for i, w in enumerate(windows):
            if first.get(w, d) < d:
                cover[i:i + length] = b"\x01" * length
        for w in windows:
            first.setdefault(w, d)
        runs = sum(1 for i, v in enumerate(cover) if v and not (i and cover[i - 1]))
        out[d] = (len(b), sum(cover), runs, hashlib.sha256(bytes(x for x, v in zip(b, cover) if not v)).hexdigest())
    return out


def tokens(line):
    return ["<*>" if re.search("[0-9]", w) else w for w in line.split()]


def recurring(rows, min_docs=5, depth=4, min_tokens=3, min_fixed=0.7, min_general=9):
    """{(id, text): line numbers to drop}."""
    lines = [(i, t, n, tokens(x)) for i, t in sorted(set(rows)) for n, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if len(x[3]) >= min_tokens]
    leaf = lambda k: (len(k), tuple(k[:depth]))
    docs = defaultdict(set)
    for i, t, _, k in lines:
        docs[leaf(k)].add((i, t))
    lines = [x for x in lines if len(docs[leaf(x[3])]) >= min_docs]
    distinct = defaultdict(set)
    for *_, k in lines:
        if len(k) >= min_general:
            distinct[leaf(k)].add(tuple(k))
    general = {}
    for lf, each in distinct.items():
        if len(each) < min_docs:
            continue
        count = Counter((p, w) for k in each for p, w in enumerate(k))
        for k in each:
            fields = tuple(w if count[p, w] >= min_docs and 10 * count[p, w] >= len(each) else None for p, w in enumerate(k))
            if sum(w is not None for w in fields) >= -(-len(k) * round(min_fixed * 10) // 10):
                general[k] = (lf, fields)
    found = defaultdict(list)
    for i, t, n, k in lines:
        found["literal", tuple(k)].append((i, t, n))
        if tuple(k) in general:
            found["general", general[tuple(k)]].append((i, t, n))
    out = defaultdict(set)
    for where in found.values():
        if len({x[:2] for x in where}) >= min_docs:
            first = min(where, key=lambda x: (x[0], xx(x[1]), x[2]))
            for x in where:
                if x != first:
                    out[x[:2]].add(x[2])
    return out


def xx(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def leaked(text, items, window=13, similarity=0.8):
    """Item ids of which the text holds a passage."""
    cut = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    w, out = cut(text), set()
    for item, passage in items:
        v = cut(passage)
        if len(v) < 8:
            continue
        n = min(window, len(v))
        for shift in range(-len(v), len(w)):
            same = [0 <= shift + q < len(w) and w[shift + q] == v[q] for q in range(len(v))]
            if any(10 * sum(same[a:a + n]) >= 10 * n * similarity for a in range(len(v) - n + 1)):
                out.add(item)
                break
    return out


def edf(shares, period):
    """Slot of every block of a period, by plain earliest deadline first: [(source, block)]."""
    done = [0] * len(shares)
    out = []
    for t in range(period):
        ready = [(-(-(k + 1) * period // q), s) for s, (k, q) in enumerate(zip(done, shares)) if k < q and k * period // q <= t]
        s = min(ready)[1]
        out.append((s, done[s]))
        done[s] += 1
    return out
