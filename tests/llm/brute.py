"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
from fractions import Fraction

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def removed_words(texts, width=50):
    """doc_id -> (words, whether each goes) for (doc_id, text) pairs."""
    words = [(i, (t or "").encode().split()) for i, t in texts]
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, w, gone))
    return out


def removed_bytes(texts, width=50):
    raw = [(i, (t or "").encode()) for i, t in texts]
    first = {}
    for i, b in raw:
        for k in range(len(b) - width + 1):
            first[b[k : k + width]] = min(i, first.get(b[k : k + width], i))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < i:
                gone[k : k + width] = [True] * width
        out.append((i, b, gone))
    return out


def runs_of(flags):
    return sum(1 for k, f in enumerate(flags) if f and (k == 0 or not flags[k - 1]))


def shingles(text):
    w = (text or "").encode().translate(_LOWER).split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def components(texts):
    """doc_id -> (number of shingles, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for t in sets[i] for j in by[t])
        for t in sets[i]:
            by[t].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(rows, changed=lambda doc_id: False, arity=16):
    """The manifest of rows (doc_id, source, lang, n_chars, text), as sorted tuples."""

    def leaf(values):
        texts = [None if v is None else str(v) for v in values]
        return _sha(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))

    def lower(t):
        return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def grow(nodes):
        """The root, and for each leaf its (left, right) siblings from the lowest level on."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for way, i in zip(ways, at, strict=True):
                run = i // arity * arity
                way.append((nodes[run:i], nodes[i + 1 : run + arity]))
            nodes = [_sha(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
            at = [i // arity for i in at]
        return nodes[0], ways

    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[1]].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    grown = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        grown[name] = grow([leaf(r) for r in trees[name]])
    if not names:
        return []
    root, crown = grow([grown[n][0] for n in names])
    out = []
    for name, above in zip(names, crown, strict=True):
        for r, way in zip(trees[name], grown[name][1], strict=True):
            folded = leaf(r[:4] + (lower(r[4]),)) if r[0] is not None and changed(r[0]) else leaf(r)
            for left, right in way + above:
                folded = _sha(*left, folded, *right)
            proof = _sha(*(d for left, right in way + above for d in left + right))
            out.append((r[0], leaf(r), grown[name][0], root, proof, folded, folded == root))
    return out


def periodic_runs(words, least=24, times=3):
    """(start, length, period) of every run, by start and period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def mixed(rows, weights=(5, 2, 1), most=3, seed=0):
    """(doc_id, size, source_size, target, copies) of rows (doc_id, source, text), with fractions."""
    sized = [(i, s, len((t or "").encode().split())) for i, s, t in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    whole = {s: sum(n for _, x, n in sized if x == s) for s in sources}
    weight = {s: Fraction(weights[k % len(weights)]) for k, s in enumerate(sources)}
    stopped = set()
    while True:
        open_ = [s for s in sources if s not in stopped]
        left = sum(whole.values()) - sum(most * whole[s] for s in stopped)
        share = Fraction(left) / sum(weight[s] for s in open_) if open_ else Fraction(0)
        above = {s for s in open_ if share * weight[s] > most * whole[s]}
        if not above:
            break
        stopped |= above
    target = {s: Fraction(most * whole[s]) if s in stopped else share * weight[s] for s in sources}
    out = []
    for s in sources:
        key = "" if s is None else ":" + s
        at = Fraction(int(hashlib.sha256(f"{seed}{key}".encode()).hexdigest()[:8], 16) % 2**31, 2**31)
        each = Fraction(math.floor(target[s] * 2**31 / whole[s]), 2**31) if whole[s] else Fraction(0)
        own = sorted(((i, n) for i, x, n in sized if x == s), key=lambda r: (-r[1], r[0] is not None, r[0] or 0))
        for i, n in own:
            copies = math.floor(at + each) - math.floor(at)
            at += each
            out.append((i, n, whole[s], float(target[s]), copies))
    return out
