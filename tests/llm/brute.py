"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def substring_dedup(rows, window=35):
    words = [(i, SPACES.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[j : j + window]) for _, w in words for j in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - window + 1):
            if count[tuple(w[j : j + window])] > 1:
                gone.update(range(j, j + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def suffix_dedup(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            s = b[j : j + length]
            if s in seen:
                gone[j : j + length] = b"\1" * length
            seen.add(s)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def lower_ascii(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def minhash_dedup(rows, k=3, percent=85):
    sets = []
    for i, t in rows:
        w = SPACES.findall(lower_ascii(t))
        s = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.append((i, s))
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    by = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        seen = Counter(m for x in s for m in by[x])
        for m, shared in seen.items():
            j, other = sets[m]
            if 100 * shared >= percent * (len(s) + len(other) - shared):
                a, b = sorted((top(i), top(j)))
                root[b] = a
        for x in s:
            by[x].append(n)
    return [(i, len(s), top(i), top(i) == i) for i, s in sets]


def decontamination(rows, items, window=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, t in items:
        w = find.findall(lower_ascii(t))
        if w:
            m = min(window, len(w))
            for j in range(len(w) - m + 1):
                windows[tuple(w[j : j + m])].add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for i, t in rows:
        w = find.findall(lower_ascii(t))
        hit, found = set(), set()
        for m in sizes:
            for j in range(len(w) - m + 1):
                if items_of := windows.get(tuple(w[j : j + m])):
                    hit.update(range(j, j + m))
                    found |= items_of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def edited_texts(rows):
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = []
    for p, (i, t) in enumerate(ordered):
        cut = len(t) // 3
        after = ordered[(p + 1) % len(ordered)][1]
        new = t[: len(t) - cut] + after[:cut]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    return out


def vector_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label), all of one length."""
    kept = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((distance(cut(v, p), e), j) for j, e in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for j in range(len(first)):
                mine = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p][1] == j]
                if mine:
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, sums = assign(), Counter()
    for (_, _, c), f in zip(kept, found):
        sums[c] += sum(d for d, _ in f)
    return [(i, "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), sums[c], digest) for (i, _, c), f in zip(kept, found)]


def simhash_dedup(rows, k=3, radius=2):
    marks = []
    for i, t in rows:
        w = SPACES.findall(lower_ascii(t))
        s = [" ".join(w[j : j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        marks.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    root = list(range(len(marks)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for m, (i, x) in enumerate(marks):
        for n in range(m):
            if (x ^ marks[n][1]).bit_count() <= radius or (i is not None and i == marks[n][0]):
                root[top(m)] = top(n)
    least = {}
    for n, (i, _) in enumerate(marks):
        r = top(n)
        least[r] = min((j for j in (i, least.get(r)) if j is not None), default=None)
    return [(i, f"{x:016x}", least[top(n)]) for n, (i, x) in enumerate(marks)]


def source_divergence(rows, least=10, ranks=10):
    """rows: (text, lang, source)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(t))) for t, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(w for _, _, ws in mine for w in set(ws))
        kept = sorted(w for w in df if df[w] >= least)
        count = {s: Counter(w for _, t, ws in mine if t == s for w in ws if df[w] >= least) for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 2) // (c.total() + 2 * len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = [(t, sum(f(p[s][w], p[t][w]) for w in kept)) for t in count if t != s]
            terms = [(w, f(p[s][w], q[w])) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found = sorted(found, key=lambda r: (-r[1], r[0].encode()))[:most]
                out += [(lang, s, part, item, v, n) for n, (item, v) in enumerate(found, 1)]
    return out


FULL = (1 << 64) - 1


def spread(x):
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & FULL
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & FULL
    return x ^ x >> 32


def byte_hash(data, values, base):
    total, power = len(data), 1
    for b in data:
        total, power = (total + values[b] * power) & FULL, power * base & FULL
    return spread(total)


def quality_grams(text, values, base):
    """Buckets of the n-grams of a text: tokens, pairs of them and pairs of their shapes."""
    out, before = [], None
    for token in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", (text or "").encode()):
        word = re.match(rb"[0-9A-Za-z\x80-\xff]", token)
        shape = int(0x41 <= token[0] <= 0x5A) if word else 3 + min(len(token), 4)
        h = byte_hash(re.sub(rb"[A-Z]", lambda m: m[0].lower(), token), values, base)
        out.append(h)
        if before:
            shape += 10 * (before[0] == h)
            out += [spread((before[0] * 3 + h) & FULL), spread(before[1] * 1000 + shape + (1 << 40))]
        before = (h, shape)
    return [spread(x) >> 52 for x in out]


def quality_weights(rows, labels, values, bases, seed, buckets=1 << 12, shrink=20.0):
    """rows: (id, text), ids apart; labels: {id: 0 or 1}. (id, log weight, n-grams, kept)."""
    grams = {i: quality_grams(t, values, bases[0]) for i, t in rows}
    raw = Counter(g for x in grams.values() for g in x)
    half = {i: xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42) % 2 for i in labels}

    def ratio(target):
        p = {b: (raw[b] + 1) / (raw.total() + buckets) for b in range(buckets)}
        return [math.log((target[b] + shrink * buckets * p[b]) / (target.total() + shrink * buckets)) - math.log(p[b])
                for b in range(buckets)]

    good = [Counter(g for i, x in grams.items() if labels.get(i) == 1 and half[i] == h for g in x) for h in (0, 1)]
    other, whole = [ratio(good[1]), ratio(good[0])], ratio(good[0] + good[1])
    weight = lambda i, r: round(sum(r[g] for g in grams[i]), 6)
    seen = sorted((weight(i, other[half[i]]), q) for i, q in labels.items() if i in grams)
    n_good = sum(q for _, q in seen)
    best, cut, lost, gone = 0.0, -math.inf, 0, 0
    for w, q in seen:
        lost, gone = lost + q, gone + 1 - q
        gain = gone / (len(seen) - n_good) - 4 * lost / n_good
        if gain > best + 1e-12:
            best, cut = gain, w
    noisy = {}
    for i, t in rows:
        u = spread(byte_hash((t or "").encode(), values, bases[1]) ^ spread(i + seed & FULL)) >> 11
        noisy[i] = weight(i, whole) - math.log(-math.log((u + 0.5) / 2**53))
    k = sum(weight(i, whole) > cut for i, _ in rows)
    least = sorted(noisy.values(), reverse=True)[k - 1] if 0 < k < len(rows) else -math.inf
    return {i: (weight(i, whole), len(grams[i]), noisy[i] >= least) for i, _ in rows}


def url_rule(url, rules):
    """(host, path, rule, verdict or None) of a URL."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = lower_ascii(host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


def url_features(url, host, path):
    share = Counter(url)
    query = re.search(r"\?([^#]*)", url)
    query = query[1] if query else ""
    return {
        "n_chars": len(url), "depth": path.count("/"), "digits": sum(c in "0123456789" for c in url) / max(1, len(url)),
        "entropy": -sum(n / len(url) * math.log2(n / len(url)) for n in share.values()),
        "params": query.count("&") + 1 if query else 0, "labels": host.count(".") + 1 if host else 0,
        "hyphens": host.count("-"),
    }
