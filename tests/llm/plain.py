"""Plain versions of the operators, one document or pair at a time, to hold results against."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import zstandard


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contamination(docs, items):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) a row."""
    windows = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i:i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (items_of := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= items_of
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text, size):
    w = blank_words(lowered(text))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def near(docs, size, percent=80):
    """(doc_id, n_shingles, component_id, kept) a row, all pairs with a shingle in common compared."""
    sets, parent, holders = [(d, shingles(t, size)) for d, t in docs], {}, defaultdict(list)

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for j, (doc, own) in enumerate(sets):
        if doc is None:
            continue
        common = Counter(k for s in own for k in holders[s])
        for k, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[k][1]) - n):
                a, b = root(doc), root(sets[k][0])
                parent[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(j)
    return [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets]


def without_repeats(docs, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept bytes) in corpus order."""
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda r: -(2**63) if r[0] is None else r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = True
            else:
                seen.add(raw[i:i + length])
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((doc, len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), kept))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = blank_words(text)
    triples = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if blank_words(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(repeated)


def chunks_of(raw, bands):
    """Lists of chunks, one list a chunk size. The longest size counts for texts that have it;
    the finest is the largest halving of it that fits four times, or the shortest there is."""
    shortest = bands.short_chunks[0][0]
    halvings = [bands.chunk >> k for k in range(30) if bands.chunk >> k >= shortest]
    finest = next((c for c in halvings if 4 * c <= len(raw)), halvings[-1])
    out = []
    for c in sorted({bands.chunk, finest}):
        if c <= len(raw):
            out.append([raw[a:a + c] for a in (min(k * c, len(raw) - c) for k in range(-(-len(raw) // c)))])
    return out


def good(text, bands):
    """base_failed, kept."""
    n, _, _, _, repeated = base_counts(text)
    base = n < bands.min_words or 100 * repeated > bands.max_repeat_percent * n
    if base or not text:
        return base, False
    raw, ratio = text.encode(), lambda b: len(zstandard.ZstdCompressor(level=bands.level).compress(b)) / len(b)
    low, high = [(lo, hi) for most, lo, hi in bands.whole if len(raw) <= most][0]
    kept = low <= ratio(raw) <= high
    for chunks in chunks_of(raw, bands):
        limits = [h for up_to, h in bands.short_chunks if len(chunks[0]) <= up_to] + [bands.chunk_highest]
        outside = [c for c in chunks if ratio(c) < bands.chunk_lowest or ratio(c) > limits[0]]
        kept = kept and len(outside) <= bands.chunk_share * len(chunks)
    return base, kept


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def letter_words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def importance(docs, items, percent=10, n_buckets=10_000, longest=1, min_words=20):
    """(doc_id, n_features, weight, score, rank) a row; ids null or not repeated."""
    def buckets(text):
        w = item_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % n_buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    of = [buckets(t) for _, t in docs]
    s, t = Counter(b for own in of for b in own), Counter(b for _, text in items for b in buckets(text))
    s_all, t_all = s.total() + n_buckets, t.total() + n_buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * float(s_all) / ((n + 1) * float(t_all)))) for b, n in s.items()}
    rows = []
    for (doc, text), own in zip(docs, of):
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        rows.append((doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(item_words(text)) >= min_words))
    order = sorted((i for i, r in enumerate(rows) if r[4]), key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    rank = {i: k + 1 for k, i in enumerate(order[:percent * len(order) // 100])}
    return [(*r[:4], rank.get(i)) for i, r in enumerate(rows)]


def copies(docs):
    """(doc_id, keep_id, group_size, kept, text_sha256) a row."""
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for body, own in groups.items():
        best = min(own)[3]
        out += [(docs[i][0], docs[best][0], len(own), i == best, hashlib.sha256(body.encode()).hexdigest()) for *_, i in own]
    return out


def divergence(docs, min_docs, k):
    """(lang, source, part, item, value, rank) of rows (lang, source, text)."""
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in ((x or "", y or "", t) for x, y, t in docs):
        w = letter_words(text)
        counts[lang, source].update(w)
        held[lang].update(set(w))
    out = []
    for lang in held:
        kept = [w for w, n in held[lang].items() if n >= min_docs]
        own = {s: {w: c[w] for w in kept} for (x, s), c in counts.items() if x == lang}
        own[None] = {w: sum(c[w] for s, c in own.items()) for w in kept}
        p = {s: {w: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for w, n in c.items()} for s, c in own.items()}
        q = p.pop(None)
        for s in p:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in p if o != s]
            terms = [(p[s][w] - q[w], w) for w in kept if own[s][w] and p[s][w] > q[w]]
            for part, rows, most in (("pair", pairs, len(pairs)), ("term", terms, k)):
                out += [(lang, s, part, i, v, r + 1) for r, (v, i) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1].encode()))[:most])]
    return out
