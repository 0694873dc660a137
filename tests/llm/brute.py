"""Plain versions of the operators' contracts."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def near_duplicates(docs, n, percent):
    """docs: (doc_id, text) with distinct ids -> {doc_id: (n_shingles, component)}."""
    sets, parent = {}, {}
    for doc, text in docs:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[doc] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        parent[doc] = doc
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(parent, a), find(parent, b)))
                parent[y] = x
    return {d: (len(sets[d]), find(parent, d)) for d in ids}


def repeats(docs, width):
    """docs: (doc_id, text) -> [(doc_id, n_words, n_removed, digest)]."""
    first = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - width + 1):
            if doc is not None:
                key = tuple(w[i:i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if doc is not None and first[tuple(w[i:i + width])] < doc:
                gone[i:i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def rule_counts(text):
    text, w = text or "", words(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times, covered = Counter(windows), [False] * len(w)
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered[i:i + 8] = [True] * 8
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, sum(covered)


def links(rows, bound):
    """rows: (vec_id, label, vector) -> {vec_id: (n_links, component)}; distinct ids."""
    import numpy as np

    good = {}
    for v, label, e in rows:
        if label is None or e is None or any(x is None or x != x or abs(x) == float("inf") for x in e) or not any(e):
            continue
        e = np.array(e, float)
        e /= np.abs(e).max()
        good[v] = (label, e / np.sqrt(e @ e))
    parent, count = {v: v for v, _, _ in rows}, Counter()
    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= bound:
                count[a] += 1
                count[b] += 1
                x, y = sorted((find(parent, a), find(parent, b)))
                parent[y] = x
    return {v: (count[v], find(parent, v)) for v in parent}


def near(a, b):
    """True if one inserted, deleted or replaced code point makes the words equal."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def variants(counts, ratio):
    """{word: n} -> {word: (form, root, n, n_near, form_n)}."""
    close = {w: [x for x in counts if near(w, x)] for w in counts}
    form = {}
    for w, found in close.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(close[w]), counts.get(form[w]))
    return out


def slipped(docs, slip, least_length, least_count):
    """(doc_id, text) -> {word: n} of the runs of letters, some of which lose a letter."""
    import zlib

    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count and len(w) >= least_length}


def resampled(docs, target, n, buckets, least, percent, seed):
    """(doc_id, text) rows, target texts -> [(doc_id, n_features, weight, score, rank)] in the order of docs."""
    import math
    import zlib

    def grams(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    rows = [(d, *grams(t)) for d, t in docs]
    s, t = Counter(b for r in rows for b in r[2]), Counter(b for x in target for b in grams(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for doc, words_, found in rows:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words_ >= least])
    order = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(order[:len(order) * percent // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def language(text, model):
    """(language, score) by one look-up a trigram, language and hash in plain integers; ``model`` as langid fits it."""
    from tabula.llm import langid

    text = (text or "").replace("\0", " ").lower()
    if not any(c.isalpha() for c in text) or not model.langs:
        return "und", 0.0
    code = [0, *(ord(c) if c.isalpha() else 0 for c in text), 0]
    found = [code[i:i + 3] for i in range(len(code) - 2) if all(code[i + j] or code[i + j + 1] for j in range(2))]
    hits = Counter()
    for gram in found:
        h, base = 0, 1
        for c in gram:
            h, base = (h + c * base) % 2**64, base * langid._GRAM_BASE % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ h >> shift) * factor % 2**64
        h ^= h >> 31
        slots = [h >> langid.SLOT_BITS * k & (1 << langid.SLOT_BITS) - 1 for k in range(langid.HASHES)]
        for k in range(len(model.langs)):
            hits[k] += all(int(model.planes[k // 64][s]) >> k % 64 & 1 for s in slots)
    share = [min(1.0, max(0.0, (hits[k] / max(len(found), 1) - p) / (1 - p))) for k, p in enumerate(model.false_positive)]
    best = max(range(len(share)), key=lambda k: (share[k], -k))
    return model.langs[best if share[best] > 0 else model.default], share[best]


def fewest_bins(lengths, capacity):
    """The least number of bins, by trying all ways to place the items."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]
