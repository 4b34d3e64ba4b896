"""The operators' results by the plainest means, for small inputs."""

import hashlib
import re

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = {}
    for item, text in items:
        words = ITEM_WORD.findall(lower(text))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = ITEM_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                ids = windows.get(tuple(words[i : i + n]))
                if ids:
                    found |= ids
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


def shingles(text, size):
    words = WORD.findall(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_groups(docs, size, per_cent=80):
    """[(doc_id, n_shingles, component_id)] with links between all pairs of rows."""
    sets = [shingles(text, size) for _, text in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * min(len(x), len(y)) >= per_cent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= per_cent * (len(x) + len(y) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(docs))


def byte_repeats(docs, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} by looking up every byte string."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def words_left(docs):
    """{doc_id: words that stay} for distinct doc_ids, by comparing all lines of 5 words and looking up all windows of 25."""
    lines = [(d, n, WORD.findall(lower(line))) for d, text in sorted(docs) for n, line in enumerate((text or "").split("\n"))]
    distinct = sorted({tuple(w) for _, _, w in lines if len(w) >= 5})
    group = {distinct[i]: g for i, _, g in near_groups([(i, " ".join(w)) for i, w in enumerate(distinct)], 5)}
    seen, gone, text = set(), set(), {d: [] for d, _ in docs}
    for d, n, w in lines:
        if len(w) >= 5:
            gone |= {(d, n)} if group[tuple(w)] in seen else set()
            seen.add(group[tuple(w)])
        text[d] += [(n, x) for x in w]
    first, out = {}, {}
    for d in sorted(text):
        have = text[d]
        drop = [(d, n) in gone for n, _ in have]
        stays = [not x for x in drop]
        for i in range(len(have) - 24):
            if any(drop[i : i + 25]) or any((d, n) in gone for n in range(have[i][0], have[i + 24][0])):
                continue
            e, j = first.setdefault(tuple(x for _, x in have[i : i + 25]), (d, i))
            if e != d or i >= j + 25:
                stays[i : i + 25] = [False] * 25
        out[d] = [x for (_, x), s in zip(have, stays) if s]
    return out
