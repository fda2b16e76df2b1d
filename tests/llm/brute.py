"""Plain Python versions of the operators, slow and short."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_counts(text):
    """The base figures of a text: words, characters, symbols, repeated lines and words."""
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    spans = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    hit = {i + k for i in range(len(found) - 7) if spans[tuple(found[i : i + 8])] > 1 for k in range(8)}
    return (
        len(found),
        sum(map(len, found)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(hit),
    )


def contamination(text, items, window=10):
    """(words, hit words, items) of a text against {item: text}."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    found, hit, names, owners = split(text), set(), set(), defaultdict(set)
    for item, body in items.items():
        phrase = split(body)
        n = min(window, len(phrase))
        for i in range(len(phrase) - n + 1 if n else 0):
            owners[tuple(phrase[i : i + n])].add(str(item))
    for n in {len(phrase) for phrase in owners}:
        for at in range(len(found) - n + 1):
            if tuple(found[at : at + n]) in owners:
                hit |= set(range(at, at + n))
                names |= owners[tuple(found[at : at + n])]
    return len(found), hit, sorted(names)


def shingles(text, width=5):
    found = words((text or "").translate(LOWER))
    if len(found) < width:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def groups(texts, similarity=75):
    """{id: (set size, smallest id reachable)} by comparing all sets that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for key in s:
            holders[key].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for key in s for j in holders[key] if j > i).items():
            if 100 * n >= similarity * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def targets(sizes, epochs=1.5, copies=2, weights=(5, 2, 1)):
    """{source: target} by sharing again and again what is above a cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    left, free, found = epochs * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > copies * sizes[s]]
        if not over:
            return found | share
        for s in over:
            found[s] = copies * sizes[s]
            left -= found[s]
            free.discard(s)
    return found


def index(rows, tokenizer, end=2):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows in order."""
    start = 0
    for name, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        yield name, start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)


def article(html):
    """The text of a page whose article is marked and holds no other element's text."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    body = re.sub(r"</?(p|h1)\b[^>]*>", "\0", body.replace("<br>", " "))
    body = re.sub(r"</?[a-z][^>]*>", "", body)
    lines = (" ".join(unescape(part).split()) for part in body.split("\0"))
    return "\n".join(line for line in lines if line)


def sha(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()
