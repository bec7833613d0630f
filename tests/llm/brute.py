"""Plain Python twins of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def substring_dedup(texts, window):
    """(n_words, n_removed, kept hash) per text."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def simhash(text, shingle=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, values, max_bits=2):
    """Smallest id reachable over links of at most max_bits differing bits."""
    label = list(ids)
    links = [(i, j) for i in range(len(ids)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= max_bits]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label
