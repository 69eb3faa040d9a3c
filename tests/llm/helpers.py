"""Plain Python versions that the operators are held against."""

import hashlib


def words(text):
    return (text or "").encode().split()


def removed_by_windows(rows, window=50):
    """{doc_id: kept words} by the definition, over every window."""
    first = {}
    for key, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, key), key)
    out = []
    for key, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key:
                gone.update(range(i, i + window))
        out.append((key, [x for i, x in enumerate(w) if i not in gone], len(w)))
    return out


def shingle_set(text, k=5):
    w = words(text)
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def groups(rows, threshold=0.8):
    """{doc_id: (class, links)} by comparing all pairs."""
    sets = {k: shingle_set(t) for k, t in rows}
    links = {k: {j for j in sets if j != k and sets[k] and jaccard(sets[k], sets[j]) >= threshold - 1e-9} for k in sets}
    out = {}
    for k in sets:
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[k] = (min(seen), len(links[k]))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
