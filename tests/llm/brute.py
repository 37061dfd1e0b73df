"""Plain single-machine versions of the text operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def jaccard_groups(docs, k, percent):
    """{doc_id: (n, component)} for {doc_id: text}."""
    sets = {d: shingles(t, k) for d, t in docs.items()}
    ids = sorted(d for d in sets if sets[d])
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    low = components(docs, links)
    return {d: (len(sets[d]), low[d]) for d in docs}


def water_fill(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """{source: target} for {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: epochs * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] >= epochs * sizes[s]}
        if not over:
            return target
        capped |= over


def best_alignment(a, b):
    best, prev = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, prev[j] + (1 if x == y else -1), prev[j + 1] - 1, row[j] - 1))
        best, prev = max(best, *row), row
    return best


def segments(score):
    """All maximal-scoring segments by their definition: split at the best segment, again and again."""
    def best(lo, hi):
        top, at = 0.0, None
        for i in range(lo, hi):
            s = 0.0
            for j in range(i, hi):
                s += score[j]
                if s > top + 1e-12 or (at and abs(s - top) <= 1e-12 and j + 1 - i < at[1] - at[0]):
                    top, at = s, (i, j + 1)
        return top, at
    out, todo = [], [(0, len(score))]
    while todo:
        lo, hi = todo.pop()
        s, at = best(lo, hi)
        if at:
            out.append((at[0], at[1], s))
            todo += [(lo, at[0]), (at[1], hi)]
    return sorted(out)
