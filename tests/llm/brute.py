"""Plain Python versions of the operators' contracts, for comparison on small tables."""

import hashlib
import re
from collections import defaultdict


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def exact(rows):
    groups = defaultdict(list)
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    for d, t in norm:
        groups[t].append(d)
    out = []
    for d, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((d, keep, len(groups[t]), d == keep, sha(t)))
    return sorted(out, key=repr)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def leaks(rows, bench, n=10):
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = defaultdict(set)
    for i, t in bench:
        w = pat.findall(lower(t))
        for k in range(max(1, len(w) - n + 1)) if w else []:
            wins[tuple(w[k : k + n])].add(i)
    sizes = sorted({len(w) for w in wins})
    out = []
    for d, t in rows:
        w, hit, items = pat.findall(lower(t)), set(), set()
        for s in sizes:
            for k in range(len(w) - s + 1):
                if (x := tuple(w[k : k + s])) in wins:
                    hit |= set(range(k, k + s))
                    items |= {str(i) for i in wins[x] if i is not None}
        out.append((d, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return sorted(out, key=repr)


def luhn(s):
    return sum((x if i % 2 == 0 else x * 2 // 10 + x * 2 % 10) for i, x in enumerate(map(int, reversed(s)))) % 10 == 0


def base_pii(rows):
    out = []
    for d, t in rows:
        t, spans, kinds = t or "", [], ("email", "ip", "card", "phone")
        for o, (pat, ok) in enumerate((
            (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
            (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(x := re.sub("[^0-9]", "", m)) <= 19 and luhn(x)),
            (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15))):
            spans += [(m.start(), o, m.end()) for m in re.finditer(pat, t) if ok(m[0])]
        spans.sort()
        out.append((d, *(sum(s[1] == o for s in spans) for o in range(4)), sha(",".join(f"{kinds[o]}:{a}:{b}" for a, o, b in spans))))
    return sorted(out, key=repr)


def shingles(t):
    w = lower(t).encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def near(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            inter = len(x & y)
            if x and y and 100 * inter >= 85 * (len(x) + len(y) - inter) and (p := find(a)) != (q := find(b)):
                up[max(p, q)] = min(p, q)
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets)


def repeats(rows, n=13):
    first, docs = {}, [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in docs:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone |= set(range(i, i + n))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), sha(b" ".join(kept))))
    return sorted(out)
