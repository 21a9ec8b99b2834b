"""Plain single-process versions of the contracts, for comparison on small tables."""

import base64
import hashlib
import html
import re
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd


def rows(sf, table, columns):
    return duckdb.sql(f"select {columns} from '{sf}/{table}.parquet' order by 1").fetchall()


def words(text):
    return (text or "").encode().split()


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_duplicates(docs, n, percent=80):
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    holders, both, groups = defaultdict(list), defaultdict(int), Groups(sets)
    for i, s in sets.items():
        for g in s:
            for j in holders[g]:
                both[j, i] += 1
            holders[g].append(i)
    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            groups.join(a, b)
    return [(i, len(s), groups.find(i), groups.find(i) == i) for i, s in sets.items()]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def secrets(docs):
    out = []
    for i, text in docs:
        s = base_spans(text)
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in s)
        out.append((i, *(sum(k == n for _, k, _ in s) for n in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    return out


def repeats(docs, m=13):
    docs = [(i, words(t)) for i, t in docs]
    owner = {}
    for i, w in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        for k in range(len(w) - m + 1):
            owner.setdefault(tuple(w[k:k + m]), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - m + 1):
            o = owner[tuple(w[k:k + m])]
            if o is not None and (i is None or o < i):
                gone[k:k + m] = [True] * m
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def article(page):
    m = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    text = re.sub(r"<(?:/?(?:p|h1)|br)>", " ", m[1] if m else "")
    text = re.sub(r"<[a-zA-Z/][^>]*$", "", re.sub(r"<[^>]*>", "", text))
    return " ".join(html.unescape(text).split())


def warc(pages):
    payload = {i: (h or "").encode() for i, h in pages}
    last = {}
    for i, h in payload.items():
        last[h] = max(last.get(h, i), i)
    return [(i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if last[h] == i else "revisit",
             None if last[h] == i else last[h]) for i, h in payload.items()]


def vectors(sf):
    got = rows(sf, "embeddings", "vec_id, embedding")
    return np.array([i for i, _ in got]), np.array([v for _, v in got], float)


def linked(ids, x, threshold=0.95):
    y = x / np.linalg.norm(x, axis=1)[:, None]
    near = y @ y.T >= threshold
    np.fill_diagonal(near, False)
    groups = Groups(ids.tolist())
    for a, b in zip(*np.nonzero(near), strict=True):
        groups.join(int(ids[a]), int(ids[b]))
    return [(int(i), int(near[k].sum()), groups.find(int(i)), groups.find(int(i)) == i) for k, i in enumerate(ids)]


def nearest(ids, x, every=20, k=20):
    out = []
    for q in np.flatnonzero(ids % every == 0):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
        out += [(int(ids[q]), r + 1, int(ids[j]), float(s[j])) for r, j in enumerate(best)]
    return out


def frame(found, columns):
    return pd.DataFrame(found, columns=columns)
