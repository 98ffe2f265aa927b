"""Plain versions of the operators, written from their contracts for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def words(text):
    return WORD.findall(text or "")


def order(doc_id):
    return LAST if doc_id is None else doc_id


def substring(rows, window=50):
    least = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            least[key] = min(least.get(key, LAST), order(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < order(i):
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text, n=3):
    w = words(lower_ascii(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_roots(rows, radius=3):
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                parent[find(a)] = find(b)
    return fps, [find(a) for a in range(len(rows))]


def simhash(rows, radius=3):
    fps, roots = simhash_roots(rows, radius)
    least = defaultdict(lambda: LAST)
    for (i, _), r in zip(rows, roots):
        least[r] = min(least[r], order(i))
    return [(i, f"{f:016x}", None if i is None and least[r] == LAST else least[r])
            for (i, _), f, r in zip(rows, fps, roots)]


def metrics(text):
    w = words(text)
    if not w:
        return (0, 0, 0, 0, 0)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = [False] * len(w)
    for i in range(len(w) - 2):
        if count[tuple(w[i:i + 3])] > 1:
            cover[i:i + 3] = [True] * 3
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(cover))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def edit_to_stretch(pattern, text):
    """Least word edit distance of ``pattern`` to any stretch of ``text`` (dynamic programme)."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != w), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def repeated(rows, least=50):
    """Documents and word positions covered by a ``least``-word window of another text too."""
    owners = defaultdict(set)
    for i, t in rows:
        w = tuple(words(t))
        for k in range(len(w) - least + 1):
            owners[w[k:k + least]].add(w)
    out = defaultdict(set)
    for i, t in rows:
        w = tuple(words(t))
        for k in range(len(w) - least + 1):
            if len(owners[w[k:k + least]]) > 1:
                out[i].update(range(k, k + least))
    return out


def collocations(rows, least, longest, top):
    """``rows`` of (lang, text)."""
    of = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                of["und" if lang is None else lang].update(
                    " ".join(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in of.items():
        n = sum(c for p, c in f.items() if " " not in p)
        found = {p: c for p, c in f.items() if " " in p and c >= least}
        scored = []
        for p, a in found.items():
            w = p.split(" ")
            score, k = min((1000 * a * n // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k)
                           for k in range(1, len(w)))
            inside = any(q != p and f" {p} " in f" {q} " and 100 * c >= 100 * a
                         for q, c in found.items())
            if not inside:
                scored.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """Root of a list of digests, and for each leaf its (side, sibling) steps."""
    steps = [[] for _ in leaves]
    groups = [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        up, merged = [], []
        for i in range(0, len(leaves), 2):
            run = leaves[i:i + 2]
            if len(run) == 2:
                for x in groups[i]:
                    steps[x].append("R" + run[1])
                for x in groups[i + 1]:
                    steps[x].append("L" + run[0])
            else:
                for x in groups[i]:
                    steps[x].append("-")
            up.append(_sha(*run))
            merged.append(sum(groups[i:i + 2], []))
        leaves, groups = up, merged
    return leaves[0], steps


def manifest(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text) → (doc_id, leaf, subroot, root, witness)."""
    def leaf(row):
        return _sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])
    of = defaultdict(list)
    for r in rows:
        of[r[2]].append((order(r[0]), leaf(r), r[0]))
    langs = sorted(of, key=lambda x: (x is not None, (x or "").encode()))
    roots, inner = [], {}
    for lang in langs:
        of[lang].sort(key=lambda x: x[:2])
        root, steps = _tree([x[1] for x in of[lang]])
        roots.append(root)
        inner[lang] = steps
    root, upper = _tree(roots)
    return sorted(((i, h, sub, root, tuple(s + up)) for lang, sub, up in zip(langs, roots, upper)
                   for (_, h, i), s in zip(of[lang], inner[lang])), key=str)


def language_profiles(rows, size):
    """``rows`` of (lang, text)."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        if lang is not None:
            counts[lang].update(language_grams(text))
    return {k: _most(c, size) for k, c in counts.items() if c}


def language_grams(text):
    found = Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            s = f" {word} "
            for n in (1, 2, 3):
                found.update(s[i:i + n] for i in range(len(s) - n + 1))
            word = ""
    del found[" "]
    return found


def _most(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]


def language(text, profiles, size):
    found = _most(language_grams(text), size)
    if not found or not profiles:
        return "und", 0.0
    far = {k: sum(abs(i - p.index(g)) if g in p else size for i, g in enumerate(found))
           for k, p in profiles.items()}
    best = min(far, key=lambda k: (far[k], k))
    return best, 1.0 - far[best] / (size * len(found))


CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


def entropy(window):
    return -sum(window.count(c) / len(window) * math.log2(window.count(c) / len(window))
                for c in set(window))


def entropy_spans(text, cut, allow, window=20):
    """Runs of characters under windows of high entropy, outside base spans and allowed words."""
    chars = list(text or "")
    for a, _, b in base_spans(text):
        chars[a:b] = " " * (b - a)
    for m in re.finditer(cut, "".join(chars)):
        chars[m.start():m.end()] = " " * (m.end() - m.start())
    out = []
    for m in CANDIDATE.finditer("".join(chars)):
        hit = m[0]
        if any(re.search(p, hit) for p in allow):
            continue
        hexadecimal = re.fullmatch("[0-9a-f]+|[0-9A-F]+", hit)
        bits = 3.0 if hexadecimal else 3.7
        under = [False] * len(hit)
        for i in range(len(hit) - window + 1):
            if entropy(hit[i:i + window]) > bits + 1e-9:
                under[i:i + window] = [True] * window
        i = 0
        while i < len(hit):
            j = i
            while j < len(hit) and under[j]:
                j += 1
            if j > i and not any(re.search(p, hit[i:j]) for p in allow):
                out.append((m.start() + i, 3, m.start() + j))
            i = max(j, i + 1)
    return out


def redacted(text, spans, mark="[REDACTED]"):
    out, at = "", 0
    for a, _, b in spans:
        if a >= at:
            out += text[at:a] + mark
        at = max(at, b)
    return text if not spans else out + text[at:]
