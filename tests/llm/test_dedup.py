"""SimHash, substring and suffix dedup against brute force."""

import random

import numpy as np
import pandas as pd
from .brute import (fingerprint, order, repeated, simhash as brute_simhash, simhash_roots,
                   substring as brute_substring)
from pyspark.sql import functions as F

import footfall.llm.simhash as simhash
from footfall.llm import queries, substring, suffix
from footfall.llm.common import minimisers, window_hashes, word_hashes
from footfall.llm.components import components


def key(row):
    return tuple((x is None, str(x)) for x in row)


def substring_rows(df):
    found = substring.dedup_substrings(df).select(
        "doc_id", "n_words", "n_removed", F.when(F.col("kept").isNull(), F.col("words_sha"))
        .otherwise(F.sha2("kept", 256)))
    return sorted(map(tuple, found.collect()), key=key)


def test_substring_equals_brute_force(docs001, rows001):
    want = sorted(brute_substring(rows001), key=key)
    assert any(r[2] for r in want)
    assert substring_rows(docs001) == want


def test_substring_edges(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert substring_rows(edge) == sorted(brute_substring(rows), key=key)
    assert substring_rows(empty) == []


def test_substring_sketch_that_is_far_too_small_loses_nothing(shipped, docs001, rows001,
                                                              monkeypatch):
    monkeypatch.setattr(substring, "repeated_windows",
                        lambda texts, ranges: _small(texts, ranges))
    assert substring_rows(docs001) == sorted(brute_substring(rows001), key=key)


_whole = substring.repeated_windows


def _small(texts, ranges):
    return _whole(texts, ranges, depth=1, cells=8)


def test_window_hashes_tell_windows_apart():
    rnd = random.Random(1)
    words = [rnd.choice([b"a", b"b", b"c"]) for _ in range(6000)]
    for lane in (0, 1):
        h = window_hashes(word_hashes(words), 9, lane)
        by = {}
        for i, x in enumerate(h.tolist()):
            assert by.setdefault(x, words[i:i + 9]) == words[i:i + 9]
        assert len(by) == len({tuple(words[i:i + 9]) for i in range(len(h))})


def test_minimisers_leave_no_window_without_anchor():
    keys = np.random.default_rng(3).integers(0, 50, 500).astype(np.uint64)
    at = set(minimisers(keys, 26).tolist())
    assert all(at & set(range(i, i + 26)) for i in range(len(keys) - 25))
    assert len(minimisers(keys[:25], 26)) == 0


def test_fingerprint_contract(rows001):
    for _, t in rows001[:60] + [(0, None), (0, ""), (0, "One"), (0, "Ärger IM Wald")]:
        assert simhash.fingerprint_of(t) == fingerprint(t)


def simhash_rows(df):
    found = simhash.near_duplicates(df).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    return sorted(map(tuple, found.collect()), key=key)


def test_simhash_equals_brute_force(docs001, rows001):
    assert simhash_rows(docs001) == sorted(brute_simhash(rows001), key=key)


def test_simhash_edges(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert simhash_rows(edge) == sorted(brute_simhash(rows), key=key)
    assert simhash_rows(empty) == []


def test_ball_links_connect_exactly_what_all_pairs_connect(shipped):
    rnd = random.Random(7)
    fps = {0, 2**64 - 1}
    for _ in range(40):
        x = rnd.getrandbits(64)
        fps.add(x)
        for _ in range(rnd.randrange(6)):
            for b in rnd.sample(range(64), rnd.randrange(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    df = shipped.createDataFrame(signed, "fp long")
    links = simhash.links(df).collect()
    for a, b in links:
        assert 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    roots = {r["node"]: r["root"] for r in components(
        shipped.createDataFrame(links, "a long, b long")).collect()}
    parent = {f[0]: f[0] for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a,) in signed:
        for (b,) in signed:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                parent[find(a)] = find(b)
    groups, mine = {}, {}
    for (f,) in signed:
        groups.setdefault(find(f), set()).add(f)
        mine.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_long_chain(shipped):
    edges = shipped.range(300).selectExpr("(id * 10) % 301 as a", "((id + 1) * 10) % 301 as b")
    found = components(edges).collect()
    assert {r["root"] for r in found} == {0} and len(found) == 301


def test_keep_first_keeps_one_of_each_group(edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    groups = {}
    for (i, _), r in zip(rows, simhash_roots(rows)[1]):
        groups.setdefault(r, []).append(i)
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = [min(v, key=order) for v in groups.values()]
    assert sorted(ids, key=order) == sorted(want, key=order)


def test_suffix_spans_cover_what_brute_force_finds(docs001, rows001):
    want = repeated(rows001)
    texts = {}
    for i, t in rows001:
        texts.setdefault(tuple((t or "").split()), []).append(i)
    found = suffix.repeated_passages(docs001).collect()
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
        assert r["n_words"] >= 50
    of_text = {i: ids for ids in texts.values() for i in ids}
    for i, words in want.items():
        if len(of_text[i]) == 1:
            assert got[i] == words
    copies = {i for ids in texts.values() if len(ids) > 1 for i in ids
              if len((dict(rows001)[i] or "").split()) >= 50}
    assert set(got) == set(want) | copies


def test_suffix_edges(edge, empty):
    found = suffix.repeated_passages(edge).collect()
    spans = {(r["doc_id"], r["start_word"], r["end_word"], r["first_doc_id"]) for r in found}
    assert {(7, 0, 61, 7), (8, 0, 60, 7), (9, 1, 62, 7), (None, 1, 61, 7)} <= spans
    assert {(4, 0, 30000, 4), (5, 0, 30000, 4)} <= spans
    assert {r["doc_id"] for r in found} == {4, 5, 7, 8, 9, None}
    assert suffix.repeated_passages(empty).count() == 0


def test_suffix_one_first_document_for_a_hot_passage(shipped):
    """The words around a passage are chance words that some of its owners share too."""
    rng = random.Random(6)
    common = [f"z{int(rng.paretovariate(0.6))}" for _ in range(20_000)]
    rows = []
    for size in (51, 60, 75):
        passage = [f"p{size}_{k}" for k in range(size)]
        rows += [(size * 1000 + i, " ".join(rng.choices(common, k=30) + passage
                                            + rng.choices(common, k=30))) for i in range(300)]
    found = suffix.repeated_passages(shipped.createDataFrame(rows, "doc_id long, text string"))
    firsts = {}
    for r in found.collect():
        firsts.setdefault(r["doc_id"] // 1000, []).append((r["doc_id"], r["first_doc_id"]))
    for size in (51, 60, 75):
        assert {d for d, _ in firsts[size]} == {size * 1000 + i for i in range(300)}
        assert {f for _, f in firsts[size]} == {size * 1000}


def test_suffix_spans_that_only_touch_are_not_one_passage(shipped):
    """A document between two others: those that share nothing aren't linked by it."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, f"x1 {one} y1"), (2, f"x2 {one} {two} y2"), (3, f"x3 {two} y3")]
    found = suffix.repeated_passages(shipped.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["first_doc_id"]) for r in found.collect()) == [
        (1, 60, 1), (2, 120, 1), (3, 60, 2)]


def test_queries(shipped, sf001, rows001):
    got = sorted(map(tuple, queries.op8_simhash(shipped, sf001).collect()), key=key)
    assert got == sorted(brute_simhash(rows001), key=key)
    got = queries.op10_substring_dedup(shipped, sf001)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_substring(rows001), key=key)


def between_crowds(seed, least=50, gram=25):
    """Two documents that share exactly ``least`` words, and 14 that share more on one side of
    their common anchor and too little on the other."""
    r = random.Random(seed)
    fresh = iter(f"u{seed}x{i}" for i in range(10**6))

    def unique(n):
        return [next(fresh) for _ in range(n)]
    while True:
        passage = unique(least)
        keys = window_hashes(word_hashes([w.encode() for w in passage]), gram)
        o = int(keys.argmin())
        if 3 < o < least - gram - 3:
            break
    a, b = unique(40) + passage + unique(40), unique(40) + passage + unique(40)
    docs = [a, b]
    for k in range(7):
        ahead = passage[o:] + a[40 + least:40 + least + (49 - (least - o))]
        docs.append(unique(30 + k) + ahead + unique(30))
        back = a[40 - (24 - o):40] + passage[:o + gram]
        docs.append(unique(30 + k) + back + unique(30))
    r.shuffle(docs)
    return [(i + 1, " ".join(w)) for i, w in enumerate(docs)], passage


def test_suffixes_between_crowds_of_longer_neighbours(shipped):
    """Neither order of the suffixes alone has the two owners side by side."""
    for seed in range(4):
        rows, passage = between_crowds(seed)
        got = suffix.repeated_passages(shipped.createDataFrame(rows, "doc_id long, text string"))
        owners = sorted(i for i, t in rows if " ".join(passage) in t)
        assert sorted((r["doc_id"], r["n_words"], r["first_doc_id"]) for r in got.collect()) == [
            (i, 50, owners[0]) for i in owners]


def overlapping(seed, n):
    """Documents of few words made of shared stretches, so that grams are crowded."""
    r = random.Random(seed)
    pool = [f"s{i}" for i in range(400)]

    def text():
        out = []
        for _ in range(r.randint(1, 3)):
            lo = r.randint(0, 300)
            out += [f"d{r.random()}" for _ in range(3)] + pool[lo:lo + r.randint(20, 90)]
        return " ".join(out)
    return [(i, text()) for i in range(n)]


def test_crowded_passages_equal_brute_force_word_for_word(shipped, monkeypatch):
    """In tasks and, of grams with many suffixes, by the windows."""
    rows = overlapping(1, 120)
    df = shipped.createDataFrame(rows, "doc_id long, text string")
    want = {i: sorted(w) for i, w in repeated(rows).items()}
    for crowd, chunk in ((4096, 20_000), (4096, 7), (5, 7)):
        monkeypatch.setattr(suffix, "CROWD", crowd)
        monkeypatch.setattr(suffix, "SORTED_ROWS", chunk)
        got = {}
        for r in suffix.repeated_passages(df).collect():
            got.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
        assert {i: sorted(w) for i, w in got.items()} == want


def suffix_rows(seed, n, least, gram, reach):
    """Suffixes of few grams with chance words before and after what they share."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        name = r.choice("abc")
        before = [f"{name}-{k}" for k in range(r.randint(0, reach))]
        after = [f"{name}{k}" for k in range(r.randint(gram, least))]
        before += [f"x{r.random()}" for _ in range(r.randint(0, reach - len(before)))]
        after += [f"y{r.random()}" for _ in range(r.randint(0, least - len(after)))]
        rows.append((i // 2, i // 2 + 100, 1000 * (i % 2 + 1), *(
            word_hashes([w.encode() for w in side])[:, 0].astype(">u4").tobytes()
            for side in (after, before))))
    return pd.DataFrame(rows, columns=suffix._NAMES).sort_values("after", ignore_index=True)


def shared_words(x, y):
    n = 0
    while n < min(len(x), len(y)) and x[n:n + 4] == y[n:n + 4]:
        n += 4
    return n // 4


def test_crowded_suffixes_give_a_row_per_widest_span_linked_as_all_pairs():
    least, gram, reach = 50, 25, 26
    for seed in range(3):
        rows = suffix_rows(seed, 160, least, gram, reach)
        spans, pairs = {}, []
        for i in range(len(rows)):
            for j in range(i):
                a, b = rows.iloc[i], rows.iloc[j]
                k, m = shared_words(a.before, b.before), shared_words(a.after, b.after)
                if a.text_no != b.text_no and m >= gram and k + m >= least:
                    spans.setdefault(i, set()).add((k, m))
                    spans.setdefault(j, set()).add((k, m))
                    pairs.append((i, j, k, m))
        widest = {i: {s for s in of if not any(
            t != s and t[0] >= s[0] and t[1] >= s[1] for t in of)} for i, of in spans.items()}
        root = {(i, s): (i, s) for i, of in widest.items() for s in of}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for i, j, k, m in pairs:
            held = [(x, s) for x in (i, j) for s in widest[x] if s[0] >= k and s[1] >= m]
            for x in held:
                root[find(x)] = find(held[0])
        for i, of in widest.items():        # spans of a text with ``least`` words in common
            for s in of:
                for t in of:
                    if min(s[0], t[0]) + min(s[1], t[1]) >= least:
                        root[find((i, s))] = find((i, t))
        want = {}
        for i, (k, m) in root:
            a = rows.iloc[i]
            want.setdefault(find((i, (k, m))), set()).add(
                (a.text_no, a.start - k, a.start + m))
        for size in (1000, 7):
            out = pd.concat(suffix._crowded((rows[i:i + size] for i in range(0, len(rows), size)),
                                            least, reach, gram))
            # a row per widest span (before: one per match)
            assert len(out) == len(root) and len(pairs) > 2 * len(out)
            # contents of spans that share ``least`` words are linked later, by their text
            linked = list(map(set, out.groupby("content").apply(
                lambda g: set(zip(g.text_no, g.from_word, g.to_word)), include_groups=False)))
            done = []
            for group in linked:
                near = [d for d in done if any(
                    t == u and min(q, w) - max(p, v) >= least
                    for t, p, q in group for u, v, w in d)]
                done = [d for d in done if d not in near] + [group.union(*near)]
            assert sorted(map(sorted, done)) == sorted(map(sorted, want.values()))


def test_hot_gram_of_repeated_words_gives_few_rows(shipped, monkeypatch):
    """Of a gram with many suffixes, also: a row for windows in a row, not one for each."""
    monkeypatch.setattr(suffix, "CROWD", 50)
    rows = [(i, " ".join([f"d{i}"] * 3 + ["to", "and"] * 120 + [f"e{i}"] * 3)) for i in range(12)]
    spans, counted = suffix._with_first, []

    def count(found, least):
        counted.append(found.count())
        return spans(found, least)
    monkeypatch.setattr(suffix, "_with_first", count)
    got = suffix.repeated_passages(shipped.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(i, 3, 243, 240, 0) for i in range(12)]
    # 12 texts of some 110 suffixes with 26 windows each
    assert counted[0] < 12 * 110 * 8
