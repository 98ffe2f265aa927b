"""Language identification, phrase collocations and the Merkle manifest against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from . import brute
from footfall.llm import language, manifest, phrases, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def corpus(n, seed, langs=("en", "de", None, "", "und")):
    """Texts over few words, with copies, nulls, odd characters and long pieces."""
    r = random.Random(seed)
    words = ["the", "of", "The", "ÄB", "a\x01", "a", "b", "\x00", "x\x0ey", "zz-z", "\U0001F600"]
    words += [f"w{i}" for i in range(20)]
    rows = []
    for i in range(n):
        lang = langs[min(int(r.expovariate(1.2)), len(langs) - 1)]
        text = "".join(
            r.choice(words[:8] if r.random() < 0.6 else words)
            + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "\x0b", "!"])
            for _ in range(r.choice([0, 1, 3, 40, 120])))
        rows.append((i // 2 if r.random() < 0.1 else i, r.choice(["s", None]), lang,
                     r.choice([len(text), None]), r.choice([text, text, text, None])))
    return rows + [rows[3], (None, None, None, None, None), (None, None, None, None, "the of a")]


@pytest.fixture(scope="module")
def mixed(shipped):
    rows = corpus(300, 5)
    df = shipped.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("tree", "row", "phrase", "n", "rank", "score", "pos", "witness")})
    return df.repartition(7), rows


# --- phrases ----------------------------------------------------------------------


def found_phrases(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,budget,bits,held", [
    (5, 1 << 18, 1 << 24, 400_000), (5, 20, 1 << 15, 50), (2, 5, 1 << 15, 400_000)])
def test_phrases_equal_brute_force(mixed, monkeypatch, least, budget, bits, held):
    """Also where nearly every prefix is extended, bitmaps are tiny and tasks pass on often."""
    df, rows = mixed
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "PAIRS_HELD", held)
    want = brute.collocations([(r[2], r[4]) for r in rows], least, 5, 25)
    assert len(want) > 20
    assert found_phrases(df, least=least, top=25, budget=budget, bits=bits) == want


def test_prefixes_that_outgrow_the_budget_are_extended(shipped, monkeypatch):
    """One phrase of five words and its parts are almost everything."""
    text = " ".join(["k l m n o"] * 200) + ". " + " ".join(f"v{i % 50}" for i in range(500))
    df = shipped.createDataFrame([("xx", text), ("xx", text), (None, "k l")],
                                 "lang string, text string")
    want = brute.collocations([("xx", text), ("xx", text), (None, "k l")], 10, 5, 2000)
    assert found_phrases(df, least=10, budget=8) == want
    assert any(r[3] > 350 and r[2].count(" ") == 4 for r in want)


def test_phrases_of_nothing(shipped, empty):
    assert found_phrases(empty) == []
    none = shipped.createDataFrame([(None, None), ("en", ""), ("en", " .\t. "), ("en", "one")],
                                   "lang string, text string")
    assert found_phrases(none, least=1) == []


def test_a_very_long_text_without_ends(shipped):
    text = " ".join(f"w{i * 7919 % 97}" for i in range(200_000)) + " " + "y" * 300_000
    df = shipped.createDataFrame([("en", text)], "lang string, text string")
    want = brute.collocations([("en", text)], 100, 5, 2000)
    assert found_phrases(df) == want and want


def test_scores_beyond_64_bits(shipped):
    """A product of 10^30 keeps every digit."""
    df = shipped.createDataFrame([(999_999_999_999, 999_999_999_989)], "a long, n long").selectExpr(
        "(cast(a as decimal(15,0)) * 1000 * cast(n as decimal(15,0)))"
        " div (cast(a as decimal(15,0)) * cast(7 as decimal(15,0))) as s")
    assert df.first()[0] == 1000 * 999_999_999_999 * 999_999_999_989 // (999_999_999_999 * 7)


def test_subtree_counts_only_its_own_nodes():
    leaves = [(b"a b", 1, 3), (b"a b c", 1, 2), (b"a bc d", 1, 9), (b"z y x", 2, 4),
              (b"z y", 2, 1)]
    assert sorted(phrases.subtree(leaves, 2)) == [
        (b"a b", 5), (b"a b c", 2), (b"a bc", 9), (b"a bc d", 9), (b"z y", 5), (b"z y x", 4)]
    assert phrases.subtree([(b"z y x", 3, 4)], 1) == [(b"z y x", 4)]


# --- manifest ---------------------------------------------------------------------


def found_manifest(df, bits):
    rows = manifest.manifest(df, bits=bits).collect()
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(r["witness"]))
                   for r in rows), key=str)


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_manifest_equals_brute_force(mixed, bits):
    """Whatever the size of a block, also with several rounds of blocks."""
    df, rows = mixed
    assert found_manifest(df, bits) == brute.manifest(rows)


def test_every_witness_folds_to_the_root_and_a_changed_row_does_not(mixed):
    df, _ = mixed
    rows = manifest.manifest(df, F.lit(True), bits=2).select(
        "leaf", "changed", "root", manifest.fold(F.col("leaf"), F.col("witness")).alias("own"),
        manifest.fold(F.col("changed"), F.col("witness")).alias("other")).collect()
    assert rows and all(r["own"] == r["root"] for r in rows)
    assert {(r["leaf"] == r["changed"]) == (r["other"] == r["root"]) for r in rows} == {True}
    assert any(r["other"] != r["root"] for r in rows)


def test_one_row_one_language_and_nothing(shipped):
    def frame(rows):
        return shipped.createDataFrame(rows, SCHEMA)
    assert found_manifest(frame([]), 3) == []
    one = [(1, "s", "en", 2, "ab")]
    got = found_manifest(frame(one), 3)
    assert got == brute.manifest(one) and got[0][1] == got[0][2] == got[0][3] and not got[0][4]
    # a repeated row, a very long text, the same text in two languages
    rows = one * 3 + [(2, None, "de", None, "x" * 3_000_000), (2, None, None, None, "")]
    assert found_manifest(frame(rows), 1) == brute.manifest(rows)


def test_partial_witnesses_grow_with_later_appends():
    f = manifest.Frontier()
    sizes = []
    for i in range(5):
        f.append(manifest.joined_hash(str(i)))
        sizes.append([len(w) for w in f.witnesses])
    assert sizes == [[0], [1, 1], [1, 1, 0], [2, 2, 2, 2], [2, 2, 2, 2, 0]]
    assert f.seal(3) == brute._tree([manifest.joined_hash(str(i)) for i in range(5)])[0]
    assert f.witnesses[4][:2] == ["-", "-"] and f.witnesses[4][2].startswith("L")


def test_manifest_query_verifies_all_but_the_changed_rows(shipped, sf001):
    rows = queries.QUERIES["op13_merkle_manifest"](shipped, sf001).collect()
    bad = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
    assert {r["doc_id"] for r in rows if not r["verified"]} == bad
    assert len({r["root"] for r in rows}) == 1


# --- language ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def spoken(shipped):
    rows = [(i, s, lang, n, t) for i, s, lang, n, t in corpus(120, 9)]
    rows += [(900, None, "en", 1, "İstanbul ΑΣ straße Ǆ1a2"), (901, None, "de", 1, "123 !? \U0001F600"),
             (902, None, None, 1, "never learned"), (903, None, "zz", 1, ""),
             (904, None, "fr", 1, "é" * 5000 + " " + "L'été" * 3000)]
    return shipped.createDataFrame(rows, SCHEMA).withColumns(
        {"gram": F.lit(1), "rank": F.lit(2), "distance": F.lit(3), "nearest": F.lit(4),
         "score": F.lit(5)}).repartition(5), rows


@pytest.mark.parametrize("size,per_block,piece", [(400, 200, 1 << 20), (30, 2, 64)])
def test_language_equals_brute_force(spoken, monkeypatch, size, per_block, piece):
    """Also with languages in several blocks and texts in pieces."""
    df, rows = spoken
    monkeypatch.setattr(language, "PIECE", piece)
    profiles = language.learn(df, size)
    plain = brute.language_profiles([(r[2], r[4]) for r in rows], size)
    got = language.predict(df, profiles, size, per_block)
    assert got.columns == ["doc_id", "source", "lang", "n_chars", "text", "gram", "rank",
                           "distance", "nearest", "lang_pred", "score"]
    for r in got.collect():
        want, score = brute.language(r["text"], plain, size)
        assert (r["lang_pred"], r["score"]) == (want, pytest.approx(score, abs=1e-12))


def test_counts_that_are_passed_on_often_are_the_same(spoken, monkeypatch):
    df, _ = spoken
    want = sorted(map(tuple, language.learn(df, 50).collect()))
    monkeypatch.setattr(language, "HELD", 10)
    monkeypatch.setattr(language, "HELD_DISTINCT", 20)
    assert sorted(map(tuple, language.learn(df, 50).collect())) == want


def test_a_word_longer_than_a_piece(monkeypatch):
    text = "ab" * 500 + " cd, " + "é" * 301 + ". x"
    whole = [x.tolist() for x in language.gram_counts(text)]
    monkeypatch.setattr(language, "PIECE", 7)
    assert [x.tolist() for x in language.gram_counts(text)] == whole
    assert len(language.gram_counts(None)[0]) == len(language.gram_counts("1 2")[0]) == 0


def test_nothing_learned(spoken, empty):
    df, _ = spoken
    nothing = language.learn(empty)
    assert {(r[0], r[1]) for r in language.predict(df, nothing).select(
        "lang_pred", "score").collect()} == {("und", 0.0)}
    assert language.predict(empty, nothing).count() == 0


def test_held_out_accuracy(shipped, sf001):
    """Languages of texts that weren't learned from; the ids' fold is the stated one."""
    got = queries.QUERIES["op11_language_id"](shipped, sf001)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    told = {r["doc_id"]: r["lang"] for r in shipped.read.parquet(
        f"{sf001}/documents.parquet").select("doc_id", "lang").collect()}
    rows = got.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    away = [r for r in rows if r["held_out"]]
    right = np.mean([r["lang_pred"] == told[r["doc_id"]] for r in away])
    assert len(away) > 20 and right >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
