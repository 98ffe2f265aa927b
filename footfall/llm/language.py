"""Language identification by rank-order profiles (operator 11).

The n-grams (one to three characters) of a text are those of its words: runs of letters, in
lower case, with a blank on either side.  A profile is the list of
the most frequent n-grams, most frequent first.  A language's profile comes from the counts over
all texts that are known to be in it; a text's profile is compared with each by the
out-of-place distance: how far an n-gram's rank is from its rank in the language, or
the longest distance where the language's profile lacks it, summed over the text's profile.

The counts are added up per task before the shuffle.  Languages are compared with in blocks of
``LANGS_PER_BLOCK``: a block's profiles have a fixed bound, so they go to the driver and the
tasks one block at a time.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and for every
text if nothing was learned; equal distances go to the language that is first by name; a row
whose id is null is held out; repeated rows count each; texts are read whole; extra columns
stay, but those called like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize

SIZE = 400                  # n-grams of a profile
LANGS_PER_BLOCK = 200
PIECE = 1 << 20             # characters of a long text that are looked at together
HELD = 4_000_000            # n-grams that a task holds before it adds them up
HELD_DISTINCT = 1_000_000   # different n-grams that a task holds before it passes them on
UNKNOWN = "und"
_RESULT = "distance double, lang string, score double"
_kinds: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point whether it is a letter, made once per process."""
    if not _kinds:
        _kinds.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _kinds[0]


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``PIECE`` characters that end behind a word."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        yield text[at:end]
        at = end


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, 21 bits for each character; empty without a letter."""
    codes = np.frombuffer((text.lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    # letters, and one blank before, between and after the words
    keep = letter | np.r_[False, letter[:-1]]
    if not keep.any():
        return np.zeros(0, np.uint64)
    line = np.r_[np.uint32(32), np.where(letter, codes, 32)[keep]].astype(np.uint64)
    two = line[:-1] << np.uint64(21) | line[1:]
    three = (two[:-1] << np.uint64(21) | line[2:])[line[1:-1] != 32]
    return np.concatenate([line[line != 32], two, three])


def _ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent keys, ties by key."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        chosen = counts >= least
        keys, counts = keys[chosen], counts[chosen]
    return keys[np.lexsort((keys, -counts))][:size]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    # integers below 2^53 stay exact
    return every, np.bincount(at, np.concatenate(counts), len(every)).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a text and how often each occurs."""
    parts = [np.unique(grams(p), return_counts=True) for p in _pieces(text or "")]
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _added([k for k, _ in parts], [n for _, n in parts])


def profile(text: str | None, size: int = SIZE) -> np.ndarray:
    return _ranked(*gram_counts(text), size)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of n-grams per language and task."""
    raw: dict[str, list[np.ndarray]] = {}
    done: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    held = 0

    def add_up() -> None:
        for lang, parts in raw.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            if lang in done:
                keys, counts = _added([done[lang][0], keys], [done[lang][1], counts])
            done[lang] = keys, counts
        raw.clear()

    def rows() -> Iterator[pd.DataFrame]:
        for lang, (keys, counts) in done.items():
            yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": counts})
        done.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            for piece in _pieces(text or ""):
                found = grams(piece)
                raw.setdefault(lang, []).append(found)
                held += len(found)
                if held >= HELD:
                    add_up()
                    held = 0
                    if sum(len(k) for k, _ in done.values()) >= HELD_DISTINCT:
                        yield from rows()
    add_up()
    yield from rows()


def learn(docs: DataFrame, size: int = SIZE, name: str = "profiles") -> DataFrame:
    """Profiles (lang, gram, rank) from all rows of ``docs`` (lang, text), written."""
    known = docs.where(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text")
    counts = known.mapInPandas(_count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    return materialize(counts.withColumn("rank", F.row_number().over(by_count) - 1)
                             .where(F.col("rank") < size).select("lang", "gram", "rank"), name)


def out_of_place(langs: list[str], profiles: list[np.ndarray], size: int):
    """A function of a text's profile: its distance to each language."""
    every = np.unique(np.concatenate(profiles))
    # a row for each n-gram, and a last one for those that no language has
    ranks = np.full((len(every) + 1, len(langs)), -1, np.int32)
    for k, grams_of in enumerate(profiles):
        ranks[np.searchsorted(every, grams_of), k] = np.arange(len(grams_of))

    def distances(found: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(every, found), len(every) - 1)
        at = np.where(every[at] == found, at, len(every))
        of = ranks[at]
        apart = np.abs(of - np.arange(len(found), dtype=np.int32)[:, None])
        return np.where(of < 0, size, apart).sum(axis=0, dtype=np.int64)
    return distances


def _best(langs: list[str], profiles: list[np.ndarray], size: int):
    """Column function: the nearest language of a block, null where there is no letter."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        distances = out_of_place(langs, profiles, size)
        for texts in batches:
            out = []
            for text in texts:
                found = profile(text, size)
                if not len(found):
                    out.append((None, None, None))
                    continue
                d = distances(found)
                k = int(d.argmin())
                worst = size * len(found)
                out.append((float(d[k]), langs[k], 1.0 - float(d[k]) / worst))
            yield pd.DataFrame(out, columns=["distance", "lang", "score"], index=texts.index)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, _RESULT).asNondeterministic()


def blocks(profiles: DataFrame, per_block: int = LANGS_PER_BLOCK
           ) -> Iterator[tuple[list[str], list[np.ndarray]]]:
    """The profiles of ``per_block`` languages at a time, by name; at most that many times
    ``SIZE`` rows are on the driver."""
    last = None
    while True:
        names = profiles.select("lang").distinct()
        if last is not None:
            names = names.where(F.col("lang") > last)
        names = [r[0] for r in names.orderBy("lang").limit(per_block).collect()]
        if not names:
            return
        rows = profiles.where(F.col("lang").between(names[0], names[-1])).toPandas()
        rows = rows.sort_values(["lang", "rank"])
        of = {k: g["gram"].to_numpy(np.int64).view(np.uint64) for k, g in rows.groupby("lang")}
        yield names, [of[n] for n in names]
        last = names[-1]


def predict(docs: DataFrame, profiles: DataFrame, size: int = SIZE,
            per_block: int = LANGS_PER_BLOCK, lang: str = "lang_pred", score: str = "score"
            ) -> DataFrame:
    """``docs`` (text, ...) with ``lang``, the nearest language, and ``score``, 0 to 1: one less
    the distance as a share of the greatest possible."""
    kept = [c for c in docs.columns if c not in (lang, score)]
    best = free_name(docs, "nearest")
    docs = docs.select(*kept, F.lit(None).cast(f"struct<{_RESULT}>").alias(best))
    waiting = False
    for names, found in blocks(profiles, per_block):
        if waiting:         # so that one block's profiles are held at a time
            docs = materialize(docs, "language-block")
        one = _best(names, found, size)(F.col("text"))
        docs = docs.withColumn(best, F.least(F.col(best), one))
        waiting = True
    return docs.select(*kept,
                       F.coalesce(F.col(best)["lang"], F.lit(UNKNOWN)).alias(lang),
                       F.coalesce(F.col(best)["score"], F.lit(0.0)).alias(score))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows kept from training: fold 0 of the id's hash; a null id is held out."""
    digest = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.when(doc_id.isNull(), F.lit(True)).otherwise(digest % folds == 0)
