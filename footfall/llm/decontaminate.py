"""Benchmark decontamination by pigeonhole edit matching (operator 3).

Texts are compared as words: lower case, runs of letters and digits; in scripts without
spaces between words (Chinese, Japanese, Thai and others) each character is a word.  A test
item of n words leaks into a document if some stretch of the document is at
most ``floor(rate * n)`` word edits (insert, drop, replace) from it.  An item
with e edits allowed is split into e + 1 pieces; whatever stretch leaks holds one
piece unchanged, so exact piece hits (one automaton for all pieces) find every
candidate, and Myers' bit-parallel distance verifies it around the hit.

A short item, of fewer than 1 / rate words, has no edit allowed and is found where it stands
word for word, be it one word or one character long.

The items are the stated query set.  They are taken in blocks of about ``block_bytes`` of
text; each block passes once over all documents, and only one block at a time is on
the driver and in the tasks.  Where there are several, the documents are written once and each
block's hits as narrow rows.

Defined results: null or empty texts match nothing, nor does an item without a letter or digit;
items repeated with the same id and text count once, those with other ids by their ids,
and a null item id is searched for like others; repeated documents are each reported; extra
columns are kept by ``mark_leaks``, but one that is called ``leaks`` is replaced; without items
or documents nothing leaks.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

RATE = 0.1
LEAST_WORDS = 1
BLOCK_BYTES = 8 << 20
LEAKS = "array<struct<item_id: long, distance: int, start_word: int, end_word: int>>"
_WORD = re.compile(r"[^\W_]+")
# Thai, Lao, Myanmar, Khmer, kana and Han, vowel signs and marks included
_UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1050-\u108f\u1780-\u17d3"
             "\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3400-\u4dbf"
             "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003fffd")
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD_OR_CHARACTER = re.compile(rf"[^\W_{_UNSPACED}]+|[{_UNSPACED}]")


def normal_words(text: str | None) -> list[str]:
    if not text:
        return []
    spaced = text.isascii() or not _HAS_UNSPACED.search(text)
    return (_WORD if spaced else _WORD_OR_CHARACTER).findall(text.lower())


def myers(pattern: list[str], words: list[str]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any stretch of ``words``, and the stretch's end.

    Bit-parallel over the pattern: one word of the text costs a few integer
    operations, with one bit per pattern word.  The first of equal ends counts.
    """
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, w in enumerate(pattern):
        masks[w] |= 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = every, 0, m
    best, end = m, 0
    for j, w in enumerate(words, 1):
        eq = masks.get(w, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (every & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # a match may begin anywhere, so nothing is carried into the lowest bit
        up, down = (up << 1) & every, (down << 1) & every
        plus = down | (every & ~((eq | minus) | up))
        minus = up & (eq | minus)
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, least_words: int):
        import ahocorasick

        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            words = normal_words(text)
            if len(words) < least_words:
                continue
            edits = math.floor(rate * len(words))
            number, cuts = len(self.items), [
                len(words) * i // (edits + 1) for i in range(edits + 2)]
            self.items.append((item_id, words, edits))
            for lo, hi in zip(cuts, cuts[1:]):
                pieces[" " + " ".join(words[lo:hi]) + " "].append((number, lo))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def leaks(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """Best match of each item that leaks into ``text``: id, distance, words from, to."""
        if self.empty or not text:
            return []
        words = normal_words(text)
        line = " " + " ".join(words) + " "
        around: dict[int, set[int]] = defaultdict(set)
        hits = [(end, size, places) for end, (size, places) in self.automaton.iter(line)]
        if not hits:
            return []
        begins: dict[int, int] = {}
        at = 0
        for i, w in enumerate(words):
            begins[at] = i
            at += len(w) + 1
        for end, size, places in hits:
            first = begins[end - size + 1]
            for number, offset in places:
                around[number].add(first - offset)
        out = []
        for number, shifts in around.items():
            item_id, pattern, edits = self.items[number]
            found = None
            for lo, hi in _spans(shifts, len(pattern), edits, len(words)):
                part = words[lo:hi]
                distance, end = myers(pattern, part)
                if distance <= edits and (found is None or distance < found[0]):
                    # the same distance read backwards gives the stretch's begin
                    _, back = myers(pattern[::-1], part[:end][::-1])
                    found = (distance, lo + end - back, lo + end)
            if found:
                out.append((item_id, *found))
        return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[2]))


def _spans(shifts: set[int], size: int, edits: int, n: int) -> list[tuple[int, int]]:
    """Stretches of the document where an item may lie, neighbours joined."""
    out: list[list[int]] = []
    for s in sorted(shifts):
        lo, hi = max(0, s - edits), min(n, s + size + edits)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _leaks_column(items: list[tuple[int | None, str]], rate: float, least_words: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items, rate, least_words)
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "distance", "start_word", "end_word"), x))
                              for x in matcher.leaks(t)] for t in texts], index=texts.index)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # nondeterministic to the planner, so that a filter on the result doesn't run it again
    return F.pandas_udf(run, LEAKS).asNondeterministic()


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES
                ) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_bytes``, one block at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text is not null").dropDuplicates()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        yield [(r["item_id"], r["text"]) for r in items.where(block == k).collect()]


def mark_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE,
               least_words: int = LEAST_WORDS, block_bytes: int = BLOCK_BYTES,
               name: str = "leaks") -> DataFrame:
    """``docs`` with ``name``: the items that leak into each text, best match of each."""
    blocks = item_blocks(benchmark, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.withColumn(name, _leaks_column(first, rate, least_words)(F.col("text")))
    row, held = free_name(docs, "leak_row"), free_name(docs, "leak_row_held")
    rows = materialize(docs.drop(name).withColumn(row, F.monotonically_increasing_id()), "leak-docs")
    hits = None
    for items in itertools.chain((first, second), blocks):
        found = rows.select(F.col(row).alias(held), _leaks_column(items, rate, least_words)(
            F.col("text")).alias("leaks"))
        part = materialize(found.where(F.size("leaks") > 0), "leak-hits")
        hits = part if hits is None else hits.union(part)
    whole = hits.groupBy(held).agg(F.sort_array(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    nothing = F.array().cast(LEAKS)
    return (rows.join(whole.withColumnRenamed("leaks", free_name(rows, "leaks_held")),
                      F.col(row) == F.col(held), "left")
                .withColumn(name, F.coalesce(free_name(rows, "leaks_held"), nothing))
                .select(*[c for c in docs.columns if c != name], name))


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, distance, start_word, end_word."""
    marked = mark_leaks(docs.select("doc_id", "text"), benchmark, **options)
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")



def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows into whose text an item leaks."""
    name = free_name(docs, "leaks")
    marked = mark_leaks(docs, benchmark, name=name, **options)
    return marked.where(F.size(name) == 0).select(*docs.columns)
