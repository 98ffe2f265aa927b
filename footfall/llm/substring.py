"""Substring dedup with a count-min prefilter (operator 10).

A window is ``window`` consecutive words.  Each word covered by a window whose
word sequence also starts in a document with a smaller id is removed.

1. Every text gets anchors: the minimisers of its ``window // 2``-word grams, chosen
   so that every window holds at least one.  An anchor occurs at least as often
   as any window that it stands for, so counting anchors overestimates windows
   and loses none, at about a fourteenth of the rows.
2. Each task sketches its anchors: per hash range, the counters of ``depth`` rows
   of a count-min sketch, saturated at two.  The partition sketches of a range
   are added up; what is kept is one bit per counter, "two or more".
3. Anchors meet the merged sketch of their range and survive if all their
   counters say "two or more".
4. Only windows holding a surviving anchor are hashed (128 bits) and grouped
   exactly, giving the smallest document of each; the rest follows from joins.

Defined results: a null text has no words; a document without a full window
loses nothing; a null id counts as greater than every other, and rows with equal
ids are one document, so they remove nothing from each other; other columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import materialize, mix, partitions, window_hashes, word_hashes, words_of

WINDOW = 50
DEPTH = 3                   # rows of the sketch
RANGE_ANCHORS = 1 << 16     # anchors expected in one hash range
TASK_ANCHORS = 400_000      # anchors that a task sketches at a time
CELLS = 1 << 18             # counters in each row of a range's sketch
_SALTS = tuple(np.uint64(s) for s in (
    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))

_BLOB = "bucket int, cells_once binary, cells_more binary, hashes binary, owners binary, " \
        "starts binary"


def _cells(hashes: np.ndarray, depth: int, cells: int) -> np.ndarray:
    """Counter numbers of each hash, one column per row of the sketch."""
    return np.stack([(mix(hashes ^ _SALTS[d]) % np.uint64(cells)).astype(np.int64) + d * cells
                     for d in range(depth)], axis=1) if len(hashes) else np.zeros(
                         (0, depth), np.int64)


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches joined until they hold ``TASK_ANCHORS`` anchors."""
    held, anchors_held = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            anchors_held += sum(map(len, batch["anchor_starts"])) // 4
        if anchors_held >= TASK_ANCHORS:
            yield pd.concat(held, ignore_index=True)
            held, anchors_held = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _sketch_rows(batches: Iterator[pd.DataFrame], ranges: int, depth: int, cells: int
                 ) -> Iterator[pd.DataFrame]:
    """Per task and hash range: the partition's sketch, and the anchors for the later lookup.

    A task emits after ``TASK_ANCHORS`` anchors, so that its memory is bounded.
    """
    for batch in _gathered(batches):
        counts = np.array([len(b) // 4 for b in batch["anchor_starts"]])
        hashes = np.frombuffer(b"".join(batch["anchor_hashes"]), np.uint64)
        starts = np.frombuffer(b"".join(batch["anchor_starts"]), np.int32)
        owners = np.repeat(batch["text_no"].to_numpy(np.int64), counts)
        # an anchor counts once per text
        order = np.lexsort((owners, hashes))
        hashes, starts, owners = hashes[order], starts[order], owners[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        bucket = (mix(hashes) % np.uint64(ranges)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        hashes, starts, owners, fresh, bucket = (
            x[order] for x in (hashes, starts, owners, fresh, bucket))
        edges = np.flatnonzero(np.diff(bucket)) + 1
        out = []
        for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(bucket)]):
            if lo == hi:
                continue
            cell, n = np.unique(_cells(hashes[lo:hi][fresh[lo:hi]], depth, cells),
                                return_counts=True)
            out.append((bucket[lo], cell[n == 1].astype(np.int32).tobytes(),
                        cell[n > 1].astype(np.int32).tobytes(), hashes[lo:hi].tobytes(),
                        owners[lo:hi].tobytes(), starts[lo:hi].tobytes()))
        yield pd.DataFrame(out, columns=["bucket", "cells_once", "cells_more", "hashes",
                                         "owners", "starts"])


def _merge(group: pd.DataFrame, depth: int, cells: int) -> pd.DataFrame:
    """Add the partition sketches of one range; keep which counters reach two."""
    total = np.zeros(depth * cells, np.uint8)
    for once in group["cells_once"]:
        at = np.frombuffer(once, np.int32)
        total[at] = np.minimum(total[at] + 1, 2)
    for more in group["cells_more"]:
        total[np.frombuffer(more, np.int32)] = 2
    return pd.DataFrame({"range": [group["bucket"].iloc[0]],
                         "repeated": [np.packbits(total >= 2).tobytes()]})


def _lookup(batches: Iterator[pd.DataFrame], depth: int, cells: int) -> Iterator[pd.DataFrame]:
    """Anchors whose every counter reached two."""
    for batch in batches:
        for hashes, owners, starts, repeated in zip(
                batch["hashes"], batch["owners"], batch["starts"], batch["repeated"]):
            bits = np.unpackbits(np.frombuffer(repeated, np.uint8))
            keep = bits[_cells(np.frombuffer(hashes, np.uint64), depth, cells)].all(axis=1)
            if keep.any():
                yield pd.DataFrame({"text_no": np.frombuffer(owners, np.int64)[keep],
                                    "start": np.frombuffer(starts, np.int32)[keep]})


def _windows(batches: Iterator[pd.DataFrame], window: int, gram: int) -> Iterator[pd.DataFrame]:
    """The windows that hold an estimated-repeated anchor, with 128-bit hashes."""
    width = window - gram + 1
    for batch in batches:
        for text_no, first_order, sha, text, starts in zip(
                batch["text_no"], batch["first_order"], batch["words_sha"], batch["text"],
                batch["starts"]):
            words = words_of(text)
            if hashlib.sha256(b" ".join(words)).digest() != sha:
                continue
            hashes = word_hashes(words)
            keys = window_hashes(hashes, gram)
            flagged = np.zeros(len(keys), bool)
            flagged[np.asarray(starts, np.int64)] = True
            # a window's anchor is the least gram inside it
            view = np.lib.stride_tricks.sliding_window_view(keys, width)
            at = np.flatnonzero(flagged[view.argmin(axis=1) + np.arange(len(view))])
            if len(at):
                yield pd.DataFrame({
                    "w1": window_hashes(hashes, window, 0)[at].view(np.int64),
                    "w2": window_hashes(hashes, window, 1)[at].view(np.int64),
                    "text_no": text_no, "doc_order": first_order, "start": at.astype(np.int32)})


def _cut(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Remove the covered words of each text."""
    for batch in batches:
        out = []
        for text_no, sha, text, starts in zip(batch["text_no"], batch["words_sha"],
                                              batch["text"], batch["cut"]):
            words = words_of(text)
            if hashlib.sha256(b" ".join(words)).digest() != sha:
                continue
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, np.asarray(starts, np.int64), 1)
            np.add.at(edge, np.asarray(starts, np.int64) + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = b" ".join(w for w, g in zip(words, gone) if not g)
            out.append((text_no, int(gone.sum()), kept.decode("utf-8", "replace")))
        if out:
            yield pd.DataFrame(out, columns=["text_no", "n_cut", "kept"])


def repeated_windows(texts: DataFrame, ranges: int, depth: int = DEPTH, cells: int = CELLS
                     ) -> DataFrame:
    """Anchors (``text_no``, ``start``) that the merged sketches estimate as repeated."""
    blobs = materialize(texts.select("text_no", "anchor_hashes", "anchor_starts").mapInPandas(
        partial(_sketch_rows, ranges=ranges, depth=depth, cells=cells), _BLOB), "sketches")
    merged = blobs.groupBy("bucket").applyInPandas(
        lambda group: _merge(group, depth, cells), "range int, repeated binary")
    met = blobs.select("bucket", "hashes", "owners", "starts").join(
        merged, F.col("bucket") == F.col("range"))
    return met.select("hashes", "owners", "starts", "repeated").mapInPandas(
        partial(_lookup, depth=depth, cells=cells), "text_no long, start int")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text) → doc_id, n_words, n_removed, kept (text left), per row.

    ``kept`` is null where nothing was removed: the text stays as it is.
    ``words_sha`` is the SHA-256 of all words, joined by one space.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    gram = max(1, window // 2)
    profiles = anchors.profile(docs, gram, window - gram + 1, "profiles")
    texts = anchors.distinct_texts(profiles, window, "texts")
    n = texts.agg(F.sum(F.length("anchor_starts"))).first()[0] or 0
    ranges = max(partitions(spark), math.ceil(n / 4 / RANGE_ANCHORS))
    hits = repeated_windows(texts, ranges).groupBy("text_no").agg(
        F.collect_list("start").alias("starts"))
    wanted = texts.select("text_no", "first_order", "raw", "words_sha").join(hits, "text_no")
    # the candidates' texts, written once for the two passes over them
    found = materialize(anchors.texts_of(docs, wanted), "candidates")
    windows = found.select("text_no", "first_order", "words_sha", "text", "starts").mapInPandas(
        partial(_windows, window=window, gram=gram),
        "w1 long, w2 long, text_no long, doc_order long, start int")
    # written, so that a window of very many documents can be split in the join
    first = materialize(windows.groupBy("w1", "w2")
                        .agg(F.min("doc_order").alias("least"), F.max("doc_order").alias("most"))
                        .where("least < most").drop("most"), "repeated-windows")
    cuts = (windows.join(first, ["w1", "w2"]).where("doc_order > least")
                   .groupBy("text_no").agg(F.collect_set("start").alias("cut")))
    done = (found.select("text_no", "words_sha", "text").join(cuts, "text_no")
                 .mapInPandas(partial(_cut, window=window),
                              "text_no long, n_cut long, kept string")
                 .dropDuplicates(["text_no"]))
    firsts = (texts.select("text_no", "first_order", F.col("words_sha").alias("sha"))
                   .join(done, "text_no", "left").drop("text_no"))
    copy = F.col("doc_order") > F.col("first_order")
    return (profiles.select("doc_id", "doc_order", "n_words", "words_sha")
                    .join(firsts, F.col("words_sha") == F.col("sha"), "left")
                    .select("doc_id", "n_words",
                            F.when(copy, F.col("n_words"))
                             .otherwise(F.coalesce("n_cut", F.lit(0))).cast("long")
                             .alias("n_removed"),
                            F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
                            F.lower(F.hex("words_sha")).alias("words_sha")))
