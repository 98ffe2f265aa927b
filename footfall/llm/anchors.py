"""Content-selected anchors of texts: what both substring operators start from.

A text's anchors are the minimiser positions of its word n-grams.  Two texts
that share a stretch of ``gram + width - 1`` words share an anchor in it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_order, materialize, minimisers, window_hashes, word_hashes, words_of

_PROFILE = "n_words long, words_sha binary, anchor_hashes binary, anchor_starts binary"


def _profile(gram: int, width: int):
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = words_of(text)
            keys = window_hashes(word_hashes(words), gram)
            at = minimisers(keys, width)
            out.append((len(words), hashlib.sha256(b" ".join(words)).digest(),
                        keys[at].tobytes(), at.astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=["n_words", "words_sha", "anchor_hashes",
                                          "anchor_starts"], index=texts.index)
    return F.pandas_udf(run, _PROFILE)


def profile(docs: DataFrame, gram: int, width: int, name: str) -> DataFrame:
    """One narrow row per document, written: word count, digest of the words, anchors."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       id_order("doc_id").alias("doc_order"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("raw"),
                       _profile(gram, width)(F.col("text")).alias("p"))
    return materialize(rows.select("doc_id", "doc_order", "raw", "p.*"), name)


def distinct_texts(profiles: DataFrame, least_words: int, name: str) -> DataFrame:
    """One written row per distinct sequence of at least ``least_words`` words.

    Carries the smallest document with it (``first_order``) and a number
    ``text_no``.  Copies are folded before the shuffle, so a group of copies
    reaches a reducer as one row per map task.
    """
    one = (profiles.where(F.col("n_words") >= least_words).groupBy("words_sha")
                   .agg(F.min(F.struct("doc_order", "raw")).alias("_first"),
                        F.first("n_words").alias("n_words"),
                        F.first("anchor_hashes").alias("anchor_hashes"),
                        F.first("anchor_starts").alias("anchor_starts")))
    return materialize(one.select(
        F.monotonically_increasing_id().alias("text_no"), "words_sha",
        F.col("_first.doc_order").alias("first_order"), F.col("_first.raw").alias("raw"),
        "n_words", "anchor_hashes", "anchor_starts"), name)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``first_order``, ``raw``, ...) with the text of its document.

    Repeated rows of one document come out repeated; callers fold them by
    ``text_no``.  Two texts of one document whose hashes are equal are told
    apart by the callers through ``words_sha``.
    """
    t = docs.select(id_order("doc_id").alias("_order"),
                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("_raw"), "text")
    return (wanted.join(t, (F.col("first_order") == F.col("_order"))
                        & (F.col("raw") == F.col("_raw")))
                  .drop("_order", "_raw"))
