"""Best-fit packing by minimum bin slack (operator 4).

Documents become token pieces of at most ``capacity`` tokens.  Pieces of one
length are alike, so the plan needs only the number of pieces of each length: at
most ``capacity`` numbers, counted by Spark.  On these the driver fills bin after
bin: the longest piece left opens the bin, and a subset-sum dynamic programme
over the lengths left, its sums held as the bits of one integer, finds the
fullest feasible combination for the rest, which is removed.  The same
combination is used for as many bins as the counts allow, so the work depends on
the capacity and not on the number of documents.  Back in Spark each piece, by
its rank among the pieces of its length, reads off its bin and place.

Defined results: a null or empty text is the end token alone; repeated rows
are packed each; null ids are kept; an empty table gives no piece.  Other
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, with_rank

CAPACITY = 4096
END_TOKEN = 1
_CACHE_WORDS = 100_000      # strings that a worker remembers per generation; no effect on results


# Lines of printable ASCII, Latin letters and blanks only, which lower-casing and NFC treat
# character by character, and the pieces that the tokenizer's split rule cuts them into.
_PLAIN = re.compile(r"[ -~\tÀ-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class _Remembered(dict):
    """Ids of strings, found by ``find`` when first met, in two generations: what isn't met
    for a whole one is forgotten."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find
        self.before: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.before.get(key)
        if ids is None:
            ids = self.find(key)
        if len(self) >= _CACHE_WORDS:
            self.before = dict(self)
            self.clear()
        self[key] = ids
        return ids


class _Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    Only for a byte-level tokenizer that lower-cases and whose tokens never span white
    space.  A piece of a plain line goes to the tokenizer's model once while it is
    remembered; the words of other lines go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        # characters as the model spells their bytes
        self.spelt = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.pieces, self.words = _Remembered(self.piece_ids), _Remembered(self.word_ids)

    def piece_ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece.translate(self.spelt))]
                     ).tobytes()

    def word_ids(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def segments(self, text: str) -> list[tuple[_Remembered, list[str]]]:
        """Runs of the text's lines: their pieces, or their words."""
        special = any(t in text for t in self.specials)
        if not special and _PLAIN.fullmatch(text.replace("\n", " ")):
            return [(self.pieces, _PIECE.findall(text.lower()))]
        return [(self.pieces, _PIECE.findall(line.lower()))
                if not special and _PLAIN.fullmatch(line) else (self.words, line.split(" "))
                for line in text.split("\n")]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [b"".join([b"".join(map(kind.__getitem__, items))
                          for kind, items in self.segments(t)]) for t in texts]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    return _Encoder(path)


def _pieces(path: str, capacity: int, end_token: int):
    def run(texts: pd.Series) -> pd.Series:
        encode, size = _encoder(path), 4 * capacity
        end = np.asarray([end_token], dtype="<u4").tobytes()
        out = []
        for ids in encode([t if isinstance(t, str) else "" for t in texts]):
            ids += end
            out.append([{"start": lo // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                        for lo in range(0, len(ids), size) for part in (ids[lo:lo + size],)])
        return pd.Series(out, index=texts.index)
    return F.pandas_udf(run, "array<struct<start: long, length: long, ids_crc32: long>>")


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                 end_token: int = END_TOKEN) -> DataFrame:
    """``docs`` (doc_id, text) → one row per piece of at most ``capacity`` tokens.

    ``tokenizer`` is the path of a tokenizer file that every worker can read.
    """
    pieces = _pieces(tokenizer, capacity, end_token)(F.col("text"))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.posexplode(pieces).alias("piece", "p"))
                .select("doc_id", "piece", "p.*"))


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of ``lengths`` (descending), within ``counts``, that fills ``room`` most.

    Bit ``s`` of ``sums`` says that ``s`` can be reached.  Copies of a length are added
    in batches of 1, 2, 4, ... so that a length costs a logarithm of its count.
    """
    mask, full = (1 << (room + 1)) - 1, 1 << room
    sums, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        left, batch = min(counts[length], room // length), 1
        while left:
            take = min(batch, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            left -= take
            batch *= 2
            if sums & full:
                break
        if sums & full:
            break
    at, chosen = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[pd.DataFrame, int]:
    """Minimum bin slack over a histogram of lengths.

    Returns the slots (length, from_rank, copies, first_bin, offset, bins) and the number
    of bins: the pieces of that length ranked from ``from_rank`` fill, ``copies`` to
    each bin, ``bins`` bins from ``first_bin`` on, from ``offset`` in each.
    """
    counts = {k: v for k, v in counts.items() if v > 0}
    used = dict.fromkeys(counts, 0)
    lengths = sorted(counts, reverse=True)
    slots, bins = [], 0
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        chosen = fullest(counts, lengths, capacity - seed)
        counts[seed] += 1
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(counts[k] // n for k, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            slots.append((length, used[length], n, bins, offset, times))
            offset += length * n
            used[length] += n * times
            counts[length] -= n * times
        bins += times
        lengths = [k for k in lengths if counts[k]]
    return pd.DataFrame(slots, columns=["length", "from_rank", "copies", "first_bin", "offset",
                                        "bins"]), bins


def _place(slots: dict[int, tuple[np.ndarray, ...]]):
    """Read off each piece's bin and offset from its length and rank."""
    def run(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        rank = ranks.to_numpy()
        bins, offsets = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for length, rows in lengths.groupby(lengths.to_numpy()).indices.items():
            start, copies, first, offset = slots[length]
            k = np.searchsorted(start, rank[rows], side="right") - 1
            nth, copy = np.divmod(rank[rows] - start[k], copies[k])
            bins[rows] = first[k] + nth
            offsets[rows] = offset[k] + copy * length
        return pd.DataFrame({"sequence_id": bins, "offset": offsets}, index=lengths.index)
    return F.pandas_udf(run, "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_token: int = END_TOKEN
         ) -> DataFrame:
    """``docs`` → every piece with its ``sequence_id`` and ``offset``."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_token), "pieces")
    # at most ``capacity`` rows, whatever the input
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan, _ = plan_bins(histogram, capacity)
    # the plan's size depends on the capacity alone
    slots = {int(length): tuple(g[c].to_numpy(np.int64) for c in (
        "from_rank", "copies", "first_bin", "offset"))
        for length, g in plan.groupby("length")}
    placed = with_rank(pieces, ["length"], "rank").withColumn(
        "place", _place(slots)(F.col("length"), F.col("rank")))
    return placed.drop("rank").select(*pieces.columns, "place.*")
