"""Suffix-array dedup with sparse suffix arrays (operator 6).

A suffix is a text from some word on.  Only suffixes that begin at an anchor (a
minimiser of the ``gram``-word grams) are retained, and of these only such whose
anchor is estimated to occur twice (the sketch of ``substring``, which loses
none).  A retained suffix is held by the words after its start and, reversed, the
words before it, as 32-bit word hashes, as far as a match of ``least`` words
needs: further words belong to the next anchors.

The suffixes are sorted over the whole cluster by range partitioning, those of one
gram (the first words) in one task.  Suffixes are compared with their nearest neighbours of
other texts on both sides, the match is extended right and left,
and matches of ``least`` words or more become spans.  Spans of a text that touch are
joined.  The spans of a passage are linked over texts, and the components tell
the smallest of its documents.

A shared passage of ``least`` words holds an anchor among its first words: two owners
share some l words before the anchor's suffix and the rest of the passage after it.  Where only two
suffixes begin with the same gram they are neighbours.  Where there are more, others that
share more on one side and less on the other may stand between two owners.  The suffixes of a gram
are therefore sorted for every l, by the l words before, then by what
follows: whatever stands between two owners now shares the passage with both.  (Of these
neighbours, those that share just l words before are compared; those that share more are
met again for a greater l.)  Of the spans at a suffix those inside others are left out, and the
matches among one gram's suffixes are linked where they are found: a row per
span, not per match, leaves the task.

Up to ``CROWD`` suffixes of one gram meet in one task for this.  Those of a gram with more
are sorted by what follows, then what precedes, over any number of tasks, and compared with their
neighbours, also across partition borders; and the
windows of ``least`` words around each suffix are grouped by content, so that no group of
equal suffixes has to meet in one task.

Documents with the same words are one text here, listed as whole-document spans.

Defined results: null, empty and short texts have no span; a null id counts as
greater than every other; rows with equal ids and texts are listed each; repeats
inside one document alone aren't reported; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import anchors
from .common import LAST_ID, materialize, partitions, word_hashes, words_of
from .components import components
from .substring import RANGE_ANCHORS, repeated_windows

LEAST = 50
CROWD = 1 << 16             # suffixes of one gram that a task takes together
SORTED_ROWS = 6000          # suffixes of whole grams that are sorted at a time
HELD_SUFFIXES = 1 << 14     # suffixes that are written together
PAIRS = 20_000              # pairs of suffixes that are compared at a time
MOST_HOT = 100_000          # grams of more suffixes that are broadcast; beyond, they are joined
_SUFFIX = "text_no long, doc_order long, start int, after binary, before binary"
_PAIR = _SUFFIX + ", border int, place int, partition int, from_word int, to_word int, " \
                 "content binary"
_NAMES = ["text_no", "doc_order", "start", "after", "before"]
_FOUND = "text_no long, doc_order long, from_word int, to_word int, content binary"
_SPAN = ["text_no", "doc_order", "from_word", "to_word", "content"]


def _suffixes(batches: Iterator[pd.DataFrame], least: int, reach: int) -> Iterator[pd.DataFrame]:
    """The retained suffixes of each text, with ``least`` words after and ``reach`` before."""
    def packed() -> pd.DataFrame:
        numbers, orders, starts = zip(*heads)
        sizes = [len(x) for x in starts]
        return pd.DataFrame({
            "text_no": np.repeat(numbers, sizes), "doc_order": np.repeat(orders, sizes),
            "start": np.concatenate(starts).astype(np.int32), "after": after, "before": before})

    heads, after, before = [], [], []
    for batch in batches:
        for text_no, order, sha, text, starts in zip(
                batch["text_no"], batch["first_order"], batch["words_sha"], batch["text"],
                batch["starts"]):
            words = words_of(text)
            if hashlib.sha256(b" ".join(words)).digest() != sha:
                continue
            codes = word_hashes(words)[:, 0].astype(">u4")
            back, n = codes[::-1].tobytes(), len(codes)
            ahead = codes.tobytes()
            at = np.unique(np.asarray(starts, np.int64))
            heads.append((text_no, order, at))
            for p in at.tolist():
                after.append(ahead[4 * p:4 * (p + least)])
                before.append(back[4 * (n - p):4 * (n - p + reach)])
            if len(after) >= HELD_SUFFIXES:
                yield packed()
                heads, after, before = [], [], []
    if heads:
        yield packed()


def _grid(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes in rows of ``width``, and how many each row really has; hashes are
    compared, not ordered."""
    grid = np.frombuffer(b"".join(x.ljust(4 * width, b"\0") for x in words), np.uint32)
    return grid.reshape(len(words), width), np.array([len(x) // 4 for x in words])


def _common(a: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that rows ``i`` and ``j`` share from the first on."""
    grid, sizes = a
    differ = grid[i] != grid[j]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), grid.shape[1])
    return np.minimum(lcp, np.minimum(sizes[i], sizes[j]))


def _runs(texts: np.ndarray) -> np.ndarray:
    """Where runs of one text begin, and the end."""
    return np.r_[0, np.flatnonzero(texts[1:] != texts[:-1]) + 1, len(texts)]


def _adjacent(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of sorted suffixes beside those of their nearest neighbours of other texts."""
    edges = _runs(texts)
    run = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    every = np.arange(len(texts))
    above, below = edges[run] - 1, edges[run + 1]
    return (np.concatenate([every[above >= 0], every[below < len(texts)]]),
            np.concatenate([above[above >= 0], below[below < len(texts)]]))


def _matches(rows: pd.DataFrame, i: np.ndarray, j: np.ndarray, least: int, reach: int
             ) -> pd.DataFrame:
    """Both sides of every match of ``least`` words between the rows ``i`` and ``j``."""
    texts, starts = rows["text_no"].to_numpy(np.int64), rows["start"].to_numpy(np.int64)
    out = []
    if len(i):
        after, before = list(rows["after"]), list(rows["before"])
        right = _common(_grid(after, least), i, j)
        left = _common(_grid(before, reach), i, j)
        orders = rows["doc_order"].to_numpy(np.int64)
        for x in np.flatnonzero(right + left >= least).tolist():
            a, r, k = int(i[x]), int(right[x]), int(left[x])
            content = xxhash.xxh3_128_digest(before[a][:4 * k] + b"|" + after[a][:4 * r])
            for y in (a, int(j[x])):
                out.append((texts[y], orders[y], starts[y] - k, starts[y] + r, content))
    return pd.DataFrame(out, columns=_SPAN).drop_duplicates()


def _spans(rows: pd.DataFrame, least: int, reach: int) -> pd.DataFrame:
    """Both sides of every match of ``least`` words between a suffix and its nearest
    neighbours of other texts, before and after it."""
    i, j = _adjacent(rows["text_no"].to_numpy(np.int64))
    return _matches(rows, i, j, least, reach)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of ``n`` nodes reaches over the edges ``a``-``b``."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (above := root[root])).any():
            root = above


def _linked(rows: pd.DataFrame, before: tuple[np.ndarray, np.ndarray], pairs: np.ndarray,
            least: int, reach: int) -> pd.DataFrame:
    """The spans of the suffixes whose pairs (i * n + j) match in ``least`` words, but those
    inside another span of the same suffix; spans that matches link have the same content.

    A span inside another shares ``least`` words with it, so its links are the other's.
    """
    n, after = len(rows), _grid(list(rows["after"]), least)
    met = []
    for lo in range(0, len(pairs), PAIRS):
        i, j = pairs[lo:lo + PAIRS] // n, pairs[lo:lo + PAIRS] % n
        right, left = _common(after, i, j), _common(before, i, j)
        far = right + left >= least
        # by suffix, then the longest before, then the longest after
        rest = (reach - left[far]) * (least + 1) + least - right[far]
        width = (reach + 1) * (least + 1)
        met.append(np.stack([i[far] * width + rest, j[far] * width + rest]))
    ends, of = np.unique(np.concatenate(met, axis=1), return_inverse=True)
    if not len(ends):
        return pd.DataFrame({c: [] for c in _SPAN})
    right = least - ends % (least + 1)
    at, left = np.divmod(ends // (least + 1), reach + 1)
    left = reach - left
    reached = at * (least + 1) + right
    whole = np.r_[True, reached[1:] > np.maximum.accumulate(reached)[:-1]]
    a, b = (np.cumsum(whole) - 1)[of.reshape(2, -1)]
    at, left, right = at[whole], left[whole], right[whole]
    texts, orders, starts = (rows[c].to_numpy(np.int64)[at]
                             for c in ("text_no", "doc_order", "start"))
    # the first span of the linked ones stands for them
    names = np.stack([texts, starts - left, starts + right, starts], axis=1).astype(">i8")
    packed, size = names.tobytes(), names.itemsize * names.shape[1]
    return pd.DataFrame({
        "text_no": texts, "doc_order": orders, "from_word": starts - left,
        "to_word": starts + right,
        "content": [packed[size * x:size * (x + 1)] for x in _roots(len(at), a, b).tolist()]})


def _crowded(batches: Iterator[pd.DataFrame], least: int, reach: int, gram: int
             ) -> Iterator[pd.DataFrame]:
    """Spans of suffixes in order of what follows: sorted for every number of words before."""
    def compare(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        grams = np.array([a[:4 * gram] for a in rows["after"]], object)
        same = np.cumsum(np.r_[False, grams[1:] != grams[:-1]])
        texts, before = rows["text_no"].to_numpy(np.int64), _grid(list(rows["before"]), reach)
        n, live, pairs = len(rows), np.arange(len(rows)), []
        for words in range(reach + 1):
            if words:
                # equal words before the suffix; within these, the order by what follows
                key = same << 32 | before[0][live, words - 1].astype(np.int64)
                order = np.argsort(key, kind="stable")
                live, key = live[order], key[order]
                same = np.cumsum(np.r_[False, key[1:] != key[:-1]])
            first = _runs(same)[:-1]
            of = texts[live]
            several = (np.minimum.reduceat(of, first) != np.maximum.reduceat(of, first))
            several = np.repeat(several, np.diff(np.r_[first, len(of)]))
            live, same = live[several], same[several]       # others have no partner left
            if not len(live):
                break
            i, j = _adjacent(texts[live])
            met = same[i] == same[j]
            i, j = live[i[met]], live[j[met]]
            if words < reach:
                # pairs that share more words before are neighbours, or linked, in that order
                x, y = before[0][i, words], before[0][j, words]
                apart = (x != y) | (x == 0)
                i, j = i[apart], j[apart]
            pairs.append(np.unique(np.minimum(i, j) * n + np.maximum(i, j)))
        if pairs and len(pairs := np.unique(np.concatenate(pairs))):
            yield _linked(rows, before, pairs, least, reach)

    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += len(batch)
        if size < SORTED_ROWS:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = rows["after"].iloc[-1][:4 * gram]
        begin = len(rows)
        while begin and rows["after"].iat[begin - 1][:4 * gram] == last:
            begin -= 1
        if begin:       # the last gram's suffixes may go on
            yield from compare(rows.iloc[:begin].reset_index(drop=True))
        held, size = [rows.iloc[begin:]], len(rows) - begin
    if size:
        yield from compare(pd.concat(held, ignore_index=True))


def suffix_spans(suffixes: DataFrame, least: int, reach: int, gram: int) -> DataFrame:
    """Sort ``suffixes`` over the cluster and compare neighbours."""
    spark = suffixes.sparkSession
    # grams that share a hash count together, which may put them among the hot ones for nothing
    key = F.xxhash64(F.substring("after", 1, 4 * gram))
    hot = materialize(suffixes.groupBy(key.alias("hot")).agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > CROWD).select("hot"), "hot-grams")
    n_hot = hot.count()
    if n_hot <= MOST_HOT:
        hot = F.broadcast(hot)
    is_hot = key == F.col("hot")
    few = suffixes.join(hot, is_hot, "left_anti") if n_hot else suffixes
    found = few.repartitionByRange(partitions(spark), F.substring("after", 1, 4 * gram)
                                   ).sortWithinPartitions("after").select(*_NAMES).mapInPandas(
        partial(_crowded, least=least, reach=reach, gram=gram), _FOUND)
    if not n_hot:
        return found
    rows = suffixes.join(hot, is_hot, "left_semi")
    found = found.union(neighbour_spans(rows, ["after", "before"], least, reach, "by-after"))
    return found.union(window_spans(rows, least, gram)).distinct()


def window_spans(rows: DataFrame, least: int, gram: int) -> DataFrame:
    """Matches of suffixes with one that shares a window: the windows of ``least`` words around each
    suffix are grouped by content and place, and those in a row with the same chosen suffix are
    one match with it.  The one of the least hash is chosen, as that is the same one for
    most windows also where a text repeats few words for long."""
    l, before = F.col("l"), F.expr("substring(before, 1, 4 * l)")
    window = F.sha2(F.concat(before, F.expr(f"substring(after, 1, 4 * ({least} - l))")), 256)
    many = rows.select(
        "text_no", "doc_order", "start", "before", "after",
        F.explode(F.sequence(F.lit(0), F.lit(least - gram))).alias("l")).where(
        (F.length("before") >= 4 * l) & (F.length("after") >= 4 * (least - l))).select(
        "text_no", "doc_order", "start", "l",
        F.unhex(F.substring(window, 1, 32)).alias("content"))
    shared = materialize(many.groupBy("content", "l").agg(
        F.min(F.struct(F.xxhash64("text_no", "start").alias("by"), "text_no", "start",
                       "doc_order")).alias("first"),
        F.min("text_no").alias("least_text"), F.max("text_no").alias("last_text"))
        .where("least_text < last_text").select(
        F.col("content").alias("same"), F.col("l").alias("words"), "first"), "crowd-windows")
    met = many.join(shared, (F.col("content") == F.col("same")) & (l == F.col("words"))).where(
        (F.col("text_no") != F.col("first.text_no")) | (F.col("start") != F.col("first.start")))
    # of one text with the chosen: window by window, as others may share just one of them
    place = F.dense_rank().over(Window.partitionBy("text_no", "start", "first").orderBy("l"))
    runs = materialize(
        met.withColumn("run", F.when(F.col("text_no") == F.col("first.text_no"), l)
                               .otherwise(l - place))
           .groupBy("text_no", "doc_order", "start", "first", "run")
           .agg(F.min("l").alias("lo"), F.max("l").alias("hi")), "crowd-runs")
    match = F.concat_ws(",", "first.text_no", "first.start", "lo", "hi")
    side = ["lo", "hi", F.unhex(F.substring(F.sha2(match, 256), 1, 32)).alias("content")]
    sides = runs.select("text_no", "doc_order", "start", *side).union(
        runs.select("first.text_no", "first.doc_order", "first.start", *side).distinct())
    return sides.select(
        "text_no", "doc_order", (F.col("start") - F.col("hi")).cast("int").alias("from_word"),
        (F.col("start") - F.col("lo") + least).cast("int").alias("to_word"), "content")


def _neighbours(batches: Iterator[pd.DataFrame], least: int, reach: int
                ) -> Iterator[pd.DataFrame]:
    """Spans of a sorted partition, and the suffixes at its ends for the borders: the run of
    one text at each end and the row beyond it."""
    columns = [c.split()[0] for c in _PAIR.split(", ")]
    task = TaskContext.get().partitionId()

    def border(rows: pd.DataFrame, side: int) -> pd.DataFrame:
        return rows.assign(border=side, place=np.arange(len(rows)), partition=task).reindex(
            columns=columns)

    rows, lead = None, None     # the last run and the row before it; rows of the first run
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rows is None else pd.concat([rows, batch], ignore_index=True)
        edges = _runs(rows["text_no"].to_numpy(np.int64))
        if lead is None and len(edges) > 2:
            lead = rows.iloc[:edges[1] + 1]
            yield border(lead, 0)
        found = _spans(rows, least, reach)
        if len(found):
            yield found.reindex(columns=columns)
        rows = rows.iloc[max(0, edges[-2] - 1):]
    if rows is not None:
        if lead is None:
            yield border(rows, 0)
        yield border(rows, 1)


def neighbour_spans(suffixes: DataFrame, order: list[str], least: int, reach: int, name: str
                    ) -> DataFrame:
    """Sort ``suffixes`` by ``order`` over the cluster and compare neighbours."""
    spark = suffixes.sparkSession
    keys = [F.expr(c) for c in [*order, "doc_order", "text_no", "start"]]
    ordered = suffixes.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    met = materialize(ordered.mapInPandas(
        partial(_neighbours, least=least, reach=reach), _PAIR), name)
    ends = met.where("border is not null")
    # one number for each partition that has rows
    filled = sorted(r[0] for r in ends.select("partition").distinct().collect())
    follows = spark.createDataFrame(list(zip(filled, filled[1:])), "partition int, next int")
    # the end of one partition and the beginning of the next: two texts' suffixes at most
    meeting = ends.where("border = 1").join(F.broadcast(follows), "partition").select(
        F.col("next").alias("at"), "border", "place", *_NAMES).union(
        ends.where("border = 0").select(F.col("partition").alias("at"), "border", "place",
                                        *_NAMES))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values(["border", "place"], ascending=[False, True])
        return _spans(rows[_NAMES].reset_index(drop=True), least, reach)

    across = meeting.groupBy("at").applyInPandas(compare, _FOUND)
    inside = met.where("content is not null").select(
        "text_no", "doc_order", "from_word", "to_word", "content")
    return inside.union(across)


def _joined(spans: DataFrame) -> DataFrame:
    """Spans (text_no, from_word, to_word, least) of a text that overlap or touch become one."""
    order = Window.partitionBy("text_no").orderBy("from_word", "to_word")
    before = F.max("to_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("from_word") > before), F.col("from_word"))
    first = F.last("begins", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (spans.withColumn("begins", begins).withColumn("first", first)
                 .groupBy("text_no", F.col("first").alias("from_word"))
                 .agg(F.max("to_word").alias("to_word"), F.min("least").alias("least")))


def _with_first(spans: DataFrame, least: int) -> DataFrame:
    """``spans`` with ``least``: the smallest document that a span's passage is linked to.

    Spans of one text that share ``least`` words or more hold a common passage and are one
    node; the two sides of a match have the same content.  The chance words around a
    passage differ from match to match, so its owners are linked over several contents.
    """
    order = Window.partitionBy("text_no").orderBy("from_word", "to_word", "content")
    before = F.max("to_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("from_word") + least > before), F.col("from_word"))
    core = F.last("begins", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # nodes are ordered by document, so a component's root has the smallest
    nodes = materialize(
        spans.withColumn("begins", begins).withColumn("core", core)
             .select("text_no", "from_word", "to_word", "content",
                     F.struct("doc_order", "text_no", "core").alias("span_node")), "span-nodes")
    # written, so that the spans of a passage of very many documents can be split in the join
    hubs = materialize(nodes.groupBy("content").agg(F.min("span_node").alias("hub")), "passages")
    edges = (nodes.select("content", "span_node").distinct().join(hubs, "content")
                  .select(F.col("span_node").alias("a"), F.col("hub").alias("b")))
    # written for the same reason; a span has a partner, so every node has an edge
    roots = materialize(components(edges), "span-roots")
    return nodes.join(roots, F.col("span_node") == F.col("node")).select(
        "text_no", "from_word", "to_word", F.col("root.doc_order").alias("least"))


def repeated_passages(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` (doc_id, text) → doc_id, start_word, end_word, n_words, first_doc_id.

    One row for each maximal passage of at least ``least`` words that stands in
    another document too; ``first_doc_id`` is the smallest document that shares some of
    it, directly or over matches that have ``least`` words in common, so the row with
    ``doc_id = first_doc_id`` is the copy to keep.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    gram = max(1, least // 2)
    reach = least - gram + 1        # every passage has an anchor within its first ``reach`` words
    profiles = anchors.profile(docs, gram, reach, "suffix-profiles")
    texts = anchors.distinct_texts(profiles, least, "suffix-texts")
    n = texts.agg(F.sum(F.length("anchor_starts"))).first()[0] or 0
    ranges = max(partitions(spark), math.ceil(n / 4 / RANGE_ANCHORS))
    kept = repeated_windows(texts, ranges).groupBy("text_no").agg(
        F.collect_list("start").alias("starts"))
    wanted = texts.select("text_no", "first_order", "raw", "words_sha").join(kept, "text_no")
    suffixes = materialize(
        anchors.texts_of(docs, wanted)
        .select("text_no", "first_order", "words_sha", "text", "starts")
        .mapInPandas(partial(_suffixes, least=least, reach=reach), _SUFFIX), "suffixes")
    passages = _joined(_with_first(suffix_spans(suffixes, least, reach, gram), least))
    shared = texts.select("text_no", "words_sha", "first_order").join(passages, "text_no").select(
        F.col("words_sha").alias("sha"), F.col("first_order").alias("owner"),
        "from_word", "to_word", "least")
    rows = profiles.where(F.col("n_words") >= least).select(
        "doc_id", "doc_order", "n_words", "words_sha")
    # a passage of a text, told of the document that stands for the text
    of_firsts = rows.join(shared, (F.col("words_sha") == F.col("sha"))
                          & (F.col("doc_order") == F.col("owner"))).select(
        "doc_id", F.col("from_word").alias("start_word"), F.col("to_word").alias("end_word"),
        F.col("least").alias("first"))
    groups = rows.groupBy("words_sha").agg(F.min("doc_order").alias("first"),
                                           F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = rows.join(groups.withColumnRenamed("words_sha", "sha"),
                       F.col("words_sha") == F.col("sha")).select(
        "doc_id", F.lit(0).alias("start_word"), F.col("n_words").cast("int").alias("end_word"),
        "first")
    return (of_firsts.union(copies)
            .withColumn("n_words", (F.col("end_word") - F.col("start_word")).cast("long"))
            .withColumn("first_doc_id", F.when(F.col("first") < F.lit(LAST_ID), F.col("first")))
            .select("doc_id", "start_word", "end_word", "n_words", "first_doc_id"))
