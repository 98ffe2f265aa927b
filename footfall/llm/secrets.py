"""Secret scans (operator 2), in DataFrame functions only.

Three patterned kinds (``BASE``) are found leftmost and non-overlapping; a match whose
length test fails is dropped.  Besides these, candidate strings (runs of
``[A-Za-z0-9+/_=-]``) are scanned with a sliding window: the counts of the characters
in the window are carried along, one entering and one leaving, and with them
the window's Shannon entropy.  Each character class (hexadecimal, base64) has its
own alphabet and threshold.  The characters under windows over the threshold are
spans of kind ``entropy``, one for each run of them.

Base spans, and what the allow-list names (samples and placeholders, with up to 20 letters
and digits on either side, and UUIDs), are blanked before candidates are looked for, so they
hide nothing beside them.  A run that is no more than words, or has no digit or no letter, is no span.

Positions are code points, the end is exclusive, and a base span is the whole match.
Equal starts are in the order assign, access, hex, entropy.

Work is linear in the text: windows are counted in chunks of ``CHUNK``, running sums over matches
on two levels, and texts are put together from slices.

Defined results: a null or empty text has no span; repeated rows are scanned each;
texts are scanned whole, whatever their length; other columns are kept, but those with
the names of the result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

# Kind, pattern, group and least length of that group.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KINDS = (*(k for k, *_ in BASE), "entropy")
# A cheap necessary condition of each kind, so that few texts are cut at all.
_CUE = {"access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
# class, what a candidate of it looks like, alphabet, bits per character to exceed
CLASSES = (
    ("hexadecimal", r"^(?:[0-9a-f]++|[0-9A-F]++)$", "0123456789abcdef", 3.0),
    ("base64", r"^[A-Za-z0-9+/_=-]++$",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=", 3.7),
)
CHUNK = 60                  # windows whose verdicts are the bits of one number
# What is blanked with the letters and digits around it, and what a run is allowed to be.
SAMPLES = ("example", "sample", "dummy", "placeholder", "changeme", "xxxx", "0000",
           "abcdefgh", "12345678", "qwertyui")
CUT = (r"(?i)(?<![A-Za-z0-9])[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}(?![A-Za-z0-9])"
       r"|(?i)[A-Za-z0-9]{0,20}?(?:" + "|".join(SAMPLES) + r")[A-Za-z0-9]{0,20}")
# no digit; no letter; words joined by separators, with a number at the end
ALLOW = (
    r"^[^0-9]++$", r"^[^A-Za-z]++$",
    r"^[-_/=+]?[A-Za-z]*+(?:[-_/=+][A-Za-z]++)*+[-_/=+]?[0-9]{0,8}[-_/=+]?$",
)
_SPAN = "array<struct<start: int, kind: int, end: int>>"
_BLOCK = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of ints, what ``combine`` makes of 0 and all before it.

    On two levels, blocks and the values of a block: no long array is rebuilt per value.
    """
    def grow(done: Column, x: Column) -> Column:
        return F.concat(done, F.array(combine(F.element_at(done, -1), x)))

    zero = F.array(F.lit(0))

    def of(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(F.transform(blocks, lambda x: F.aggregate(x, zero, grow)), whole)

    def whole(inner: Column) -> Column:
        offsets = F.aggregate(inner, zero, lambda done, x: grow(done, F.element_at(x, -1)))
        return F.flatten(F.zip_with(
            inner, F.slice(offsets, F.lit(1), F.size(inner)),
            lambda x, o: F.transform(F.slice(x, F.lit(1), F.size(x) - 1),
                                     lambda y: combine(o, y))))

    return _let(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(
        F.array().cast("array<int>")))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, hit).

    What lies between the matches comes from ``split``, so the starts are running sums.
    """
    def of(hits: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), F.length)
        return _let(gaps, lambda g: F.zip_with(
            F.zip_with(running(F.zip_with(g, hits, lambda a, h: a + F.length(h)),
                               lambda a, b: a + b), g, lambda a, b: a + b),
            hits, lambda at, h: F.struct(at.alias("start"), h.alias("hit"))))
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def _as_spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"),
        (m["start"] + F.length(m["hit"])).alias("end")))


def _base_spans(text: Column, number: int) -> Column:
    kind, pattern, group, least = BASE[number]
    found = F.filter(matches(text, pattern), lambda m: F.length(
        F.regexp_extract(m["hit"], pattern, group)) >= least)
    return F.when(text.rlike(_CUE.get(kind, pattern)), _as_spans(found, number)).otherwise(
        F.array().cast(_SPAN))


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """``text`` with the characters under sorted ``spans`` replaced; overlapping spans become one.

    ``mark`` makes the replacement from the number of characters of a span that no earlier one
    covers; a span that begins inside an earlier one adds its rest of characters only by that.
    """
    def of(s: Column) -> Column:
        ends = F.transform(s, lambda x: x["end"])
        return _let(running(ends, F.greatest), lambda before: _let(
            F.split(text, ""), lambda chars: F.concat(
                F.array_join(F.zip_with(s, before, lambda x, b: F.concat(
                    F.array_join(F.slice(chars, b + 1, F.greatest(x["start"] - b, F.lit(0))), ""),
                    mark(F.struct((x["start"] >= b).alias("first"),
                                  F.greatest(x["end"] - F.greatest(x["start"], b), F.lit(0))
                                  .alias("size"))))), ""),
                F.array_join(F.slice(chars, F.array_max(ends) + 1, F.size(chars)), ""))))
    return F.when(F.size(spans) > 0, _let(spans, of)).otherwise(text)


def _blanked(text: Column, spans: Column) -> Column:
    return replaced(text, spans, lambda x: F.repeat(F.lit(" "), x["size"]))


def hot_windows(chars: Column, alphabet: str, least_bits: float, window: int = WINDOW) -> Column:
    """For each window of the array ``chars`` whether its entropy is over ``least_bits``.

    With counts c in a window of W, the entropy is log2 W - sum(c log2 c) / W.  A step
    changes two counts, so the sum changes by two differences of the table c log2 c.  The
    counts are fields of 5 bits in a few numbers; the verdicts of a chunk are bits of one.
    """
    if window > 31:
        raise ValueError("counts have five bits")
    words = -(-len(alphabet) // 12)
    clog = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(window + 1)])
    enough = (math.log2(window) - least_bits) * window
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c) - 1)

    def count(s: Column, code: Column) -> Column:
        word = F.get(F.array(*[s[f"c{i}"] for i in range(words)]), F.floor(code / 12).cast("int"))
        return F.call_function("shiftright", word, (code % 12) * 5).bitwiseAND(F.lit(31).cast("long")).cast("int")

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (code % 12) * 5)

    def step(s: Column, x: Column) -> Column:
        enter, leave = x["enter"], x["leave"]
        grown, shrunk = count(s, enter), count(s, leave)
        total = F.when(enter == leave, s["total"]).otherwise(
            s["total"] + F.get(clog, grown + 1) - F.get(clog, grown)
            + F.when(leave >= 0, F.get(clog, shrunk - 1) - F.get(clog, shrunk)).otherwise(0.0))
        into, out_of = F.floor(enter / 12), F.floor(leave / 12)
        zero = F.lit(0).cast("long")
        fields = [(s[f"c{i}"] + F.when(into == i, one(enter)).otherwise(zero)
                   - F.when((leave >= 0) & (out_of == i), one(leave)).otherwise(zero)
                   ).alias(f"c{i}") for i in range(words)]
        hot = (s["i"] >= window - 1) & (total < enough)
        flag = F.when(hot, F.call_function("shiftleft", F.lit(1).cast("long"),
                                           s["i"] - (window - 1))).otherwise(zero)
        return F.struct((s["i"] + 1).alias("i"), total.alias("total"),
                        (s["flags"] + flag).alias("flags"), *fields)

    start = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("total"),
                     F.lit(0).cast("long").alias("flags"),
                     *[F.lit(0).cast("long").alias(f"c{i}") for i in range(words)])
    before = F.array_repeat(F.lit(-1), window)

    def chunk(part: Column) -> Column:
        steps = F.zip_with(part, F.slice(F.concat(before, part), F.lit(1), F.size(part)),
                           lambda e, x: F.struct(e.alias("enter"), x.alias("leave")))
        return F.aggregate(steps, start, step, lambda s: s["flags"])

    def of(c: Column) -> Column:
        last = F.floor((F.size(c) - window) / CHUNK).cast("int")
        flags = F.transform(F.sequence(F.lit(0), last), lambda j: _let(
            F.slice(c, j * CHUNK + 1, F.lit(CHUNK + window - 1)), chunk))
        bits = F.sequence(F.lit(0), F.lit(CHUNK - 1))
        return F.slice(F.flatten(F.transform(flags, lambda f: F.transform(
            bits, lambda b: F.call_function("shiftright", f, b).bitwiseAND(F.lit(1).cast("long")) == 1))),
            F.lit(1), F.size(c) - window + 1)

    return _let(codes, lambda c: F.when(F.size(c) >= window, of(c)).otherwise(
        F.array().cast("array<boolean>")))


def hot_runs(chars: Column, alphabet: str, least_bits: float, window: int = WINDOW) -> Column:
    """The runs of characters under hot windows: array of (start, end)."""
    def of(hot: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hot) - 1)

        def quiet(first: Column, size: Column) -> Column:
            return ~F.array_contains(F.slice(hot, first + 1, size), True)

        begins = F.filter(places, lambda i: F.get(hot, i) & quiet(
            F.greatest(i - window, F.lit(0)), F.least(i, F.lit(window))))
        ends = F.filter(places, lambda i: F.get(hot, i) & quiet(i + 1, F.lit(window)))
        return F.zip_with(begins, ends, lambda a, b: F.struct(
            a.alias("start"), (b + window).alias("end")))
    return _let(hot_windows(chars, alphabet, least_bits, window),
                lambda hot: F.when(F.array_contains(hot, True), of(hot)).otherwise(
                    F.array().cast("array<struct<start: int, end: int>>")))


def _entropy_spans(text: Column) -> Column:
    """Entropy spans of a text in which base spans are blank."""
    def secret(hit: Column) -> Column:
        out = F.lit(True)
        for pattern in ALLOW:
            out = out & ~hit.rlike(pattern)
        return out

    def spans(m: Column) -> Column:
        def of(chars: Column) -> Column:
            runs = None
            for _, shape, alphabet, bits in reversed(CLASSES):
                own = F.transform(chars, F.lower) if alphabet == alphabet.lower() else chars
                found = hot_runs(own, alphabet, bits)
                runs = found if runs is None else F.when(m["hit"].rlike(shape), found
                                                         ).otherwise(runs)
            kept = F.filter(runs, lambda r: secret(F.array_join(
                F.slice(chars, r["start"] + 1, r["end"] - r["start"]), "")))
            return F.transform(kept, lambda r: F.struct(
                (m["start"] + r["start"]).alias("start"), F.lit(len(BASE)).alias("kind"),
                (m["start"] + r["end"]).alias("end")))
        return _let(F.split(m["hit"], ""), of)

    def of(clean: Column) -> Column:
        likely = F.filter(matches(clean, CANDIDATE), lambda m: secret(m["hit"]))
        return F.flatten(F.transform(likely, spans))

    cut = _let(text, lambda t: _blanked(t, _as_spans(matches(t, CUT), 0)))
    return F.when(text.rlike(CANDIDATE), _let(cut, of)).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, text: str = "text", base: str = "base_spans", spans: str = "spans"
         ) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (base and entropy spans), arrays of (start, kind, end).

    ``kind`` numbers ``KINDS``; both arrays are sorted by start, then kind.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    with_base = docs.withColumn(base, F.array_sort(F.concat(
        *[_base_spans(t, i) for i in range(len(BASE))])))
    found = _entropy_spans(_blanked(t, F.col(base)))
    return with_base.withColumn(spans, F.array_sort(F.concat(F.col(base), found)))


def joined(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, text: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; overlapping spans become one."""
    base, spans = free_name(docs, "base_spans"), free_name(docs, "secret_spans")
    marked = scan(docs, text, base, spans)
    clean = replaced(F.col(text), F.col(spans),
                     lambda x: F.when(x["first"], mark).otherwise(F.lit("")))
    return marked.withColumn(text, clean).drop(base, spans)
