"""Secret scans: three patterns, and windows of high entropy.

Base spans are the leftmost matches of the patterns. To them come candidate
strings (long runs of token characters) in which some window has a high Shannon
entropy for its character class. The window slides one character at a time and
its entropy is updated from the counts of the two characters that change.
Candidates that look like known harmless strings, or that touch a base span,
are suppressed.

Time grows with the length of the text, however long a candidate is and however
many there are: each string is cut once, long candidates are scored piece by
piece, and sorted spans are merged in one pass.

Only DataFrame and SQL functions run.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrays import folded, let

# The patterns of the three kinds, the characters of candidates, the classes with their least entropy in bits, and the allow-list.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
CLASSES = (("hex", r"^[0-9a-fA-F]+$", 3.0), ("alpha", r"^[A-Za-z]+$", 4.1), ("mixed", r"", 3.75))
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"EXAMPLE|example|PLACEHOLDER|placeholder|CHANGEME|changeme",
    r"^[a-z][a-z/_=-]*$",
    r"^[A-Z][A-Z/_=-]*$",
    r"^[0-9+/_=-]+$",
)
WINDOW = 20
#: Characters of a candidate that are scored at a time.
PIECE = 4096

SPAN = "array<struct<start: int, rank: int, end: int, m: string>>"


def pieces_of(text: Column, pattern: str) -> Column:
    """Matches of the pattern, each with the gap before it: array of (g, m). Empty where nothing matches."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(F.rlike(text, F.lit(pattern)), F.filter(both, lambda p: p["m"].isNotNull())).otherwise(F.array().cast("array<struct<g: string, m: string>>"))


def located(pieces: Column, rank: int, keep: Callable[[Column], Column] | None = None, with_match: bool = False) -> Column:
    """Spans of matches, in code points: a running sum of the lengths of gaps and matches gives each start.

    keep is a condition on the match.
    """
    kind = SPAN[6:-1]

    def step(at, p):
        begin = at + F.length(p["g"])
        end = begin + F.length(p["m"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), (p["m"] if with_match else F.lit(None).cast("string")).alias("m"))
        return end, F.when(keep(p["m"]), span) if keep else span

    return folded(pieces, F.lit(0), step, kind)


def least_sum(s: Column, window: int) -> Column:
    """The least, over the windows of s, of the sum of c * log2(c) over the counts c of its characters.

    A window's entropy is log2(window) - sum / window, so the least sum belongs
    to the highest entropy. counts holds a character for each one of ALPHABET,
    its code 48 more than the count. One step takes a character in and, once
    the window is full, lets the oldest out; only these two counts change.
    """
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    count = lambda counts, i: F.ascii(F.substring(counts, i, F.lit(1))) - 48
    put = lambda counts, i, c: F.overlay(counts, F.char(c + 48), i, F.lit(1))
    codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.struct(F.lit("0" * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("best"))

    def into(acc, x):
        c = count(acc["counts"], x["new"])
        return F.struct(put(acc["counts"], x["new"], c + 1).alias("counts"), (acc["sum"] + F.get(terms, c + 1) - F.get(terms, c)).alias("sum"), acc["best"].alias("best"))

    def slide(acc, x):
        c_in, c_out = count(acc["counts"], x["new"]), count(acc["counts"], x["old"])
        change = (F.get(terms, c_in + 1) - F.get(terms, c_in)) + (F.get(terms, c_out - 1) - F.get(terms, c_out))
        total = acc["sum"] + change
        counts = put(put(acc["counts"], x["new"], c_in + 1), x["old"], c_out - 1)
        return F.struct(counts.alias("counts"), total.alias("sum"), F.least(acc["best"], total).alias("best"))

    def step(acc, x):
        return F.when(x["old"].isNull(), into(acc, x)).when(x["new"] == x["old"], acc).otherwise(slide(acc, x))

    def scored(codes):
        old = F.concat(F.array_repeat(F.lit(None).cast("int"), window), F.slice(codes, F.lit(1), F.size(codes) - window))
        first = F.aggregate(F.arrays_zip(F.slice(codes, 1, window).alias("new"), F.slice(old, 1, window).alias("old")), start, step)
        rest = F.arrays_zip(F.slice(codes, F.lit(window + 1), F.size(codes)).alias("new"), F.slice(codes, F.lit(1), F.size(codes) - window).alias("old"))
        full = let(first, lambda a: F.struct(a["counts"].alias("counts"), a["sum"].alias("sum"), a["sum"].alias("best")))
        return F.aggregate(rest, full, step, lambda acc: acc["best"])

    return let(codes, lambda c: F.when(F.size(c) >= window, scored(c)))


def harmless(s: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | F.rlike(s, F.lit(pattern))
    return out


def random_looking(s: Column, window: int = WINDOW) -> Column:
    """Whether some window of s has at least the entropy that its class asks for. Pieces overlap by a window less one character."""
    most = F.lit(0.0)
    for _, pattern, bits in reversed(CLASSES):
        bound = F.lit(round(window * (math.log2(window) - bits), 9))
        most = F.when(F.rlike(s, F.lit(pattern)), bound).otherwise(most) if pattern else bound
    pieces = F.regexp_extract_all(s, F.lit(f"(?=(.{{1,{PIECE + window - 1}}})).{{1,{PIECE}}}"), F.lit(1))
    return F.coalesce(let(most, lambda b: F.exists(pieces, lambda p: F.round(least_sum(p, window), 9) <= b)), F.lit(False))


def guarded(base: Column, runs: Column) -> Column:
    """All spans by start, then rank, and a last run after them."""
    guard = F.struct(F.lit((1 << 31) - 1).alias("start"), F.lit(3).alias("rank"), F.lit((1 << 31) - 1).alias("end"), F.lit(None).cast("string").alias("m"))
    return F.concat(F.array_sort(F.concat(base, runs)), F.array(guard))


def apart(spans: Column) -> Column:
    """Of guarded spans, the runs that touch no base span. Runs do not overlap each other.

    In one pass: reach is the furthest end of the base spans so far. A run that
    begins before it is dropped; else it waits, and is dropped if a base span
    begins before its end, and emitted when the next run comes.
    """
    kind = SPAN[6:-1]
    none = F.lit(None).cast(kind)

    def step(s, x):
        is_run, wait = x["rank"] == 3, s["wait"]
        reach = F.when(is_run, s["reach"]).otherwise(F.greatest(s["reach"], x["end"]))
        kept = F.when(is_run, F.when(s["reach"] <= x["start"], x).otherwise(none)).otherwise(F.when(x["start"] < wait["end"], none).otherwise(wait))
        return F.struct(reach.alias("reach"), kept.alias("wait")), F.when(is_run, wait)

    return folded(spans, F.struct(F.lit(0).alias("reach"), none.alias("wait")), step, kind)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, base and extra; each is an array of (start, rank, end).

    Positions are code points, end exclusive; rank is the kind's place in KINDS.
    base is sorted by start, then rank. Null text counts as empty. Repeated
    rows each get their result; other columns are not read; an empty table
    gives an empty result. A text is one row, so a long one takes memory in
    proportion to its matches; there is no limit on its length.

    The allow-list suppresses a whole candidate: UUIDs, candidates that hold
    one of its words anywhere, letters of one case in words joined by / _ = -,
    and digits with signs. They get no entropy span however random they look;
    base spans are not subject to it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    found = found.select("doc_id", *[pieces_of(F.col("text"), p).alias(f"p{i}") for i, p in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE))])
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    base = F.array_sort(F.concat(located(F.col("p0"), 0, long_enough), located(F.col("p1"), 1), located(F.col("p2"), 2)))
    found = found.select("doc_id", base.alias("b"), located(F.col("p3"), 3, with_match=True).alias("r"))
    found = found.withColumn("both", F.when(F.size("r") > 0, guarded(F.col("b"), F.col("r"))).otherwise(F.array().cast(SPAN)))
    extra = F.filter(apart(F.col("both")), lambda r: ~harmless(r["m"]) & random_looking(r["m"], window))
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    return found.select("doc_id", plain(F.col("b")).alias("base"), plain(extra).alias("extra"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")
