"""N-gram Jaccard join with a grouped prefix filter.

A document is the set of its distinct word n-grams. In an order from rare to
frequent grams, two sets that reach the threshold share a gram among the first
n - ceil(t * n) + 1 of each, their prefixes. The steps:

1. Hash the grams of every text; texts with equal sets form one class.
2. Deal (gram, class) by gram, count the classes of each gram and deal the
   grams back to their classes. Grams that a great part of the texts have are
   found in step 1; they come last in the order and are dealt by class, not by
   gram, so that no task gets all of them. Grams of one class only come first in the order
   and can match nothing: a class whose prefix holds only such grams is done.
3. Classes with the same size and prefix form one group. Groups that share a
   prefix gram are paired, if their sizes, the gram's places and then their
   whole prefixes allow the threshold.
4. Group pairs are expanded to their members, and each pair is verified on the
   whole sets. In a long list of groups with a common gram, members are first
   verified against one of them; those that both link to it need no link of
   their own, which keeps the links few in large groups of near copies.
5. The links' connected components are the result.

Steps 1 and 2 hash in numpy over Arrow batches, with packed arrays between
tasks; the rest are DataFrame joins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import wordhash
from docloom.llm.components import connected_components
from docloom.llm.shared import small_batches, text_key, without, written

LOW48, MOST = np.uint64((1 << 48) - 1), 0x7FFF
COLUMNS = ["id", "key", "n", "sig", "gram", "many"]


def sets_of(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams (hash, text), grams per text, and a signature per text. A text of fewer words than size is one gram."""
    hashes, counts = wordhash.words(texts, wordhash.SPACED)
    h, owner, _ = wordhash.grams(hashes, counts, size)
    starts = np.cumsum(counts) - counts
    for n in range(1, size):
        few = np.flatnonzero(counts == n)
        if len(few):
            whole = np.concatenate([hashes[starts[i] : starts[i] + n] for i in few])
            h, owner = np.r_[h, wordhash.grams(whole, np.full(len(few), n), n)[0]], np.r_[owner, few]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh]
    many = np.bincount(owner, minlength=len(texts))
    sums = np.r_[np.uint64(0), np.cumsum(wordhash.mixed(h), dtype=np.uint64)]
    ends = np.cumsum(many)
    sig = wordhash.mixed(sums[ends] - sums[ends - many] + many.astype(np.uint64))
    return h, owner, many, sig


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash's upper 32 bits; buckets is below 2^31."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def describe(size: int, share: float):
    """A mapInArrow function: (id, key, text) to (id, key, n, sig), and rows (gram, many) of the grams that at least a share of the task's texts have.

    Grams are counted piece by piece, leaving out those in fewer than 4 texts
    of a piece; the table of counts is halved, rarest first, beyond a million.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often: dict[int, int] = {}
        rows, ids = 0, pa.int64()
        for part in parts:
            texts = wordhash.byte_strings(part["text"])
            ids = part["id"].type
            for a, b in wordhash.batches(texts, len(texts)):
                h, _, many, sig = sets_of(texts[a:b], size)
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([part["id"].slice(a, b - a), part["key"].slice(a, b - a), pa.array(many, pa.int64()), pa.array(signed(sig), pa.int64()), none, none], COLUMNS)
                rows += b - a
                h = np.sort(h)
                starts = np.flatnonzero(np.r_[len(h) > 0, h[1:] != h[:-1]])
                counts = np.diff(np.r_[starts, len(h)])
                for g, c in zip(h[starts[counts > 3]].tolist(), counts[counts > 3].tolist(), strict=True):
                    often[g] = often.get(g, 0) + c
                if len(often) > 1_000_000:
                    often = dict(sorted(often.items(), key=lambda x: -x[1])[:500_000])
        found = [(g, c) for g, c in often.items() if c >= max(8, share * rows)]
        if found:
            none = pa.nulls(len(found), pa.int64())
            grams = pa.array(signed(np.array([g for g, _ in found], dtype=np.uint64)), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(found), ids), none, none, none, grams, pa.array([c for _, c in found], pa.int64())], COLUMNS)
        wordhash.release()

    return run


def dealt(size: int, buckets: int, hot, flush: int = 500_000):
    """A mapInArrow function: texts to packed grams by bucket, sent whenever a task has flush of them.

    Hot grams (a broadcast, sorted array) are dealt by class instead of by gram,
    so that no bucket gets all classes of one; they need not be counted.

    Each task sends the grams of a set once, however many copies it reads (the
    sets that were sent are remembered, up to a million at a time).
    """

    def packed(grams: list[np.ndarray], sigs: list[np.ndarray]) -> pa.RecordBatch:
        h, owner = np.concatenate(grams), np.concatenate(sigs)
        to = bucket_of(np.where(among(h & LOW48, hot.value), owner, h), buckets)
        order = np.argsort(to, kind="stable")
        h, owner, to = h[order], owner[order], to[order]
        cuts = np.r_[0, np.flatnonzero(np.diff(to)) + 1, len(to)]
        last = np.r_[(owner[1:] != owner[:-1]) | (to[1:] != to[:-1]), True]
        low, high = h.astype(np.uint32), ((h >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16)
        out = []
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            ends = np.flatnonzero(last[x:y])
            out.append((int(to[x]), owner[x:y][ends].tobytes(), np.diff(np.r_[-1, ends]).astype(np.uint32).tobytes(), low[x:y].tobytes(), high[x:y].tobytes()))
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["bucket", "sigs", "counts", "low", "high"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        grams, sigs, held = [], [], 0
        for part in parts:
            texts = wordhash.byte_strings(part["text"])
            for a, b in wordhash.batches(texts, len(texts)):
                h, owner, many, sig = sets_of(texts[a:b], size)
                first = np.zeros(len(sig), dtype=bool)
                for i, s in enumerate(sig.tolist()):
                    if many[i] and s not in sent:
                        sent.add(s)
                        first[i] = True
                if len(sent) > 1_000_000:
                    sent.clear()
                use = first[owner]
                grams.append(h[use])
                sigs.append(sig[owner[use]])
                held += len(grams[-1])
                if held >= flush:
                    yield packed(grams, sigs)
                    grams, sigs, held = [], [], 0
        if held:
            yield packed(grams, sigs)
        del grams, sigs
        wordhash.release()

    return run


def joined(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=dtype)


def among(grams: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, grams), len(hot) - 1)] == grams if len(hot) else np.zeros(len(grams), dtype=bool)


PACKET = "bucket int, sigs binary, sizes binary, shared binary, keys binary"


def counted(buckets: int, hot):
    """An applyInPandas function over one bucket of grams: what each class shares there, packed by one of so many buckets of classes.

    For each class the grams that other classes have too, as order keys: classes
    with the gram (15 bits, the most if more or hot), then 48 bits of the gram.
    Grams of one class alone are not sent: a class's size tells their number.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sigs, counts = joined(frame["sigs"], np.uint64), joined(frame["counts"], np.uint32)
        gram = joined(frame["low"], np.uint32).astype(np.uint64) | (joined(frame["high"], np.uint16).astype(np.uint64) << np.uint64(32))
        owner = np.repeat(sigs, counts)
        del frame, sigs, counts
        order = np.lexsort((owner, gram))
        gram, owner = gram[order], owner[order]
        del order
        fresh = np.ones(len(gram), dtype=bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        gram, owner = gram[fresh], owner[fresh]
        starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        df = np.diff(np.r_[starts, len(gram)])
        df = np.repeat(df, df)
        df[among(gram, hot.value)] = MOST
        use = df > 1
        owner, key = owner[use], (np.minimum(df[use], MOST).astype(np.uint64) << np.uint64(48)) | gram[use]
        del gram, df, use
        order = np.argsort(owner, kind="stable")
        owner, key = owner[order], key[order]
        ends = np.flatnonzero(np.r_[owner[1:] != owner[:-1], len(owner) > 0])
        who, shared = owner[ends], np.diff(np.r_[-1, ends])
        to = bucket_of(who, buckets)
        # Owners are in order, and so are their buckets: each packet is a run.
        cuts = np.r_[np.flatnonzero(np.r_[len(to) > 0, to[1:] != to[:-1]]), len(to)]
        at = np.r_[0, np.cumsum(shared)]
        out = [(int(to[x]), who[x:y].tobytes(), b"", shared[x:y].astype(np.uint32).tobytes(), key[at[x] : at[y]].tobytes()) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        del owner, key, order
        wordhash.release()
        return pd.DataFrame(out, columns=["bucket", "sigs", "sizes", "shared", "keys"])

    return run


def sized(buckets: int):
    """A mapInArrow function: (sig, n) to packets that tell the sizes of classes, each once for a batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            who, first = np.unique(np.asarray(part["sig"]).view(np.uint64), return_index=True)
            n = np.asarray(part["n"])[first].astype(np.uint32)
            to = bucket_of(who, buckets)
            cuts = np.r_[np.flatnonzero(np.r_[len(to) > 0, to[1:] != to[:-1]]), len(to)]
            rows = [(int(to[x]), who[x:y].tobytes(), n[x:y].tobytes(), b"", b"") for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5)]], ["bucket", "sigs", "sizes", "shared", "keys"])

    return run


def prefixed(percent: int):
    """An applyInPandas function over one bucket of classes: those that can link, with prefix and ordered keys."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tells = frame["sizes"].str.len() > 0
        known, sizes = joined(frame.loc[tells, "sigs"], np.uint64), joined(frame.loc[tells, "sizes"], np.uint32).astype(np.int64)
        frame = frame[~tells]
        sigs, shared, keys = joined(frame["sigs"], np.uint64), joined(frame["shared"], np.uint32).astype(np.int64), joined(frame["keys"], np.uint64)
        who, at = np.unique(sigs, return_inverse=True)
        order = np.argsort(known, kind="stable")
        n = sizes[order][np.searchsorted(known[order], who)] if len(who) else np.zeros(0, dtype=np.int64)
        many = np.bincount(at, shared, minlength=len(who)).astype(np.int64)
        s = n - many
        first = n - (percent * n + 99) // 100 + 1 - s
        owner = np.repeat(at, shared)
        alive = (first > 0) & (many > 0)
        use = alive[owner]
        owner, keys = owner[use], keys[use]
        order = np.lexsort((keys, owner))
        owner, keys = owner[order], signed(keys[order])
        ids = np.flatnonzero(alive)
        parts = np.split(keys, np.cumsum(many[ids])[:-1]) if len(ids) else []
        return pd.DataFrame({"sig": signed(who[ids]), "n": n[ids], "single": s[ids], "prefix": pd.Series([k[: first[i]] for i, k in zip(ids, parts, strict=True)], dtype=object), "keys": pd.Series(parts, dtype=object)})

    return run


def reaches(percent: int, common: Column, n_a: Column, n_b: Column) -> Column:
    """Whether sets of n_a and n_b grams with so many in common have the similarity, in whole numbers."""
    return common * (100 + percent) >= (n_a + n_b) * percent


def sizes_allow(percent: int) -> Column:
    """Of two groups a and b: whether sizes and the numbers of shared grams allow the similarity."""
    return (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent) & reaches(percent, F.least("a.shared", "b.shared"), F.col("a.n"), F.col("b.n"))


def places_allow(percent: int) -> Column:
    """Of two groups that have a gram in common, at pos in each prefix: whether it may be their first one.

    If it is, the common grams are this one and at most what follows it in either set.
    """
    return reaches(percent, F.least(F.col("a.shared") - F.col("a.pos"), F.col("b.shared") - F.col("b.pos")), F.col("a.n"), F.col("b.n"))


def prefixes_allow(percent: int) -> Column:
    """Of two groups a and b: whether their whole prefixes allow the similarity.

    Common grams are those in both prefixes and, of the set whose prefix ends
    first in the order, at most the rest of it.
    """
    c = F.size(F.array_intersect("a.prefix", "b.prefix"))
    rest_a, rest_b = F.col("a.shared") - F.size("a.prefix"), F.col("b.shared") - F.size("b.prefix")
    rest = F.when(F.element_at("a.prefix", -1) < F.element_at("b.prefix", -1), rest_a).otherwise(rest_b)
    return reaches(percent, c + rest, F.col("a.n"), F.col("b.n"))


def verified(percent: int) -> Column:
    """Of two classes a and b: whether their whole sets have the similarity."""
    return reaches(percent, F.size(F.array_intersect("a.keys", "b.keys")), F.col("a.n"), F.col("b.n"))


def size_band(n: Column, percent: int) -> Column:
    """Sizes that allow the similarity lie in the same band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(max(100 / percent, 1.01)) + 1e-9).cast("int")


def met(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (g1, g2) of groups that have a prefix gram in common, whose sizes and places allow the similarity and whose labels differ.

    lists holds (gram, g, n, shared, pos, lo, hi, hub): lo and hi are the labels
    of the group's members, hub that of the gram's centre (null in short lists).
    Groups with the hub's label alone need no pairs among themselves: however
    long a list of near copies is, only its other groups are paired, and those
    by bands of sizes.
    """
    main = F.coalesce((F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("hub")), F.lit(False))
    marked = lists.withColumns({"main": main, "band": size_band(F.col("n"), percent)})
    a = marked.where("not main").alias("a")
    b = marked.withColumn("near", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).alias("b")
    once = F.col("b.main") | (F.col("a.g") < F.col("b.g"))
    settled = (F.col("a.lo") == F.col("b.hi")) & (F.col("b.lo") == F.col("a.hi"))
    on = (F.col("a.gram") == F.col("b.gram")) & (F.col("a.band") == F.col("b.near")) & once & ~settled & sizes_allow(percent) & places_allow(percent)
    return a.join(b, on).select(F.col("a.g").alias("g1"), F.col("b.g").alias("g2")).distinct()


def links_of(classes: DataFrame, percent: int, long_list: int) -> tuple[DataFrame, DataFrame]:
    """From classes (sig, n, single, prefix, keys): labels (sig, label) and links (a, b) between labels.

    Classes with one label are connected; the links connect the labels of all
    other classes that are linked.
    """
    groups = classes.groupBy("n", "single", "prefix").agg(F.min("sig").alias("g"))
    groups = written(groups, "ngram-groups")
    members = written(classes.join(groups, ["n", "single", "prefix"]).select("sig", "g", "n", "keys"), "ngram-members")
    groups = groups.withColumn("shared", F.col("n") - F.col("single"))
    lists = groups.select("g", "n", "single", "shared", F.posexplode("prefix").alias("pos", "gram"))

    # Stars: the first member of each group against that of the group with the fewest single grams in its longest list; other members against the first.
    centre = lists.groupBy("gram").agg(F.min(F.struct("single", "g")).alias("c"), F.count(F.lit(1)).alias("many")).where(F.col("many") > long_list)
    rays = lists.select("g", "gram").join(centre, "gram").groupBy("g").agg(F.max(F.struct("many", "c")).alias("best"))
    rays = rays.select(F.col("g").alias("x"), F.col("best.c.g").alias("y")).where("x <> y")
    rays = rays.unionByName(members.where("sig <> g").select(F.col("sig").alias("x"), F.col("g").alias("y")))
    sets = members.select("sig", "n", "keys")
    rays = rays.join(sets.alias("a"), F.col("x") == F.col("a.sig")).select("y", F.struct(F.col("a.sig").alias("sig"), F.col("a.n").alias("n"), F.col("a.keys").alias("keys")).alias("a"))
    stars = written(rays.join(sets.alias("b"), (F.col("y") == F.col("b.sig")) & verified(percent)).select(F.col("a.sig").alias("sig"), F.col("b.sig").alias("hub")), "ngram-stars")
    further = stars.select(F.col("sig").alias("hub"), F.col("hub").alias("label"))
    label = stars.join(further, "hub", "left").select("sig", F.coalesce("label", "hub").alias("label"))
    members = written(members.join(label, "sig", "left").withColumn("label", F.coalesce("label", "sig")), "ngram-labels")
    known = members.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    hubs = centre.select("gram", F.col("c.g").alias("g")).join(known, "g").select("gram", F.col("lo").alias("hub"))
    pairs = met(lists.join(known, "g").join(hubs, "gram", "left"), percent)
    front = groups.select("g", F.struct("n", "shared", "prefix").alias("s"))
    pairs = pairs.join(front.select(F.col("g").alias("g1"), F.col("s").alias("a")), "g1").join(front.select(F.col("g").alias("g2"), F.col("s").alias("b")), "g2")
    pairs = pairs.where(prefixes_allow(percent)).select("g1", "g2")
    pairs = pairs.unionByName(known.where("lo <> hi").select(F.col("g").alias("g1"), F.col("g").alias("g2")))

    left = pairs.join(members.alias("m"), F.col("g1") == F.col("m.g")).select("g2", F.struct("m.sig", "m.n", "m.keys", "m.label", "m.g").alias("a"))
    apart = (F.col("a.label") != F.col("b.label")) & ((F.col("a.g") != F.col("b.g")) | (F.col("a.sig") < F.col("b.sig")))
    pairs = left.join(members.alias("b"), (F.col("g2") == F.col("b.g")) & apart & verified(percent)).select(F.col("a.label").alias("a"), F.col("b.label").alias("b"))
    hubs = members.join(stars, "sig").select(F.col("label").alias("a"), F.col("hub").alias("b"))
    hubs = hubs.join(members.select(F.col("sig").alias("b"), F.col("label").alias("c")), "b").select("a", F.col("c").alias("b"))
    links = hubs.unionByName(pairs).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return members.select("sig", "label"), links


def hot_grams(described: DataFrame, share: float, most: int) -> np.ndarray:
    """The grams (48 bits, sorted) that a share of the rows have by the tasks' counts, the most frequent ones up to a bound.

    They come last in the order, whatever their exact counts; any choice gives
    the same result, this one keeps buckets even.
    """
    counts = described.agg(F.count("n").alias("rows")).first()
    often = described.where("gram is not null").groupBy("gram").agg(F.sum("many").alias("many")).where(F.col("many") >= max(64, share * counts["rows"]))
    grams = often.orderBy(F.col("many").desc(), "gram").limit(most).select("gram").toPandas()["gram"].to_numpy(dtype=np.int64)
    return np.unique(grams.view(np.uint64) & LOW48)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, long_list: int = 4, buckets: int | None = None, hot_share: float = 0.001, hot_most: int = 100_000, part_bytes: int = 32 << 20) -> DataFrame:
    """components_of() without key."""
    return components_of(docs, id_col, text_col, size, percent, long_list, buckets, hot_share, hot_most, part_bytes).drop("key")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, ...) with the least id of their component, with all their columns. Equal rows stay or go together."""
    found = written(components_of(docs), "ngram-found")
    return without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, long_list: int = 4, buckets: int | None = None, hot_share: float = 0.001, hot_most: int = 100_000, part_bytes: int = 32 << 20) -> DataFrame:
    """One row per row of docs: id, key (a hash of the text), n_shingles, component_id.

    Words are runs of anything but ASCII white space, A-Z as a-z; the set holds
    the distinct runs of size words, or the whole sequence of a text with fewer.
    Texts link when 100 * intersection >= percent * union. component_id is the
    least id that can be reached by links, the row's own included. Null texts
    and texts without words have empty sets and link with nothing, each a
    component of its own. Equal ids count as one document's copies only through
    their texts. Ids may be of any type that has an order; a null id is never
    the least, unless there is no other. An empty table gives an empty result;
    other columns are not read. A text may be of any length; its words take a
    few dozen bytes each in its task.

    Grams are compared by 48 bits of their hashes, and sets count as equal when
    64 bits computed from all their grams are; the search loses no link.
    Components take a number of rounds in the logarithm of their longest path;
    beyond 60 rounds an error is raised.

    Grams are dealt into buckets of about part_bytes, counted before; each
    bucket is one group in a task's memory.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    described = written(rows.mapInArrow(describe(size, hot_share), f"id {kind}, key bigint, n bigint, sig bigint, gram bigint, many bigint"), "ngram-docs")
    documents = described.where("gram is null")
    # Grams of equal sets are mostly sent once, so those of all rows are an upper bound.
    grams_of_all = documents.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(24, -(-14 * grams_of_all // part_bytes))
    buckets = buckets or 2 * parts
    hot = spark.sparkContext.broadcast(hot_grams(described, hot_share, hot_most))
    grams = rows.select("text").mapInArrow(dealt(size, buckets, hot), "bucket int, sigs binary, counts binary, low binary, high binary")
    packed = grams.repartition(parts, "bucket").groupBy("bucket").applyInPandas(counted(parts, hot), PACKET)
    sizes = documents.where("n > 0").select("sig", "n").mapInArrow(sized(parts), PACKET)
    classes = packed.unionByName(sizes).repartition(parts, "bucket").groupBy("bucket").applyInPandas(prefixed(percent), "sig bigint, n bigint, single bigint, prefix array<bigint>, keys array<bigint>")
    classes = written(classes, "ngram-classes")
    labels, links = links_of(classes, percent, long_list)
    labels = labels.join(connected_components(links).withColumnRenamed("node", "label"), "label", "left").select("sig", F.coalesce("component", "label").alias("component"))

    own = documents.where("n > 0").groupBy("sig").agg(F.min("id").alias("least_id"))
    own = own.join(labels, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = own.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = own.join(least, "component").select("sig", "component_id")
    filled = documents.where("n > 0").join(classes, "sig").select("id", "key", "n", "component_id")
    empty = documents.where("n = 0").select("id", "key", "n", F.col("id").alias("component_id"))
    return filled.unionByName(empty).select(F.col("id").alias(id_col), "key", F.col("n").alias("n_shingles"), "component_id")
