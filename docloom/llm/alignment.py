"""Alignment of the tokens of two tokenizers by a dictionary of groups.

Where a token of A and a token of B end at the same byte, the text is cut; the
tokens between two cuts are a group, and all its A tokens are linked with all
its B tokens. A group is written "a1,a2|b1": the ids of A, the ids of B. The
same groups come again and again, so links are never made per text: each
distinct group is a row of a dictionary with the number of documents that hold
it, its links are expanded once, and what the counts of its links add up to is
joined back by the group.

A pair of ids may be linked by several groups of one document and still counts
that document once: a document says for which pairs this happens and how often,
and that is taken off the sum over groups.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import small_batches, written
from docloom.llm.token_counts import byte_letters

#: From a space between two words up to the next. Neither tokenizer has a token across such a place, as Tokenizer.cuts says.
CHUNK = re.compile(r"\s*\S+(?:(?!\x20\S)\s+\S*)*|\s+")
#: Characters of texts that are cut into chunks at a time.
SLICE = 1 << 18
#: Fixed value: how byte-level BPE files with use_regex cut a text before merging.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that every version of Unicode classes alike; texts with others go to the file's own library.
SETTLED = re.compile("[^\0-\u024f]")

Encoded = tuple[np.ndarray, np.ndarray]


def flat(ids: list[list[int]]) -> Encoded:
    """All ids in a row, and how many each text has."""
    size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(size.sum())), size


class Tokenizer:
    """A public tokenizer file.

    encode(texts) gives the ids of texts that each begin with a space, without
    special tokens; pieces are the bytes of each id; cuts tells whether a text
    may be cut at single spaces between words.
    """

    def __init__(self, path: str) -> None:
        self.encode: Callable[[list[str]], Encoded]
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.pieces = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
            self.encode = lambda texts: flat(model.encode([t[1:] for t in texts], num_threads=1))
            self.cuts = not any(re.search("[^▁]▁", p) for p in names)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer as File

            file, letters = File.from_file(path), byte_letters()
            file.encode_special_tokens = True
            plain = {t.content for t in file.get_added_tokens_decoder().values()}
            self.pieces = [b""] * file.get_vocab_size()
            for piece, i in file.get_vocab().items():
                self.pieces[i] = piece.encode() if piece in plain else bytes(letters[c] for c in piece)
            with open(path, encoding="utf-8") as said:
                settings = json.load(said)
            before = settings["pre_tokenizer"] or {}
            self.cuts = settings["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", False) and not before.get("add_prefix_space", True)
            own = self.encode = lambda texts: flat([e.ids for e in file.encode_batch_fast(texts, add_special_tokens=False)])
            merges = [m if isinstance(m, list) else m.split(" ") for m in settings["model"].get("merges", [])]
            made = [settings["model"]["vocab"].get("".join(m)) for m in merges]
            if self.cuts and made == list(range(256, 256 + len(made))):
                self.encode = self.quick(own, 256 + len(made))
        self.lengths = np.fromiter(map(len, self.pieces), dtype=np.int64, count=len(self.pieces))

    def quick(self, own: Callable[[list[str]], Encoded], many: int) -> Callable[[list[str]], Encoded]:
        """As own, by a library for ranks: where ids follow the merges, merging by the lowest id and by the first merge are the same. Chunks are encoded in one run, which tokens can't cross."""
        import tiktoken

        ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks={self.pieces[i]: i for i in range(many)}, special_tokens={})

        def run(texts: list[str]) -> Encoded:
            joined = "".join(texts)
            if len(texts) > 1 and SETTLED.search(joined) is None:
                ids = np.asarray(ranks.encode_ordinary(joined), dtype=np.int64)
                ends = np.cumsum(self.lengths[ids])
                last = np.cumsum(np.fromiter((len(t.encode()) for t in texts), dtype=np.int64, count=len(texts)))
                at = np.searchsorted(ends, last)
                if (ends[at] == last).all():
                    return ids, np.diff(at + 1, prepend=0)
            return own(texts)

        def sorted_out(texts: list[str]) -> Encoded:
            rare = np.fromiter((SETTLED.search(t) is not None for t in texts), dtype=bool, count=len(texts))
            if not rare.any():
                return run(texts)
            parts, order = [run([t for t, r in zip(texts, rare, strict=True) if not r]), own([t for t, r in zip(texts, rare, strict=True) if r])], np.r_[np.flatnonzero(~rare), np.flatnonzero(rare)]
            ids, size = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            back = np.argsort(order, kind="stable")
            return ids[ranges((np.cumsum(size) - size)[back], size[back])], size[back]

        return sorted_out


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Interned:
    """The groups of the pieces of text that a task has met, so that a piece is encoded and cut once. It is emptied when it holds more than most pieces or groups, or 100 characters for each of most."""

    def __init__(self, a: Tokenizer, b: Tokenizer, most: int) -> None:
        self.a, self.b, self.most = a, b, most
        self.forget()

    def forget(self) -> None:
        self.chunk: dict[str, int] = {}
        self.characters = 0
        self.single: dict[int, int] = {}
        self.wide: dict[tuple[bytes, bytes], int] = {}
        self.texts: list[str] = []
        #: Of each piece: tokens of A, of B, groups, links, whether both sides give its bytes back; and the groups of all pieces in a row.
        self.numbers = np.zeros((0, 5), dtype=np.int64)
        self.groups = np.zeros(0, dtype=np.int64)

    def full(self) -> bool:
        return max(len(self.chunk), len(self.texts), self.characters // 100) > self.most

    def learn(self, new: list[str]) -> None:
        raw = [c.encode() for c in new]
        length = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        good, sides = np.ones(len(new), dtype=bool), []
        for side in (self.a, self.b):
            ids, size = side.encode(new)
            said = [side.pieces[i] for i in ids.tolist()]
            if b"".join(said) != b"".join(raw):
                edges = np.r_[0, np.cumsum(size)].tolist()
                good &= np.fromiter((b"".join(said[i:j]) == r for i, j, r in zip(edges, edges[1:], raw)), dtype=bool, count=len(raw))
            sides.append((ids, size))
        (a, size_a), (b, size_b) = [(ids[np.repeat(good, size)], np.where(good, size, 0)) for ids, size in sides]
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        at = np.searchsorted(ends_b, ends_a)
        cut = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a if len(a) else np.zeros(0, dtype=bool)
        last_a, last_b = np.flatnonzero(cut) + 1, at[cut] + 1
        n_a, n_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
        group = self.numbered(a, b, last_a - n_a, last_b - n_b, n_a, n_b)
        owner = np.searchsorted(np.cumsum(np.where(good, length, 0)), ends_a[cut])
        n_groups = np.bincount(owner, minlength=len(new))
        links = np.zeros(len(new), dtype=np.int64)
        np.add.at(links, owner, n_a * n_b)
        self.chunk.update(zip(new, range(len(self.chunk), len(self.chunk) + len(new))))
        self.numbers = np.concatenate([self.numbers, np.stack([size_a, size_b, n_groups, links, good], axis=1)])
        self.groups = np.concatenate([self.groups, group])
        self.characters += sum(map(len, new))

    def numbered(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """The number of each group, given by where its tokens begin and how many they are."""
        out = np.empty(len(n_a), dtype=np.int64)
        one = (n_a == 1) & (n_b == 1)
        code, which = np.unique(a[at_a[one]] << 32 | b[at_b[one]], return_inverse=True)
        known = [self.single.get(c) for c in code.tolist()]
        for i, c in enumerate(code.tolist()):
            if known[i] is None:
                known[i] = self.single[c] = len(self.texts)
                self.texts.append(f"{c >> 32}|{c & 0xFFFFFFFF}")
        out[one] = np.asarray(known, dtype=np.int64)[which]
        raw_a, raw_b, found = a.tobytes(), b.tobytes(), []
        for i, j, n, m in zip(*(x[~one].tolist() for x in (at_a, at_b, n_a, n_b)), strict=True):
            key = raw_a[8 * i : 8 * (i + n)], raw_b[8 * j : 8 * (j + m)]
            g = self.wide.get(key)
            if g is None:
                g = self.wide[key] = len(self.texts)
                self.texts.append(f"{','.join(map(str, a[i : i + n].tolist()))}|{','.join(map(str, b[j : j + m].tolist()))}")
            found.append(g)
        out[~one] = found
        return out


def slices(text: str) -> Iterator[str]:
    """A text in runs of whole chunks of about SLICE characters; a longer chunk makes a longer run."""
    begin = 0
    cut = re.compile(r"(?<=\S)\x20(?=\S)")
    while len(text) - begin > SLICE:
        at = cut.search(text, begin + SLICE)
        if at is None:
            break
        yield text[begin : at.start()]
        begin = at.start()
    yield text[begin:]


def linked(key: str) -> list[str]:
    """The distinct pairs of ids that a group links, each written as the group that has only this pair."""
    a, b = (dict.fromkeys(side.split(",")) for side in key.split("|"))
    return [f"{x}|{y}" for x in a for y in b]


class Block:
    """What a batch of documents gives: a row for each, a dictionary of its groups, and pairs that one document links by several groups."""

    def __init__(self, interned: Interned) -> None:
        self.interned = interned
        self.numbers: list[np.ndarray] = []
        self.digests: list = []
        self.waiting: list[tuple[int, list[str]]] = []
        self.size = 0
        self.place: dict[str, int] = {}
        #: (document << 32 | place of a group, times) of each run.
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, text: str | None) -> None:
        self.numbers.append(np.array([0, 0, 0, 0, 1], dtype=np.int64))
        self.digests.append(None)
        whole = f" {text}" if text else ""
        for run in (slices(whole) if self.interned.a.cuts and self.interned.b.cuts else [whole]) if text else ():
            self.waiting.append((len(self.numbers) - 1, CHUNK.findall(run) if self.interned.a.cuts and self.interned.b.cuts else [run]))
            self.size += len(run)
            if self.size >= SLICE:
                self.work()

    def work(self) -> None:
        """Counts the groups of the runs that wait."""
        known, runs = self.interned, self.waiting
        self.waiting, self.size = [], 0
        if not runs:
            return
        if known.full():
            known.forget()
        new = [c for c in dict.fromkeys(chain.from_iterable(chunks for _, chunks in runs)) if c not in known.chunk]
        if new:
            known.learn(new)
        pieces = np.fromiter(map(known.chunk.__getitem__, chain.from_iterable(chunks for _, chunks in runs)), dtype=np.int64)
        edges = np.r_[0, np.cumsum([len(chunks) for _, chunks in runs])]
        own = known.numbers[pieces]
        sums = np.concatenate([np.zeros((1, 5), dtype=np.int64), np.cumsum(own, axis=0)])
        starts = np.cumsum(known.numbers[:, 2]) - known.numbers[:, 2]
        groups = known.groups[ranges(starts[pieces], own[:, 2])]
        group_edges = sums[edges, 2]
        texts = np.array(known.texts, dtype=object)
        for (doc, chunks), i, j, first, last in zip(runs, edges, edges[1:], group_edges, group_edges[1:]):
            part = sums[j] - sums[i]
            good = self.numbers[doc][4] and part[4] == len(chunks)
            self.numbers[doc] = self.numbers[doc] + [*part[:4], 0] if good else np.zeros(5, dtype=np.int64)
            if good:
                begun = self.digests[doc]
                self.digests[doc] = begun or hashlib.sha256()
                self.digests[doc].update((";" if begun else "").encode() + ";".join(texts[groups[first:last]].tolist()).encode())
        met, at = np.unique(groups, return_inverse=True)
        places = np.fromiter((self.place.setdefault(known.texts[g], len(self.place)) for g in met.tolist()), dtype=np.int64, count=len(met))
        docs = np.repeat([doc for doc, _ in runs], np.diff(group_edges))
        self.found.append(np.unique(docs << 32 | places[at], return_counts=True))

    def row(self, ids: pa.Array) -> pa.RecordBatch:
        self.work()
        numbers = np.array(self.numbers, dtype=np.int64).reshape(-1, 5)
        cells = np.concatenate([np.zeros(0, dtype=np.int64), *[c for c, _ in self.found]])
        cells, which = np.unique(cells, return_inverse=True)
        times = np.zeros(len(cells), dtype=np.int64)
        np.add.at(times, which, np.concatenate([np.zeros(0, dtype=np.int64), *[n for _, n in self.found]]))
        stays = numbers[cells >> 32, 4] == 1
        cells, times = cells[stays], times[stays]
        doc, at = cells >> 32, cells & 0xFFFFFFFF
        pairs, surplus = self.twice(doc, at)
        lists = {
            "ids": ids, **{n: pa.array(numbers[:, i]) for i, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "digests": pa.array([d.hexdigest() if d is not None and good else "" for d, good in zip(self.digests, numbers[:, 4])], pa.string()), "ends": pa.array(np.searchsorted(doc, np.arange(len(numbers)), side="right"), pa.int32()),
            "at": pa.array(at, pa.int32()), "times": pa.array(times), "keys": pa.array(list(self.place), pa.string()), "docs": pa.array(np.bincount(at, minlength=len(self.place)), pa.int64()),
            "twice": pa.StructArray.from_arrays([pa.array([int(p[0]) for p in pairs], pa.int32()), pa.array([int(p[1]) for p in pairs], pa.int32()), pa.array(surplus, pa.int64())], ["a", "b", "n"]),
        }
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists.values()], list(lists))

    def twice(self, doc: np.ndarray, at: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
        """Pairs that documents link by more than one group, and by how many groups more than one, summed over documents."""
        number: dict[str, int] = {}
        of = [[number.setdefault(p, len(number)) for p in linked(key)] for key in self.place]
        pair, size = flat(of)
        links = pair[ranges((np.cumsum(size) - size)[at], size[at])] if len(at) else pair[:0]
        cells, times = np.unique(np.repeat(doc, size[at]) << 32 | links, return_counts=True)
        surplus = np.zeros(len(number), dtype=np.int64)
        np.add.at(surplus, cells & 0xFFFFFFFF, times - 1)
        some = np.flatnonzero(surplus)
        names = list(number)
        return [names[i].split("|") for i in some], surplus[some]


def blocks(path_a: str, path_b: str, most: int):
    """A mapInArrow function: (id, text) to one row for each batch of documents."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        interned = Interned(tokenizer(path_a), tokenizer(path_b), most)
        for part in parts:
            if part.num_rows:
                block = Block(interned)
                for text in part["text"]:
                    block.add(text.as_py())
                yield block.row(part["id"])

    return run


def expanded(parts: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """(g, docs) to the links of each group: (g, docs, a, b, times), where times is how many of the group's links have these ids."""
    for part in parts:
        rows: list[tuple] = []
        for g, docs in zip(part["g"].to_pylist(), part["docs"].to_pylist(), strict=True):
            a, b = (Counter(map(int, side.split(","))) for side in g.split("|"))
            for x, m in a.items():
                rows += [(g, docs, x, y, m * n) for y, n in b.items()]
                if len(rows) > most:
                    yield link_batch(rows)
                    rows = []
        if rows:
            yield link_batch(rows)


def link_batch(rows: list[tuple]) -> pa.RecordBatch:
    g, docs, a, b, times = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(docs, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(times, pa.int64())], ["g", "docs", "a", "b", "times"])


def summed(names: list[str]):
    """A mapInArrow function: blocks with the values of their groups to a row per document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                own = {name: part[name][i].values for name in ("ids", "n_a", "n_b", "n_groups", "n_links", "digests", "ends", "at", "times", "places", "best", "total")}
                at, times, ends = (np.asarray(own[name]) for name in ("at", "times", "ends"))
                sums = []
                for name in ("best", "total"):
                    of_group = np.zeros(len(own["places"]), dtype=np.int64)
                    of_group[np.asarray(own["places"])] = np.asarray(own[name])
                    before = np.concatenate([[0], np.cumsum(times * of_group[at])])
                    sums.append(pa.array(np.diff(before[ends], prepend=0), pa.int64()))
                yield pa.RecordBatch.from_arrays([*[own[n] for n in ("ids", "n_a", "n_b", "n_groups", "n_links")], *sums, own["digests"]], names)

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", most: int = 300_000) -> DataFrame:
    """One row per row of docs: id, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256.

    Each text with a space before it is encoded without special tokens by the
    files at path_a and path_b (a .model file adds that space itself); the files
    must be readable there on every worker. n_links counts all pairs of an A
    token and a B token in a common group. The count of an id pair is the number
    of rows of docs that hold it linked; n_best is the number of links whose
    count is the highest of their A id (ties included), count_sum the sum of
    counts over links. groups_sha256 is the hash of the groups in order, joined
    by ";".

    Null and empty texts, and texts that the bytes of either side don't give
    back (as where a tokenizer writes the same for two characters), have no
    tokens: zeros, an empty groups_sha256, and no part in the counts. Repeated
    rows count as documents of their own; other columns are not read; an empty
    table gives an empty result.

    Where both vocabularies allow it, texts are cut at single spaces between
    words, and each distinct piece is encoded once as long as a task remembers
    it (up to most pieces and groups, and 100 * most characters). Documents travel in blocks (one per Arrow batch) with a
    dictionary of their groups: what is joined and shuffled are a block's
    distinct groups, whatever the lengths of texts; a group that all blocks have
    meets one row. A task holds one block, its texts and their distinct groups;
    a text without spaces is encoded as a whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    longs = ", ".join(f"{c} array<bigint>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    shape = f"ids array<{kind}>, {longs}, digests array<string>, ends array<int>, at array<int>, times array<bigint>, keys array<string>, docs array<bigint>, twice array<struct<a: int, b: int, n: bigint>>"
    made = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(blocks(path_a, path_b, most), shape)
    made = written(made.withColumn("block", F.monotonically_increasing_id()), "alignment")

    dictionary = made.select(F.explode(F.arrays_zip("keys", "docs")).alias("k")).groupBy(F.col("k.keys").alias("g")).agg(F.sum("k.docs").alias("docs"))
    links = written(dictionary.mapInArrow(expanded, "g string, docs bigint, a int, b int, times bigint"), "links")
    again = made.select(F.explode("twice").alias("t")).select("t.a", "t.b", (-F.col("t.n")).alias("docs"))
    pairs = links.select("a", "b", "docs").unionByName(again).groupBy("a", "b").agg(F.sum("docs").alias("count"))
    pairs = written(pairs, "pairs")
    highest = pairs.groupBy("a").agg(F.max("count").alias("most"))
    valued = pairs.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("bigint").alias("is_best"))
    values = links.join(valued, ["a", "b"]).groupBy("g").agg(F.sum(F.col("times") * F.col("is_best")).alias("best"), F.sum(F.col("times") * F.col("count")).alias("total"))

    places = made.select("block", F.posexplode("keys").alias("place", "g")).join(values, "g")
    of_block = places.groupBy("block").agg(F.collect_list(F.struct("place", "best", "total")).alias("v"))
    whole = made.drop("keys", "docs", "twice").join(of_block, "block", "left").withColumn("v", F.coalesce("v", F.array().cast("array<struct<place: int, best: bigint, total: bigint>>")))
    whole = whole.withColumns({name: F.col(f"v.{field}") for name, field in (("places", "place"), ("best", "best"), ("total", "total"))}).drop("v", "block")
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return whole.mapInArrow(summed(names), f"`{id_col}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:-1]) + ", groups_sha256 string")
