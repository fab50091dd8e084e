"""Token counts under a unigram model, by dynamic programming on a trie.

A text is cut into pre-tokens (a word with the space before it, or a run of
other white space). The distinct pre-tokens of a batch go into a trie; a node's
best forward score depends only on the path to it, so it is computed once for
all pre-tokens that share the prefix, together with the number of pieces of
that best segmentation. The count at a pre-token's last node is its token count,
and a text's count is the sum over its pre-tokens.

Pieces come from a public vocabulary file. Such files hold merge ranks, not
probabilities; by Zipf's law a piece of rank r is given log probability
-log(r + 1) (or, with scores="stored", the score in the file). Characters
without a piece fall back to one piece per UTF-8 byte.
"""

from __future__ import annotations

import base64
import json
import math
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.shared import small_batches

#: A word with one space before it, else white space that a word does not need.
PRE_TOKEN = re.compile(r"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+(?=[\x20\x09-\x0D]|$)|[\x20\x09-\x0D]", re.DOTALL)
#: How much less likely than the rarest piece a byte of an unknown character is.
PENALTY = 10.0


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranked_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, stored score) in rank order, as text; pieces that are not whole characters are left out."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return [(model.id_to_piece(i).replace("▁", " "), model.get_score(i)) for i in ids]
    if path.endswith(".tiktoken"):
        with open(path, "rb") as file:
            ranks = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, file))
    else:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        ranks = sorted((rank, bytes(letters[c] for c in piece)) for piece, rank in vocabulary.items() if all(c in letters for c in piece))
    out = []
    for rank, piece in ranks:
        try:
            out.append((piece.decode("utf-8"), float(-rank)))
        except UnicodeDecodeError:
            continue
    return out


@lru_cache(maxsize=4)
def vocabulary(path: str, scores: str) -> tuple[dict[str, float], int, float]:
    """Piece scores, the longest piece and the score of a byte."""
    table = {}
    for i, (piece, stored) in enumerate(ranked_pieces(path)):
        table.setdefault(piece, stored if scores == "stored" else -math.log(i + 2))
    return table, max(map(len, table)), min(table.values()) - PENALTY


class Trie:
    """Pre-tokens with shared prefixes. Per node: children, best forward score, pieces of that best."""

    def __init__(self, pieces: dict[str, float], longest: int, byte_score: float) -> None:
        self.pieces, self.longest, self.byte_score = pieces, longest, byte_score
        #: Longest piece with these last three characters: how far back a node has to look.
        self.reach: dict[str, int] = {}
        for p in pieces:
            if len(p) > 2 and len(p) > self.reach.get(p[-3:], 2):
                self.reach[p[-3:]] = len(p)
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.score: list[float] = [0.0]
        self.count: list[int] = [0]

    def insert(self, token: str) -> int:
        """The node of token; new nodes get their score and count from the nodes above, once. Of equal scores the one with fewer pieces counts."""
        children, score, count, pieces = self.children, self.score, self.count, self.pieces
        path = [0]
        for i, c in enumerate(token):
            below = children[path[-1]]
            node = below.get(c)
            if node is None:
                node = len(children)
                below[c] = node
                size = len(c.encode("utf-8", "surrogatepass"))
                best, n = score[path[-1]] + size * self.byte_score, count[path[-1]] + size
                for k in range(1, min(self.reach.get(token[i - 2 : i + 1], 2) if i > 1 else 2, i + 1) + 1):
                    p = pieces.get(token[i + 1 - k : i + 1])
                    if p is not None:
                        up = path[-k]
                        s, m = score[up] + p, count[up] + 1
                        if s > best or (s == best and m < n):
                            best, n = s, m
                children.append({})
                score.append(best)
                count.append(n)
            path.append(node)
        return path[-1]


    def walked(self, token: str) -> int:
        """The count of a token that is not worth nodes: the same scores, of which only as many are held as the longest piece reaches back."""
        scores, counts = deque([0.0], self.longest), deque([0], self.longest)
        for i, c in enumerate(token):
            size = len(c.encode("utf-8", "surrogatepass"))
            best, n = scores[-1] + size * self.byte_score, counts[-1] + size
            for k in range(1, min(self.reach.get(token[i - 2 : i + 1], 2) if i > 1 else 2, i + 1) + 1):
                p = self.pieces.get(token[i + 1 - k : i + 1])
                if p is not None:
                    s, m = scores[-k] + p, counts[-k] + 1
                    if s > best or (s == best and m < n):
                        best, n = s, m
            scores.append(best)
            counts.append(n)
        return counts[-1]


def counts(path: str, scores: str, most_nodes: int, longest_token: int):
    """A mapInArrow function: replaces the column text by n_tokens and n_pretokens.

    The trie and the counts of known pre-tokens live as long as a task. The trie
    is begun again whenever it passes most_nodes, also inside a text, and the
    counts go with it; pre-tokens of more than longest_token characters get no
    nodes. Both bound the memory and change no count.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(*vocabulary(path, scores)), {}
        for part in parts:
            tokens, pre = [], []
            for text in part["text"].to_pylist():
                words = PRE_TOKEN.findall(text) if text else []
                full = False
                for word in set(words).difference(known):
                    if len(word) > longest_token:
                        known[word] = trie.walked(word)
                        full = True
                        continue
                    known[word] = trie.count[trie.insert(word)]
                    if len(trie.children) > most_nodes:
                        trie.clear()
                        full = True
                tokens.append(sum(map(known.__getitem__, words)))
                pre.append(len(words))
                if full:
                    known = {}
            kept = [i for i, name in enumerate(part.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], pa.array(tokens, pa.int64()), pa.array(pre, pa.int64())], [*[part.schema.names[i] for i in kept], "n_tokens", "n_pretokens"])

    return run


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", scores: str = "zipf", most_nodes: int = 1_000_000, longest_token: int = 512) -> DataFrame:
    """One row per row of docs: id, n_tokens, n_pretokens.

    Null and empty texts have no tokens. Repeated rows each get their result;
    other columns are not read; an empty table gives an empty result. The
    vocabulary file must be readable at vocabulary_path on every worker. A text
    may be of any length, with white space or without: beside the text itself a
    task holds the trie and the distinct pre-tokens of one text.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    return rows.mapInArrow(counts(vocabulary_path, scores, most_nodes, longest_token), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, n_pretokens bigint")
