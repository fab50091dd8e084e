"""The group dictionary against a plain alignment of whole texts."""

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import alignment
from docloom.llm.queries import TOKENIZERS, op13_cross_tokenizer_alignment

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def whole(text, libraries):
    """Groups of a text: both encodings of the whole, byte places of both, cut at the common ones."""
    a, b = libraries
    if not text:
        return []
    raw = f" {text}".encode()
    stands_for = alignment.byte_letters()
    ids_a, ids_b = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
    of_a = [bytes(stands_for[c] for c in a.id_to_token(i)) for i in ids_a]
    of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(of_a) != raw or b"".join(of_b) != raw:
        return []
    end_a, end_b = [*accumulate(map(len, of_a))], [*accumulate(map(len, of_b))]
    cuts, out, i, j = sorted(set(end_a) & set(end_b)), [], 0, 0
    for c in cuts:
        k, m = i, j
        while k < len(end_a) and end_a[k] <= c:
            k += 1
        while m < len(end_b) and end_b[m] <= c:
            m += 1
        out.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return out


def plain(rows, libraries):
    groups = [(i, whole(t, libraries)) for i, t in rows]
    count = Counter(p for _, gs in groups for p in {(x, y) for a, b in gs for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for i, gs in groups:
        links = Counter((x, y) for a, b in gs for x in a for y in b)
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
        out.append((
            i, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in links.items()), hashlib.sha256(said.encode()).hexdigest() if gs else "",
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [
    "<|endoftext|> <s> </s> <unk> <0x41> ▁ a", "▁", "a▁b", "plain <|endoftext|>text<s>", " lead", "  two  spaces ", "\n\n x \t y \n", "tail   ", "\x00 nul \x00\x01", "it's we'll 's ' s", "é x́ ́y", "日本語 の テキスト 123", "naïve façade",
    "\U0001F600 \U0001F468‍\U0001F469", "a b   c d", "\x1c a \x1d b", "x" * 3000, "ab " * 2000, "一龥" * 1500, " " * 500, "﻿ bom ‮", "aaaa bbbb aaaabbbb aa", "the the the cat", "the cat the", "1234567890 12 3", "don't don't",
]


def test_odd_texts(spark, odd_docs, no_docs, libraries):
    rows = [(100 + i, t) for i, t in enumerate(ODD)] + [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    docs = odd_docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string"), allowMissingColumns=True)
    assert got(alignment.align_documents(docs.repartition(3), A, B)) == plain(rows, libraries)
    none = alignment.align_documents(no_docs, A, B)
    assert none.count() == 0 and none.columns[-1] == "groups_sha256"


def test_small_memory_and_slices_change_nothing(spark, odd_docs, libraries, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert got(alignment.align_documents(docs, A, B, most=3)) == plain(rows, libraries)
    monkeypatch.setattr(alignment, "SLICE", 10)
    for text in ODD:
        block = alignment.Block(alignment.Interned(alignment.tokenizer(A), alignment.tokenizer(B), 3))
        block.add(text)
        assert "".join(alignment.slices(f" {text}")) == f" {text}"
        assert block.row(pa.array([1]))["digests"].to_pylist() == [[plain([(0, text)], libraries)[0][-1]]]


def test_whole_table(spark, sf, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op13_cross_tokenizer_alignment(spark, sf)) == plain(rows, libraries)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sé日́▁ \n\t \x1c1.\U0001F600<>"), max_size=40))
def test_pieces_are_encoded_as_in_the_whole_text(text):
    import sentencepiece
    import tokenizers

    both = getattr(test_pieces_are_encoded_as_in_the_whole_text, "both", None)
    if both is None:
        a = tokenizers.Tokenizer.from_file(A)
        a.encode_special_tokens = True
        both = test_pieces_are_encoded_as_in_the_whole_text.both = (a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.Interned(alignment.tokenizer(A), alignment.tokenizer(B), 10_000))
    block = alignment.Block(both[2])
    block.add(text)
    row = block.row(pa.array([1]))
    _, n_a, n_b, n_groups, n_links, _, _, digest = plain([(0, text)], both[:2])[0]
    assert [row[n][0][0].as_py() for n in ("n_a", "n_b", "n_groups", "n_links", "digests")] == [n_a, n_b, n_groups, n_links, digest]


def test_settled_characters_are_cut_alike(libraries):
    """Every character of the quick way, in all positions to its neighbours, as the file's own library has it."""
    quick = alignment.tokenizer(A)
    letters = [chr(c) for c in range(0x250)]
    texts = [f" {c}a{c}1{c} {c} {c}{c}  {c}'s{c}\n{c}" for c in letters]
    ids, size = quick.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
