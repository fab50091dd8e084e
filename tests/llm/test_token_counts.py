import math
import os
import random
import tracemalloc

import pytest

from docloom.llm import token_counts as tc
from docloom.llm.queries import TOKENIZERS, op1_token_counts

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")


def brute(token, pieces, longest, byte_score):
    """All end positions in turn, without a trie."""
    best = [(0.0, 0)]
    for i in range(1, len(token) + 1):
        size = len(token[i - 1].encode())
        options = [(best[i - 1][0] + size * byte_score, best[i - 1][1] + size)]
        for k in range(1, min(longest, i) + 1):
            if token[i - k : i] in pieces:
                options.append((best[i - k][0] + pieces[token[i - k : i]], best[i - k][1] + 1))
        best.append(min(options, key=lambda x: (-x[0], x[1])))
    return best[-1][1]


@pytest.mark.parametrize("scores", ["zipf", "stored"])
def test_trie_equals_brute_force(scores):
    model = tc.vocabulary(MODEL, scores)
    trie, rng = tc.Trie(*model), random.Random(1)
    words = [" the", " there", " therefore", "日本", "\U0001F600x", "\n\n", " "] + ["".join(rng.choice("abcdeéß ñ") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    assert [trie.count[trie.insert(w)] for w in words] == [brute(w, *model) for w in words] == [trie.walked(w) for w in words]


def test_shared_prefixes_have_one_node():
    trie = tc.Trie(*tc.vocabulary(MODEL, "zipf"))
    trie.insert(" there")
    n = len(trie.children)
    trie.insert(" the")
    assert len(trie.children) == n
    trie.insert(" these")
    assert len(trie.children) == n + 2


def test_against_a_unigram_tokenizer():
    """The public tokenizers library with the same pieces and scores segments with the same number of pieces."""
    from tokenizers import Tokenizer, models

    pieces, longest, byte_score = tc.vocabulary(MODEL, "zipf")
    other = Tokenizer(models.Unigram([("<unk>", -100.0), *pieces.items()], unk_id=0, byte_fallback=False))
    words = [" tokens", " are", " counted", " by", " dynamic", " programming", "abc", " Straße", " extraordinarily"]
    trie = tc.Trie(pieces, longest, byte_score)
    assert [len(other.encode(w).ids) for w in words] == [trie.count[trie.insert(w)] for w in words]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken"])
def test_other_vocabulary_files(name):
    pieces, longest, byte_score = tc.vocabulary(f"{TOKENIZERS}/{name}", "zipf")
    assert " the" in pieces and byte_score < min(pieces.values()) and math.isfinite(byte_score)


def test_pre_tokens_lose_nothing():
    for text in ("a  b", " a\n\n b \t", "", "\x0b\x0c", "x y  ", "one two\r\nthree"):
        assert "".join(tc.PRE_TOKEN.findall(text)) == text


def test_query_equals_brute_force(spark, sf):
    model = tc.vocabulary(MODEL, "zipf")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = {}
    for r in op1_token_counts(spark, sf).collect():
        words = tc.PRE_TOKEN.findall(texts[r.doc_id])
        for w in words:
            known.setdefault(w, brute(w, *model))
        assert (r.n_tokens, r.n_pretokens) == (sum(known[w] for w in words), len(words))


def test_odd_rows_and_small_memory(odd_docs, no_docs):
    rows = tc.count_tokens(odd_docs, MODEL).collect()
    assert len(rows) == odd_docs.count() and {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {0}
    assert sorted(map(str, rows)) == sorted(map(str, tc.count_tokens(odd_docs, MODEL, most_nodes=10).collect()))
    assert sorted(map(str, rows)) == sorted(map(str, tc.count_tokens(odd_docs, MODEL, longest_token=3).collect()))
    assert tc.count_tokens(no_docs, MODEL).collect() == []


def test_a_text_without_white_space_takes_no_nodes():
    """320,000 characters in one pre-token, and very many distinct short ones in one text."""
    import pyarrow as pa

    model = tc.vocabulary(MODEL, "zipf")
    long = "thequickbrownfox" * 20_000
    many = " ".join(f"{i:x}q{i}" for i in range(15_000))
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "text": [long, many, "the end"]})
    tracemalloc.start()
    (out,) = tc.counts(MODEL, "zipf", 20_000, 512)([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and out["n_pretokens"].to_pylist() == [1, 15_000, 2]
    assert out["n_tokens"].to_pylist()[0] == tc.Trie(*model).walked(long) and out["n_tokens"].to_pylist()[2] == brute("the", *model) + brute(" end", *model)
