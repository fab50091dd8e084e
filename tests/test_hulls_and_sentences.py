"""Hull volumes against known ones and against all facets; learnt abbreviations against a plain version."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from docloom.operators import hulls, sentences


def every_facet(points):
    """The volume by trying every set of d points: a facet has all others on one side."""
    middle, total = points.mean(axis=0), 0.0
    for f in combinations(range(len(points)), points.shape[1]):
        normal, offset = hulls.plane(points, f, middle)
        if (points @ normal - offset <= 1e-9).all():
            total += abs(np.linalg.det(points[list(f)] - middle))
    return total / math.factorial(points.shape[1])


@pytest.mark.parametrize("d", [1, 2, 3, 4, 5])
def test_known_volumes(d):
    simplex = np.vstack([np.zeros(d), np.eye(d)])
    assert math.isclose(hulls.volume(simplex), 1 / math.factorial(d), rel_tol=1e-9)
    cube = np.array([[(i >> b) & 1 for b in range(d)] for i in range(1 << d)], dtype=float)
    assert math.isclose(hulls.volume(cube * 3 - 1), 3.0**d, rel_tol=1e-9)
    inside = np.random.default_rng(d).random((200, d))
    assert math.isclose(hulls.volume(np.vstack([cube, inside, cube])), 1.0, rel_tol=1e-9)
    assert hulls.volume(np.hstack([inside, inside[:, :1]])) == 0.0 and hulls.volume(inside[:d]) == 0.0 and hulls.volume(np.ones((9, d))) == 0.0


@pytest.mark.parametrize("d,n", [(2, 14), (3, 13), (4, 11), (5, 9)])
def test_random_points_equal_all_facets(d, n):
    for seed in range(5):
        points = np.random.default_rng(seed).normal(size=(n, d))
        assert math.isclose(hulls.volume(points), every_facet(points), rel_tol=1e-9)


def test_groups_in_parts(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 3))
    rows = [("a", p.tolist()) for p in points] + [("b", p.tolist()) for p in points[:3]] + [("c", None), (None, [0.0, 0.0, 0.0])] + [(None, p.tolist()) for p in np.eye(3)] + [("d", [1.0, 2.0, 3.0])] * 50
    df = spark.createDataFrame(rows, "k string, v array<double>")
    for part in (7, 10_000):
        found = {r.k: (r.n, r.volume) for r in hulls.hull_volumes(df, ["k"], "v", part).collect()}
        assert found.keys() == {"a", "b", "d", None} and found["b"] == (3, 0.0) and found["d"] == (50, 0.0)
        assert found["a"][0] == 500 and math.isclose(found["a"][1], hulls.volume(points), rel_tol=1e-9) and math.isclose(found[None][1], 1 / 6, rel_tol=1e-9)
    assert hulls.hull_volumes(df.limit(0), ["k"], "v").collect() == []


def bare(token):
    return re.sub(r"""^["'(\[]+|[,;:!?"')\]]+$""", "", token.lower())


def plain_abbreviations(texts):
    n, dotted = Counter(), Counter()
    for t in texts:
        for b in map(bare, re.findall(r"\S+", t or "", re.ASCII)):
            w = b.rstrip(".")
            if re.search(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]", w):
                n[w] += 1
                dotted[w] += b.endswith(".")
    p = min(max(sum(dotted.values()) / max(sum(n.values()), 1), 1e-12), 1 - 1e-12)
    out = set()
    for w, d in dotted.items():
        letters, rest = len(w.replace(".", "")), n[w] - d
        ratio = 2 * (d * math.log(0.99 / p) + rest * math.log(0.01 / (1 - p)))
        if d and ratio * math.exp(-letters) * (w.count(".") + 1) * float(letters) ** -rest >= 0.3:
            out.add(w)
    return out


def plain_sentences(text, known):
    out, own = [], ""
    for piece in re.split(r"(?<=[.!?])(?=\s)", text or "", flags=re.ASCII):
        own += piece
        last = re.findall(r"\S+$", piece, re.ASCII)
        if not (piece.endswith(".") and last and bare(last[0]).rstrip(".") in known):
            out.append(own)
            own = ""
    return [s for s in (re.sub(r"^\s+", "", s, flags=re.ASCII) for s in [*out, own]) if s]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(300)]

    def sentence():
        own = rng.choices(words, k=rng.randint(4, 12))
        own.insert(rng.randint(1, len(own) - 1), rng.choice(["dr.", "e.g.", "(etc.)", "Fig. 3", "vs."]))
        return " ".join(own).capitalize() + rng.choice([".", "!", "?", '."'])

    return [rng.choice([" ", "  ", "\n"]).join(sentence() for _ in range(rng.randint(1, 8))) for _ in range(120)] + [None, "", "  \n", "One. ", "No end", "..", "A.B. c. D"]


def test_planted_abbreviations_end_no_sentence(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    known = {r.word for r in sentences.abbreviations(df).collect()}
    assert known == plain_abbreviations(texts) and {"dr", "e.g", "etc", "fig", "vs"} <= known
    for most in (200_000, 0):
        got = {}
        for r in sorted(sentences.learnt_sentences(df, ["id"], most=most).collect(), key=lambda r: r.sentence_no):
            got.setdefault(r.id, []).append(r.sentence)
        assert got == {i: s for i, t in enumerate(texts) if (s := plain_sentences(t, known))}
    assert not any(re.search(r"\b(dr|vs|fig)\.$", s, re.I) for own in got.values() for s in own)


def test_known_abbreviations_and_none(spark):
    df = spark.createDataFrame([(1, "See Dr. Who. He left.")], "id int, text string")
    none, own = spark.createDataFrame([], "word string"), spark.createDataFrame([("dr",), ("dr",)], "word string")
    assert [r.sentence for r in sentences.learnt_sentences(df, ["id"], known=none).orderBy("sentence_no").collect()] == ["See Dr.", "Who.", "He left."]
    assert [r.sentence for r in sentences.learnt_sentences(df, ["id"], known=own).orderBy("sentence_no").collect()] == ["See Dr. Who.", "He left."]
    assert sentences.learnt_sentences(df.limit(0), ["id"]).collect() == []


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_are_counted_before_patterns_and_texts_stay_where_they_are(spark, texts, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    known = spark.createDataFrame([("dr",), (None,)], "word string")
    assert "Window" not in plan_of(sentences.learnt_sentences(df, ["id"], known=known))
    found = {n: sorted(sentences.learnt_sentences(df, ["id"], known=known, most=n).collect()) for n in (200_000, 0)}
    assert found[200_000] == found[0] != []
