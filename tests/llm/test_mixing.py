import hashlib
import random
from collections import defaultdict

from docloom.llm import mixing


def targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Resharing in rounds, as the contract words it."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        rest = total - sum(full.values())
        now = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if now[s] > most * sizes[s]}
        if not over:
            return full | now
        full |= {s: most * sizes[s] for s in over}
        open_ -= over
    return full


def check(rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and (r.first_slot is None) == (r.taken == 0)
    want = targets(dict(sizes))
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) and abs(taken[s] - want[s]) <= 0.5001


def test_targets_and_takes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    check(rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_skew_and_null_source(spark):
    rows = [(i, f"w{i} " * (i % 37), ["hot", None, "b", "c", "Ω"][min(4, max(0, i % 9 - 4))]) for i in range(2000)]
    check(mixing.mix(spark.createDataFrame(rows, "doc_id int, text string, source string"), docs_per_block=4).collect())


def test_slots_are_spread(spark):
    """Any stretch of the schedule holds each source's share, but for a few slots; runs of points may be short."""
    t = spark.createDataFrame([("a", 614), ("b", 307), (None, 103)], "source string, n_blocks bigint")
    slots = sorted((r.slot, r.source, r.block) for r in mixing.schedule(t, 10, per_row=50).collect())
    assert [s for s, _, _ in slots] == list(range(1024))
    for source, share in (("a", 0.6), ("b", 0.3), (None, 0.1)):
        own = [(s, k) for s, x, k in slots if x == source]
        assert [k for _, k in own] == list(range(len(own)))
        for a in range(0, 1024, 50):
            assert abs(sum(a <= s < a + 200 for s, _ in own) - share * min(200, 1024 - a)) <= 12


def brute_stream(docs, bits, block, seed="mix-1"):
    """The training stream word by word: walk the slots, give each the next block of its source."""
    sizes = defaultdict(int)
    for _, s, n in docs:
        sizes[s] += n
    quota = {s: int(t + 0.5) for s, t in targets(dict(sizes)).items()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    stream = {}
    for s in sizes:
        own = sorted((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i, n) for i, x, n in docs if x == s)
        words = [(i, k) for _, i, n in own for k in range(n)]
        stream[s] = (words * 2)[: quota[s]]
    owner = [s for s in order for _ in range(-(-quota[s] // block))]
    out, at = [], defaultdict(int)
    for slot in range(1 << bits):
        point = int(format(slot, f"0{bits}b")[::-1], 2)
        if point < len(owner):
            s = owner[point]
            out += [(slot, *w) for w in stream[s][at[s] : at[s] + block]]
            at[s] += block
    return out


def test_pieces_equal_a_walk_over_the_slots(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["hot", "hot", "b", None]), rng.choice([0, 1, 7, 40, 300])) for i in range(120)]
    table = spark.createDataFrame([(i, "w " * n, s) for i, s, n in docs], "doc_id int, text string, source string")
    total = sum(int(t + 0.5) for t in targets({s: sum(n for _, x, n in docs if x == s) for s in {x for _, x, _ in docs}}).values())
    bits = 7
    block = max(1, -(-total // (2**bits - 3)))
    pieces = sorted(map(tuple, mixing.mixed_pieces(table, least_bits=bits).select("slot", "doc_id", "begin", "words").collect()))
    got = sorted((slot, i, begin + k) for slot, i, begin, words in pieces for k in range(words))
    assert got == sorted(brute_stream(docs, bits, block)) and len(got) == total


def test_the_schedule_decides(spark, monkeypatch):
    """Words come from slots only: other slots, other first places; fewer slots, fewer words."""
    docs = spark.createDataFrame([(i, "w " * (i % 50), f"s{i % 3}") for i in range(300)], "doc_id int, text string, source string")
    rows = lambda: {r.doc_id: (r.taken, r.first_slot) for r in mixing.mix(docs).collect()}
    usual, schedule = rows(), mixing.schedule
    monkeypatch.setattr(mixing, "reversed_bits", lambda point, bits: point)
    in_turn = rows()
    monkeypatch.undo()
    monkeypatch.setattr(mixing, "schedule", lambda blocks, bits: schedule(blocks, bits).where("block % 2 = 0"))
    half = rows()
    monkeypatch.setattr(mixing, "schedule", lambda blocks, bits: schedule(blocks, bits).where("false"))
    none = rows()
    assert {i: s for i, (_, s) in usual.items()} != {i: s for i, (_, s) in in_turn.items()}
    assert 0 < sum(t for t, _ in half.values()) < sum(t for t, _ in usual.values()) and set(none.values()) == {(0, None)}


def test_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check(rows)
    assert mixing.mix(no_docs).collect() == []


def test_only_empty_texts(spark):
    rows = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id int, text string, source string")).collect()
    assert [(r.size, r.taken) for r in rows] == [(0, 0), (0, 0)]
