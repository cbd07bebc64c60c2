"""Which row of a near-duplicate group stays, whatever its id."""

from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
import numpy as np

from seismark.llm import lines

from .fixtures import LOWER, frame, words

RND = random.Random(5)


def speak(n: int) -> str:
    return " ".join("".join(RND.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def kept(spark, rows) -> list:
    found = corpus_pipeline.near_dedup(spark, frame(spark, rows), "")
    return sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)


def test_null_and_repeated_ids(spark):
    one, two, three, four, five = (speak(60) for _ in range(5))
    rows = [(None, one), (None, two), (None, two), (7, three), (7, four), (7, four), (3, five), (7, five), (None, five)]
    want = sorted([(None, one), (None, two), (7, three), (7, four), (3, five)], key=str)
    assert kept(spark, rows) == want
    assert kept(spark, rows[::-1]) == want


def shingles(text: str) -> frozenset:
    own = words(text.translate(LOWER))
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def groups_by_brute_force(texts: list[str]) -> list[int]:
    """A group number of each text, from all pairs of shingle sets; no operator is used."""
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        x, y = sets[a], sets[b]
        if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
            group = [group[a] if g == group[b] else g for g in group]
    return group


def edited(text: str, edits: int) -> str:
    own = text.split(" ")
    for _ in range(edits):
        own[RND.randrange(len(own))] = speak(1)
    return " ".join(own)


def test_recall_against_all_pairs(spark):
    base = speak(120)
    boilerplate = speak(40)
    texts = [edited(base, n) for n in range(6) for _ in range(12)]
    texts += [boilerplate + " " + speak(12) for _ in range(60)] + [boilerplate + " " + speak(n % 9) for n in range(30)]
    texts += [speak(n % 7) for n in range(21)] + [base.upper(), base.replace(" ", "\n"), ""]
    for _ in range(30):
        own = speak(RND.randrange(30, 200))
        texts += [own, edited(own, 1), edited(own, 2), edited(own, 4)]
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = sorted({*texts, *(r["text"] or "" for r in table)})
    group = groups_by_brute_force(texts)
    first = {g: group.index(g) for g in set(group)}
    assert len(first) < len(texts) - 80
    want = sorted(((i, texts[i]) for i in first.values()), key=str)
    assert kept(spark, list(enumerate(texts))) == want


def test_sketches_bound_the_difference_and_tell_long_texts_apart():
    import numpy as np

    from seismark.llm.resemblance import sketch_distance, sketches_of

    rng = np.random.default_rng(3)
    for n, m, shared in ((30, 30, 20), (3000, 3700, 2900), (5000, 5000, 10), (40_000, 33_000, 0), (1, 1, 1)):
        both = rng.integers(0, 2**63, shared, dtype=np.uint64)
        sets = [np.concatenate([both, rng.integers(0, 2**63, size - shared, dtype=np.uint64)]) for size in (n, m)]
        left, right = (sketches_of(np.zeros(len(x), np.int64), x, 1)[0] for x in sets)
        difference = n + m - 2 * shared
        assert sketch_distance(left, right) <= difference
        if min(n, m) > 1000 and shared < 100:  # unlike texts are told apart however long they are
            assert 9 * sketch_distance(left, right) > n + m
    texts = sketches_of(np.array([0, 0, 2]), np.array([5, 5 + 2**40, 7], np.uint64), 3)
    assert texts[1] == bytes(len(texts[1])) and sketch_distance(texts[0], texts[1]) in (0, 2)


def test_fingerprints_bring_near_copies_together(spark, monkeypatch):
    """Without any shared shingle to meet under, linked fingerprints alone find near copies, and the
    shingles decide: texts of one fingerprint that are not similar stay apart."""
    from seismark.llm import resemblance, simhash

    base, other, third = speak(3000), speak(3000), speak(200)
    texts = [base, base + " tail", "head " + base, other, edited(other, 1), third, speak(200)]
    none = lambda texts: spark.createDataFrame([], "key long, node long, size long")
    monkeypatch.setattr(resemblance, "prefix_rows", none)
    rows = list(enumerate(texts))
    assert kept(spark, rows) == sorted([rows[0], rows[3], rows[5], rows[6]], key=str)
    monkeypatch.setattr(simhash, "text_fingerprints", lambda data, offsets, shingle=3: np.zeros(len(offsets) - 1, np.uint64))
    assert kept(spark, rows) == sorted([rows[0], rows[3], rows[5], rows[6]], key=str)


def test_fingerprints_are_linked_within_two_bits(spark):
    from seismark.llm import resemblance

    codes = [0, 3, 7, -1, -2, 7 << 40]  # 3 and 7 differ by a bit, 0 and 3 by two, -1 and -2 by one
    sketches = spark.createDataFrame([(n, 10, c, b"") for n, c in enumerate(codes)], "node long, size long, code long, sketch binary")
    key = {r["node"]: r["key"] for r in resemblance.fingerprint_rows(sketches).collect()}
    assert key[0] == key[1] == key[2] and key[3] == key[4] and len(set(key.values())) == 3


def test_shared_passages_do_not_bring_every_pair_of_their_texts_together(spark, monkeypatch):
    """Each passage stands in too few texts for a sample to tell, and in enough to meet pairwise."""
    from seismark.llm import resemblance

    passages = [speak(30) for _ in range(12)]
    texts = [" ".join([speak(50 + n % 20), passages[n % 12], speak(60)]) for n in range(12 * 40)]
    near = [edited(t, 2) for t in texts[:24]]
    boilerplate = [" ".join([passages[n % 12], passages[n % 11], speak(n % 7)]) for n in range(48)]
    every = sorted({*texts, *near, *boilerplate})
    made, old = [], resemblance.similar_pairs

    def counted(pairs, *others):
        made.append(pairs.distinct().count())
        return old(pairs, *others)

    monkeypatch.setattr(resemblance, "similar_pairs", counted)
    group = groups_by_brute_force(every)
    first = {g: group.index(g) for g in set(group)}
    assert len(first) <= len(every) - 24
    assert kept(spark, list(enumerate(every))) == sorted(((i, every[i]) for i in first.values()), key=str)
    assert made[-1] < len(every)


def test_open_pairs_lose_none_and_crowded_keys_bound_them():
    """Under any one key: the pairs of different groups that may be similar, and no fewer than that counted."""
    import pyarrow as pa

    from seismark.llm import resemblance

    rng = np.random.default_rng(4)
    n = 400
    size = rng.integers(1, 60, n)
    columns = [rng.integers(0, 6, n), rng.permutation(n), size, rng.integers(0, size // 5 + 1), rng.integers(0, 40, n)]
    columns[4][columns[0] == 5] = 1  # all joined
    key, node, size, place, group = columns
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "size", "place", "component"])
    want = {}
    for a, b in combinations(range(n), 2):
        if key[a] == key[b] and group[a] != group[b] and 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b]):
            if 9 * min(size[a] - place[a], size[b] - place[b]) >= 4 * (size[a] + size[b]):
                want.setdefault(key[a], set()).add(tuple(sorted((node[a], node[b]))))
    found = [p for b in resemblance.open_pairs(iter([batch])) for p in zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == set().union(*want.values())
    crowded = {k: p for b in resemblance.crowded_keys(iter([batch])) for k, p in zip(b["key"].to_pylist(), b["pairs"].to_pylist(), strict=True)}
    members = {k: int((key == k).sum()) for k in range(6)}
    assert crowded and 5 not in crowded
    assert all(len(pairs) <= max(crowded.get(k, 0), resemblance.CROWD * members[k]) for k, pairs in want.items())


def test_batches_of_texts_are_small_unless_the_session_says_otherwise(spark):
    """Every stage that holds whole texts in its tasks bounds the batches by bytes, not by rows alone."""
    from seismark.llm import passages
    from seismark.llm._spark import BATCH_BYTES

    rows = [(i, speak(60)) for i in range(5)]
    stages = [lambda s, d, f=f: f(s, d, "") for f in (corpus_pipeline.language_id, corpus_pipeline.line_dedup, corpus_pipeline.near_dedup)]
    for stage in [*stages, lambda s, d: passages.remove_passages(d), lambda s, d: lines.line_report(d)]:
        for own in (None, "1m"):
            session = spark.newSession()
            if own:
                session.conf.set(BATCH_BYTES, own)
            stage(session, frame(session, rows))
            assert session.conf.get(BATCH_BYTES) == (own or "4m")
