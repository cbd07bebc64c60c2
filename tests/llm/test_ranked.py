"""Ranked search against a plain scorer; the SQL statement is tested in test_oracle."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from seismark.llm import ranked

from .fixtures import LOWER, SCHEMA, frame, odd_texts

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute(rows, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    n_docs, n_words = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    found = Counter()
    for item, text in items:
        scored = []
        for i, count, n in held:
            m = 75 + (25 * n * n_docs) // max(n_words, 1)
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * count[w] // (1000 * count[w] + 12 * m))
                for w, times in Counter(terms(text)).items() if count[w]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found.update((item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k]))
    return found


def asked(spark, items):
    return spark.createDataFrame([(*x, "x", 1) for x in items], "item_id long, text string, rank string, score long")


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(4)
    rows = odd_texts()
    common = [w for _, t in rows for w in terms(t)][:500]
    rows += [(9000 + i, " ".join(rnd.choices(common, k=rnd.randint(1, 60)))) for i in range(400)]
    rows += [(20000 + i, "tied words here") for i in range(60)] + [(20003, "tied words here")] * 3
    items = [(i, " ".join(rnd.choices(common, k=k))) for i, k in enumerate((1, 3, 20, 90, 200))]
    items += [(50, "TIED words"), (50, "TIED words"), (51, None), (52, ""), (53, "unknownword"), (None, "tied here here"), (54, rows[6][1])]
    return rows, items


@pytest.mark.parametrize("options", [{}, {"part_bytes": 12_000, "k": 1000}])
def test_every_item_gets_its_best_documents(spark, corpus, options):
    rows, items = corpus
    found = ranked.ranked_search(frame(spark, rows), asked(spark, items), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == brute(rows, items, options.get("k", 20))


def test_blocks_and_steps_of_any_size(corpus):
    """The same best documents whatever the size of a block and however few documents it scores."""
    import pyarrow as pa

    rows, items = corpus
    vocabulary, searched = ranked.items_of([(i, t, 1) for i, t in items if t])
    where = {h: n for n, h in enumerate(vocabulary.tolist())}
    docs = []
    for i, text in rows:
        hashes, _ = ranked.hashed_words(pa.array([text], pa.string()))
        count = Counter(where[h] for h in hashes.tolist() if h in where)
        docs.append((i, len(hashes), sorted(count), [count[t] for t in sorted(count)]))
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*docs, strict=True), kinds, strict=True)], names=["doc_id", "n", "terms", "counts"])
    n_docs, n_words = sum(n > 0 for _, n, *_ in docs), sum(n for _, n, *_ in docs)
    weight = ranked.np.arange(len(vocabulary)) % 7 * 100
    results = []
    for documents, postings, cells, scored in ((8192, 10**6, 1 << 24, 64), (50, 10**6, 64, 1), (8192, 300, 5000, 7)):
        with pytest.MonkeyPatch.context() as patch:
            for name, value in (("BLOCK_DOCUMENTS", documents), ("BLOCK_POSTINGS", postings), ("PRESENCE_CELLS", cells), ("FIRST_SCORED", scored)):
                patch.setattr(ranked, name, value)
            best = [ranked.Best(20) for _ in searched]
            seen = 0
            for block in ranked.blocks(iter([batch]), n_docs, n_words, len(vocabulary)):
                seen += len(block.ids)
                for item, own in zip(searched, best, strict=True):
                    block.search(item, weight, own)
            assert seen == len(rows)
            results.append([list(zip(b.score.tolist(), b.none.tolist(), b.id.tolist(), strict=True)) for b in best])
    assert results[0] == results[1] == results[2]
    assert any(results[0])


def test_empty_tables(spark):
    items = asked(spark, [(1, "some words")])
    assert ranked.ranked_search(spark.createDataFrame([], SCHEMA), items).count() == 0
    assert ranked.ranked_search(frame(spark, odd_texts()), items.limit(0)).count() == 0
    assert ranked.ranked_search(frame(spark, [(1, None), (2, "")]), items).count() == 0
