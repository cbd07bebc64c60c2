"""Source divergence against plain counting; the SQL statement is tested in test_oracle."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from seismark.llm import divergence

from .fixtures import LOWER

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, row int, p long"


def brute(rows, min_docs):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [w.translate(LOWER) for w in WORD.findall(text or "")]
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
        groups[lang].add(source)
    found = []
    for lang, sources in groups.items():
        kept = [w for w, n in held[lang].items() if n >= min_docs]
        everything = sum((counts[lang, s] for s in sources), Counter())

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}

        q, p = shares(everything), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in sources if o != s]
            terms = [(q[w] - p[s][w], w.encode()) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:50])):
                found += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)]
    return Counter(found)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcé中Z") for _ in range(rnd.randint(1, 4))) for _ in range(200)]
    rows = []
    for _ in range(500):
        lang, source = rnd.choice(["en", "de", None]), rnd.choice(["hot"] * 8 + [f"s{i}" for i in range(12)] + [None, ""])
        pool = words[hash(source or "") % 50 :: 3] if rnd.random() < 0.5 else words
        rows.append((" ".join(rnd.choices(pool, k=rnd.randint(0, 40))) + rnd.choice(["", " 12 x-y", "\n"]), lang, source))
    rows += [(None, "en", "silent"), ("", "en", "blank"), ("only one", "tiny", "a"), (None, "tiny", "b"), ("x " * 5000, "en", "hot")]
    return [*rows, *rows[:20]]


def table(spark, rows):
    return spark.createDataFrame([(i % 3, *r, "x", 1, 2, 3) for i, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("min_docs, options", [(30, {}), (3, {"block_terms": 16, "block_sources": 3})])
def test_divergence(spark, rows, min_docs, options):
    found = divergence.divergence(table(spark, rows), min_docs, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == brute(rows, min_docs)


def test_empty_table(spark):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, total, terms = 10**14 + 7, 3 * 10**15 + 1, 10**9
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_tree_walk_prices_only_leaves_of_the_pair():
    rng = np.random.default_rng(1)
    dense = np.where(rng.random((9, 30)) < 0.1, rng.integers(1, 1000, (9, 30)), 0)
    zero = rng.integers(1, 50, 9)
    row, column = np.nonzero(dense)
    tree = divergence.QuadTree(row, column, dense[row, column], 5)
    a, b = np.triu_indices(9, 1)
    full = np.where(dense > 0, dense, zero[:, None])
    want = np.abs(full[a] - full[b]).sum(axis=1) - 30 * np.abs(zero[a] - zero[b])
    assert tree.excess(a, b, zero).tolist() == want.tolist()
    empty = divergence.QuadTree(row[:0], column[:0], row[:0], 5)
    assert empty.excess(a, b, zero).tolist() == [0] * len(a)
