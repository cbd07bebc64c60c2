"""License scan against plain search of phrases and plain alignment of notices."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from seismark.llm import licenses
from seismark.llm.license_texts import NOTICES, PHRASES

from .fixtures import LOWER, SCHEMA, frame, odd_texts

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def notice_spans(text, notice, number):
    """(score, number, start, stop) of merged diagonals with votes enough."""
    k = min(3, len(notice))
    places = defaultdict(set)
    for i in range(len(text) - k + 1):
        for j in range(len(notice) - k + 1):
            if text[i : i + k] == notice[j : j + k]:
                places[i - j].add(j)
    group, spans = [], []
    for diagonal in [*sorted(places), None]:
        if group and (diagonal is None or diagonal - group[-1] > len(notice) // 8):
            if 4 * len(set().union(*(places[d] for d in group))) >= len(notice) - k + 1:
                start, stop = max(group[0], 0), min(group[-1] + len(notice), len(text))
                spans.append((2 * common(notice, text[start:stop]) / (len(notice) + stop - start), number, start, stop))
            group = []
        group.append(diagonal)
    return [s for s in spans if s[0] >= 0.8]


def brute(rows):
    found = Counter()
    for i, text in rows:
        own, base, labels, score = words(text), [], set(), 0.0
        for phrase, label in PHRASES.items():
            said = phrase.split()
            places = [p for p in range(len(own)) if own[p : p + len(said)] == said]
            base += [(p, label) for p in places]
        spans = [s for n, (_, notice) in enumerate(NOTICES) for s in notice_spans(own, words(notice), n)]
        taken = []
        for value, number, start, stop in sorted(spans, key=lambda s: (-s[0], s[1:])):
            if all(stop <= x or start >= y for x, y in taken):
                taken.append((start, stop))
                labels.add(NOTICES[number][0])
                score = max(score, value)
        at = [p for p, _ in base]
        names = {label for _, label in base}
        found[
            i, len(own), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(names)), ",".join(sorted(names | labels)),
            1.0 if base else score,
        ] += 1
    return found


def license_texts():
    full = [text for _, text in NOTICES]
    spoilt = [" ".join(w for i, w in enumerate(t.split()) if i % 11 != 5) for t in full]
    added = [" ".join(w + (" indeed" if i % 9 == 4 else "") for i, w in enumerate(t.split())) for t in full]
    texts = [
        *full, *spoilt, *added, "MIT-License, mit license MIT license", "the apache\nlicense of the apache license",
        "a general public license and a general public", "license mit", "mit license " * 500, "license " * 3000,
        "nothing here " * 200 + full[3] + " words " * 50 + full[5], full[1] + " " + full[1], "é" + full[0] + "中",
        "licensed under the " * 40, "the public license the public license general public license",
    ]
    return [(100 + i, t) for i, t in enumerate(texts)]


def test_license_scan(spark):
    rows = [*odd_texts(), *license_texts(), (100, NOTICES[0][1]), (None, NOTICES[4][1]), (100, "other text, mit license")]
    found = licenses.license_scan(frame(spark, rows))
    assert found.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_whole_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert Counter(map(tuple, licenses.license_scan(documents).collect())) == brute(rows)


def test_versions_and_terms_are_told_apart(spark):
    rows = [(i, "Some words. " + text + " More words.") for i, (_, text) in enumerate(NOTICES)]
    found = {r["doc_id"]: r for r in licenses.license_scan(frame(spark, rows)).collect()}
    for i, (label, _) in enumerate(NOTICES):
        assert label in found[i]["labels"].split(",")
        assert set(found[i]["labels"].split(",")) <= {label, *filter(None, found[i]["base_labels"].split(","))}


def test_empty_table(spark):
    assert licenses.license_scan(spark.createDataFrame([], SCHEMA)).count() == 0
