"""Each operator against a brute-force version, on odd documents and on a whole small table."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seismark.llm import decontamination, language, lines, lm_score, packing, passages, simhash, substring, topk, toxicity
from seismark.llm._spark import components

from .fixtures import LOWER, SCHEMA, frame, odd_texts, words

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def corpora(spark):
    rows = odd_texts()
    small = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    return [(frame(spark, rows), rows), (table(spark, "documents"), small)]


def counted(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def windows_removed(units: list, length: int, counts: Counter) -> np.ndarray:
    gone = np.zeros(len(units), bool)
    for j in range(len(units) - length + 1):
        if counts[tuple(units[j : j + length]) if isinstance(units, list) else units[j : j + length]] > 1:
            gone[j : j + length] = True
    return gone


def test_packing(spark, corpora):
    coder = Tokenizer.from_file(TOKENIZER)
    for documents, rows in corpora:
        found = packing.pack(documents, TOKENIZER, bucket_bytes=1 << 18).toPandas()
        want = Counter()
        for i, text in rows:
            ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
            for at in range(0, len(ids), 2048):
                piece = np.array(ids[at : at + 2048], "<u4")
                want[i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
        number = [None if x != x else int(x) for x in found["doc_id"]]
        rest = zip(*(found[c] for c in ("start", "length", "ids_crc32", "doc_tokens")), strict=True)
        assert Counter((a, *map(int, b)) for a, b in zip(number, rest, strict=True)) == want
        for _, own in found.sort_values("offset").groupby("sequence_id"):
            assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
            assert own["length"].sum() <= 2048


def test_best_fit_takes_the_tightest_window():
    window, offset = packing.best_fit_decreasing(np.array([6, 5, 4, 3, 2]), 10)
    assert window.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]


def test_topk(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 500)]  # ties
    rows += [(600, None), (601, [None, *[0.1] * 7]), (602, [float("nan")] * 8), (603, [float("inf")] * 8), (None, [1.0] * 8), (620, [1.0] * 3)]
    data = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score long, place long")
    from pyspark.sql import functions as F

    for k, shard in ((20, 8192), (3, 40), (1000, 100)):
        found = topk.top_k(data, F.col("vec_id") % 20 == 0, k, shard_rows=shard, query_rows=7).collect()
        good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows[:500]]
        want = Counter()
        for q, x in good:
            if q % 20 == 0:
                best = sorted((-int(x @ y), i) for i, y in good if i != q)[:k]
                want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
        assert counted(found) == want
    assert topk.top_k(data.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("hot", [200_000, 1])
def test_substring(spark, corpora, hot):
    for documents, rows in corpora:
        raw = [(i, (t or "").encode()) for i, t in rows]
        counts = Counter(b[j : j + 200] for _, b in raw for j in range(len(b) - 199))
        want = Counter()
        for i, b in raw:
            gone = windows_removed(b, 200, counts)
            runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
            want[i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()] += 1
        assert counted(substring.remove_repeats(documents, shard_bytes=1 << 14, queue_bytes=1000, hot_contents=hot).collect()) == want


@pytest.mark.parametrize("hot", [200_000, 1])
def test_passages(spark, corpora, hot):
    for documents, rows in corpora:
        split = [(i, words(t)) for i, t in rows]
        counts = Counter(tuple(w[j : j + 35]) for _, w in split for j in range(len(w) - 34))
        want = Counter()
        for i, w in split:
            gone = windows_removed(w, 35, counts)
            kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
            want[i, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
        found = passages.remove_passages(documents, shard_windows=500, group_suffixes=50, hot_contents=hot)
        assert counted(found.collect()) == want


def test_decontamination(spark, corpora):
    import re

    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for documents, rows in corpora:
        texts = [t for _, t in rows if t and len(t) > 300]
        items = [(1, texts[0][20:200]), (2, "One"), (3, None), (4, ""), (1, texts[1][:90]), (None, texts[2][:150]), (10, "zzz yyy"), (5, texts[0][40:230])]
        benchmark = spark.createDataFrame([(*x, 7) for x in items], "item_id long, text string, words long")
        known: dict[tuple, set] = {}
        for i, t in items:
            own = word.findall((t or "").translate(LOWER))
            k = min(10, len(own))
            for j in range(len(own) - k + 1 if own else 0):
                known.setdefault(tuple(own[j : j + k]), set()).add(i)
        want = Counter()
        for i, t in rows:
            own, hit, found = word.findall((t or "").translate(LOWER)), set(), set()
            for k in range(1, 11):
                for j in range(len(own) - k + 1):
                    if owners := known.get(tuple(own[j : j + k])):
                        hit.update(range(j, j + k))
                        found |= owners - {None}
            names = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
            want[i, len(own), len(hit), len(found), names, bool(hit)] += 1
        for size in (16 << 20, 400):
            got = decontamination.contamination(spark, documents, benchmark, broadcast_bytes=size)
            assert counted(got.collect()) == want
        clean = decontamination.remove_contaminated(spark, documents, benchmark, broadcast_bytes=400)
        assert clean.columns == documents.columns and clean.count() == sum(n for x, n in want.items() if not x[-1])
        again = documents.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(7)))  # repeated and null ids
        want = Counter((None if x[0] is None or x[0] % 2 else 7, *x[1:]) for x in want.elements())
        assert counted(decontamination.contamination(spark, again, benchmark, broadcast_bytes=400).collect()) == want
        empty = decontamination.contamination(spark, documents, benchmark.limit(0))
        assert empty.where("contaminated").count() == 0 and empty.count() == len(rows)


def brute_groups(rows):
    codes = []
    for _, text in rows:
        w = words((text or "").translate(LOWER))
        shingles = [" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        codes.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (codes[a] ^ codes[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    least: dict[int, int] = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return Counter((i, f"{codes[a]:016x}", least.get(find(a))) for a, (i, _) in enumerate(rows))


def test_simhash(spark, corpora):
    for documents, rows in corpora:
        want = brute_groups(rows)
        assert counted(simhash.simhash_groups(documents).collect()) == want


def test_vantage_shards_lose_no_link(spark):
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2**63, 60, dtype=np.uint64)
    for _ in range(400):
        codes = np.append(codes, codes[rng.integers(len(codes))] ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64))))
    codes = np.unique(codes)
    data = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "code long")
    found = dict(components(simhash.near_duplicate_links(data, 2, 40), "test").collect())
    root = simhash.forest(len(codes), *np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2))
    label = [found.get(int(x), int(x)) for x in codes.view(np.int64)]
    assert len(set(zip(root.tolist(), label, strict=True))) == len(set(root.tolist())) == len(set(label))


def within(a: str, b: str, limit: int) -> bool:
    """Edit distance by the textbook table, after a bound by the bags of characters."""
    bag = Counter(a)
    bag.subtract(b)
    if sum(abs(n) for n in bag.values()) > 2 * limit:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > limit:
            return False
    return row[-1] <= limit


def brute_lines(rows, near_chars=20, edits=2):
    """Per document: rows, lines, repeats, near repeats, removed lines, links, and each line's class."""
    order = lambda i, t: (i is not None, i or 0, xxhash.xxh64_intdigest(t, 42) + 2**63 & 2**64 - 1)
    stands = Counter((i, t or "") for i, t in rows)
    own = {d: [(n, x) for n, x in enumerate(d[1].split("\n")) if x.strip(" \t\n\x0b\x0c\r")] for d in stands}
    first: dict[str, tuple] = {}
    for d in sorted(own, key=lambda d: order(*d)):
        for n, x in own[d]:
            first.setdefault(x, (order(*d), n, d[0]))
    texts, near = sorted(first, key=len), {x: [] for x in first}
    for a, x in enumerate(texts):
        limit = min(edits, len(x) // near_chars)
        for y in texts[a + 1 :]:
            if not limit or len(y) - len(x) > limit:
                break
            if within(x, y, limit):
                near[x].append(y)
                near[y].append(x)
    found = Counter()
    for d, lined in own.items():
        again = [(order(*d), n) > first[x][:2] for n, x in lined]
        close = [any(first[y][:2] < first[x][:2] for y in near[x]) for _, x in lined]
        copies = Counter(x for e in own for _, x in own[e])
        classes = tuple(
            (n, first[x][2], first[x][1], len(near[x]), a, b)
            for (n, x), a, b in zip(lined, again, close, strict=True) if copies[x] > 1 or near[x]
        )
        either = sum(a or b for a, b in zip(again, close, strict=True))
        found[d[0], stands[d], len(lined), sum(again), sum(close), either, sum(len(near[x]) for _, x in lined), classes] += 1
    return found, {frozenset((first[x], first[y])) for x in near for y in near[x]}


def lines_found(documents, **options):
    rows = lines.line_report(documents, **options).collect()
    classes = lambda r: tuple((x["line"], *x[2:]) for x in r["classes"])
    return Counter((*r[:-1], classes(r)) for r in rows)


def test_lines(spark, corpora):
    rnd = np.random.default_rng(3)
    speak = lambda n: "".join(rnd.choice(list("abcd é"), n))
    base = [speak(n) for n in (3, 12, 19, 20, 21, 30, 39, 40, 41, 60)]
    odd = [(None, base[8]), (None, base[8]), (None, base[8] + "\nother"), (7, "Yes.\n\n \t\nYes."), (7, "No.\nYes."), (8, "\r\nNo."), (8, "\r\nNo.")]
    for i in range(60):
        line = [list(base[k]) for k in rnd.integers(0, len(base), 4)]
        for x in line:
            for _ in range(rnd.integers(0, 4)):
                at = int(rnd.integers(0, len(x) + 1))
                x[at : at + int(rnd.integers(0, 2))] = rnd.choice(list("abc"), rnd.integers(0, 2)).tolist()
        odd.append((100 + i // 2, "\n".join("".join(x) for x in line)))
    for documents, rows in [*corpora, (frame(spark, odd), odd)]:
        want, links = brute_lines(rows)
        assert lines_found(documents) == want
        place = lambda x: ((x["doc_id"] is not None, x["doc_id"] or 0, x["text_hash"] + 2**63), x["number"], x["doc_id"])
        pairs = lines.linked_classes(documents).collect()
        assert len(pairs) == len(links) and {frozenset((place(r["a_first"]), place(r["b_first"]))) for r in pairs} == links


def test_lines_with_hot_keys_and_classes(spark, monkeypatch):
    """Splitting hot keys and broadcasting hot classes change no result."""
    rows = [(i, f"Page {i % 40:02d} of the report on rivers and lakes, printed\nall rights reserved\n{i}") for i in range(400)]
    want, _ = brute_lines(rows)
    assert lines_found(frame(spark, rows)) == want
    monkeypatch.setattr(lines, "HOT_LINES", 1)
    monkeypatch.setattr(lines, "HOT_SHARE", 0)
    monkeypatch.setattr(lines, "SAMPLE", 2)
    monkeypatch.setattr(lines, "HOT_CLASS_LINES", 20)
    assert lines_found(frame(spark, rows)) == want


def test_documents_without_their_repeated_lines(spark):
    rows = [(1, "kept\ntwice"), (2, "twice\nown"), (3, "twice"), (None, "twice\n\n"), (4, " \n"), (5, None), (5, ""), (1, "kept\ntwice")]
    kept = lines.without_repeats(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    want = [(None, "twice\n\n", 7), (1, "kept", 10), (1, "kept", 10), (2, "own", 3), (4, " \n", 2), (5, None, 0), (5, "", 0)]
    found = Counter((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect())
    assert found == Counter((i, t, 4 if t == "kept" else n) for i, t, n in want)


def test_edit_distance_band():
    rng = np.random.default_rng(8)
    left, right = [], []
    for _ in range(1500):
        a = "".join(rng.choice(list("abé"), rng.integers(0, 25)))
        b = list(a)
        for _ in range(rng.integers(0, 5)):
            at = int(rng.integers(0, len(b) + 1))
            b[at : at + int(rng.integers(0, 2))] = rng.choice(list("abc"), rng.integers(0, 2)).tolist()
        left.append(a)
        right.append("".join(b))
    for edits in (1, 2, 3):
        want = [min(edits + 1, lines.plain_distance(a, b)) for a, b in zip(left, right, strict=True)]
        assert lines.edit_distances(left, right, edits).tolist() == want


def test_language(spark, corpora):
    rows = odd_texts()
    found = {r["doc_id"]: r for r in language.identify(corpora[0][0]).collect()}
    assert len(found) == len({i for i, _ in rows})
    for i, t in rows:
        if t is None or not any(c.isalpha() for c in t):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0) or i is None
    documents = table(spark, "documents")
    held = [r for r in language.identify(documents).join(documents, "doc_id").collect() if r["held_out"]]
    assert held and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in held)
    assert language.keep_identified(documents).columns == documents.columns
    assert {r["lang_pred"] for r in language.identify(documents.limit(0).unionByName(documents.limit(0))).collect()} == set()


def test_toxicity(spark):
    big = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(documents, labels)
    assert found.count() == documents.count()
    held = found.where("held_out").join(labels, "doc_id").collect()
    order = sorted(held, key=lambda r: r["score"])
    rank = [n for n, r in enumerate(order, 1) if r["toxic"]]
    bad = len(rank)
    assert (sum(rank) - bad * (bad + 1) / 2) / (bad * (len(held) - bad)) > 0.8
    odd = toxicity.score_documents(frame(spark, odd_texts()), toxicity.learn(documents, labels)).collect()
    assert len(odd) == len(odd_texts()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in odd)
    none = toxicity.toxicity(documents, labels.limit(0)).agg({"score": "max"}).first()[0]
    assert none == 0.0


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = toxicity.Network(np.zeros(1 << toxicity.BITS), np.zeros(1 << toxicity.BITS))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(size=(5, 3 + 2 * toxicity.EMBEDDED))
    index, length = rng.integers(0, 5, (3, 4)), np.array([4, 2, 3])
    target, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        p = toxicity.sigmoid(net.run(net.gates(x), index, length))
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).mean()

    grads, dx = net.gradients(x, index, length, target, weight)
    for name, grad in [*grads.items(), ("x", dx)]:
        value = x if name == "x" else net.p[name]
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 6)]:
            keep, step = value[at], 1e-2
            value[at] = keep + step
            up = loss()
            value[at] = keep - step
            down = loss()
            value[at] = keep
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-3


def test_lm_score(spark):
    rows = odd_texts()
    documents = frame(spark, rows)
    target = documents.where("doc_id between 5 and 9").select("doc_id")
    columns = "doc_id", "n_tokens", "difference_micro"
    # all pairs by broadcast, as in so small a table; all by the join; some by each
    found, joined, mixed = (
        counted(lm_score.cross_entropy_difference(documents, target, hot_share=share).select(*columns).collect())
        for share in (lm_score.HOT_SHARE, 2.0, 2e-3)
    )
    import re

    token = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = [(i, token.findall((t or "").translate(LOWER))) for i, t in rows]
    aimed = [w for i, w in split if i is not None and 5 <= i <= 9]
    single = [Counter(x for w in part for x in w) for part in ([w for _, w in split], aimed)]
    total = [sum(c.values()) for c in single]
    known = set(single[0])
    named = lambda w: [x if x in known else None for x in w]
    pair = [Counter(p for w in part for p in zip(["^", *named(w)], named(w), strict=False)) for part in ([w for _, w in split], aimed)]
    rows_of = len(split), len(aimed)
    size = len(known)

    def p(model, before, word):
        own = single[model][word] if word is not None else total[model] - sum(single[model][w] for w in known)
        context = rows_of[model] if before == "^" else single[model][before] if before is not None else total[model] - sum(single[model][w] for w in known)
        seen = pair[model][before, word] / max(context, 1)
        return lm_score.BIGRAM_WEIGHT * seen + (1 - lm_score.BIGRAM_WEIGHT) * (own + 1) / (total[model] + size + 1)

    want = Counter()
    for i, w in split:
        micro = sum(int(np.floor((np.log(p(0, a, b)) - np.log(p(1, a, b))) * 1e6 + 0.5)) for a, b in zip(["^", *named(w)], named(w), strict=False))
        want[i, len(w), micro] += 1
    assert found == joined == mixed == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty, TOKENIZER).count() == 0
    assert substring.remove_repeats(empty).count() == passages.remove_passages(empty).count() == 0
    assert simhash.simhash_groups(empty).count() == lines.line_report(empty).count() == 0
    assert language.identify(empty).count() == 0
    assert lm_score.cross_entropy_difference(empty, empty).count() == 0
    assert toxicity.toxicity(empty, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_a_shard_of_passages_is_hashed_in_slices():
    """The working arrays of a shard's texts are those of a slice, not of all its bytes."""
    import tracemalloc

    import pyarrow as pa

    from seismark.llm import passages

    texts = [" ".join(f"word{n % 977:08d}" for n in range(i, i + 150)).encode() for i in range(2000)]
    batch = pa.RecordBatch.from_pydict(
        {"gram": [7] * 2000, "content": list(range(2000)), "places": [1] * 2000, "n": [116] * 2000, "bytes": pa.array(texts, pa.binary())}
    )
    tracemalloc.start()
    found = list(passages.decide(iter([batch]), 35, 1 << 17))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [b.num_rows for b in found] == [2000]
    assert peak < 20 * sum(map(len, texts)), peak / sum(map(len, texts))


def test_lines_use_the_memory_of_a_slice_again():
    """In a fresh process, as a Python worker is: almost no pages are faulted in once some slices are done."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import resource
import numpy as np, pyarrow as pa
from types import SimpleNamespace
from seismark.llm import lines
ran = []
frame = SimpleNamespace(mapInArrow=lambda run, schema: ran.append(run))
frame.select = lambda *names: frame
lines.line_rows(frame)
lines.entry_rows(frame, 2, 20, np.empty(0, np.int64))
text = "\\n".join(f"line {i} of a text that goes on for some time {i * 7919 % 10007}" for i in range(8000))
batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text_hash": [2], "text": [text]})
for run in ran:
    before = []
    for _ in run(iter([batch] * 12)):
        before.append(resource.getrusage(resource.RUSAGE_SELF).ru_minflt)
    print((before[-1] - before[5]) // 6)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(lines.__file__).parents[2], capture_output=True, text=True, check=True)
    assert max(map(int, done.stdout.split())) < 500, done.stdout


def test_lines_beyond_the_basic_plane():
    """Hashes of characters by table and by formula are the same."""
    chars = np.array([0, 10, 65, 0x4E00, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF], np.uint32)
    assert (lines.codes(chars) == lines.mix(chars.astype(np.uint64) + np.uint64(77))).all()


def test_known_chunks_take_little_memory(monkeypatch):
    """A worker keeps the ids of many distinct chunks, not Python objects for each; a full table starts anew."""
    import tracemalloc

    coder, plain = packing.Chunks(Tokenizer.from_file(TOKENIZER)), Tokenizer.from_file(TOKENIZER)
    texts = [" ".join(f"w{n * 2654435761 % 2**32:x}" for n in range(i, i + 4000)) for i in range(0, 80_000, 4000)]
    tracemalloc.start()
    for text in texts:
        (own,), whole = coder.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert not whole.any()
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert own.tolist() == plain.encode(texts[-1], add_special_tokens=False).ids
    assert kept < 80 * 80_000, kept / 80_000
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 100)
    for text in (texts[0], texts[3], texts[0]):
        (own,), _ = coder.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert own.tolist() == plain.encode(text, add_special_tokens=False).ids
