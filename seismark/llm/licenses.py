"""License scans by diagonal voting.

Templates are the base phrases and whole notices. Every text gives the rolling hashes of its word
k-grams (k = 3, and 2 for two-word phrases), which Spark joins to the template positions of the same
gram. A hit at word ``i`` of the text and ``j`` of the template votes for the diagonal ``i - j``, where
the template would begin. Votes are counted by diagonal, neighbouring diagonals (a word more or less
in eight) are merged into one span, and a span with a quarter of the template's grams is verified on
the words: a phrase must stand there word by word; a notice needs twice the longest common
subsequence of words, over the words of both, to be 0.8 or more. Of notices that overlap in a text
the best one gives its label.

Votes and spans belong to distinct texts, named by two 64-bit hashes, so that copies of a text add
up in the tasks that read them and are verified once. The templates are a fixed list of some dozens
of texts and are broadcast; of the documents' texts only those with a span move.

Edge cases: null and empty texts have no words; each repeated row gets a row of its own; a null id
is an id like any other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismark.llm._bitmap import bitmap_of, sifted
from seismark.llm._spark import written
from seismark.llm._text import LOWER, WORD_OR_HIGH, mix, sequence_hashes, signed, slices, utf8, word_hashes, word_spans
from seismark.llm.license_texts import NOTICES, PHRASES

GRAM_WORDS = 3
#: Words of a notice to each word that may be added or left out within a span.
SLACK_WORDS = 8
#: Least share of a template's grams that vote for a span, as one in so many.
VOTES = 4
MIN_SCORE = 0.8
VERIFIED = "a long, b long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double"


def worded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of the words, and the n + 1 word offsets of the texts."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    return (data, *word_spans(data, offsets, WORD_OR_HIGH))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words; runs of different length never share one by design."""
    return mix(sequence_hashes(hashes, k) + np.uint64(k))


class Template:
    def __init__(self, label: str, text: str, exact: bool):
        data, starts, ends, _ = worded(pa.array([text]))
        self.label, self.exact = label, exact
        self.words = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
        self.k = min(GRAM_WORDS, len(self.words))
        self.grams = grams(word_hashes(data, starts, ends), self.k)
        self.slack = 0 if exact else len(self.words) // SLACK_WORDS
        self.least = -(-len(self.grams) // VOTES)
        self.places: dict[bytes, int] = {}
        for i, word in enumerate(self.words):
            self.places[word] = self.places.get(word, 0) | 1 << i

    def score(self, span: list[bytes]) -> float:
        """1 for the template itself; less the more words must be added or left out."""
        if self.exact:
            return float(span == self.words)
        full = (1 << len(self.words)) - 1
        row = full  # a cleared bit is a step of the common subsequence
        for word in span:
            met = row & self.places.get(word, 0)
            row = ((row + met) | (row - met)) & full
        return 2 * (len(self.words) - row.bit_count()) / (len(self.words) + len(span))


def templates(phrases: dict[str, str], notices: list[tuple[str, str]]) -> list[Template]:
    return [*(Template(label, text, True) for text, label in phrases.items()), *(Template(label, text, False) for label, text in notices)]


def keyed(documents: DataFrame, text_column: str) -> DataFrame:
    """The texts and the two hashes that name each."""
    text = F.coalesce(text_column, F.lit(""))
    return documents.select(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), text.alias("text"))


def gram_rows(texts: DataFrame) -> DataFrame:
    """(a, b, words, grams): the hashes of all 3-grams of a text, then those of all its 2-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, starts, ends, at = worded(batch.column("text"))
            words, hashes = np.diff(at), word_hashes(data, starts, ends)
            parts, row = [], np.repeat(np.arange(len(words)), words)
            for k in (GRAM_WORDS, 2):
                value = grams(hashes, k)
                inside = np.flatnonzero(np.arange(len(value)) + k <= at[1:][row[: len(value)]])
                parts.append((row[inside], value[inside]))
            row, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(len(words) + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(value[order])))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(words), lists], names=["a", "b", "words", "grams"])

    return texts.mapInArrow(run, "a long, b long, words long, grams array<long>")


def template_rows(spark, known: list[Template]) -> DataFrame:
    rows = [(number, at, t.k, gram) for number, t in enumerate(known) for at, gram in enumerate(signed(t.grams).tolist())]
    return spark.createDataFrame(rows, "template int, at int, k int, gram long")


def voted_spans(texts: DataFrame, known: list[Template]) -> DataFrame:
    """(a, b, spans): per text the spans (template, start, stop) that hold votes enough."""
    spark = texts.sparkSession
    limits = spark.createDataFrame([(i, t.slack, t.least, len(t.words)) for i, t in enumerate(known)], "template int, slack int, least int, size int")
    every = gram_rows(texts).select("a", "b", "words", F.posexplode("grams").alias("place", "gram"))
    long_grams = F.greatest(F.col("words") - (GRAM_WORDS - 1), F.lit(0))
    word = F.col("place") - F.when(F.col("k") == GRAM_WORDS, F.lit(0)).otherwise(long_grams)
    hits = every.join(F.broadcast(template_rows(spark, known)), "gram").select("a", "b", "template", word.alias("word"), "at")
    # at most one vote a template position: copies of a text and repeats add nothing
    votes = hits.groupBy("a", "b", "template", (F.col("word") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("at"))
    along = Window.partitionBy("a", "b", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    opens = F.when(gap <= F.col("slack"), 0).otherwise(1)
    numbered = votes.join(F.broadcast(limits), "template").withColumn("opens", opens).withColumn("span", F.sum("opens").over(along))
    merged = numbered.groupBy("a", "b", "template", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"), F.first("least").alias("least"),
        F.min("diagonal").alias("start"), (F.max("diagonal") + F.first("size")).alias("stop"),
    )
    enough = merged.where(F.col("votes") >= F.col("least"))
    return enough.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("template", "start", "stop"))).alias("spans"))


def verified_spans(words: list[bytes], spans: list[dict], known: list[Template]) -> list[tuple[Template, int, float]]:
    """(template, start, score) of the phrases that stand there, and of the notices that are alike
    enough; of notices that overlap only the best stays, among equals the first in the list."""
    phrases, notices = [], []
    for span in spans:
        template = known[span["template"]]
        start, stop = max(span["start"], 0), min(span["stop"], len(words))
        score = template.score(words[start:stop])
        if template.exact and score == 1:
            phrases.append((template, start, score))
        elif not template.exact and score >= MIN_SCORE:
            notices.append((-score, span["template"], start, stop))
    taken: list[tuple[int, int]] = []  # disjoint, in order
    for score, number, start, stop in sorted(notices):
        at = bisect_left(taken, (start, stop))
        if (at == len(taken) or taken[at][0] >= stop) and (at == 0 or taken[at - 1][1] <= start):
            taken.insert(at, (start, stop))
            phrases.append((known[number], start, -score))
    return phrases


def verify(batches: Iterator[pa.RecordBatch], phrases: dict[str, str], notices: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    known = templates(phrases, notices)
    names = [x.split()[0] for x in VERIFIED.split(", ")]
    for batch in slices(batches, "text"):
        data, starts, ends, at = worded(batch.column("text"))
        rows = []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            words = [data[s:e].tobytes() for s, e in zip(starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]], strict=True)]
            found = verified_spans(words, spans, known)
            base = [start for template, start, _ in found if template.exact]
            rows.append(
                (
                    len(base), min(base, default=None), max(base, default=None), sorted({t.label for t, _, _ in found if t.exact}),
                    sorted({t.label for t, _, _ in found}), max((score for *_, score in found), default=0.0),
                )
            )
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64()]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *columns], names=names)


def license_facts(
    documents: DataFrame, text_column: str = "text", phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str]] = NOTICES
) -> DataFrame:
    """What was found in each distinct text that holds any span, by its two hashes ``a`` and ``b``."""
    texts = keyed(documents, text_column)
    spans = written(voted_spans(texts, templates(phrases, notices)), "licenses-spans", free_shuffles=True)
    once = sifted(texts, ("a", bitmap_of(spans, "a"))).dropDuplicates(["a", "b"])
    return once.join(spans, ["a", "b"]).mapInArrow(lambda batches: verify(batches, phrases, notices), VERIFIED)


def counted_rows(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, a, b, n_words) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            *_, at = worded(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "a", "b")), pa.array(np.diff(at))], names=["doc_id", "a", "b", "n_words"])

    kind = dict(documents.dtypes)[id_column]
    text: Column = F.coalesce(text_column, F.lit(""))
    source = documents.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), text.alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, a long, b long, n_words long")


def license_scan(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per document: its words, the places and labels of base phrases, all labels, and the
    best score of a verified span (0 without one)."""
    facts = written(license_facts(documents, text_column, **options), "licenses-facts", free_shuffles=True)
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return counted_rows(documents, id_column, text_column).join(facts, ["a", "b"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        joined("base_labels").alias("base_labels"), joined("labels").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
