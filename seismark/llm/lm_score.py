"""Cross-entropy difference of two matched bigram models, per document.

Both models are interpolated word bigrams over one vocabulary with the same weights: the target
model counts the documents that the caller marks, the background model all documents. The
vocabulary is every word of the corpus; every word and every pair of neighbouring words is counted,
in every document, and none is cut off, so the model grows with the corpus and is a table.

A word is named by a code: frequent words (at least ``HOT_SHARE`` of all tokens, so at most
``1 / HOT_SHARE`` of them) by their place in a broadcast list that also holds their counts, others by
a 64-bit hash. A pair of frequent words that stands once in the corpus is not stored: whoever meets
it outside the table knows that its count is one, and one or zero in the target by its own document.
Such a pair's loss follows from the broadcast counts, so the table holds what repeated pairs add to
it, and the full loss of pairs with a rare word. Pairs with at least ``HOT_SHARE`` of all tokens are
broadcast as well; they are the keys that would crowd a shuffle. A document's other pairs meet the
table in a join, once per document and pair.

A token's loss difference is taken in whole millionths, so a document's sum is exact and does not
depend on its order. Lower is more like the target.

Edge cases: null and empty texts have no tokens and score null; without target words the target
model is the uniform one over the vocabulary; repeated rows are counted and scored one by one; a
null id is scored and never in the target; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.llm._spark import discard, written
from seismark.llm._text import LOWER, WORD_OR_HIGH, mix, signed, slices, utf8, word_hashes, word_spans

#: Bounds each broadcast list to four million entries of 24 bytes.
HOT_SHARE = 2.5e-7
BIGRAM_WEIGHT = 0.6
#: Distinct keys that a task sums before it hands them on.
HELD_KEYS = 1 << 19
MICRO = 1_000_000
#: Target ids that are broadcast; more of them meet the documents in a shuffled join.
BROADCAST_IDS = 2_000_000


class Words(NamedTuple):
    """The frequent words by hash, their counts, and the sums of all words; [0] background, [1] target.

    ``context`` has one more entry, the start of a document: a word's count as a predecessor, document
    ends included, is its count, and that of the start is the number of documents.
    """

    word: np.ndarray
    own: tuple[np.ndarray, np.ndarray]
    context: tuple[np.ndarray, np.ndarray]
    tokens: tuple[int, int]
    size: int

    def micro(self, pair, context, own) -> np.ndarray:
        """Loss under the target less that under the background, in millionths of a nat."""
        chance = [
            BIGRAM_WEIGHT * (pair[m] / np.maximum(context[m], 1)) + (1 - BIGRAM_WEIGHT) * ((own[m] + 1) / (self.tokens[m] + self.size + 1.0))
            for m in (0, 1)
        ]
        return np.floor((np.log(chance[0]) - np.log(chance[1])) * MICRO + 0.5).astype(np.int64)

    def single(self, a: np.ndarray, b: np.ndarray, target: np.ndarray | int) -> np.ndarray:
        """``micro`` of pairs of frequent words that stand once, in a document of the target or not."""
        context, own = ([counts[m][at] for m in (0, 1)] for counts, at in ((self.context, a), (self.own, b)))
        return self.micro((np.ones(len(a)), np.broadcast_to(target, len(a))), context, own)

    def frequent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a >= 0) & (a <= len(self.word)) & (b >= 0) & (b < len(self.word))

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One number for a pair of codes: counted off for two frequent words, else a hash."""
        hashed = signed(mix(mix(a.view(np.uint64)) + b.view(np.uint64)))
        with np.errstate(over="ignore"):
            return np.where(self.frequent(a, b), a * (len(self.word) + 1) + b, hashed)

    def codes(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the word before and of the word, for every token, and the offsets of the rows."""
        word, at = tokens(batch)
        if len(self.word):
            place = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
            word = np.where(self.word[place] == word, place, word)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[at[:-1][np.diff(at) > 0]] = len(self.word)
        return before, word, at


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the rows end to end, and the offsets of the rows."""
    data, offsets = utf8(batch.column("text"))
    data = LOWER[data]
    starts, ends, at = word_spans(data, offsets, WORD_OR_HIGH)
    return signed(word_hashes(data, starts, ends)), at


def flags(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("target").to_numpy(zero_copy_only=False).astype(np.int64)


def firsts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of sorted columns first stand."""
    fresh = np.zeros(len(columns[0]), bool)
    fresh[:1] = True
    for x in columns:
        fresh[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(fresh)


def counted(marked: DataFrame, names: list[str], parts: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]]) -> DataFrame:
    """(names, n, t): how often each stands in all documents and in the target's. ``parts`` gives a
    key for every token, the columns of ``names`` that it stands for, and the offsets of the rows.
    Tasks sum before the shuffle."""

    def summed(held: list[list[np.ndarray]]) -> list[np.ndarray]:
        key, *columns, n, t = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key)
        first = firsts(key[order])
        return [x[order[first]] for x in (key, *columns)] + [np.add.reduceat(x[order], first) for x in (n, t)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in held[0][1:]], names=[*names, "n", "t"])

        for batch in slices(batches, "text"):
            *columns, at = parts(batch)
            held.append(summed([[*columns, np.ones(at[-1], np.int64), np.repeat(flags(batch), np.diff(at))]]))
            if sum(len(part[0]) for part in held) > HELD_KEYS:
                held = [summed(held)]
                if len(held[0][0]) > HELD_KEYS // 2:
                    yield out()
                    held = []
        if held:
            held = [summed(held)]
            yield out()

    rows = marked.select("text", "target").mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n", "t"]))
    # tasks have summed what they can; a second partial sum before the shuffle would find next to nothing
    return rows.repartition(*names).groupBy(*names).agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def word_counts(marked: DataFrame, hot_share: float) -> tuple[DataFrame, Words]:
    """(word, n, t) of every word, as a table, and the frequent ones with the sums."""

    def parts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        word, at = tokens(batch)
        return word, word, at

    words = written(counted(marked, ["word"], parts), "lm-words", free_shuffles=True)
    total, aimed, size = words.agg(F.sum("n"), F.sum("t"), F.count(F.lit(1))).first()
    total, aimed = total or 0, aimed or 0
    rows, aimed_rows = marked.agg(F.count(F.lit(1)), F.count_if("target")).first()
    hot = words.where(F.col("n") >= F.lit(hot_share * total)).orderBy("word").toArrow()  # at most 1 / hot_share rows
    own = hot["n"].to_numpy(), hot["t"].to_numpy()
    context = tuple(np.append(x, y) for x, y in zip(own, (rows, aimed_rows), strict=True))
    return words, Words(hot["word"].to_numpy(), own, context, (total, aimed), size)


def loss_table(marked: DataFrame, words: DataFrame, shared) -> DataFrame:
    """(key, n, outside, more): a pair's count, what is to be added for each time a document outside
    the target has it, and what more inside the target."""

    def parts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        a, b, at = shared.value.codes(batch)
        return shared.value.key(a, b), a, b, at

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Words = shared.value
        for batch in batches:
            a, b, n, t, *looked_up = (batch.column(i).to_numpy() for i in range(8))

            def counts(code: np.ndarray, table: tuple, joined: list[np.ndarray]) -> list[np.ndarray]:
                inside = (code >= 0) & (code < len(table[0]))
                if not len(table[0]):
                    return joined
                at = np.where(inside, code, 0)
                return [np.where(inside, table[m][at], joined[m]) for m in (0, 1)]

            micro = known.micro((n, t), counts(a, known.context, looked_up[:2]), counts(b, known.own, looked_up[2:]))
            outside, inside = micro.copy(), micro.copy()
            hot = known.frequent(a, b)
            outside[hot] -= known.single(a[hot], b[hot], 0)
            inside[hot] -= known.single(a[hot], b[hot], 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (known.key(a, b), n, outside.astype(np.int32), (inside - outside).astype(np.int32))],
                names=["key", "n", "outside", "more"],
            )

    top = len(shared.value.word)
    before_hot, word_hot = F.col("a").between(0, top), F.col("b").between(0, top - 1)
    pairs = written(counted(marked, ["a", "b"], parts).where(~(before_hot & word_hot) | (F.col("n") > 1)), "lm-pairs", free_shuffles=True)
    # a rare word is looked up in the table, a frequent one in the broadcast list: no join has a frequent key
    before = words.select(F.col("word").alias("a"), F.col("n").alias("context_n"), F.col("t").alias("context_t"))
    own = words.select(F.col("word").alias("b"), F.col("n").alias("own_n"), F.col("t").alias("own_t"))
    kinds = [
        pairs.where(before_hot & word_hot),
        pairs.where(before_hot & ~word_hot).join(own, "b"),
        pairs.where(~before_hot & word_hot).join(before, "a"),
        pairs.where(~before_hot & ~word_hot).join(own, "b").join(before, "a"),
    ]
    whole = ["a", "b", "n", "t", "context_n", "context_t", "own_n", "own_t"]
    aligned = [kind.select(*[F.col(c) if c in kind.columns else F.lit(0).cast("long").alias(c) for c in whole]) for kind in kinds]
    every = aligned[0].unionByName(aligned[1]).unionByName(aligned[2]).unionByName(aligned[3])
    table = written(every.mapInArrow(losses, "key long, n long, outside int, more int"), "lm-losses", free_shuffles=True)
    discard(pairs)
    return table


def score(marked: DataFrame, losses: DataFrame, shared, hot_share: float) -> DataFrame:
    """(doc_id, n_tokens, difference_micro, score): mean loss difference per token, in nats."""
    bound = F.lit(hot_share * shared.value.tokens[0])
    hot = losses.where(F.col("n") >= bound).orderBy("key").toArrow()  # at most 1 / hot_share rows
    outside = hot["outside"].to_numpy()
    frequent = marked.sparkSession.sparkContext.broadcast((hot["key"].to_numpy(), np.stack([outside, outside + hot["more"].to_numpy()])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Words = shared.value
        hot_key, hot_add = frequent.value
        for batch in slices(batches, "text"):
            a, b, at = known.codes(batch)
            key, n = known.key(a, b), batch.num_rows
            row, flag = np.repeat(np.arange(n), np.diff(at)), np.repeat(flags(batch), np.diff(at))
            micro, hit = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
            both = known.frequent(a, b)
            micro[both] = known.single(a[both], b[both], flag[both])
            if len(hot_key):
                where = np.minimum(np.searchsorted(hot_key, key), len(hot_key) - 1)
                hit = hot_key[where] == key
                micro[hit] += hot_add[flag[hit], where[hit]]
            sums = np.concatenate([[0], np.cumsum(micro)])
            row, key = row[~hit], key[~hit]
            order = np.argsort(key)  # by key, and then by row: small numbers, which numpy sorts by their digits
            order = order[np.argsort(row[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
            row, key = row[order], key[order]
            fresh = firsts(row, key)
            times = np.diff(np.concatenate([fresh, [len(row)]]))
            # a document's own row, under a key that spreads, and behind it a row for each pair to look up
            source = np.concatenate([np.arange(n), row[fresh]])
            text = batch.column("text_hash").to_numpy()
            zeros = np.zeros(len(fresh), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(source)), pa.array(text[source]), batch.column("target").take(pa.array(source)),
                    pa.array(np.concatenate([text, key[fresh]])), pa.array(np.concatenate([np.zeros(n, np.int64), times])),
                    pa.array(np.concatenate([np.diff(at), zeros])), pa.array(np.concatenate([sums[at[1:]] - sums[at[:-1]], zeros])),
                ],
                names=["doc_id", "text_hash", "target", "key", "times", "n_tokens", "micro"],
            )

    shape = "doc_id long, text_hash long, target boolean, key long, times long, n_tokens long, micro long"
    rows = marked.withColumn("text_hash", F.xxhash64("doc_id", "text")).mapInArrow(run, shape)
    added = F.col("outside") + F.when(F.col("target"), F.col("more")).otherwise(0)
    # a key stands once in the table, so hashing it holds a partition's even share and nothing is sorted
    met = rows.join(losses.where(F.col("n") < bound).drop("n").hint("shuffle_hash"), "key", "left")
    # rows with one id and one text are summed together and dealt out again, so no row needs a number
    per_text = met.groupBy("doc_id", "text_hash").agg(
        F.count_if(F.col("times") == 0).alias("copies"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("micro") + F.when(F.col("times") > 0, F.col("times") * F.coalesce(added, F.lit(0))).otherwise(0)).alias("micro"),
    )
    dealt = per_text.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    mean = F.col("difference_micro") / F.col("n_tokens") / MICRO
    return dealt.select("doc_id", "n_tokens", F.expr("micro div copies").alias("difference_micro")).withColumn(
        "score", F.when(F.col("n_tokens") > 0, mean)
    )


def cross_entropy_difference(
    documents: DataFrame, target_ids: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Score every document against the documents whose id is in ``target_ids`` (column doc_id)."""
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("marked", F.lit(True))
    few = ids.count() <= BROADCAST_IDS
    marked = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left").select("doc_id", "text", F.coalesce("marked", F.lit(False)).alias("target"))
    if not few:
        marked = written(marked, "lm-marked", free_shuffles=True)
    words, known = word_counts(marked, hot_share)
    shared = documents.sparkSession.sparkContext.broadcast(known)
    losses = loss_table(marked, words, shared)
    discard(words)
    return score(marked, losses, shared, hot_share)
