"""Language identification in two steps: the family first, then one language against another.

Features are hashed byte n-grams of the lower-cased text with everything but letters blanked. All
classifiers are linear support vector machines, trained in numpy on a bounded sample of labelled
rows (``ROWS_PER_LANGUAGE`` of each language, ``SAMPLE_CHARS`` characters of each). Prediction reads
whole texts: a linear score is a sum of weights, so a text is a lookup per n-gram.

The classifiers tell languages from each other and always name one. Whether a text is in any of them
at all is told by its likeness: the mean log frequency of its n-grams in a language, against what
labelled texts score that the frequencies were not counted on. It is low for every language for
junk and for languages that nobody labelled. Short texts get the wider margin that they need.

Edge cases: a text that is null or has no letter is ``und`` with score 0; without any labelled row
every text is; a language of an unknown family is a family of its own; with one learned language
every other text gets it; repeated rows and extra columns do not matter; a null id is not held out
and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismark.llm._spark import bounded_sample, numbered, remainder, renamed_back, small_batches
from seismark.llm._text import LOWER, slices, utf8

ROWS_PER_LANGUAGE = 200
SAMPLE_CHARS = 3000
ORDERS = (1, 2, 3, 4)
BITS = 12
UNDETERMINED = "und"
#: A text is rejected when it lies this many times further below its language's mean likeness than
#: all but a few (the share) of the labelled texts do.
SLACK = 1.5
#: And never within this many spreads times the slack, however evenly a small sample scores.
LEAST_SPREADS = 4.0
OUTLIERS = 0.001

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "finnic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "iranian": "fa ps ku tg",
    "indic": "hi bn ur pa gu mr ne si",
    "semitic": "ar he mt am",
    "celtic": "ga cy gd br",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_BLANKED = np.where(_LETTER[LOWER], LOWER, 32).astype(np.uint8)
_FACTORS = [np.uint32(0x9E3779B1 ^ (0x85EBCA6B * (i + 1) & 0xFFFFFFFF)) | np.uint32(1) for i in range(max(ORDERS))]


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the feature of every position and whether its n-gram ends in its row."""
    code = _BLANKED[data].astype(np.uint32)
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    for k, order in enumerate(ORDERS):
        n = max(0, len(code) - order + 1)
        h = np.zeros(n, np.uint32)
        for i in range(order):
            h = h * np.uint32(31) + code[i : i + n] * _FACTORS[i]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        feature = (h >> np.uint32(32 - BITS)).astype(np.int64) + (k << BITS)
        yield feature, np.arange(n) + order <= row_end[:n]


def mean_weights(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns of ``weights``): mean weight of the n-grams of a row; and their number."""
    n, columns = len(offsets) - 1, weights.shape[1]
    total, count = np.zeros((n, columns)), np.zeros(n)
    filled = np.flatnonzero(np.diff(offsets))
    for feature, whole in grams(data, offsets):
        feature, at = feature[whole], np.concatenate([[0], np.cumsum(whole)])[np.minimum(offsets, len(whole))]
        has = filled[at[filled + 1] > at[filled]]
        if not len(has):
            continue
        count[has] += (at[has + 1] - at[has])
        for c in range(columns):
            total[has, c] += np.add.reduceat(weights[:, c][feature], at[has], dtype=np.float64)
    return total / np.maximum(count, 1)[:, None], count


@dataclass
class Profile:
    """Log frequencies (features x languages), and what labelled texts score by them: the mean, the
    spread between long texts, that of a single n-gram, and the limit in these spreads."""

    logs: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    single: np.ndarray
    limit: float = np.inf

    def distance(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, languages): spreads by which a text lies below the mean of a language."""
        return self.below(*mean_weights(self.logs, data, offsets))

    def below(self, score: np.ndarray, count: np.ndarray) -> np.ndarray:
        return (self.mean - score) / np.sqrt(self.spread**2 + self.single**2 / np.maximum(count, 1)[:, None])

    def strange(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether a text is unlike every language."""
        return self.distance(data, offsets).min(axis=1) > self.limit


def log_frequencies(texts: list[list[str]]) -> np.ndarray:
    """(features, languages): log frequency of every feature among those of its order."""
    size = 1 << BITS
    count = np.full((len(ORDERS) << BITS, len(texts)), 0.5)
    for language, own in enumerate(texts):
        for feature, whole in grams(*utf8(pa.array(own, pa.string()))):
            count[:, language] += np.bincount(feature[whole], minlength=len(count))
    by_order = count.reshape(len(ORDERS), size, -1)
    return np.log(by_order / by_order.sum(axis=1, keepdims=True)).reshape(count.shape)


def profile_of(rows: list[tuple[str, str]], languages: list[str]) -> Profile:
    """The likeness of (text, language) rows; each half of them is scored by the other one.

    A language with one row has no score out of sample, and nothing is rejected then.
    """
    texts = [[text for text, lang in rows if lang == name] for name in languages]
    logs = log_frequencies(texts)
    score, count, target = [], [], []
    rng, halves = np.random.default_rng(0), [log_frequencies([own[half::2] for own in texts]) for half in (0, 1)]
    for language, own in enumerate(texts):
        for number, text in enumerate(own):
            pieces = [text]
            for size in (20, 60, 250):
                at = int(rng.integers(0, max(1, len(text) - size)))
                pieces.append(text[at : at + size])
            found, n = mean_weights(halves[1 - number % 2], *utf8(pa.array(pieces, pa.string())))
            score.append(found[n > 0])
            count += n[n > 0].tolist()
            target += [language] * int((n > 0).sum())
    every, count, target = np.concatenate(score), np.array(count), np.array(target, np.int64)
    score = every[np.arange(len(target)), target]
    profile = Profile(logs, *(np.full(len(languages), 1e-3) for _ in range(3)))
    for language in range(len(languages)):
        own = target == language
        if len(texts[language]) < 2 or not own.any():
            return profile
        far, n = score[own] - np.average(score[own], weights=np.sqrt(count[own])), count[own]
        profile.mean[language] = np.average(score[own], weights=np.sqrt(n))
        long = n >= np.median(n)
        profile.spread[language] = max(1e-3, np.sqrt(np.mean(far[long] ** 2)))
        profile.single[language] = max(1e-3, np.sqrt(np.mean(far[~long] ** 2 * n[~long]))) if (~long).any() else 1e-3
    # by the nearest language, as texts are judged: a wrong label or a passage in another one is not strange
    profile.limit = SLACK * max(LEAST_SPREADS, float(np.quantile(profile.below(every, count).min(axis=1), 1 - OUTLIERS)))
    return profile


@dataclass
class Model:
    """Weights (features x classifiers), biases, and what each classifier decides."""

    languages: list[str] = field(default_factory=list)
    families: list[list[int]] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    profile: Profile | None = None

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, classifiers): mean weight of the n-grams of a row, plus the bias."""
        return mean_weights(self.weights, data, offsets)[0] + self.bias

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number and confidence (0 to 1) of every row."""
        n = len(offsets) - 1
        sure = lambda x: 1 / (1 + np.exp(-np.clip(3 * x, -30, 30)))
        margin = self.margins(data, offsets)
        if len(self.families) > 1:
            one_family = sure(margin[:, : len(self.families)])
            one_family /= one_family.sum(axis=1, keepdims=True)
        else:
            one_family = np.ones((n, 1))
        family, score = one_family.argmax(axis=1), one_family.max(axis=1)
        votes = np.zeros((n, len(self.languages)))
        first = len(self.families) if len(self.families) > 1 else 0
        for k, (a, b) in enumerate(self.pairs):
            p = sure(margin[:, first + k])
            votes[:, a] += p
            votes[:, b] += 1 - p
        inside = np.full((n, len(self.languages)), -1.0)
        for f, members in enumerate(self.families):
            rows = family == f
            inside[np.ix_(rows, members)] = votes[np.ix_(rows, members)] / max(1, len(members) - 1) if len(members) > 1 else 1.0
        return inside.argmax(axis=1), score * inside.max(axis=1)


def linear_svm(x: np.ndarray, y: np.ndarray, epochs: int = 40, penalty: float = 1e-4, seed: int = 1) -> np.ndarray:
    """Weights (last one: bias) of a squared-hinge linear SVM; y is +1 or -1, classes weigh alike."""
    rng, n = np.random.default_rng(seed), len(y)
    weight = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum()))).astype(np.float32)
    w, mean = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    square, steps = np.full(x.shape[1] + 1, 1e-6, np.float32), 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 64):
            rows = order[at : at + 64]
            part = x[rows]
            slack = np.maximum(0, 1 - y[rows] * (part @ w[:-1] + w[-1])) * y[rows] * weight[rows]
            grad = np.append(-(slack @ part) / len(rows) + penalty * w[:-1], -slack.mean())
            square += grad * grad
            w -= 0.1 * grad / np.sqrt(square)
            if epoch >= epochs // 2:
                steps += 1
                mean += (w - mean) / steps
    return mean


def train(rows: list[tuple[str, str]]) -> Model:
    """A model of (text, language) rows. Pieces of each text teach it short texts too."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model()
    rng, texts, target = np.random.default_rng(0), [], []
    for text, lang in rows:
        pieces = [text]
        for size in (60, 250):
            at = int(rng.integers(0, max(1, len(text) - size)))
            pieces.append(text[at : at + size])
        texts += pieces
        target += [languages.index(lang)] * len(pieces)
    target = np.array(target)
    data, offsets = utf8(pa.array(texts, pa.string()))
    size = len(ORDERS) << BITS
    x = np.zeros((len(texts), size), np.float32)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    for feature, whole in grams(data, offsets):
        np.add.at(x, (row[: len(feature)][whole], feature[whole]), 1)
    x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
    spread = np.sqrt(np.maximum(np.einsum("nf,nf->f", x, x, dtype=np.float64) / len(x) - x.mean(axis=0, dtype=np.float64) ** 2, 0))
    scale = np.where(x.max(axis=0) > 0, 1 / (spread * np.sqrt(size) + 1e-7), 0).astype(np.float32)
    x *= scale
    families: dict[str, list[int]] = {}
    for number, lang in enumerate(languages):
        families.setdefault(FAMILY_OF.get(lang, lang), []).append(number)
    members = list(families.values())
    family = np.array([next(f for f, own in enumerate(members) if number in own) for number in range(len(languages))])
    pairs = [(a, b) for own in members for i, a in enumerate(own) for b in own[i + 1 :]]
    columns = []
    if len(members) > 1:
        columns += [linear_svm(x, np.where(family[target] == f, 1, -1).astype(np.float32)) for f in range(len(members))]
    for a, b in pairs:
        rows_of_pair = np.isin(target, (a, b))
        columns.append(linear_svm(x[rows_of_pair], np.where(target[rows_of_pair] == a, 1, -1).astype(np.float32)))
    if not columns:
        return Model(languages, members, pairs, np.zeros((size, 0), np.float32), np.zeros(0))
    w = np.stack(columns, axis=1)
    return Model(languages, members, pairs, np.ascontiguousarray(w[:-1] * scale[:, None]), w[-1].astype(np.float64))


def learn(
    labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id", likeness: bool = False
) -> Model:
    """A model from a bounded sample of the labelled rows, with the likeness of a language if asked."""
    text, lang = F.col(text_column), F.col(lang_column)
    rows = labelled.where(text.isNotNull() & lang.isNotNull() & text.rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    salt = F.xxhash64(F.col(id_column).cast("string"))
    at = F.lit(1) + F.pmod(salt, F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(1)))
    limits = dict.fromkeys(sorted(counts), ROWS_PER_LANGUAGE)
    sample = bounded_sample(rows, lang, limits, counts, salt).select(
        text.substr(at.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"), lang.alias("lang"), salt.alias("salt")
    )
    taken: dict[str, list] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["salt"], r["text"])):
        own = taken.setdefault(r["lang"], [])
        if len(own) < ROWS_PER_LANGUAGE:
            own.append((r["text"], r["lang"]))
    rows = [x for lang in sorted(taken) for x in taken[lang]]
    model = train(rows)
    if likeness and rows:
        model.profile = profile_of(rows, model.languages)
    return model


def predict_languages(documents: DataFrame, model: Model, keep: list[str], text_column: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``lang_pred`` and ``score`` of its whole text.

    With the likeness learned, a text unlike every language is ``und`` with score 0.
    """
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "_text"):
            known = np.array(batch.column("_lettered").fill_null(False).to_pylist(), bool)
            if model.languages:
                number, score = model.predict(*utf8(batch.column("_text")))
                if model.profile:
                    known &= ~model.profile.strange(*utf8(batch.column("_text")))
                name = np.array([*model.languages, UNDETERMINED], object)[np.where(known, number, len(model.languages))]
            else:
                name, score = np.full(len(known), UNDETERMINED, object), np.zeros(len(known))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), pa.array(name, pa.string()), pa.array(np.where(known, score, 0.0))],
                names=[*keep, "lang_pred", "score"],
            )

    text = F.col(text_column)
    source = documents.select(*keep, text.alias("_text"), text.rlike(r"\p{L}").alias("_lettered"))
    return source.mapInArrow(run, f"{shape}, lang_pred string, score double")


def training_rows(documents: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """The rows that may be learned from: not in the held-out fold."""
    return documents.where(remainder("doc_id", folds) != held)


def identify(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned outside the held-out fold."""
    model = learn(training_rows(documents))
    scored = predict_languages(documents, model, ["doc_id"])
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents in a learned language, with all their columns. Texts without a letter go, and
    those that are unlike every learned language."""
    small_batches(documents.sparkSession)
    model = learn(training_rows(documents), likeness=True)
    frame, names = numbered(documents)
    scored = predict_languages(frame.withColumn("_whole", F.col(names["text"])), model, list(names.values()), "_whole")
    return renamed_back(scored.where(F.col("lang_pred") != UNDETERMINED), names)
