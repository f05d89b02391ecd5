"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. The model of a category is a logistic regression with an
L1 penalty over the words of a text and their beginnings, and over the probabilities of all
earlier categories. For fitting, those are out-of-fold: a document's probability comes from a model
fitted without the document's fold. For prediction they come from the earlier final models.

Models are fitted on a bounded sample of labelled documents (``FIT_ROWS``, those with the least hashes of their ids) and on all
words and beginnings found in ``LEAST`` of them; any other word has no weight, so rare words cannot collide with telling ones. All models of a category are fitted side by
side, each in a task of its own. The penalty leaves few weights; they are sent to the tasks,
which score all documents, whole.

Rows whose labels are null are not fitted on; of labels of one id that clash the lower one counts. A category whose sample lacks one of the two
classes gets its base rate, 0 without any label. Null and empty texts have no words; they are scored by
the rest of the model and never rejected. Repeated rows get the same result; of texts that share an id
the least is fitted on. An empty table gives an empty result. Columns of any name stay as they are.
"""

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.sources.workspace import written

FIT_ROWS, LEAST, FOLDS = 8_000, 4, 3
BEGINNING = 4
PENALTY, STEPS = 0.0001, 250
WORDS = re.compile(r"[^\W_]+")


def terms_of(text: str | None) -> list[str]:
    """The different words of a text, and their different beginnings, marked by a dash."""
    words = set(WORDS.findall(text.lower())) if text else set()
    return [*words, *{word[:BEGINNING] + "-" for word in words}]


def _terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([sorted(terms_of(text)) for text in texts.to_pylist()], pa.list_(pa.string()))


def rejected(category: str, threshold: float = 0.5) -> Column:
    """Whether a scored document is taken to be of a category; one without words never is."""
    return (F.col(category) >= threshold) & (F.col("n_terms") > 0)


class Link:
    """One category's model: a base, a weight for every telling term and one for every earlier category."""

    def __init__(self, base: float, terms: dict[str, float], earlier: Sequence[float]):
        self.base, self.terms, self.earlier = base, terms, earlier

    def probability(self, terms: list[str], before: list[float]) -> float:
        weight = self.terms.get
        total = self.base + sum(weight(term, 0.0) for term in terms) + sum(w * p for w, p in zip(self.earlier, before))
        return 1 / (1 + math.exp(-total)) if total > -700 else 0.0


def _scorer(links: list[Link]):
    telling = set().union(*(link.terms for link in links))

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, columns = [], [[] for _ in links]
            for text in texts.to_pylist():
                found = terms_of(text)
                counts.append(len(found))
                found = sorted(telling.intersection(found))
                before: list[float] = []
                for link, column in zip(links, columns):
                    before.append(link.probability(found, before))
                    column.append(before[-1])
            arrays = [pa.array(counts, pa.int32()), *(pa.array(column, pa.float64()) for column in columns)]
            yield pa.StructArray.from_arrays(arrays, names=["n_terms", *(f"p{i}" for i in range(len(links)))])

    return score


class Chain:
    """Fitted links, in the order of their categories."""

    def __init__(self, categories: Sequence[str], links: list[Link]):
        self.categories, self.links = list(categories), links

    def scored(self, docs: DataFrame, text: str) -> DataFrame:
        """``row`` (the whole input row), ``n_terms`` and the probability of every category, named as it."""
        kind = "n_terms int" + "".join(f", p{i} double" for i in range(len(self.links)))
        score = F.arrow_udf(_scorer(self.links), kind)(F.coalesce(F.col(text), F.lit(""))).alias("score")
        named = [F.col(f"score.p{i}").alias(category) for i, category in enumerate(self.categories)]
        return docs.select(F.struct("*").alias("row"), score).select("row", "score.n_terms", *named)


def fit_chain(
    docs: DataFrame, labels: DataFrame, key: str, text: str, categories: Sequence[str], fit_rows: int = FIT_ROWS
) -> Chain:
    """A chain for 0/1 label columns, in the order given; ``labels`` names its documents by ``key``."""
    marks = [f"is_{i}" for i in range(len(categories))]
    marked = labels.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(m) for c, m in zip(categories, marks)])
    # Of labels that clash the lower one counts.
    marked = marked.dropna().groupBy("id").agg(*[F.min(m).alias(m) for m in marks])
    # Exactly fit_rows rows of numbers, however many labels there are: a few more by the share (ten standard deviations), then
    # the first of those. No text is shuffled for documents that are not chosen.
    share = (fit_rows + 10 * math.sqrt(fit_rows)) / max(1, marked.count())
    near = marked.filter(F.xxhash64("id") / F.lit(2.0**64) + 0.5 < F.lit(share))
    chosen = near.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id", *marks).agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    terms = F.arrow_udf(_terms, "array<string>")
    fold = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int")
    sample = written(texts.select("id", *marks, terms("text").alias("terms"), fold.alias("fold")), "toxicity-sample")
    often = sample.select(F.explode("terms").alias("term")).groupBy("term").count().filter(F.col("count") >= LEAST)
    # As many as LEAST of the sample's documents share: bounded by the sample, not by the corpus.
    vocabulary = [row["term"] for row in often.orderBy(F.desc("count"), "term").collect()]
    numbers = F.arrow_udf(_numbered(vocabulary), "array<int>")
    rows = sample.select("id", "fold", *marks, numbers("terms").alias("terms"), F.array().cast("array<double>").alias("before"))
    links = []
    for mark in marks:
        link, rows = _linked(rows, mark, vocabulary, last=mark == marks[-1])
        links.append(link)
    return Chain(categories, links)


def _numbered(vocabulary: list[str]):
    place = {term: i for i, term in enumerate(vocabulary)}

    def numbered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array([[place[t] for t in terms if t in place] for terms in rows.to_pylist()], pa.list_(pa.int32()))

    return numbered


def _linked(rows: DataFrame, mark: str, vocabulary: list[str], last: bool) -> tuple[Link, DataFrame]:
    """A category's link, and the rows with its out-of-fold probability added to ``before``.

    The model of all rows and those without a fold are fitted side by side, each in a task that
    holds its bounded sample.
    """
    models = F.array(F.lit(-1), *([] if last else map(F.lit, range(FOLDS))))
    dealt = rows.withColumnRenamed(mark, "mark").withColumn("model", F.explode(models))
    dealt = dealt.select("model", "id", "fold", "mark", "terms", "before").groupBy("model")
    fitted = written(dealt.applyInArrow(_fitter(len(vocabulary)), FITTED), "toxicity-fits")
    weights = {row["term"]: row["value"] for row in fitted.filter("term is not null").collect()}
    base = weights.pop(-1, math.copysign(BASE, -1.0))
    earlier = sorted(number for number in weights if number >= len(vocabulary))
    link = Link(base, {vocabulary[n]: w for n, w in weights.items() if n < len(vocabulary)}, [weights[n] for n in earlier])
    if last:
        return link, rows
    held_out = fitted.filter("term is null").select("id", "value")
    joined = rows.join(held_out, "id", "left")
    before = F.concat("before", F.array(F.coalesce("value", F.lit(0.0))))
    return link, written(joined.withColumn("before", before).drop("value"), "toxicity-folds")


FITTED = "model int, term int, id long, value double"
BASE = 800.0


def _fitter(size: int):
    """Fits one model: rows of its weights (``term`` -1 is the base) or, for a fold, of its documents' probabilities."""

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        (model,) = (value.as_py() for value in key)
        table = table.sort_by("id")
        folds = table["fold"].to_numpy()
        data = Sample(table["terms"].combine_chunks(), table["before"].combine_chunks(), size)
        marks = table["mark"].to_numpy()
        inside = folds != model
        base, weights = fitted(data.part(inside), marks[inside])
        if model >= 0:
            ids, values = table["id"].to_numpy()[~inside], 1 / (1 + np.exp(-data.part(~inside).times(weights) - base))
            terms = [None] * len(ids)
        else:
            kept = np.flatnonzero(weights)
            # Weights of earlier categories are told even where they are 0, so that none is missing.
            kept = np.union1d(kept, np.arange(size, data.size))
            terms, values, ids = [-1, *kept.tolist()], [base, *weights[kept].tolist()], [None] * (1 + len(kept))
        columns = [pa.array([model] * len(terms), pa.int32()), pa.array(terms, pa.int32()), pa.array(ids, pa.int64())]
        return pa.Table.from_arrays([*columns, pa.array(values, pa.float64())], names=["model", "term", "id", "value"])

    return fit


class Sample:
    """Documents as the numbers of their terms, and the probabilities of earlier categories as further columns."""

    def __init__(self, terms: pa.ListArray, before: pa.ListArray, size: int):
        self._counts = np.asarray(terms.value_lengths())
        self._terms = np.asarray(terms.flatten())
        width = len(before[0]) if len(before) else 0
        self._before = np.asarray(before.flatten(), dtype=np.float64).reshape(len(before), width)
        self._terms_size, self.size = size, size + width

    def part(self, chosen: np.ndarray) -> "Sample":
        own = object.__new__(Sample)
        own._counts, own._before = self._counts[chosen], self._before[chosen]
        own._terms = self._terms[np.repeat(chosen, self._counts)]
        own._terms_size, own.size = self._terms_size, self.size
        return own

    def __len__(self) -> int:
        return len(self._counts)

    def times(self, weights: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(self)), self._counts)
        return np.bincount(rows, weights[self._terms], len(self)) + self._before @ weights[self._terms_size :]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For every column the sum of the values of the documents that have it."""
        own = np.bincount(self._terms, np.repeat(values, self._counts), self._terms_size)
        return np.concatenate([own, self._before.T @ values])


def fitted(data: Sample, marks: np.ndarray) -> tuple[float, np.ndarray]:
    """Base and weights of a logistic regression with an L1 penalty, by accelerated proximal steps.

    Columns are scaled to one spread, so rare terms learn as fast as common ones; the penalty is on the
    unscaled weights.
    """
    rate = marks.mean() if len(marks) else 0.0
    if rate in (0.0, 1.0):
        return math.copysign(BASE, rate - 0.5), np.zeros(data.size)
    # Both classes weigh the same, however rare one is.
    weigh = np.where(marks == 1, 0.5 / rate, 0.5 / (1 - rate))
    ones = np.ones(len(data))
    share = data.sums(ones) / len(data)
    scale = np.sqrt(np.maximum(share * (1 - np.minimum(share, 1)), 1 / len(data)))
    # The largest curvature, by a few power steps.
    vector, largest = np.ones(data.size), 1.0
    for _ in range(12):
        moved = data.times(vector / scale)
        vector = data.sums(weigh * (moved - moved.mean())) / scale / len(data)
        largest = max(1e-9, float(np.linalg.norm(vector)))
        vector /= largest
    step = 1 / (0.3 * largest + 0.25)
    threshold = step * PENALTY / scale
    weights, base = np.zeros(data.size), 0.0
    ahead, base_ahead, pace = weights, base, 1.0
    for _ in range(STEPS):
        wrong = weigh * (1 / (1 + np.exp(-np.clip(data.times(ahead / scale) + base_ahead, -500, 500))) - marks)
        moved = ahead - step * data.sums(wrong) / scale / len(data)
        moved = np.sign(moved) * np.maximum(np.abs(moved) - threshold, 0)
        base_moved = base_ahead - step * wrong.mean()
        next_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / next_pace * (moved - weights)
        base_ahead = base_moved + (pace - 1) / next_pace * (base_moved - base)
        weights, base, pace = moved, base_moved, next_pace
    return base, weights / scale
