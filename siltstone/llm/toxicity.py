"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the byte n-grams of each lower-cased word with a space on either
side; a feature is present in a document or not. Its log-count ratio r compares
how often it is present in toxic and in clean documents, and the classifier is
a logistic regression on r times presence. Ratios come from all documents of
the training sample; the ``FEATURES`` whose presence differs most between the
labels are fitted.

The sample is the only bounded part: ``SAMPLE`` labelled documents, those
whose ids hash lowest. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import handing_back, stored
from siltstone.llm.textbytes import expanded, prefix_sums, text_bytes, text_slices, window_hashes

ORDERS = (3, 4, 5, 6, 7)
#: Features that are fitted at most, and by how many standard deviations their presence must differ.
FEATURES = 4_096
LEAST_Z = 4.0
SAMPLE = 12_000
THRESHOLD = 0.7
SMOOTHING = 0.5
PENALTY = 0.5
STEPS = 400
#: Bytes of text that are scored together, and of which all n-grams are counted together.
SCORED_BYTES = 3 << 20
COUNTED_BYTES = 1 << 19
#: N-grams of whole documents that are told apart at once.
TOGETHER = 1 << 18

_U = np.uint64


def word_grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of the word and hash of each n-gram."""
    data, offsets = text_bytes(pc.binary_join_element_wise("", words, "", " "))
    sums = prefix_sums(data)
    lengths = np.diff(offsets)
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for order in ORDERS:
        inside = np.maximum(lengths - order + 1, 0)
        hashes.append(window_hashes(sums, order)[expanded(offsets[:-1], inside)])
        owners.append(np.repeat(np.arange(len(words)), inside))
    return np.concatenate(owners), np.concatenate(hashes)


class Features:
    """The hashes that are features, in order; a table of their leading bits rules most others out."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        self.leading = np.zeros(1 << 20, bool)
        self.leading[hashes >> _U(44)] = True

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The feature of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.leading[hashes >> _U(44)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = at[same]
        return out


def _runs(document: np.ndarray, totals: np.ndarray) -> Iterator[slice]:
    """Whole documents of about ``TOGETHER`` n-grams at a time; ``totals`` are those up to each entry."""
    low = 0
    while low < len(document):
        before = totals[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(totals, before + TOGETHER, side="right")))
        if high < len(document):
            cut = int(np.searchsorted(document, document[high]))
            high = cut if cut > low else int(np.searchsorted(document, document[low], side="right"))
        yield slice(low, high)
        low = high


def document_grams(texts: pa.Array, features: Features | None = None) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Hashes of the n-grams, in order, and document and n-gram of each presence.

    An n-gram goes by its place among the hashes, which are the features, or
    without them all that occur. Presences are distinct and in order, and come
    in runs of whole documents, as all of a slice's take many times its bytes.
    Each distinct word's n-grams are looked up once, and only words that have a
    feature are followed back to their documents.
    """
    split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    words = split.flatten().dictionary_encode()
    owner, gram = word_grams(words.dictionary)
    if features is None:
        hashes, gram = np.unique(gram, return_inverse=True)
    else:
        hashes, gram = features.hashes, features.number(gram)
        owner, gram = owner[gram >= 0], gram[gram >= 0]
    order = np.argsort(owner, kind="stable")
    owner, gram = owner[order], gram[order]
    counts = np.bincount(owner, minlength=len(words.dictionary))
    begins = np.cumsum(counts) - counts

    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    document = np.repeat(np.arange(len(texts)), sizes)
    at = words.indices.to_numpy()
    telling = counts[at] > 0
    # A word that a document repeats adds nothing new.
    pairs = np.unique(document[telling] * len(counts) + at[telling])
    document, at = np.divmod(pairs, max(len(counts), 1))

    def presences() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for run in _runs(document, np.cumsum(counts[at])):
            own = counts[at[run]]
            keys = np.repeat(document[run] * len(hashes), own)
            keys += gram[expanded(begins[at[run]], own)]
            yield np.divmod(np.unique(keys), len(hashes))

    return hashes, presences()


@dataclass(frozen=True)
class Classifier:
    """Hashes of the features in order, weight of each with its ratio included, and intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array, features: Features) -> np.ndarray:
        sums = np.zeros(len(texts))
        for document, feature in document_grams(texts, features)[1]:
            sums += np.bincount(document, self.weights[feature], len(texts))
        return 1 / (1 + np.exp(-np.clip(sums + self.intercept, -500, 500)))


def training_sample(documents: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """``sample`` labelled ids at most, with a text each. Ids whose CRC-32 leaves 1 modulo 3 are never among them.

    Of several texts of an id the one with the least hash is taken, whatever
    number of rows there are.
    """
    usable = labels.select(F.col("doc_id"), F.col(label).alias("label")).dropna()
    usable = usable.filter("crc32(cast(doc_id AS string)) % 3 <> 1").groupBy("doc_id").agg(F.max("label").alias("label"))
    few = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # ``sample`` rows of an id and a label are broadcast.
    met = documents.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    once = met.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label"))
    return once.select("text", F.col("label").cast("int").alias("label"))


def _presences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean documents of a slice have each n-gram."""
    for batch in batches:
        for part in text_slices(batch, "text", COUNTED_BYTES):
            label = part.column("label").to_numpy(zero_copy_only=False) > 0
            hashes, runs = document_grams(part.column("text"))
            toxic, clean = np.zeros((2, len(hashes)), np.int64)
            for document, gram in runs:
                toxic += np.bincount(gram[label[document]], minlength=len(hashes))
                clean += np.bincount(gram[~label[document]], minlength=len(hashes))
            columns = [pa.array(hashes.view(np.int64)), pa.array(clean), pa.array(toxic)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "clean", "toxic"])


def _rows(hashes: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(hashes)
        for batch in batches:
            for part in text_slices(batch, "text"):
                own = [b""] * part.num_rows
                for document, feature in document_grams(part.column("text"), features)[1]:
                    found, starts = np.unique(document, return_index=True)
                    for number, features_of in zip(found.tolist(), np.split(feature.astype("<u2"), starts[1:]), strict=True):
                        own[number] = features_of.tobytes()
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(own, pa.binary())], ["label", "features"])

    return task


def fit_logistic(rows: np.ndarray, features: np.ndarray, ratio: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights on ``ratio`` times presence, and intercept, by accelerated gradient steps with an L2 penalty."""
    n, k = len(label), len(ratio)
    values = ratio[features]
    forward = lambda w: np.bincount(rows, values * w[features], n)
    back = lambda g: np.bincount(features, values * g[rows], k)
    # The steepest curvature, by repeated multiplication.
    probe = np.ones(k)
    for _ in range(20):
        probe = back(forward(probe / max(np.linalg.norm(probe), 1e-300)))
    steep = 0.25 * (np.linalg.norm(probe) + n) + PENALTY
    w = old = np.zeros(k)
    share = min(max(label.mean(), 1 / (n + 2)), 1 - 1 / (n + 2))
    b = old_b = float(np.log(share / (1 - share)))
    for step in range(STEPS):
        push = step / (step + 3)
        at, at_b = w + push * (w - old), b + push * (b - old_b)
        error = 1 / (1 + np.exp(-np.clip(forward(at) + at_b, -500, 500))) - label
        old, old_b = w, b
        w, b = at - (back(error) + PENALTY * at) / steep, at_b - error.sum() / steep
    return w, b


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Classifier:
    """A classifier from the labelled documents that may be learned from; without any, every score is one half."""
    chosen = stored(training_sample(documents, labels, label, sample), "sample")
    totals = {row["toxic"]: row["n"] for row in chosen.groupBy(F.expr("label > 0 AS toxic")).agg(F.count("*").alias("n")).collect()}
    clean, toxic = totals.get(False, 0), totals.get(True, 0)
    if not clean or not toxic:
        return Classifier(np.zeros(0, _U), np.zeros(0), 4.0 * (bool(toxic) - bool(clean)))
    grams = chosen.mapInArrow(handing_back(_presences), "gram long, clean long, toxic long").groupBy("gram")
    grams = grams.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).selectExpr(
        "gram",
        f"ln((toxic + {SMOOTHING}) / {toxic + 2 * SMOOTHING}) - ln((clean + {SMOOTHING}) / {clean + 2 * SMOOTHING}) AS ratio",
        f"abs(toxic / {toxic} - clean / {clean}) AS apart",
        f"(toxic + clean) / {toxic + clean} AS share",
    )
    # Presence in all documents tells nothing; its spread would be zero.
    grams = grams.filter("share < 1").withColumn("z", F.expr(f"apart / sqrt(share * (1 - share) * (1 / {toxic} + 1 / {clean}))"))
    best = grams.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "gram").limit(FEATURES).select("gram", "ratio").toPandas()
    hashes = best["gram"].to_numpy(np.int64).view(_U)
    order = np.argsort(hashes)
    hashes, ratio = hashes[order], best["ratio"].to_numpy(float)[order]
    # At most ``sample`` rows, of two bytes a feature.
    rows = chosen.mapInArrow(handing_back(_rows(hashes)), "label int, features binary").toPandas()
    own = [np.frombuffer(bytes(x), "<u2") for x in rows["features"]]
    place = np.repeat(np.arange(len(own)), [len(x) for x in own])
    present = np.concatenate(own).astype(np.int64)
    weights, intercept = fit_logistic(place, present, ratio, (rows["label"].to_numpy() > 0).astype(float))
    return Classifier(hashes, weights * ratio, intercept)


def _scores(model: Classifier):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.hashes)
        for batch in batches:
            for part in text_slices(batch, "text", SCORED_BYTES):
                score = model.scores(part.column("text"), features)
                columns = [
                    *(part.column(c) for c in ("doc_id", "held_out")), pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return task


def toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """One row per document: whether its label is held out, its score, and whether it counts as toxic.

    Reads doc_id and text of the documents, doc_id and the label of the
    labels, and no other column. A null or empty text has no feature and gets
    the intercept's score. Null labels and ids teach nothing; of several labels
    of one id the greatest counts. Ids may be null or repeat in the documents:
    every row is scored. An empty table gives no rows.
    """
    chosen = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    model = train(chosen, labels, label, sample)
    folded = chosen.withColumn("held_out", F.coalesce(F.expr("crc32(cast(doc_id AS string)) % 3 = 1"), F.lit(False)))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return folded.mapInArrow(handing_back(_scores(model)), f"doc_id {kind}, held_out boolean, score double, predicted int")


def reject_toxic(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose score is below the threshold, with all their columns."""
    model = train(documents.select("doc_id", F.col("text").cast("string").alias("text")), labels, label, sample)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.hashes)
        for batch in batches:
            for part in text_slices(batch, "text", SCORED_BYTES):
                yield part.filter(pa.array(model.scores(part.column("text"), features) < threshold))

    return documents.mapInArrow(handing_back(task), documents.schema)
