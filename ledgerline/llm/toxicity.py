"""Toxicity scores by non-negative positive-unlabelled learning.

Only toxic documents are confirmed; everything else is unlabelled and holds some
toxic documents too. Each classifier is a linear model over hashed words, trained
in numpy on the corrected risk

    prior * E_P[loss(+1)] + max(0, E_U[loss(-1)] - prior * E_P[loss(-1)])

whose second part estimates the risk on clean documents and must not go below
zero; where a batch takes it there, the step goes the other way. Several
classifiers see different unlabelled samples and their margins are averaged.

How many documents hold a word, which decides on the words with a weight, and the
margins between which the boundary is set are counted over all training documents.
Only the gradient steps use samples, which are bounded by parameters. Scoring reads
every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words

BUCKETS = 1 << 18
_SCALE = 1 << 20  # steps of the sampling share
_STEP = 2.0**-16  # weights are multiples of it, so that margins add up exactly in any order


def word_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words of each text, and the first one of each text.

    A word is a run of letters (any byte above 127 counts as one), A-Z lower-cased,
    so marks around a word do not hide it.
    """
    hashed, bounds = words.hashed_words(texts, words.LETTERS)
    bucket = (hashed >> np.uint64(64 - 18)).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    both = np.unique(text * BUCKETS + bucket)
    return both % BUCKETS, np.searchsorted(both, np.arange(len(texts) + 1) * BUCKETS)


def _sampled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(roles, order, text) to (roles, order, features)."""
    for batch in batches:
        for first, texts in words.chunks(batch.column(2)):
            features, bounds = word_features(texts)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(features.astype(np.int32)))
            kept = [batch.column(i).slice(first, len(texts)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=["roles", "order", "features"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (bucket, n): how many texts of the task hold a word; bucket -1 has all texts."""
    seen, total = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for _, texts in words.chunks(batch.column(0)):
            features, _ = word_features(texts)
            seen += np.bincount(features, minlength=BUCKETS)
            total += len(texts)
    held = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(held, -1)), pa.array(np.append(seen[held], total))], names=["bucket", "n"]
    )


def useful_words(in_positive: np.ndarray, positives: int, seen: np.ndarray, texts: int, deviations: float = 6.0) -> np.ndarray:
    """Words whose share of the positives is ``deviations`` standard errors off their share of all texts.

    The error counts a third of a positive at least, so a word in three or fewer is no evidence for the label.
    """
    expected = positives * (seen + 0.5) / max(texts, 1)
    far = np.abs(in_positive - expected) >= deviations * np.sqrt(np.maximum(expected, 1 / 3))
    return np.flatnonzero(far & (in_positive + seen > 1))


def nnpu_weights(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    *,
    seen: tuple[np.ndarray, int] | None = None,
    epochs: int = 30,
    batches: int = 16,
    rate: float = 0.05,
    decay: float = 1e-3,
    deviations: float = 6.0,
    seed: int = 0,
) -> np.ndarray:
    """Weights of a linear classifier (the bias is last) by Adam on the nnPU risk.

    Only ``useful_words`` get a weight. ``seen`` says how many texts hold each word and
    how many texts there are; without it the unlabelled rows are counted. The boundary
    is that of the given rows. Texts with the same words count once among the positives.
    """
    positive = list({row.tobytes(): row for row in positive}.values())
    rows = [*positive, *unlabelled]
    n_p, n_u = len(positive), len(unlabelled)
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    in_p = np.bincount(flat[: sizes[:n_p].sum()], minlength=BUCKETS)
    if seen is None:
        seen = np.bincount(flat[sizes[:n_p].sum() :], minlength=BUCKETS), n_u
    useful = useful_words(in_p, n_p, *seen, deviations)
    column = np.full(BUCKETS, -1)
    column[useful] = np.arange(len(useful))
    kept = column[flat] >= 0
    row = np.repeat(np.arange(len(rows)), sizes)[kept]
    flat, firsts = column[flat][kept], np.searchsorted(row, np.arange(len(rows) + 1))
    weights, bias = np.zeros(len(useful)), -2.0
    m, v, step = np.zeros(len(useful) + 1), np.zeros(len(useful) + 1), 0
    rng = np.random.default_rng(seed)

    def gathered(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = firsts[chosen + 1] - firsts[chosen]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return flat[np.repeat(firsts[chosen], lengths) + inside], np.repeat(np.arange(len(chosen)), lengths)

    for _ in range(epochs if n_p and n_u else 0):
        order_p, order_u = rng.permutation(n_p), n_p + rng.permutation(n_u)
        count = min(batches, n_p, n_u)
        for part_p, part_u in zip(np.array_split(order_p, count), np.array_split(order_u, count), strict=True):
            chosen = np.concatenate([part_p, part_u])
            index, owner = gathered(chosen)
            margin = bias + np.bincount(owner, weights[index], minlength=len(chosen))
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            at_p, at_u = slice(0, len(part_p)), slice(len(part_p), None)
            loss_minus = np.logaddexp(0, margin)
            clean = loss_minus[at_u].mean() - prior * loss_minus[at_p].mean()
            grad = np.zeros(len(chosen))
            if clean >= 0:
                # d loss(+1) = p - 1, d loss(-1) = p; over the positives their difference is -1.
                grad[at_p] = -prior / len(part_p)
                grad[at_u] = p[at_u] / len(part_u)
            else:
                grad[at_p] = prior * p[at_p] / len(part_p)
                grad[at_u] = -p[at_u] / len(part_u)
            full = np.append(np.bincount(index, grad[owner], minlength=len(useful)) + decay * weights, grad.sum())
            step += 1
            m = 0.9 * m + 0.1 * full
            v = 0.999 * v + 0.001 * full**2
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
    weights = np.round(weights / _STEP) * _STEP
    if n_p and n_u:
        index, owner = gathered(np.arange(n_p + n_u))
        margin = np.bincount(owner, weights[index], minlength=n_p + n_u)
        cuts, recall = _cuts(margin[:n_p])
        bias = -boundary(cuts, recall, *_histogram(cuts, margin[n_p:]))
    out = np.zeros(BUCKETS + 1)
    out[useful], out[-1] = weights, bias
    return out


def _cuts(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins that may divide, and the share of the positives from each one on."""
    if not len(positive):
        return np.zeros(0), np.zeros(0)
    cuts = np.unique(np.quantile(positive, np.linspace(0, 1, 401)))
    return cuts, 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)


def _histogram(cuts: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many margins lie before, between and after the cuts, and the largest of each part."""
    part = np.searchsorted(cuts, margins, side="right")
    top = np.full(len(cuts) + 1, -np.inf)
    np.maximum.at(top, part, margins)
    return np.bincount(part, minlength=len(cuts) + 1), top


def boundary(cuts: np.ndarray, recall: np.ndarray, counts: np.ndarray, tops: np.ndarray) -> float:
    """The margin at which to divide: it makes recall**2 / share predicted largest.

    With positive and unlabelled data only, this stands in for the F1 score.
    """
    total = max(counts.sum(), 1)
    share = (counts[::-1].cumsum()[::-1][1:]) / total
    best = int(np.argmax(recall**2 / np.maximum(share, 1 / total)))
    below = tops[: best + 1].max()
    return float((cuts[best] + (below if np.isfinite(below) else cuts[best])) / 2)


def _trained(prior: float, seen):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["positive", "order"])  # whatever order the rows came in
        positive = [np.asarray(x, np.int64) for x in frame.features[frame.positive]]
        unlabelled = [np.asarray(x, np.int64) for x in frame.features[~frame.positive]]
        weights = nnpu_weights(positive, unlabelled, prior, seen=seen.value, seed=int(frame.bag.iloc[0]))
        distinct = {row.tobytes(): row for row in positive}.values()
        cuts, recall = _cuts(np.array([weights[row].sum() for row in distinct]))
        packed = {"weights": weights, "cuts": cuts, "recall": recall}
        return pd.DataFrame({"bag": [int(frame.bag.iloc[0])], **{k: [v.tobytes()] for k, v in packed.items()}})

    return run


def _margins(features: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[features])])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _histograms(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text) to (bag, part, n, top): histograms of the whole task."""
        held = [(np.zeros(len(cuts) + 1, np.int64), np.full(len(cuts) + 1, -np.inf)) for _, cuts in models.value]
        for batch in batches:
            for _, texts in words.chunks(batch.column(0)):
                features, bounds = word_features(texts)
                for (weights, cuts), (counts, tops) in zip(models.value, held, strict=True):
                    n, top = _histogram(cuts, _margins(features, bounds, weights))
                    counts += n
                    np.maximum(tops, top, out=tops)
        for bag, (counts, tops) in enumerate(held):
            part = np.flatnonzero(counts)
            columns = [np.full(len(part), bag), part, counts[part], tops[part]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bag", "part", "n", "top"])

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    bags: int = 3,
    positives: int = 10_000,
    unlabelled: int = 15_000,
    prior: float | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> np.ndarray:
    """Averaged weights of ``bags`` classifiers.

    ``labels`` names confirmed toxic documents (label 1) by id; only rows given here
    are used. For the gradient steps about ``positives`` of them and ``unlabelled`` of
    ``docs`` per bag are sampled by a hash of the id, so each bag fits one task whatever
    the corpus size. Word counts and margins are those of all documents given here.
    ``prior`` is the share of toxic documents; by default their share among ``labels``.
    Labels other than 1 serve for that share only.
    """
    marked = labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label")).where(
        "_id IS NOT NULL AND _label IS NOT NULL"
    )
    counts = marked.agg(F.count_if(F.col("_label") == 1).alias("toxic"), F.count("*").alias("all")).first()
    if not counts["toxic"]:
        return _no_evidence()
    prior = prior if prior is not None else counts["toxic"] / counts["all"]
    place = F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(_SCALE))
    confirmed = (
        marked.where(F.col("_label") == 1).where(place < _share(positives, counts["toxic"])).select("_id").distinct()
        .withColumn("_toxic", F.lit(True))
    )
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).where("_id IS NOT NULL")
    # A row for each bucket at most, summed before it reaches the driver.
    counted = texts.select("_text").mapInArrow(_document_counts, "bucket bigint, n bigint")
    seen, total = np.zeros(BUCKETS, np.int64), 0
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if row["bucket"] < 0:
            total = row["n"]
        else:
            seen[row["bucket"]] = row["n"]
    share = _share(unlabelled, total, most=_SCALE // bags)
    # The confirmed sample is bounded by the parameter, so it may be broadcast.
    roles = texts.join(F.broadcast(confirmed), "_id", "left").withColumn(
        "_bag", F.when(place < share * bags, F.floor(place / share).cast("int"))
    )
    either = roles.where("_toxic OR _bag IS NOT NULL")
    all_bags = F.array(*[F.lit(i) for i in range(bags)])
    none = F.array().cast("array<int>")
    wanted = F.concat(
        F.transform(F.when(F.col("_toxic"), all_bags).otherwise(none), lambda b: F.struct(b.alias("bag"), F.lit(True).alias("positive"))),
        F.transform(
            F.when(F.col("_bag").isNotNull(), F.array("_bag")).otherwise(none),
            lambda b: F.struct(b.alias("bag"), F.lit(False).alias("positive")),
        ),
    )
    featured = either.select(wanted.alias("roles"), F.col("_id").alias("order"), "_text").mapInArrow(
        _sampled_features,
        "roles array<struct<bag: int, positive: boolean>>, order bigint, features array<int>",
    )
    rows = featured.select(F.explode("roles").alias("_role"), "order", "features").select(
        "_role.bag", "_role.positive", "order", "features"
    )
    context = docs.sparkSession.sparkContext
    frequencies = context.broadcast((seen, total))  # BUCKETS numbers
    found = rows.groupBy("bag").applyInPandas(
        _trained(prior, frequencies), "bag int, weights binary, cuts binary, recall binary"
    ).collect()
    if not found:  # no document to learn from
        return _no_evidence()
    models = [tuple(np.frombuffer(r[c]) for c in ("weights", "cuts", "recall")) for r in sorted(found, key=lambda r: r["bag"])]
    if not any(len(cuts) for _, cuts, _ in models):  # no confirmed document among these
        return np.mean([weights for weights, _, _ in models], axis=0)
    shared = context.broadcast([(weights[:-1], cuts) for weights, cuts, _ in models])
    counts = [np.zeros(len(cuts) + 1, np.int64) for _, cuts, _ in models]
    tops = [np.full(len(cuts) + 1, -np.inf) for _, cuts, _ in models]
    parts = texts.select("_text").mapInArrow(_histograms(shared), "bag bigint, part bigint, n bigint, top double")
    for row in parts.groupBy("bag", "part").agg(F.sum("n").alias("n"), F.max("top").alias("top")).collect():
        counts[row["bag"]][row["part"]], tops[row["bag"]][row["part"]] = row["n"], row["top"]
    placed = [
        np.append(weights[:-1], -boundary(cuts, recall, n, top) if len(cuts) else weights[-1])
        for (weights, cuts, recall), n, top in zip(models, counts, tops, strict=True)
    ]
    return np.mean(placed, axis=0)


def _no_evidence() -> np.ndarray:
    """Weights by which every score is close to 0."""
    return np.append(np.zeros(BUCKETS), -30.0)


def _share(wanted: int, of: int, most: int = _SCALE) -> int:
    """How many of ``_SCALE`` equal parts give about ``wanted`` of ``of`` rows."""
    return max(1, min(most, -(-wanted * _SCALE // max(of, 1))))


def _scored(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            for first, texts in words.chunks(batch.column(1)):
                features, bounds = word_features(texts)
                margin = table[-1] + _margins(features, bounds, table)
                score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(score)], names=["doc_id", "score"]
                )

    return run


def held_out(id_column: str = "doc_id") -> Column:
    """Documents whose labels are never learned from: a fifth, by checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.5,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    **training,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learns from ``labels`` and ``docs`` outside the held-out fifth and scores every
    text. ``score`` is the estimated probability of label 1; ``predicted`` is 1 from
    ``threshold`` on. Neither labels nor other columns are inputs of a score.

    Null and empty texts have no words and get the score of the bias. Null ids are
    scored, never learned from and not held out; repeated rows are scored each.
    Without any confirmed toxic document, or any document to learn from, every score is close to 0. An empty table
    gives an empty result. Ids are bigint.
    """
    kept = docs.select(F.col(id_column).cast("bigint").alias(id_column), F.col(text_column).alias(text_column))
    weights = train(
        kept.where(~held_out(id_column)),
        labels.where(~held_out(id_column)),
        id_column=id_column,
        text_column=text_column,
        label_column=label_column,
        **training,
    )
    table = docs.sparkSession.sparkContext.broadcast(weights)  # BUCKETS numbers
    scored = kept.mapInArrow(_scored(table), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
