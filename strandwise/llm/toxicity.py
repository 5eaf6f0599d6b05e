"""Toxic passages by maximum-scoring segments.

Tokens score their log-odds between toxic and clean documents under a Dirichlet prior. A
linear scan finds all maximal-scoring segments of a text; extreme-value statistics tell
how far they exceed what clean text of that length shows by chance, and that evidence is
calibrated to a probability on the labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows the classifier is fitted on at most, those with the smallest hashes.
FIT_ROWS = 200_000
#: Tokens that a task counts before it hands their counts on.
COUNTED = 200_000
#: Tokens the classifier holds at most, those with the surest log-odds.
MODEL_TOKENS = 1 << 17
#: Prior weight of a token, as a share of its own documents.
PRIOR = 0.1
#: Standard deviations by which log-odds must differ from 0; only what exceeds them scores.
SURE = 2.5
#: What every token costs, so that a passage must hold its toxic tokens close together.
DRIFT = 0.1
#: Largest evidence (minus the log of a chance probability) that calibration tells apart.
TOP = 50.0

_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def log_odds(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    """Log-odds of a token shrunk towards 0 by ``SURE`` standard deviations.

    ``toxic`` of ``n_toxic`` and ``clean`` of ``n_clean`` documents hold it; the prior adds
    ``PRIOR`` times its documents to either side, in proportion to the classes' sizes.
    """
    both = toxic + clean
    if both <= 0 or n_toxic <= 0 or n_clean <= 0:
        return 0.0
    share = n_toxic / (n_toxic + n_clean)
    a, b = PRIOR * both * share + 1e-3, PRIOR * both * (1 - share) + 1e-3
    delta = math.log((toxic + a) / (n_toxic + a + b)) - math.log((clean + b) / (n_clean + a + b))
    spread = SURE * math.sqrt(1 / (toxic + a) + 1 / (clean + b))
    return math.copysign(max(0.0, abs(delta) - spread), delta)


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments ``(score, first, last + 1)``, in linear time.

    ``hits`` are ``(position, score)`` in order; every position costs ``drift``, and those
    not listed score nothing else. A candidate joins the nearest earlier one that starts
    lower and ends lower; a chain of such starts is kept so none is looked at twice.
    """
    left: list[float] = []
    right: list[float] = []
    first: list[int] = []
    lower: list[int] = []  # the nearest earlier candidate that starts lower
    last: list[int] = []
    total, previous = 0.0, -1
    for at, score in hits:
        total -= drift * (at - previous - 1)
        previous, gain = at, score - drift
        if gain <= 0:
            total += gain
            continue
        lo, start = total, at
        total += gain
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = lower[j]
            if j < 0 or right[j] >= total:
                break
            lo, start = left[j], first[j]
            for stack in (left, right, first, lower, last):
                del stack[j:]
        left.append(lo)
        right.append(total)
        first.append(start)
        lower.append(j)
        last.append(at + 1)
    return [(r - l, a, b) for l, r, a, b in zip(left, right, first, last, strict=True)]


@dataclass
class Model:
    """``weights``: token to its score, and its scores had one toxic or one clean document less."""

    weights: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    decay: float = 1.0  # lambda of the extreme-value law
    rate: float = 1.0  # K of the extreme-value law
    slope: float = 0.0
    offset: float = -20.0

    def segments(self, words: list[str], held: int = 0) -> list[tuple[float, int, int]]:
        get = self.weights.get
        hits = [(i, w[held]) for i, w in enumerate(map(get, words)) if w is not None]
        return maximal_segments(hits, DRIFT) if hits else []

    def evidence(self, n: int, segments: list[tuple[float, int, int]]) -> float:
        """Minus the log of the chance that clean text of ``n`` tokens scores like this.

        The best ``r`` segments together have a sum statistic; the surest ``r`` counts,
        after a factor of 2^r for the choice.
        """
        expected = math.log(max(1e-9, self.rate * max(n, 1)))
        best, total = 0.0, 0.0
        for r, score in enumerate(sorted((s for s, _, _ in segments), reverse=True), 1):
            total += self.decay * score - expected
            if total <= 0:
                break
            log_p = -total + (r - 1) * math.log(max(total, 1e-9)) - math.lgamma(r + 1) - math.lgamma(r)
            if r == 1 and total < 30:  # beyond that the two agree
                log_p = math.log(-math.expm1(-math.exp(-total)))
            best = max(best, -log_p - r * math.log(2))
        return min(best, TOP)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * evidence + self.offset))))


def _decay(scores: np.ndarray, chances: np.ndarray) -> float:
    """The positive root of ``sum(chances * exp(root * scores)) = 1``."""
    if not (scores > 0).any():
        return 1.0

    def excess(x):
        return float((chances * np.exp(np.minimum(x * scores, 700))).sum()) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e3:
        high *= 2
    low = high / 2 if high > 1 else 0.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope (0 at least) and offset of ``P(toxic | x)`` over binned counts, by Newton steps with a small ridge."""
    share = (toxic.sum() + 0.5) / (toxic.sum() + clean.sum() + 1)
    beta = np.array([0.1, math.log(share / (1 - share))])
    design = np.stack([x, np.ones_like(x)])
    n = toxic + clean
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -500, 500)))
        step = np.linalg.solve((design * (n * p * (1 - p) + 1e-9)) @ design.T + 1e-2 * np.eye(2), design @ (toxic - n * p) - 1e-2 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def _labelled(docs: DataFrame, labels: DataFrame, doc_id: str, fit_rows: int) -> DataFrame:
    known = labels.select(F.col(doc_id).alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("_id is not null and toxic in (0, 1)").orderBy(F.xxhash64("_id"), "_id", "toxic").limit(fit_rows)
    # fit_rows ids and labels at most
    return docs.join(F.broadcast(known), F.col(doc_id) == F.col("_id")).select("text", "toxic")


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS
) -> Model:
    """A model from the labelled rows of ``docs`` for which ``train`` holds.

    At most ``fit_rows`` labels are used. Only ``text`` and ``toxic`` enter it. In
    calibration each document is scored as if it had not been counted.
    """
    rows = _labelled(docs.where(train).select(doc_id, F.col(text).alias("text")), labels, doc_id, fit_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            return pa.record_batch(
                [pa.array(keys, pa.string()), *(pa.array([seen[y][k] for k in keys], pa.int64()) for y in (1, 0))],
                ["token", "toxic", "clean"],
            )

        seen, size = (Counter(), Counter()), 0
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = set(tokens(t.as_py()))
                seen[y].update(found)
                seen[y][None] += 1  # the document itself
                size += len(found)
                if size > COUNTED:
                    yield pack()
                    seen, size = (Counter(), Counter()), 0
        yield pack()

    counts = rows.mapInArrow(count, "token string, toxic long, clean long")
    counts = counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).cache()
    total = counts.where("token is null").first()
    if total is None or not total.toxic or not total.clean:
        counts.unpersist()
        share = 0.0 if total is None else total.toxic / max(1, total.toxic + total.clean)
        return Model(offset=math.log((share + 1e-6) / (1 + 1e-6 - share)) if share < 1 else 14.0)
    # the same estimate as log_odds, to find the surest tokens
    both = F.col("toxic") + F.col("clean")
    share = total.toxic / (total.toxic + total.clean)
    a, b = both * (PRIOR * share) + 1e-3, both * (PRIOR * (1 - share)) + 1e-3
    delta = F.log((F.col("toxic") + a) / (total.toxic + a + b)) - F.log((F.col("clean") + b) / (total.clean + a + b))
    sure = F.abs(delta) / F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + b))
    words = counts.where("token is not null and length(token) <= 64").withColumn("sure", sure).where(F.col("sure") > SURE)
    chosen = words.orderBy(F.desc("sure"), "token").limit(MODEL_TOKENS).collect()
    n_tokens = counts.where("token is not null").agg(F.sum("clean")).first()[0] or 1
    counts.unpersist()
    y, n = total.toxic, total.clean
    model = Model({
        r.token: (
            log_odds(r.toxic, r.clean, y, n),
            log_odds(r.toxic - 1, r.clean, y - 1, n) if r.toxic else log_odds(r.toxic, r.clean, y, n),
            log_odds(r.toxic, r.clean - 1, y, n - 1) if r.clean else log_odds(r.toxic, r.clean, y, n),
        )
        for r in chosen
    })
    chances = np.array([(r.clean + PRIOR * (r.toxic + r.clean) * (1 - share)) for r in chosen]) / max(1, n_tokens)
    scores = np.array([model.weights[r.token][0] for r in chosen])
    rest = max(0.0, 1 - chances.sum())
    model.decay = _decay(np.append(scores, 0.0) - DRIFT, np.append(chances, rest))
    model.rate = _rate(rows, model)
    model.slope, model.offset = _calibrate(rows, model)
    return model


def _rate(rows: DataFrame, model: Model) -> float:
    """K by maximum likelihood from the best segments of clean documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = 0.0
            for t in batch.column(0).to_pylist():
                words = tokens(t)
                best = max((s for s, _, _ in model.segments(words, 2)), default=0.0)
                total += max(1, len(words)) * math.exp(-model.decay * best)
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64()), pa.array([total])], ["n", "total"])

    got = rows.where("toxic = 0").mapInArrow(run, "n long, total double").agg(F.sum("n"), F.sum("total")).first()
    return got[0] / got[1] if got[1] else 1.0


def _calibrate(rows: DataFrame, model: Model) -> tuple[float, float]:
    width = 0.125

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(t)
                x = model.evidence(len(words), model.segments(words, 1 if y else 2))
                found[round(x / width), y] += 1
            keys = list(found)
            yield pa.record_batch(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())],
                ["bin", "toxic", "n"],
            )

    binned = rows.mapInArrow(run, "bin long, toxic int, n long").groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect()
    bins = sorted({r.bin for r in binned})  # TOP / width + 1 at most
    count = {(r.bin, r.toxic): r.n for r in binned}
    toxic = np.array([count.get((b, 1), 0) for b in bins], float)
    clean = np.array([count.get((b, 0), 0) for b in bins], float)
    return _logistic(np.array(bins, float) * width, toxic, clean)


RESULT = (
    "score double, predicted int, evidence double, n_passages int, "
    "passages array<struct<first:int,last:int,score:double,text:string>>"
)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", alpha: float = 0.01) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 on), ``evidence`` and the passages.

    A passage is a maximal segment that clean text of this length shows with an expected
    count below ``alpha``: its first and last token number, its score and its tokens. Null
    and empty texts have no token and score what the calibration gives to no evidence;
    repeated rows each get a row; an empty table gives none; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MODEL_TOKENS tokens of 64 letters at most
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            out = []
            for t in batch.column(1):
                words = tokens(t.as_py())
                segments = m.segments(words)
                x = m.evidence(len(words), segments)
                p = m.probability(x)
                passages = [
                    {"first": a, "last": b - 1, "score": s, "text": " ".join(words[a:b])}
                    for s, a, b in segments
                    if m.rate * len(words) * math.exp(-m.decay * s) < alpha
                ]
                out.append((p, int(p >= 0.5), x, len(passages), passages))
            passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("text", pa.string())])
            kinds = [pa.float64(), pa.int32(), pa.float64(), pa.int32(), pa.list_(passage)]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds, strict=True)]
            yield pa.record_batch([batch.column(0), *columns], [doc_id, "score", "predicted", "evidence", "n_passages", "passages"])

    return docs.select(doc_id, text).mapInArrow(run, f"{doc_id} {kind}, {RESULT}")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            keep = []
            for t in batch.column(at):
                words = tokens(t.as_py())
                keep.append(m.probability(m.evidence(len(words), m.segments(words))) < 0.5)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
