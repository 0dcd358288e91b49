"""Quality classification by co-training.

Two classifiers see different views of a page: what its text is like (shares of letters,
marks, capitals and digits, lengths and repetition of words and lines, and hashed shapes of words),
and what is known about it (source, language, length). Both start from labelled
documents. In each round every unlabelled document is scored by both, and each view hands the
documents it is most confident about, with its labels, to the other. In the end
each view is calibrated on labelled rows kept aside, and the calibrated views are combined
into the score of every document.

The text is read once; features are a narrow table that the rounds read. Classifiers are
fitted on bounded samples: ``SAMPLE`` labelled rows, of rows that share an id the one with the smallest hash, and ``HANDED`` rows of each class, view and
round; what is counted and scored is the whole corpus.

Defined cases: null and empty texts have the features of an empty text; null source and
language are a value of their own; a document with several labels has the highest, a null label is none; without
labels of both classes the score is the share of good rows, or 0.5; repeated rows get equal rows; a null ``doc_id``
is not held out and never labelled; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import held_out, space_blocks, stored, utf8
from sparkrank.llm.toxicity import fit_logistic

SAMPLE = 20_000
ROUNDS = 3
HANDED = 500
SURE = 0.95  # least confidence of a handed label
SHAPES = 64
META = 64  # hashed values of source and language

#: Classes of bytes: a lower-case, A upper-case, 0 digit, u non-ASCII, # mark.
CLASSES = bytes(ord("a") if 97 <= b < 123 else ord("A") if 65 <= b < 91 else ord("0") if 48 <= b < 58 else ord("u") if b > 127 else ord("#") if b > 32 else 32 for b in range(256))
RUNS = re.compile(rb"(.)\1+")


def text_features(data: bytes) -> np.ndarray:
    """Features of a text, all near 0 to 1."""
    words: Counter = Counter()
    shapes = np.zeros(SHAPES)
    n = chars = 0
    kept: dict[bytes, int] = {}
    classes = np.zeros(256, np.int64)
    for block in space_blocks(data):
        marked = block.translate(CLASSES)
        classes += np.bincount(np.frombuffer(marked, np.uint8), minlength=256)
        tokens = block.split()
        n += len(tokens)
        chars += sum(map(len, tokens))
        words.update(tokens)
        for shape, count in Counter(marked.split()).items():
            if shape not in kept:
                kept[shape] = zlib.crc32(RUNS.sub(rb"\1", shape)[:12]) % SHAPES
            shapes[kept[shape]] += count
    lines = data.count(b"\n") + 1
    seen = max(chars, 1)
    common = words.most_common(1)[0][1] if words else 0
    shares = [classes[ord(c)] / seen for c in "aA0u#"]
    sizes = [np.log1p(n) / 12, chars / max(n, 1) / 20, len(words) / max(n, 1), common / max(n, 1), min(n / lines / 50, 4), np.log1p(lines) / 8]
    return np.concatenate([shares, sizes, np.sqrt(shapes / max(n, 1))])


def meta_features(source: str | None, lang: str | None, length: int) -> np.ndarray:
    out = np.zeros(META + 3)
    for name in (f"s:{source}", f"l:{lang}"):
        out[zlib.crc32(name.encode("utf-8", "replace")) % META] += 1
    size = np.log1p(length)
    out[META:] = size / 12, (size / 12) ** 2, float(length < 200)
    return out


FEATURES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("text_view", pa.list_(pa.float32())), ("meta_view", pa.list_(pa.float32()))])


def _views(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(2))
        content = [text_features(t).astype(np.float32) for t in texts]
        about = [meta_features(s, g, len(t)).astype(np.float32) for t, s, g in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(content, FEATURES.field(2).type), pa.array(about, FEATURES.field(3).type)], schema=FEATURES)


def views(docs: DataFrame) -> DataFrame:
    """``doc_id, row, text_view, meta_view`` for every row; ``row`` stands for its text, source and language, so copies share it."""
    cols = [F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")]
    nulls = [F.col(c).isNull() for c in ("source", "lang")]  # the hash passes over nulls
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text", "source", "lang", *nulls).alias("row"), *cols)
    return rows.mapInArrow(_views, "doc_id long, row long, text_view array<float>, meta_view array<float>")


def logits(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def _logits(models):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [logits(w, batch.column(i).flatten().to_numpy().reshape(batch.num_rows, -1).astype(float)) for w, i in zip(models.value, (2, 3), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "row": batch.column(1), "text_logit": found[0], "meta_logit": found[1]})

    return run


class Model:
    """The two views and the weights that combine their calibrated scores."""

    def __init__(self, content: np.ndarray, about: np.ndarray, calibration: list[np.ndarray], combined: np.ndarray):
        self.views, self.calibration, self.combined = (content, about), calibration, combined

    def arrays(self) -> tuple:
        """What a broadcast holds: an instance would need this module on the workers."""
        return *self.views, self.calibration, self.combined

    def score(self, z: np.ndarray) -> np.ndarray:
        """``z``: a logit of each view in the columns."""
        steady = np.column_stack([logits(c, z[:, i : i + 1]) for i, c in enumerate(self.calibration)])
        return probability(logits(self.combined, steady))


def _arrays(rows, label=None):
    x = [np.array([r[c] for r in rows], float) for c in ("text_view", "meta_view")]
    return x, np.array([r.quality for r in rows] if label is None else np.full(len(rows), label), float)


def train(features: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sample: int = SAMPLE, handed: int = HANDED) -> Model:
    spark = features.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)")
    known = known.filter(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "chosen")  # bounded: two numbers a row
    # one row for each id, combined before the shuffle
    least = features.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct("row", "text_view", "meta_view")).alias("least"))
    rows = least.select("doc_id", "quality", "least.*").collect()
    rows.sort(key=lambda r: r.doc_id)
    y = np.array([r.quality for r in rows], float)
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        sizes = len(text_features(b"")), META + 3
        return Model(*(np.zeros(s + 1) for s in sizes), [np.zeros(2)] * 2, np.array([0, 0, np.log(share / (1 - share))]))
    x, _ = _arrays(rows)
    aside = np.array([zlib.crc32(f"aside {r.doc_id}".encode()) % 4 == 0 for r in rows])
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside = np.zeros(len(rows), bool)
    pools = [[x[i][~aside]] for i in (0, 1)]
    targets = [[y[~aside]] for _ in (0, 1)]
    fit = lambda i: fit_logistic(np.concatenate(pools[i]), np.concatenate(targets[i]), ridge=1.0)
    weights = [fit(0), fit(1)]
    # which documents have labels is a join, not a list: labels may be many
    free = stored(features.join(labels.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct(), "doc_id", "left_anti"), "unlabelled")
    used: list[int] = []  # rows handed over so far, at most rounds * 4 * handed
    edge = float(np.log(SURE / (1 - SURE)))
    for _ in range(rounds):
        scored = free.mapInArrow(_logits(spark.sparkContext.broadcast(weights)), "doc_id long, row long, text_logit double, meta_logit double")
        scored = stored(scored, "scored")
        fresh = scored.filter(~F.col("row").isin(used)) if used else scored
        moved = 0
        for giver, column in enumerate(("text_logit", "meta_logit")):
            for label, z in ((1, F.col(column)), (0, -F.col(column))):
                best = fresh.filter(z >= edge).groupBy("row").agg(F.max(z).alias("z"))
                sure = best.orderBy(F.desc("z"), "row").limit(handed).select("row")
                picked = free.join(F.broadcast(sure), "row").dropDuplicates(["row"]).collect()
                if picked:
                    px, py = _arrays(picked, label)
                    pools[1 - giver].append(px[1 - giver])
                    targets[1 - giver].append(py)
                    used += [r.row for r in picked]
                    moved += len(picked)
        if not moved:
            break
        weights = [fit(0), fit(1)]
    test = aside if aside.any() else np.ones(len(rows), bool)
    z = np.column_stack([logits(weights[i], x[i][test]) for i in (0, 1)])
    calibration = [fit_logistic(z[:, i : i + 1], y[test], ridge=0.1) for i in (0, 1)]
    steady = np.column_stack([logits(c, z[:, i : i + 1]) for i, c in enumerate(calibration)])
    return Model(*weights, calibration, fit_logistic(steady, y[test], ridge=0.1))


def _score(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*model.value)
        for batch in batches:
            if batch.num_rows:
                z = np.column_stack([logits(w, batch.column(i).flatten().to_numpy().reshape(batch.num_rows, -1).astype(float)) for w, i in zip(own.views, (2, 3), strict=True)])
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text_score": probability(z[:, 0]), "meta_score": probability(z[:, 1]), "score": own.score(z)})

    return run


def scored(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, sample: int = SAMPLE, handed: int = HANDED) -> DataFrame:
    """``doc_id, held_out, text_score, meta_score, score, predicted`` for every row of ``docs``; scores are of good quality."""
    features = stored(views(docs), "views")
    model = docs.sparkSession.sparkContext.broadcast(train(features, labels, rounds, sample, handed).arrays())
    found = features.mapInArrow(_score(model), "doc_id long, text_score double, meta_score double, score double")
    return found.select("doc_id", held_out().alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
