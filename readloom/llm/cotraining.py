"""A quality classifier by co-training: a text view and a metadata view teach each other.

Each view is a logistic regression. In every round each view, calibrated on labelled rows
that are held out, labels the unlabelled rows it is sure of for the other view. At the end
the calibrated views are combined by a third regression on the held-out rows.

Features are staged once, for every row. A round looks at all unlabelled rows: it counts
those that a view is sure of, and takes an even sample of them, by hash, `taught` at most.
The one other bound is `labelled`, the labelled rows that are fitted on.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NONSPACE, U64, Words, batch, mixed, slices, staged

#: Labelled rows to fit on; rounds; how sure a view must be; rows that a view teaches the other in a round.
LABELLED, ROUNDS, CONFIDENT, TAUGHT = 20_000, 5, 0.95, 1000
#: Rows with a lower score are rejected.
THRESHOLD = 0.5

#: A class for each byte: ASCII marks one by one, then digits, capitals, small letters, spaces, line ends, controls, the rest.
_MARKS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASS = np.full(256, len(_MARKS) + 5, np.int64)
_CLASS[_MARKS] = np.arange(len(_MARKS))
_CLASS[0x30:0x3A], _CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x20], _CLASS[0x0A] = (len(_MARKS) + k for k in range(5))
_CLASS[0x80:] = len(_MARKS) + 6
_N_CLASS = len(_MARKS) + 7


def text_view(texts: list[bytes]) -> np.ndarray:
    """A row of features of each text: shares of byte classes, word and line statistics."""
    n = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    shares = np.bincount(np.repeat(np.arange(n), size) * _N_CLASS + _CLASS[data], minlength=n * _N_CLASS).reshape(n, _N_CLASS)
    w = Words(texts, NONSPACE, lower=True)
    h, owner, count = w.hashes(), w.owner(), np.maximum(w.counts, 1)
    length = (w.end - w.start).astype(float)
    mean = np.bincount(owner, length, n) / count
    spread = np.sqrt(np.maximum(0, np.bincount(owner, length**2, n) / count - mean**2))
    pairs = np.lexsort((h, owner))
    new = np.append(True, (h[pairs][1:] != h[pairs][:-1]) | (owner[pairs][1:] != owner[pairs][:-1])) if len(h) else np.empty(0, bool)
    distinct = np.bincount(owner[pairs][new], minlength=n) / count
    again = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=n) / count
    lines = shares[:, len(_MARKS) + 4] + 1
    return np.column_stack([np.sqrt(shares / np.maximum(size, 1)[:, None]), np.log1p(size), np.log1p(w.counts), mean, spread, distinct, again, np.log1p(size / lines), np.log(lines)])


SOURCES, LANGS, SIZES = 64, 16, 20


def metadata(source: list, lang: list, n_chars: list) -> np.ndarray:
    """Places of source, language (hashed) and length class in the metadata view; nulls have values of their own."""
    own = [zlib.crc32(repr(s).encode()) % SOURCES for s in source]
    spoken = [SOURCES + zlib.crc32(repr(s).encode()) % LANGS for s in lang]
    size = [SOURCES + LANGS + (0 if c is None else min(SIZES - 1, 1 + int(math.log2(max(c, 0) + 1)))) for c in n_chars]
    return np.array([own, spoken, size], np.int32).T.reshape(-1, 3)


def metadata_view(places: np.ndarray) -> np.ndarray:
    """One-hot features."""
    out = np.zeros((len(places), SOURCES + LANGS + SIZES))
    out[np.arange(len(places))[:, None], places] = 1
    return out


class Logistic:
    """Logistic regression on standardised features, by Newton steps, classes weighted alike if `even`."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, even: bool = True):
        self.mean, self.scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        share = y.mean()
        weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) if even and 0 < share < 1 else np.ones(len(y))
        ridge = np.full(z.shape[1], penalty)
        ridge[-1] = 1e-6
        self.w = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            slope = z.T @ (weight * (p - y)) + ridge * self.w
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), slope)
            self.w -= step
            if np.abs(step).max() < 1e-6:
                break

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


#: What a view may be sure of: own view, class.
KINDS = [(view, good) for view in (0, 1) for good in (1.0, 0.0)]


def sure_of(model: Model, views: list[np.ndarray], key: np.ndarray, taught: list[np.ndarray], confident: float) -> list[np.ndarray]:
    """For each kind the rows of which the view is sure, without those (by key) that it has taught."""
    p = [_sigmoid(model.calibrated(k, x)) for k, x in enumerate(views)]
    return [np.flatnonzero(((p[view] if good else 1 - p[view]) >= confident) & ~np.isin(key, taught[view])) for view, good in KINDS]


class LocalPool:
    """Unlabelled rows in memory."""

    def __init__(self, views: list[np.ndarray]):
        self.views, self.key = views, mixed(np.arange(len(views[0]), dtype=U64))

    def pick(self, model: Model, wanted: list[int], taught: list[np.ndarray], confident: float, salt: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        out = []
        for n, sure in zip(wanted, sure_of(model, self.views, self.key, taught, confident), strict=True):
            best = sure[np.argsort(mixed(self.key[sure] + U64(salt)))][:n]
            out.append((self.key[best], [x[best] for x in self.views]))
        return out


class Model:
    """Both views, their calibration and their combination; without rows of both classes the share of the good.

    pool.pick gives, for each of KINDS, keys and views of at most as many rows as wanted.
    """

    def __init__(self, views: list[np.ndarray], y: np.ndarray, held: np.ndarray, pool, rounds: int = ROUNDS, confident: float = CONFIDENT, taught: int = TAUGHT):
        self.prior = float(y.mean()) if len(y) else 1.0
        self.fitted = False
        if any(len(np.unique(part)) < 2 for part in (y[held], y[~held])):
            return
        train = [[x[~held]] for x in views]
        truth = [[y[~held]] for _ in views]
        done = [np.empty(0, U64), np.empty(0, U64)]
        wanted = [max(1, round(taught * (self.prior if good else 1 - self.prior))) for _, good in KINDS]
        for k in range(rounds + 1):
            self.models = [Logistic(np.concatenate(x), np.concatenate(t)) for x, t in zip(train, truth, strict=True)]
            self.scales = [Logistic(m.logit(x[held])[:, None], y[held], 1e-2, False) for m, x in zip(self.models, views, strict=True)]
            if k == rounds:
                break
            found = pool.pick(self, wanted, done, confident, k)
            if not any(len(key) for key, _ in found):
                break
            for (view, good), (key, rows) in zip(KINDS, found, strict=True):
                train[1 - view].append(rows[1 - view])
                truth[1 - view].append(np.full(len(key), good))
                done[view] = np.concatenate([done[view], key])
        both = np.column_stack([self.calibrated(k, x[held]) for k, x in enumerate(views)])
        self.combined = Logistic(both, y[held], 1e-2, False)
        self.fitted = True

    def calibrated(self, view: int, x: np.ndarray) -> np.ndarray:
        return self.scales[view].logit(self.models[view].logit(x)[:, None])

    def scores(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """Probabilities of being good: by text, by metadata, by both."""
        if not self.fitted:
            return [np.full(len(views[0]), self.prior)] * 3
        logits = [self.calibrated(k, x) for k, x in enumerate(views)]
        return [*map(_sigmoid, logits), _sigmoid(self.combined.logit(np.column_stack(logits)))]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"))


def _views(rows: pa.RecordBatch, texts: list[bytes]) -> list[np.ndarray]:
    return [text_view(texts).astype(np.float32).astype(float), metadata_view(metadata(*(rows.column(c).to_pylist() for c in ("source", "lang", "n_chars"))))]


_FEATURES = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("text", pa.list_(pa.float32())), ("meta", pa.list_(pa.int32()))])


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A staged table of doc_id, hash (of the whole row), text array<float>, meta array<int>, quality of every row.

    Labels without doc_id or quality are left out; of labels that disagree the better counts.
    """

    def work(batches):
        for rows, texts in slices(batches):
            meta = metadata(*(rows.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
            yield batch(_FEATURES, rows.column("doc_id"), rows.column("hash"), list(text_view(texts).astype(np.float32)), list(meta))

    rows = _rows(docs).withColumn("hash", F.xxhash64("text", "source", "lang", "n_chars"))
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("quality"))
    return staged(rows.mapInArrow(work, "doc_id long, hash long, text array<float>, meta array<int>").join(known, "doc_id", "left").select("doc_id", "hash", "text", "meta", "quality"), "features")


def _stacked(rows: pa.RecordBatch | pa.Table, column: str) -> np.ndarray:
    n, found = rows.num_rows, rows.column(column)
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    return found.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1), np.int32)


def _stored(rows) -> list[np.ndarray]:
    """Both views of stored features."""
    return [_stacked(rows, "text").astype(float), metadata_view(_stacked(rows, "meta"))]


class Pool:
    """The unlabelled rows of a table of features; rows that are alike count once."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.where("quality is null").select("hash", "text", "meta")

    def pick(self, model: Model, wanted: list[int], taught: list[np.ndarray], confident: float, salt: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """One pass counts the rows that each view is sure of, another takes twice as many as wanted, evenly by hash; the smallest hashes are kept."""
        counted, chosen = pa.schema([("kind", pa.int32()), ("n", pa.int64())]), pa.schema([("kind", pa.int32()), ("hash", pa.int64()), ("text", pa.list_(pa.float32())), ("meta", pa.list_(pa.int32()))])

        def sure(rows):
            key = rows.column("hash").to_numpy().view(U64)
            return key, sure_of(model, _stored(rows), key, taught, confident)

        def count(batches):
            total = np.zeros(len(KINDS), np.int64)
            for rows in batches:
                if rows.num_rows:
                    total += [len(x) for x in sure(rows)[1]]
            yield batch(counted, np.arange(len(KINDS)), total)

        n = dict(map(tuple, self.rows.mapInArrow(count, "kind int, n long").groupBy("kind").agg(F.sum("n")).collect()))
        least = [min(1.0, 2 * k / max(1, n.get(kind, 0))) * 2.0**64 for kind, k in enumerate(wanted)]

        def take(batches):
            for rows in batches:
                if not rows.num_rows:
                    continue
                key, found = sure(rows)
                order = mixed(key + U64(salt)).astype(float)
                for kind, at in enumerate(found):
                    at = pa.array(at[order[at] < least[kind]])
                    yield batch(chosen, np.full(len(at), kind), *(rows.column(c).take(at) for c in ("hash", "text", "meta")))

        found = self.rows.mapInArrow(take, "kind int, hash long, text array<float>, meta array<int>").groupBy("kind", "hash").agg(F.any_value("text").alias("text"), F.any_value("meta").alias("meta")).toArrow()
        kinds, keys, views = found.column("kind").to_numpy(), found.column("hash").to_numpy().view(U64), _stored(found)
        out = []
        for kind, k in enumerate(wanted):
            mine = np.flatnonzero(kinds == kind)
            mine = mine[np.argsort(mixed(keys[mine] + U64(salt)))][:k]
            out.append((keys[mine], [v[mine] for v in views]))
        return out


def fit(found: DataFrame, labelled: int = LABELLED, **how) -> Model:
    """The model from `features`. Of the rows of one doc_id that with the smallest hash is taken for its label."""
    known = found.where("quality is not null").groupBy("doc_id").agg(F.min_by(F.struct("quality", "text", "meta"), "hash").alias("x")).select("doc_id", "x.*")
    got = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled).toArrow().sort_by("doc_id")
    y = got.column("quality").to_numpy()
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 0 for i in got.column("doc_id").to_pylist()], bool)
    return Model(_stored(got) if len(y) else [np.zeros((0, 1))] * 2, y, held, Pool(found), **how)


_SCORES = pa.schema([("doc_id", pa.int64()), ("text_score", pa.float64()), ("metadata_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """doc_id, text_score, metadata_score, score (0 to 1), accepted of every row of `docs`.

    Null texts are empty; null metadata is a value of its own. Without labels of both classes
    every score is the share of good labels (1 without any). Rows that are repeated have
    one score; an empty table gives none; a score of just `threshold` is accepted.
    """
    found = features(docs, labels)
    model = fit(found, **how)

    def work(batches):
        for rows in batches:
            if rows.num_rows:
                yield batch(_SCORES, rows.column("doc_id"), *model.scores(_stored(rows)))

    return found.select("doc_id", "text", "meta").mapInArrow(work, "doc_id long, text_score double, metadata_score double, score double").withColumn("accepted", F.col("score") >= threshold)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of `docs` that are not rejected: doc_id, text, lang, source, n_chars as they are. Cases are as in `score`."""
    model = fit(features(docs, labels), **how)

    def work(batches):
        for rows, texts in slices(batches):
            yield rows.filter(pa.array(model.scores(_views(rows, texts))[2] >= threshold))

    rows = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return rows.mapInArrow(work, rows.schema)
