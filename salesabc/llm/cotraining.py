"""Quality classification by co-training of two views.

The content view sees hashed words and hashed word shapes; the metadata view
sees the page's language, source and size, and layout figures (lines, their
lengths, character classes, repetition).  Both start from a bounded sample of
labelled rows.  In every round each view scores all documents outside it and
hands its most confident ones to the other view as pseudo-labels; at the end
both are calibrated on labelled rows that were kept aside, and their
log-odds are added up by a small logistic model.  Every document is scored.

Bounds: ``fit_rows`` labelled rows (chosen by a hash of the id) and ``picks``
pseudo-labels a class, view and round; the pool from which they are picked is
every document outside the sample (held-out ones, those with labels beyond it
and null ids too, by their texts alone), and each task hands on its own best
ones only.

Defined cases: a null text is empty; null metadata is a value of its own; rows
without an id are scored and never have a label; repeated rows are
scored alike; without labels of both classes every score is the share of label
1 (a half without any); an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_array, written

FIT_ROWS = 8000
PICKS = 300
ROUNDS = 3
WORD_DIMS, SHAPE_DIMS, NAME_DIMS = 128, 128, 16
LAYOUT = 12
CONTENT, META = WORD_DIMS + SHAPE_DIMS, 2 * NAME_DIMS + LAYOUT
_RUNS = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Letters by case, digits as 0, other characters as they are, runs collapsed."""
    return _RUNS.sub(r"\1", "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in word[:40]))


def _spots(value: str, dims: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(value) % dims


def features(texts: pa.Array, langs: list, sources: list) -> tuple[np.ndarray, np.ndarray]:
    """Content and metadata vectors of a batch, as bytes from 0 to 255."""
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    flat, offsets = split.flatten(), offsets - offsets[0]
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_pylist()
    index = coded.indices.to_numpy(zero_copy_only=False)
    spot = np.array([_spots(w.lower(), WORD_DIMS) for w in names], np.int64)
    form = np.array([WORD_DIMS + _spots(shape(w), SHAPE_DIMS) for w in names], np.int64)
    content, meta = np.zeros((len(texts), CONTENT), np.float32), np.zeros((len(texts), META), np.float32)
    for i, text in enumerate(texts.to_pylist()):
        own = index[offsets[i]:offsets[i + 1]]
        n = max(1, len(own))
        content[i] = (np.bincount(spot[own], minlength=CONTENT) + np.bincount(form[own], minlength=CONTENT)) / n if len(own) else 0
        raw = np.frombuffer(text.encode(), np.uint8)
        size = max(1, len(raw))
        lines = np.diff(np.concatenate(([-1], np.flatnonzero(raw == 10), [len(raw)]))) - 1
        table = np.bincount(raw, minlength=256) / size
        distinct, count = np.unique(own, return_counts=True)
        meta[i, _spots(f"lang {langs[i]}", NAME_DIMS)] = 1
        meta[i, NAME_DIMS + _spots(f"source {sources[i]}", NAME_DIMS)] = 1
        meta[i, 2 * NAME_DIMS:] = (np.log1p(len(raw)) / 16, np.log1p(len(lines)) / 12, np.log1p(lines.mean()) / 12, np.log1p(lines.max()) / 12,
                                   table[65:91].sum(), table[48:58].sum(), table[33:48].sum(), table[58:65].sum() + table[91:97].sum() + table[123:127].sum(),
                                   table[32], len(distinct) / n, count.max() / n if len(count) else 0, table[128:].sum())
    return np.sqrt(np.clip(content, 0, 1)), np.sqrt(np.clip(meta, 0, 1))


def feature_table(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, keep: list[str]) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                content, meta = features(text_array(part.column(1)), part.column(2).to_pylist(), part.column(3).to_pylist())
                pack = lambda x: pa.array([r.tobytes() for r in np.round(x * 255).astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pack(content), pack(meta), *(part.column(4 + i) for i in range(len(keep)))], [id_col, "content", "meta", *keep])

    kinds = "".join(f", {k} {docs.schema[k].dataType.simpleString()}" for k in keep)
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang"), F.col(source_col).cast("string").alias("_source"), *keep)
    return own.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, content binary, meta binary{kinds}")


def unpack(column) -> np.ndarray:
    rows = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1).astype(np.float32) / 255 if rows else np.zeros((0, 1), np.float32)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 0.5, steps: int = 12) -> np.ndarray:
    """Weights, the bias last, of a logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x), np.float32)]).astype(np.float64)
    weight = np.ones(len(x)) if weight is None else weight
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -8, 8)
        if np.abs(step).max() < 1e-3:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _best_of_all(pool: DataFrame, views: list[np.ndarray], picks: int) -> list[list]:
    """For each view and class, the most confident rows of the whole pool (content, meta)."""

    def best(batches):
        held: dict[int, list] = {k: [] for k in range(4)}
        for batch in batches:
            content, meta = unpack(batch.column(1)), unpack(batch.column(2))
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for view, x in enumerate((content, meta)):
                z = logit(x, views[view])
                for cls in (0, 1):
                    sure = z if cls else -z
                    top = np.argsort(-sure, kind="stable")[:picks]
                    got = held[2 * view + cls] + [(float(sure[i]), int(keys[i]), batch.column(1)[i].as_py(), batch.column(2)[i].as_py()) for i in top]
                    held[2 * view + cls] = sorted(got, key=lambda r: (-r[0], r[1]))[:picks]
        rows = [(k, *r) for k, got in held.items() for r in got]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["kind", "sure", "tie", "content", "meta"])

    tops = written(pool.select(F.xxhash64("_key", "content", "meta").alias("tie"), "content", "meta").mapInArrow(best, "kind long, sure double, tie long, content binary, meta binary"), "confident")
    return [tops.where(F.col("kind") == k).orderBy(F.col("sure").desc(), "tie").limit(picks).collect() for k in range(4)]


def co_train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
             label_col: str = "quality", fit_rows: int = FIT_ROWS, picks: int = PICKS, rounds: int = ROUNDS) -> DataFrame:
    """id, content_score, metadata_score, score: calibrated probabilities of label 1 for every document.

    ``learn`` is a condition on the id; labels of other rows are never read.
    """
    marked = docs.withColumn("_learn", F.coalesce(learn, F.lit(False)) & F.col(id_col).isNotNull())
    table = written(feature_table(marked, id_col, text_col, lang_col, source_col, ["_learn"]), "features")
    given = written(labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label")).where(learn & F.col(id_col).isNotNull() & F.col("label").isin(0, 1))
                    .groupBy(id_col).agg(F.max("label").alias("label")), "given-labels")
    n = given.count()
    share = int(min(1.0, fit_rows / max(n, 1)) * 1_000_000)
    hashed = F.pmod(F.xxhash64(id_col), F.lit(1_000_000))
    fit = (table.where(F.col("_learn") & (hashed < share)).join(given.where(hashed < share), id_col).orderBy(F.xxhash64(id_col)).limit(2 * fit_rows)
           .select("content", "meta", "label", F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(4)).alias("part")).collect())
    label, part = np.array([r["label"] for r in fit], float), np.array([r["part"] for r in fit])
    views, platt, mix = [np.zeros(CONTENT + 1), np.zeros(META + 1)], [np.array([1.0, 0.0])] * 2, np.array([0.5, 0.5, 0.0])
    aside = part == 0
    if min((label[~aside] == c).sum() for c in (0, 1)) > 0:
        x = [unpack([r[c] for r in fit]) for c in ("content", "meta")]
        extra: list[list[tuple[bytes, int]]] = [[], []]  # pseudo-labels that each view was given
        for k in range(rounds + 1):
            for v in (0, 1):
                more = unpack([b for b, _ in extra[v]]) if extra[v] else x[v][:0]
                y = np.concatenate([label[~aside], [c for _, c in extra[v]]])
                views[v] = fit_logistic(np.concatenate([x[v][~aside], more]), y, np.concatenate([np.ones((~aside).sum()), np.full(len(extra[v]), 0.5)]))
            if k < rounds:
                pool = table.join(given.where(hashed < share), id_col, "left_anti").withColumn("_key", F.col(id_col))
                tops = _best_of_all(pool, views, picks)
                for v in (0, 1):  # a view learns from what the other one is sure of
                    extra[v] += [((r["content"], r["meta"])[v], cls) for cls in (0, 1) for r in tops[2 * (1 - v) + cls] if r["sure"] > 2]
        sides = aside if min((label[aside] == c).sum() for c in (0, 1)) > 0 else ~aside
        z = [logit(x[v][sides], views[v]) for v in (0, 1)]
        platt = [fit_logistic(z[v][:, None], label[sides], l2=0.01) for v in (0, 1)]
        mix = fit_logistic(np.column_stack([logit(z[v][:, None], platt[v]) for v in (0, 1)]), label[sides], l2=0.05)
    elif len(label):
        share_1 = np.clip(label.mean(), 0.001, 0.999)
        platt = [np.array([0.0, np.log(share_1 / (1 - share_1))])] * 2

    def score(batches):
        for batch in batches:
            z = [logit(logit(unpack(batch.column(1 + v)), views[v])[:, None], platt[v]) for v in (0, 1)] if batch.num_rows else [np.zeros(0)] * 2
            p = lambda t: pa.array(1 / (1 + np.exp(-t)))
            yield pa.RecordBatch.from_arrays([batch.column(0), p(z[0]), p(z[1]), p(np.clip(mix[0] * z[0] + mix[1] * z[1] + mix[2], -30, 30))], [id_col, "content_score", "metadata_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return table.select(id_col, "content", "meta").mapInArrow(score, f"`{id_col}` {kind}, content_score double, metadata_score double, score double")
