"""Toxicity by weak supervision.

Voters: a fixed lexicon, three lexicons mined from labelled rows (whole words,
word beginnings and endings that mark toxic rows), and text patterns.  A generative
label model over the voters' firing patterns estimates, by EM, how often each
voter fires on either class and how voters correlate beyond the class; it sees
a given label as one more voter.  A linear classifier is then trained on the
model's posterior labels and scores every document.

What covers all data: the voters' firing patterns, of held-out rows and null
ids too, without labels, and the scores.  What is fitted on a bounded sample: the mined terms and the classifier's weights
(``fit_rows`` rows each, chosen by a hash of the id).  The pattern table has at
most 3 * 2^voters rows at every size.

Defined cases: a null text is empty and scores like any text without a hit; a
null id is kept, counts as unlabelled and trains no weights; repeated rows are scored alike;
rows without a label only feed the posterior; with no labels at all the fixed
lexicon and the patterns decide; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import process_cache, text_array, written

FIT_ROWS = 20_000
MAX_TERMS = 512
#: General insults that start the first voter (fixed values).
SEED_LEXICON = ("idiot", "idiots", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "pathetic",
                "worthless", "disgusting", "clown", "imbecile", "garbage", "vermin", "dumb", "retard", "filth", "hate you")
MINED_VOTERS = 3  # whole words, beginnings, endings
VOTERS = 1 + MINED_VOTERS + 4
_SPACED = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_UPPER = bytes(range(65, 91))
_PLAIN = bytes(c for c in range(128) if chr(c).isalnum() or chr(c).isspace())
_WORD = re.compile(r"[^\W_]+")


def flat_text(text: str) -> str:
    """Lower-case text with ASCII punctuation as spaces, one character a UTF-8 byte, spaces at both ends."""
    return " " + text.lower().encode().translate(_SPACED).decode("latin-1") + " "


def _term(word: str) -> str:
    return word.encode().decode("latin-1")


def word_terms(word: str) -> list[str]:
    """Patterns of a word in ``flat_text``: the word, its beginnings, its ending."""
    out = [f" {word} "] + [f" {word[:k]}" for k in (4, 5, 6) if len(word) > k]
    if len(word) > 5:
        out.append(f"{word[-5:]} ")
    return [_term(t) for t in out]


def sketch(words: list[str]) -> int:
    """The least hash of the five-word shingles, mostly shared by near copies."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return min((digest(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0) >> 1


def mine_terms(fit: DataFrame) -> list[str]:
    """Terms of (text, label) rows that mark label 1, best first.

    Near copies (rows with the same shingle sketch) count once, so that the
    chance words of a copied document don't look like markers.
    """

    def sketched(batches):
        for batch in batches:
            texts = text_array(batch.column(0))
            yield pa.RecordBatch.from_arrays([texts, batch.column(1), pa.array([sketch(_WORD.findall(t.lower())) for t in texts.to_pylist()], pa.int64())], ["text", "label", "sketch"])

    def counted(batches):
        marks, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = set()
                for word in set(_WORD.findall(text.lower())):
                    if 2 < len(word) < 40:
                        own.update(word_terms(word))
                (marks if label else clean).update(own)
        names = list(marks.keys() | clean.keys())
        for lo in range(0, len(names), 100_000):
            part = names[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([marks[t] for t in part]), pa.array([clean[t] for t in part])], ["term", "marks", "clean"])

    one = (fit.mapInArrow(sketched, "text string, label int, sketch long").groupBy("sketch", "label").agg(F.max("text").alias("text")).select("text", "label"))
    counts = one.mapInArrow(counted, "term string, marks long, clean long").groupBy("term").agg(F.sum("marks").alias("marks"), F.sum("clean").alias("clean"))
    total = fit.agg(F.sum("label")).first()[0] or 0
    share = F.col("marks") / (F.col("marks") + F.col("clean"))
    n = F.col("marks") + F.col("clean")
    z = 1.64
    lower = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    best = (counts.where(F.col("marks") >= max(3, 0.005 * total)).withColumn("sure", lower).where("sure >= 0.5")
            .orderBy(F.col("marks").desc(), F.col("sure").desc(), F.length("term"), "term").limit(4 * MAX_TERMS).collect())
    chosen: list[str] = []
    for r in best:
        if len(chosen) < MAX_TERMS and not any(t in r["term"] for t in chosen):
            chosen.append(r["term"])
    return chosen


def _automaton(terms: list[str]):
    import ahocorasick

    cache = process_cache()
    key = ("terms", tuple(terms))
    if key not in cache:
        auto = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            auto.add_word(term, i)
        auto.make_automaton()
        cache[key] = auto
    return cache[key]


def text_hits(docs: DataFrame, id_col: str, text_col: str, terms: list[str], keep: list[str]) -> DataFrame:
    """Per document: the distinct terms found, all their occurrences, words, and shares of upper case and symbols."""

    def run(batches):
        auto = _automaton(terms) if terms else None
        for batch in batches:
            found, hits, words, upper, symbols = [], [], [], [], []
            for text in text_array(batch.column(1)).to_pylist():
                raw, flat = text.encode(), flat_text(text)
                got = [i for _, i in auto.iter(flat)] if auto else []
                found.append(sorted(set(got)))
                hits.append(len(got))
                words.append(len(raw.split()))
                size = max(1, len(raw))
                upper.append((len(raw) - len(raw.translate(None, _UPPER))) / size)
                symbols.append(len(raw.translate(None, _PLAIN).translate(None, bytes(range(128, 256)))) / size)
            cols = [batch.column(0), pa.array(found, pa.list_(pa.int32())), pa.array(hits, pa.int64()), pa.array(words, pa.int64()), pa.array(upper, pa.float64()), pa.array(symbols, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols + [batch.column(2 + i) for i in range(len(keep))], [id_col, "found", "hits", "words", "upper", "symbols", *keep])

    kinds = "".join(f", `{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, found array<int>, hits long, words long, upper double, symbols double{kinds}"
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), *keep).mapInArrow(run, schema)


def term_voter(term: str) -> int:
    """The mined voter of a term: 0 whole words, 1 beginnings, 2 endings."""
    return 2 if term[0] != " " else 0 if term[-1] == " " else 1


def votes(n_seed: int, mined: list[str]) -> Column:
    """The firing pattern as bits of one integer: bit 0 fixed lexicon, 1-3 mined words, beginnings, endings, then four patterns.

    ``mined`` has the terms behind the first ``n_seed``, sorted by voter.
    """
    ends = [n_seed + sum(term_voter(t) < v for t in mined) for v in range(MINED_VOTERS + 1)]

    def fires_from(low, high):
        return F.exists("found", lambda t: (t >= low) & (t < high))

    fires = [F.exists("found", lambda t: t < n_seed), *(fires_from(*b) for b in zip(ends, ends[1:])), F.col("hits") >= 2, F.col("hits") * 200 > F.col("words"),
             F.col("upper") > 0.4, F.col("symbols") > 0.15]
    out = F.lit(0)
    for i, fire in enumerate(fires):
        out = out.bitwiseOR(F.when(fire, 1 << i).otherwise(0))
    return out


class LabelModel:
    """P(pattern, class) of binary voters: class-wise firing weights and pairwise weights for correlated voters.

    With so few voters every pattern can be enumerated, so the model is
    normalised exactly; EM fits it to pattern counts.  A given label is a
    voter that is silent on rows without one.
    """

    def __init__(self, voters: int, rounds: int = 30):
        self.voters, self.rounds = voters, rounds
        every = np.arange(1 << voters)
        self.bits = ((every[:, None] >> np.arange(voters)) & 1).astype(float)
        self.pairs: list[tuple[int, int]] = []

    def _features(self) -> np.ndarray:
        cross = [self.bits[:, i] * self.bits[:, j] for i, j in self.pairs]
        return np.column_stack([self.bits, *cross]) if cross else self.bits

    def _joint(self) -> np.ndarray:
        """log P(pattern | class), one column a class."""
        x = self._features()
        raw = np.column_stack([x[:, :self.voters] @ self.weights[c] + x[:, self.voters:] @ self.cross for c in (0, 1)])
        top = raw.max(axis=0)
        return raw - top - np.log(np.exp(raw - top).sum(axis=0))

    def _maximise(self, mass: np.ndarray) -> None:
        """Gradient steps on the expected log-likelihood; mass[pattern, class]."""
        x, v, total = self._features(), self.voters, mass.sum()
        for _ in range(60):
            p = np.exp(self._joint())
            gap = [x.T @ (mass[:, c] - mass[:, c].sum() * p[:, c]) for c in (0, 1)]
            for c in (0, 1):
                self.weights[c] += 4 * (gap[c][:v] / max(mass[:, c].sum(), 1e-9)) - 1e-3 * self.weights[c]
            self.cross += 2 * ((gap[0][v:] + gap[1][v:]) / max(total, 1e-9)) - 1e-3 * self.cross
        self.prior = np.clip(mass.sum(axis=0) / total, 1e-4, 1 - 1e-4)

    def fit(self, pattern: np.ndarray, label: np.ndarray, count: np.ndarray) -> LabelModel:
        """label: 0, 1, or -1 where none is given."""
        v, known = self.voters, label >= 0
        given = count[known & (label == 1)].sum() / max(count[known].sum(), 1) if known.any() else 0.1
        self.prior = np.array([1 - given, given]).clip(1e-3, 1 - 1e-3)
        self.weights = np.stack([np.full(v, -3.0), np.full(v, 0.0)])
        self.cross, self.given = np.zeros(0), np.array([[0.98, 0.02], [0.05, 0.95]])
        for stage in (0, 1):  # first without correlations, then with those that the first leaves over
            for _ in range(self.rounds if known.any() else 3):
                post = self.posterior(pattern, label)
                mass = np.zeros((1 << v, 2))
                np.add.at(mass[:, 1], pattern, count * post)
                np.add.at(mass[:, 0], pattern, count * (1 - post))
                self._maximise(mass + 1e-6)
                for c, share in ((0, 1 - post), (1, post)):
                    w = count * share
                    got = np.array([(w * (label == g)).sum() for g in (0, 1)]) + np.array([[8.0, 0.2], [0.2, 8.0]])[c]
                    self.given[c] = got / got.sum()
            if stage == 0:
                self.pairs = self._correlated(pattern, label, count, post)
                self.cross = np.zeros(len(self.pairs))
        return self

    def _correlated(self, pattern, label, count, post) -> list[tuple[int, int]]:
        """Pairs of voters that fire together more or less often than their rates within a class say.

        Classes are the given labels where both have enough of them, else the posterior.
        """
        given = [count * (label == c) for c in (0, 1)]
        classes = given if min(w.sum() for w in given) >= 100 else [count * (1 - post), count * post]
        left = np.zeros((self.voters, self.voters))
        for w in classes:
            x, share = self.bits[pattern], w / max(w.sum(), 1e-9)
            rate = share @ x
            left = np.maximum(left, np.abs(x.T @ (x * share[:, None]) - np.outer(rate, rate)))
        return [(i, j) for i in range(self.voters) for j in range(i + 1, self.voters) if left[i, j] > 0.02]

    def posterior(self, pattern: np.ndarray, label: np.ndarray) -> np.ndarray:
        """P(class 1 | voters and, where given, the label)."""
        score = self._joint()[pattern] + np.log(self.prior)
        for g in (0, 1):
            score = score + (label == g)[:, None] * np.log(self.given[:, g])[None, :]
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))


def design(found: list, hits: np.ndarray, words: np.ndarray, upper: np.ndarray, symbols: np.ndarray, terms: int) -> np.ndarray:
    """Features of the linear classifier."""
    x = np.zeros((len(hits), terms + 5), np.float32)
    size = [len(f) for f in found]
    x[np.repeat(np.arange(len(found)), size), np.concatenate([np.asarray(f, np.int64) for f in found]) if sum(size) else np.zeros(0, np.int64)] = 1
    x[:, terms] = hits > 0
    x[:, terms + 1] = np.log1p(hits)
    x[:, terms + 2] = np.minimum(1, 100 * hits / np.maximum(words, 1))
    x[:, terms + 3] = upper
    x[:, terms + 4] = symbols
    return x


def fit_linear(x: np.ndarray, y: np.ndarray, l2: float = 0.05, steps: int = 25) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic regression on soft labels, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x), np.float32)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-4
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", fit_rows: int = FIT_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, the ``carry`` columns, score (probability of label 1) for every document.

    ``learn`` is a condition on the id: labels of other rows are never read.
    Carried columns only go along with their row.
    """
    spark = docs.sparkSession
    along = [f"_carry{i}" for i in range(len(carry))]
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(a) for c, a in zip(carry, along))).withColumn("_learn", F.coalesce(learn, F.lit(False)) & F.col(id_col).isNotNull())
    given = (labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label")).where(learn & F.col(id_col).isNotNull() & F.col("label").isin(0, 1))
             .groupBy(id_col).agg(F.max("label").alias("label")))
    given = written(given, "given-labels")
    n = given.count()
    share = int(min(1.0, fit_rows / max(n, 1)) * 1_000_000)
    sampled = F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share
    fit = own.where(F.col("_learn") & sampled).join(given.where(sampled), id_col).select("text", "label")
    terms = [f" {_term(w)} " for w in SEED_LEXICON]
    n_seed = len(terms)
    mined = sorted((t for t in mine_terms(written(fit, "fit")) if t not in terms), key=term_voter) if n else []
    terms += mined
    narrow = written(text_hits(own, id_col, "text", terms, ["_learn", *along]).withColumn("pattern", votes(n_seed, mined)), "hits")
    # Labels are of rows that may be learned from only; all others count as unlabelled.
    labelled = narrow.join(given, id_col, "left").withColumn("label", F.coalesce("label", F.lit(-1)))
    table = labelled.groupBy("pattern", "label").count().collect()  # at most 3 * 2^voters rows
    weights = np.zeros(len(terms) + 6)
    if table:
        pattern, label, count = (np.array([r[i] for r in table]) for i in range(3))
        model = LabelModel(VOTERS).fit(pattern, label, count.astype(float))
        total = int(count.sum())
        share = int(min(1.0, fit_rows / total) * 1_000_000)
        rows = (labelled.where(F.col(id_col).isNotNull() & ((F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share) | ((F.col("label") >= 0) & sampled)))
                .orderBy(F.xxhash64(id_col)).limit(2 * fit_rows).select("found", "hits", "words", "upper", "symbols", "pattern", "label").toPandas())
        x = design(rows["found"].tolist(), *(rows[c].to_numpy() for c in ("hits", "words", "upper", "symbols")), len(terms))
        weights = fit_linear(x, model.posterior(rows["pattern"].to_numpy(), rows["label"].to_numpy()))

    def score(batches):
        for batch in batches:
            found, rest = batch.column(1).to_pylist(), [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            held = [batch.column(6 + i) for i in range(len(carry))]
            out = []
            for lo in range(0, len(found), 4096):
                x = design(found[lo:lo + 4096], *(c[lo:lo + 4096] for c in rest), len(terms))
                out.append(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *held, pa.array(np.concatenate(out) if out else [], pa.float64())], [id_col, *carry, "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *carry))
    return narrow.select(id_col, "found", "hits", "words", "upper", "symbols", *along).mapInArrow(score, f"{kinds}, score double")
