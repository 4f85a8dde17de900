"""Toxicity by weak supervision.

1. Lexicon: every word that toxic labelled texts hold far more often than clean ones; all of them are features of the
   classifier, and for the label model they are dealt into LEXICON_VOTERS voters. Pattern voters look at shouting, exclamation, insults per word and the like. Every voter fires or not, so a text's votes are
   one of 2^VOTERS masks; masks are counted over all texts by grouped aggregation.
2. Label model: a latent class (toxic or not) generates the votes along a tree of the strongest conditional correlations
   between voters. EM over the mask counts, with the labelled training rows' masks clamped, estimates the class balance,
   each voter's accuracy and the tree's pairwise tables; it gives every mask a posterior.
3. Classifier: a logistic regression on words, densities and patterns is fitted to the posteriors of a bounded sample and
   scores every text, so that it also weighs what no voter looks at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.llm.common import arrow_batch, cut, is_held_out, lean, runs, utf8
from annolith.llm.jaccard_join import BASE, LOWER, _mix, _power

#: Labelled texts that voters and classifier are fitted on, at most; drawn by a hash over all labelled rows.
FIT_ROWS = 10_000
LEXICON_VOTERS, PATTERN_VOTERS = 10, 6
#: Toxic labelled texts that hold a word of the lexicon, at least.
SUPPORT = 3
VOTERS = LEXICON_VOTERS + PATTERN_VOTERS
#: Features besides words: the constant, three densities, the patterns.
DENSE = 4 + PATTERN_VOTERS
WORD = np.array([48 <= i <= 57 or 65 <= i <= 90 or 97 <= i <= 122 or i >= 128 for i in range(256)])
UPPER = np.array([65 <= i <= 90 for i in range(256)])
CHUNK = 1 << 19


def text_words(data: np.ndarray, offsets: np.ndarray):
    """For ranges of rows: (first, one past the last, word hashes, offsets of each row's words, pattern counts of each row)."""
    for a, b in runs(offsets, CHUNK):
        raw, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        n = len(raw)
        if not n:
            yield a, b, np.zeros(0, np.uint64), np.zeros(b - a + 1, np.int64), np.zeros((b - a, 4), np.int64)
            continue
        ink = WORD[raw]
        first, last = ink.copy(), ink.copy()
        first[1:] &= ~ink[:-1]
        last[:-1] &= ~ink[1:]
        edge = own[:-1][own[:-1] < n]
        first[edge] = ink[edge]
        edge = own[1:][own[1:] > 0] - 1
        last[edge] = ink[edge]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _power(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = _mix((total[ends] - total[starts]) * down[starts])
        marks = np.zeros((n + 1, 4), np.int32)
        for i, x in enumerate((raw == 33, UPPER[raw], ink, (raw >= 48) & (raw <= 57))):
            np.cumsum(x, out=marks[1:, i])
        yield a, b, h, np.searchsorted(starts, own), (marks[own[1:]] - marks[own[:-1]]).astype(np.int64)


def word_hash(word: str) -> int:
    return int(next(text_words(*utf8(pa.array([word]))))[2][0])


def _training(batches):
    out = pa.schema([("toxic", pa.int32()), ("words", pa.binary())])
    for batch in batches:
        toxic = batch.column(0).to_pylist()
        rows: list[bytes] = []
        for a, b, h, at, _ in text_words(*utf8(batch.column(1))):
            rows += [np.unique(h[at[i] : at[i + 1]]).tobytes() for i in range(b - a)]
        yield arrow_batch(out, toxic=toxic, words=rows)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """(toxic, text) of labelled rows outside the held-out fold, fit_rows at most; equal texts of one label count once."""
    own = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col))).groupBy(F.col(id_col).alias("fit_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    share = fit_rows / max(own.count(), fit_rows)
    if share < 1:
        own = own.where(F.pmod(F.xxhash64("fit_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select(F.col(id_col).alias("fit_id"), F.col(text_col).alias("text")).join(F.broadcast(own), "fit_id")
    return cut(rows.where("text is not null").select("toxic", "text").distinct(), "sample")


class Voters:
    """The lexicon (word hashes and the voter of each) with all patterns; lexicon words may be none."""

    def __init__(self, words: np.ndarray, voter: np.ndarray):
        order = np.argsort(words)
        self.words, self.voter = words[order], voter[order]

    def features(self, h: np.ndarray, at: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vote masks, the classifier's dense features of each row, and (row, lexicon word) of each word that a row holds."""
        rows = len(at) - 1
        n = np.diff(at)
        row = word = np.zeros(0, np.int64)
        if len(self.words) and len(h):
            i = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            where = np.flatnonzero(self.words[i] == h)
            row, word = np.searchsorted(at, where, "right") - 1, i[where]
        all_ = np.bincount(row, minlength=rows).astype(np.float64)
        bang, upper, ink, digit = (marks[:, i] for i in range(4))
        patterns = [bang >= 3, upper * 2 > ink, all_ >= 2, all_ * 200 >= np.maximum(n, 1), n < 8, digit * 5 > ink]
        votes = np.zeros((rows, VOTERS), bool)
        votes[row, self.voter[word]] = True
        votes[:, LEXICON_VOTERS:] = np.stack(patterns, axis=1)
        mask = (votes << np.arange(VOTERS)).sum(axis=1)
        dense = np.stack([np.ones(rows), np.log1p(all_), np.log1p(100 * all_ / np.maximum(n, 1)), np.log1p(n) / 10], axis=1)
        own = np.unique(row * max(len(self.words), 1) + word)
        return mask, np.concatenate([dense, votes[:, LEXICON_VOTERS:]], axis=1).astype(np.float64), own // max(len(self.words), 1), own % max(len(self.words), 1)


def find_voters(sample: list[tuple[int, np.ndarray]]) -> Voters:
    """Words whose presence makes a text toxic more likely than not, by a lower bound, in order of log odds."""
    y = np.array([t for t, _ in sample], np.int64)
    if not len(y) or not y.sum() or y.all():
        return Voters(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    words = np.concatenate([w for _, w in sample])
    of = np.repeat(y, [len(w) for _, w in sample])
    vocabulary, index = np.unique(words, return_inverse=True)
    bad, all_ = np.bincount(index, of), np.bincount(index)
    clean = all_ - bad
    odds = np.log((bad + 0.5) / (y.sum() - bad + 0.5)) - np.log((clean + 0.5) / (len(y) - y.sum() - clean + 0.5))
    good = np.flatnonzero((bad >= SUPPORT) & ((bad - np.sqrt(bad)) / np.maximum(all_, 1) >= 0.5))
    best = good[np.lexsort((vocabulary[good], -bad[good] * np.maximum(odds[good], 0)))]
    return Voters(vocabulary[best], np.arange(len(best)) % LEXICON_VOTERS)


class LabelModel:
    """Posterior of the toxic class for vote masks; see the module's text."""

    def __init__(self, masks: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 25):
        """known: (masks, 2) counts of labelled rows by class, clamped; counts: all rows."""
        self.votes = (masks[:, None] >> np.arange(VOTERS)) & 1
        free = np.maximum(counts - known.sum(axis=1), 0).astype(np.float64)
        base = (known.sum(axis=0) + 1) / (known.sum() + 2)
        lexicon = self.votes[:, :LEXICON_VOTERS].any(axis=1)
        self.parent = np.full(VOTERS, -1)
        self.balance = base
        post = np.where(lexicon, 0.9, base[1] * 0.3)
        for r in range(rounds):
            weight = np.stack([free * (1 - post) + known[:, 0], free * post + known[:, 1]], axis=1)
            if r == rounds // 2:
                self.parent = self._tree(weight)
            self._fit(weight)
            post = self.posterior(masks)
        self.accuracy = self._accuracy(np.stack([free * (1 - post) + known[:, 0], free * post + known[:, 1]], axis=1))

    def _tree(self, weight: np.ndarray) -> np.ndarray:
        """Spanning tree of the largest conditional mutual information, rooted at voter 0."""
        info = np.zeros((VOTERS, VOTERS))
        total = weight.sum()
        for y in range(2):
            w, v = weight[:, y], self.votes.astype(np.float64)
            n = w.sum() + 1
            both = (v * w[:, None]).T @ v / n
            p = np.diag(both)
            for a, b, joint in ((1, 1, both), (1, 0, p[:, None] - both), (0, 1, p[None, :] - both), (0, 0, 1 - p[:, None] - p[None, :] + both)):
                x = np.where(a, p, 1 - p)[:, None] * np.where(b, p, 1 - p)[None, :]
                joint = np.maximum(joint, 1e-12)
                info += n / total * joint * np.log(joint / np.maximum(x, 1e-12))
        parent, inside = np.full(VOTERS, -1), [0]
        while len(inside) < VOTERS:
            out = [j for j in range(VOTERS) if j not in inside]
            i, j = max(((i, j) for i in inside for j in out), key=lambda e: (info[e], -e[0], -e[1]))
            parent[j] = i
            inside.append(j)
        return parent

    def _fit(self, weight: np.ndarray) -> None:
        self.balance = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        self.table = np.zeros((VOTERS, 2, 2))  # P(fires | class, parent fires)
        for j in range(VOTERS):
            up = self.votes[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(self.votes), np.int64)
            for y in range(2):
                for u in range(2):
                    w = weight[:, y] * (up == u)
                    self.table[j, y, u] = ((w * self.votes[:, j]).sum() + 0.1) / (w.sum() + 0.2)

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        votes = (masks[:, None] >> np.arange(VOTERS)) & 1
        log = np.tile(np.log(self.balance), (len(masks), 1))
        for j in range(VOTERS):
            up = votes[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(masks), np.int64)
            for y in range(2):
                p = self.table[j, y, up]
                log[:, y] += np.log(np.where(votes[:, j] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))

    def _accuracy(self, weight: np.ndarray) -> np.ndarray:
        """For each voter, the share of rows on which its vote is the class."""
        fires = self.votes == 1
        return np.array([(weight[fires[:, j], 1].sum() + weight[~fires[:, j], 0].sum()) / max(weight.sum(), 1) for j in range(VOTERS)])


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression on soft targets by Newton steps; the first column is the constant."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep), x.T @ (p - target) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _masks(voters):
    out = pa.schema([("mask", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(1 << VOTERS, np.int64)
        for batch in batches:
            for _, _, h, at, marks in text_words(*utf8(batch.column(0))):
                total += np.bincount(voters.value.features(h, at, marks)[0], minlength=1 << VOTERS)
        at = np.flatnonzero(total)
        yield arrow_batch(out, mask=at, n=total[at])

    return run


def _scores(voters, weights):
    out = pa.schema([("key", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for a, b, h, at, marks in text_words(*utf8(batch.column(1))):
                _, dense, row, word = voters.value.features(h, at, marks)
                total = dense @ weights.value[: dense.shape[1]] + np.bincount(row, weights.value[dense.shape[1] + word], b - a)
                score[a:b] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(score)], schema=out)

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> tuple[Voters, LabelModel | None, np.ndarray]:
    """Voters, label model and classifier weights. Labels are used of rows outside the held-out fold only.

    Without labels of both classes no lexicon is found and every score is the base rate, a half at most."""
    texts = training_sample(docs, labels, id_col, text_col, label_col, fit_rows)
    got = texts.mapInArrow(lean(_training), "toxic int, words binary").toArrow()
    sample = sorted(((t, np.frombuffer(w, np.uint64)) for t, w in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True)), key=lambda x: (x[0], len(x[1]), x[1][:4].tobytes()))
    voters = find_voters(sample)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(voters)
    known = texts.mapInArrow(lean(_known(sent)), "toxic int, mask int, dense array<double>, words array<int>").toArrow()
    toxic, mask = np.array(known.column(0).to_pylist(), np.int64), np.array(known.column(1).to_pylist(), np.int64)
    if not len(toxic):
        return voters, None, np.concatenate(([-2.0], np.zeros(DENSE - 1 + len(voters.words))))
    dense = known.column(2).combine_chunks().flatten().to_numpy().reshape(len(toxic), DENSE)
    x = np.concatenate([dense, np.zeros((len(toxic), len(voters.words)))], axis=1)
    words = known.column(3).combine_chunks()
    x[np.repeat(np.arange(len(toxic)), words.value_lengths().to_numpy()), DENSE + words.flatten().to_numpy()] = 1
    counted = docs.select(text_col).mapInArrow(lean(_masks(sent)), "mask int, n long").groupBy("mask").agg(F.sum("n").alias("n")).toPandas()
    masks = np.union1d(counted["mask"].to_numpy(np.int64), mask)
    counts = np.zeros(len(masks), np.int64)
    counts[np.searchsorted(masks, counted["mask"].to_numpy(np.int64))] = counted["n"].to_numpy()
    clamped = np.zeros((len(masks), 2))
    np.add.at(clamped, (np.searchsorted(masks, mask), toxic), 1)
    model = LabelModel(masks, counts, clamped)
    return voters, model, logistic(x, model.posterior(mask))


def _known(voters):
    out = pa.schema([("toxic", pa.int32()), ("mask", pa.int32()), ("dense", pa.list_(pa.float64())), ("words", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            toxic = batch.column(0).to_pylist()
            for a, b, h, at, marks in text_words(*utf8(batch.column(1))):
                mask, dense, row, word = voters.value.features(h, at, marks)
                yield arrow_batch(out, toxic=toxic[a:b], mask=mask, dense=list(dense), words=np.split(word, np.searchsorted(row, np.arange(1, b - a))))

    return run


def score(docs: DataFrame, labels: DataFrame, key, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(key, score) for every row of docs; key: a long column. A null or empty text gets the score of no words at all."""
    voters, _, weights = fit(docs, labels, id_col, text_col, label_col)
    context = docs.sparkSession.sparkContext
    return docs.select(key.alias("key"), F.col(text_col)).mapInArrow(lean(_scores(context.broadcast(voters), context.broadcast(weights))), "key long, score double")


def document_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A null or empty text has the score of no words; rows without id are scored and in the held-out fold or not as the empty id;
    repeated rows are scored each; other columns are ignored. Without documents there are no rows, without labels no lexicon."""
    rows = score(docs, labels, F.col("doc_id").cast("long")).withColumnRenamed("key", "doc_id")
    return rows.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
