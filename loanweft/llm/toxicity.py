"""Toxicity by weak supervision: lexicon and pattern voters, a label model, a linear classifier.

1. A bounded sample of labelled rows (``sample`` of them, those with the
   smallest hashes) tells which words and which word beginnings occur mostly in
   toxic texts. Each becomes a voter: it votes toxic where it occurs. Words are
   runs of letters (any byte from 0x80 on counts as one), A-Z lower-cased.
2. The label model sees the votes, the annotator's being one of them.
   Expectation-maximization estimates how often each voter fires on toxic and on clean texts. Votes that
   still go together once the label is known are correlated (a word and its
   beginnings, for instance): such voters form a cluster, whose evidence is
   divided by its effective size, and the estimation is repeated.
3. A logistic regression is fitted to the posterior labels, on the votes and on
   the number of hits.

Every text is then scored whole in one pass without a shuffle. Neither labels
nor language, source or id are inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import LOWER, mixed, over_batches, pick, polynomial, raw, slices, word_spans

SAMPLE = 20_000  # labelled rows that the voters and the classifier are fitted on
VOTERS = 400
BEGINNINGS = (4, 5, 6)  # lengths in bytes of the word beginnings that may become voters
LEAST_PRECISION = 0.4  # that a voter has for sure (lower bound at Z deviations)
Z = 2.5
ANNOTATOR_ERROR = 0.02
BETWEEN = np.ones(256, bool)
BETWEEN[97:123] = False
BETWEEN[128:] = False
WORD = re.compile(rb"[a-z\x80-\xff]+")
TOGETHER = 2


@dataclass(frozen=True)
class Model:
    """``voters``: (kind, token), kind 0 for whole words, else the length of a beginning; ``weights``: per voter, hits, constant."""

    voters: list[tuple[int, bytes]]
    weights: np.ndarray
    accuracy: np.ndarray  # of each voter: how often it fires on toxic and on clean texts
    correlated: np.ndarray  # cluster of each voter

    def tables(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Per kind: sorted hashes and the voters they stand for."""
        made = []
        for kind in sorted({k for k, _ in self.voters}):
            own = [i for i, (k, _) in enumerate(self.voters) if k == kind]
            hashes = np.concatenate([token_hash(self.voters[i][1]) for i in own])
            order = np.argsort(hashes)
            made.append((kind, hashes[order], np.array(own)[order]))
        return made

    def score(self, data: np.ndarray, offsets: np.ndarray, tables) -> np.ndarray:
        text, voter, hits = votes(data, offsets, tables)
        logit = np.full(len(offsets) - 1, self.weights[-1])
        np.add.at(logit, text, self.weights[voter])
        return 1 / (1 + np.exp(-(logit + self.weights[-2] * np.log1p(hits))))


def token_hash(token: bytes) -> np.ndarray:
    return mixed(polynomial(np.frombuffer(token, np.uint8))(np.array([0]), np.array([len(token)])))


def votes(data: np.ndarray, offsets: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, voter) of every vote, each once, and the number of words that fire per text."""
    n, pairs, hit = len(offsets) - 1, [np.zeros(0, np.int64)], []
    voters = 1 + max((int(v.max()) for _, _, v in tables), default=0)
    if len(data) and tables:
        low = LOWER[data]
        starts, ends = word_spans(low, offsets, BETWEEN)
        text, of = np.searchsorted(offsets, starts, "right") - 1, polynomial(low)
        for kind, hashes, own in tables:
            long = np.flatnonzero(ends - starts > kind) if kind else np.arange(len(starts))
            key = mixed(of(starts[long], starts[long] + kind if kind else ends[long]))
            at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
            found = hashes[at] == key
            pairs.append(text[long[found]] * voters + own[at[found]])
            hit.append(long[found])
    hits = np.bincount(text[np.unique(np.concatenate(hit))], minlength=n) if hit else np.zeros(n)
    once = np.unique(np.concatenate(pairs))
    return once // voters, once % voters, hits


def labelled(docs: DataFrame, labels: DataFrame, sample: int, seed_column: str = "doc_id") -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled training rows: crc32 of the id as text not divisible by 5, label 0 or 1."""
    known = pick(labels, doc_id="bigint", toxic="int").filter(
        F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64(seed_column), seed_column).limit(sample)
    # the sample bounds the broadcast: ids and labels only
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def mine(rows: DataFrame, most: int) -> list[tuple[int, bytes]]:
    """Words and word beginnings that are surely frequent in toxic and rare in other rows, the surest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for piece in slices(batch, ["text"], TOGETHER << 20):
                for text, toxic in zip(piece.column(0).cast(pa.binary()).to_pylist(), piece.column(1).to_pylist()):
                    words = set(WORD.findall((text or b"").lower()))
                    tokens = {(0, w) for w in words} | {(k, w[:k]) for k in BEGINNINGS for w in words if len(w) > k}
                    seen[toxic].update(tokens)
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield batch_of(seen)
                    seen = [Counter(), Counter()]
        yield batch_of(seen)

    def batch_of(seen: list[Counter]) -> pa.RecordBatch:
        tokens = list({*seen[0], *seen[1]})
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in tokens], pa.int32()), pa.array([w for _, w in tokens], pa.binary()),
             pa.array([seen[1][t] for t in tokens], pa.int64()), pa.array([seen[0][t] for t in tokens], pa.int64())],
            names=["kind", "token", "toxic", "clean"])

    counted = rows.mapInArrow(count, "kind int, token binary, toxic bigint, clean bigint").groupBy("kind", "token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = F.col("toxic") + F.col("clean")
    p = F.col("toxic") / n
    bound = (p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
    best = counted.filter(F.col("toxic") >= 3).withColumn("bound", bound).filter(F.col("bound") > LEAST_PRECISION)
    return [(r.kind, bytes(r.token)) for r in best.orderBy(F.desc("toxic"), F.desc("bound"), "kind", "token").limit(most).collect()]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def label_model(fired: np.ndarray, annotated: np.ndarray, prior: float, rounds: int = 3,
                steps: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each row, rates (voter, [clean, toxic]) and cluster of each voter.

    ``fired`` is the 0/1 matrix of votes, ``annotated`` the 0/1 votes of the
    annotator, who errs at a rate of ANNOTATOR_ERROR; ``prior`` is the share of
    toxic rows. A voter that doesn't fire abstains; only if none fires does
    their silence count.
    """
    n, voters = fired.shape
    silent = ~fired.any(axis=1)
    certain = np.log((1 - ANNOTATOR_ERROR) / ANNOTATOR_ERROR)
    start = np.log(prior / (1 - prior)) + np.where(annotated == 1, certain, -certain)
    posterior = sigmoid(start)
    share, cluster = np.ones(voters), np.arange(voters)
    votes_and_silence = np.c_[fired, silent]
    for _ in range(rounds):
        for _ in range(steps):
            toxic, clean = posterior.sum(), n - posterior.sum()
            rates = np.stack([((1 - posterior) @ votes_and_silence + 0.1) / (clean + 1), (posterior @ votes_and_silence + 0.1) / (toxic + 1)], axis=1)
            evidence = np.log(rates[:, 1] / rates[:, 0]) * np.r_[share, 1.0]
            posterior = sigmoid(start + votes_and_silence @ evidence)
        rest = fired - np.outer(1 - posterior, rates[:-1, 0]) - np.outer(posterior, rates[:-1, 1])
        scale = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
        correlation = (rest.T @ rest) / n / np.outer(scale, scale)
        cluster = np.arange(voters)
        for a, b in np.argwhere(np.triu(correlation, 1) > 0.4):
            cluster[cluster == cluster[b]] = cluster[a]
        for c in np.unique(cluster):
            own = np.flatnonzero(cluster == c)
            mean = (correlation[np.ix_(own, own)].sum() - len(own)) / max(1, len(own) * (len(own) - 1))
            share[own] = 1 / (1 + (len(own) - 1) * max(0.0, mean))
    return posterior, rates[:-1], cluster


def regression(features: np.ndarray, target: np.ndarray, penalty: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last weight is the constant and not penalized."""
    x = np.c_[features, np.ones(len(features))]
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ weights)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (target - p) - ridge * weights)
        weights += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = VOTERS) -> Model:
    """The model of (doc_id, text) and (doc_id, toxic). Without a toxic training row no voter is found and every score is 0."""
    docs = pick(docs, doc_id="bigint", text="string")
    rows = labelled(docs, labels, sample)
    voters = mine(rows, most)
    blank = Model(voters, np.zeros(len(voters) + 2), np.zeros((len(voters), 2)), np.arange(len(voters)))
    tables = blank.tables()

    def vote(piece: pa.RecordBatch) -> pa.RecordBatch:
        text, voter, hits = votes(*raw(piece.column(0)), tables)
        own = np.split(voter.astype(np.int32), np.searchsorted(text, np.arange(1, piece.num_rows)))
        return pa.RecordBatch.from_pydict({"voters": pa.array(own, pa.list_(pa.int32())), "hits": pa.array(hits, pa.int64()), "toxic": piece.column(1)})

    seen = over_batches(rows, vote, "voters array<int>, hits bigint, toxic int", TOGETHER).groupBy("voters", "hits").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()  # of the sample
    n = sum(r.n for r in seen)
    toxic = sum(r.toxic for r in seen)
    if not voters or not toxic:
        return Model([], np.array([0.0, -1e9]), np.zeros((0, 2)), np.zeros(0))
    seen.sort(key=lambda r: (r.voters, r.hits))
    fired, hits, annotated = np.zeros((n, len(voters)), np.float32), np.zeros(n), np.zeros(n, np.int64)
    at = 0
    for r in seen:
        fired[at:at + r.n, r.voters] = 1
        hits[at:at + r.n] = r.hits
        annotated[at:at + r.toxic] = 1
        at += r.n
    posterior, rates, cluster = label_model(fired, annotated, min(0.99, max(0.01, toxic / n)))
    return Model(voters, regression(np.c_[fired, np.log1p(hits)], posterior), rates, cluster)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row of (doc_id, text); predicted is 1 from a score of 0.5 on.

    A null text is empty. Null and repeated ids stay, one row each; other
    columns are left out.
    """
    tables = model.tables()

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = model.score(*raw(piece.column(1)), tables)
        return pa.RecordBatch.from_pydict({"doc_id": piece.column(0), "score": pa.array(found), "predicted": pa.array((found >= 0.5).astype(np.int32))})

    return over_batches(pick(docs, doc_id="bigint", text="string"), run, "doc_id bigint, score double, predicted int", TOGETHER)
