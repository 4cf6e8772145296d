"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words (runs of ASCII letters, digits and bytes above 0x7F, A-Z folded). Every term of the fitting rows
is indexed, however rare. Its weight in a text is (1 + ln tf) * idf * relevance; relevance is the fourth power of the
term's log odds between toxic and other rows, shrunk towards the overall odds by ``SHRINK`` rows, so a term that
says nothing of the label counts little and none is left out. Terms that no fitting row has take no part.

Examples stand in an inverted index: a term's postings are cut where a new block of ``BLOCK`` examples begins, and
each cut holds the largest weight within. A query reads the postings of its strongest terms until no example without
any of them can be among the k nearest; the examples found whose sum so far, with the largest weights that their
block has of the terms not read, cannot reach the k-th are skipped; the others are scored whole. So the result is
exactly the k nearest. Votes are weighted by similarity. A logistic curve turns votes into scores; it is fitted
on the votes that each of ``FOLDS`` parts of the fitting rows gets from an index of the others. Texts without a known
term get the toxic share of the fitting rows.

Fitting rows: at most ``FIT_ROWS`` labelled rows, the smallest by hashed id among those not held out
(crc32(doc_id as text) mod 4 is not 2). Labels, language, source and doc_id are no inputs of a score. All
documents are scored over their whole texts. The index is broadcast; FIT_ROWS bounds its examples, and their texts its postings.

Nulls and edge cases: a null or empty text has no terms; a null label is no label; several labels of one
doc_id count as the largest; a null doc_id is not held out; repeated rows each get their score; other
columns are ignored; without fitting rows every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from ternion.llm import textbytes as tb
from ternion.llm.tables import hand_back, handing_back, small_batches
from ternion.plans.lineage import cut

FIT_ROWS, SHRINK, POWER, NEIGHBOURS, BLOCK, FOLDS, THRESHOLD = 6_000, 10.0, 4, 15, 64, 4, 0.3
_SLACK, _STRANDS = 1e-9, 512

APART = np.ones(256, bool)
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def term_counts(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct term hashes of each text in ascending order, their rows and counts."""
    data, off = tb.flat(column)
    data = tb.FOLD[data]
    starts, ends, row = tb.words(data, off, APART)
    return tb.bag(tb.span_hashes(data, starts, ends), row)


@dataclass
class Index:
    """Labelled examples: postings by term and example, cut by block, with the largest weight of each cut."""

    terms: np.ndarray  # ascending hashes
    number: np.ndarray  # each one's number: the commonest terms come first, so that what is read often lies together
    factor: np.ndarray  # idf * relevance of each term
    ids: np.ndarray  # doc_id of each example
    toxic: np.ndarray
    rows: np.ndarray  # example of each posting
    vals: np.ndarray
    cuts: np.ndarray  # first posting of each cut, and the end
    block: np.ndarray  # block of each cut
    high: np.ndarray  # largest weight of each cut
    edge: np.ndarray  # first cut of each term, and the end
    most: np.ndarray  # largest weight of each term
    cols: np.ndarray  # the postings again, by example
    own: np.ndarray
    start: np.ndarray  # first of these of each example, and the end
    base: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    @cached_property
    def query(self) -> np.ndarray:
        """Room for one text's weights by term, zero between uses."""
        return np.zeros(len(self.terms), np.float32)

    def known(self, hashes: np.ndarray, owner: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The terms that the index has, as numbers, with their rows and raw weights."""
        if not len(hashes) or not len(self.terms):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        hit = self.terms[at] == hashes
        at = self.number[at[hit]]
        return at, owner[hit], (1.0 + np.log(n[hit])) * self.factor[at]

    def nearest(self, cols: np.ndarray, v: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` most similar examples (ties to the smaller number) and their similarities, all above 0."""
        none = np.zeros(0, np.int64), np.zeros(0)
        size = np.sqrt((v * v).sum())
        if not len(cols) or size <= 0:
            return none
        v = v / size
        order = np.argsort(-v * self.most[cols], kind="stable")
        cols, v = cols[order], v[order]
        after = np.r_[np.cumsum((v * self.most[cols])[::-1])[::-1][1:], 0.0]  # what the terms behind each can add
        partial, seen, step, least = np.zeros(len(self.ids)), 0, 8, 0.0
        while seen < len(cols):  # the strongest terms, until no example without any of them can be among the k
            part = slice(seen, min(len(cols), seen + step))
            first, last = self.cuts[self.edge[cols[part]]], self.cuts[self.edge[cols[part] + 1]]
            partial += np.bincount(_spans(self.rows, first, last), weights=np.repeat(v[part], last - first) * _spans(self.vals, first, last), minlength=len(partial))
            seen, step = part.stop, step + 8
            least = _least(partial, k)
            if least > after[seen - 1] + _SLACK:
                break
        found = np.flatnonzero((partial > 0) & (partial + after[seen - 1] >= least - _SLACK))
        if len(found) > 4 * k and seen < len(cols):
            first, last = self.edge[cols[seen:]], self.edge[cols[seen:] + 1]
            more = np.bincount(_spans(self.block, first, last), weights=np.repeat(v[seen:], last - first) * _spans(self.high, first, last), minlength=-(-len(self.ids) // BLOCK))
            found = found[partial[found] + more[found // BLOCK] >= least - _SLACK]
        query = self.query
        query[cols] = v
        first, last = self.start[found], self.start[found + 1]
        products = query[_spans(self.cols, first, last)] * _spans(self.own, first, last)
        sims = np.add.reduceat(products, np.cumsum(last - first) - (last - first)) if len(found) else np.zeros(0)
        query[cols] = 0.0
        best = np.lexsort((found, -np.round(sims, 9)))[:k]
        best = best[sims[best] > 0]
        return found[best], sims[best]

    def vote(self, ids: np.ndarray, sims: np.ndarray) -> float:
        """The toxic share of the neighbours by similarity, with a quarter of a neighbour's worth of the overall share mixed in."""
        return float(((sims * self.toxic[ids]).sum() + 0.25 * self.base) / (sims.sum() + 0.25))

    def score(self, vote: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.slope * _logit(vote) + self.shift)))


def _least(x: np.ndarray, k: int) -> float:
    """At most the ``k``-th largest of numbers from 0 up: the ``k``-th largest among the maxima of `_STRANDS` interleaved parts."""
    wide = len(x) // _STRANDS * _STRANDS
    if wide < _STRANDS:
        return float(np.partition(x, -k)[-k]) if len(x) >= k else 0.0
    return float(np.partition(x[:wide].reshape(-1, _STRANDS).max(0), -k)[-k])


def _spans(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The parts ``x[first[i]:last[i]]``, end to end."""
    return np.concatenate([x[:0], *(x[a:z] for a, z in zip(first.tolist(), last.tolist(), strict=True))])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[float, float]:
    """Slope and shift of the logistic curve through 0/1 marks, by Newton's steps under a weak pull to (1, 0)."""
    at = np.array([1.0, 0.0])
    design = np.c_[x, np.ones(len(x))]
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ at, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.eye(2) * 0.1, design.T @ (y - p) - 0.1 * (at - [1.0, 0.0]))
        at = at + step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def build(ids: np.ndarray, toxic: np.ndarray, hashes: np.ndarray, owner: np.ndarray, n: np.ndarray) -> Index:
    """The index of examples given as (doc_id, mark) and their (hash, example, count) rows, without calibration."""
    terms, cols = np.unique(hashes, return_inverse=True)
    rows, p = len(ids), float(toxic.sum())
    df = np.bincount(cols, minlength=len(terms))
    number = np.empty(len(terms), np.int32)
    number[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    cols = number[cols].astype(np.int64)
    df = np.bincount(cols, minlength=len(terms)).astype(float)
    pos = np.bincount(cols, weights=toxic[owner], minlength=len(terms))
    share = (p + 0.5) / (rows + 1.0)
    odds = np.log(pos + SHRINK * share) - np.log(df - pos + SHRINK * (1 - share)) - np.log(share / (1 - share))
    factor = (np.log((rows + 1) / (df + 1)) + 1.0) * np.abs(odds) ** POWER
    v = (1.0 + np.log(n)) * factor[cols]
    size = np.sqrt(np.bincount(owner, weights=v * v, minlength=rows))
    v = v / np.where(size > 0, size, 1.0)[owner]
    # Examples with one leading term stand together, so the blocks' bounds are tight.
    heavy = np.lexsort((-v, owner))
    first = heavy[np.r_[True, owner[heavy][1:] != owner[heavy][:-1]]] if len(heavy) else heavy
    lead = np.full(rows, -1)
    lead[owner[first]] = cols[first]
    order = np.lexsort((ids, lead))
    place = np.empty(rows, np.int64)
    place[order] = np.arange(rows)
    at = np.lexsort((place[owner], cols))
    cols, row, v = cols[at], place[owner[at]], v[at].astype(np.float32)
    part = cols * (rows // BLOCK + 1) + row // BLOCK
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    high = np.maximum.reduceat(v, cuts) if len(cuts) else v
    edge = np.searchsorted(cols[cuts], np.arange(len(terms) + 1))
    again = np.argsort(row, kind="stable")
    return Index(
        terms, number, factor, ids[order], toxic[order], row.astype(np.int32), v, np.r_[cuts, len(part)].astype(np.int32), (row[cuts] // BLOCK).astype(np.int32), high, edge.astype(np.int32),
        np.maximum.reduceat(high, edge[:-1]) if len(terms) else high, cols[again].astype(np.int32), v[again], np.searchsorted(row[again], np.arange(rows + 1)).astype(np.int32), p / rows if rows else 0.0,
    )


def _votes(index: Index, hashes: np.ndarray, owner: np.ndarray, n: np.ndarray, rows: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The vote on each of ``rows`` texts, not a number where the index knows no term, and its nearest examples."""
    cols, owner, v = index.known(hashes, owner, n)
    edge = np.searchsorted(owner, np.arange(rows + 1))
    out, seen = np.full(rows, np.nan), [np.zeros(0, np.int64)] * rows
    for k in range(rows):
        ids, sims = index.nearest(cols[edge[k] : edge[k + 1]], v[edge[k] : edge[k + 1]])
        if len(ids):
            out[k], seen[k] = index.vote(ids, sims), ids
    return out, seen


def learn(ids: np.ndarray, toxic: np.ndarray, hashes: np.ndarray, owner: np.ndarray, n: np.ndarray) -> Index:
    """The calibrated index of examples; ``owner`` ascends."""
    index = build(ids, toxic, hashes, owner, n)
    votes = np.full(len(ids), np.nan)
    fold = (tb.mix(ids.astype(np.int64).view(tb.U)) % tb.U(FOLDS)).astype(np.int64)
    for f in range(FOLDS):
        own = fold == f
        if own.any() and not own.all():
            place = np.cumsum(~own) - 1
            rest, mine = ~own[owner], own[owner]
            part = build(ids[~own], toxic[~own], hashes[rest], place[owner[rest]], n[rest])
            votes[own] = _votes(part, hashes[mine], (np.cumsum(own) - 1)[owner[mine]], n[mine], int(own.sum()))[0]
            del part  # before the next one is built
    good = ~np.isnan(votes)
    if good.any():
        index.slope, index.shift = _logistic(_logit(votes[good]), toxic[good])
    return index


@handing_back
def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.pieces(batch):
            h, row, n = term_counts(part.column("text"))
            edge = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edge, pa.array(x)) for x in (h.view(np.int64), n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), *lists], ["doc_id", "toxic", "terms", "n"])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Index:
    """Learn the index from at most ``fit_rows`` labelled documents."""
    small_batches(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = cut(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "tox-chosen")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))  # fit_rows rows at most are broadcast
    parts = _fetched(sample)
    hand_back()  # what the fetched tables held
    index = learn(*parts)
    del parts
    hand_back()
    return index


def _fetched(sample: DataFrame) -> tuple[np.ndarray, ...]:
    """What ``learn`` takes, of the fitting rows only; no Arrow table outlives the call."""
    table = sample.mapInArrow(_terms, "doc_id long, toxic int, terms array<long>, n array<int>").toArrow()
    table = table.sort_by("doc_id").combine_chunks()
    ids, toxic = np.array(table.column("doc_id"), np.int64), (np.asarray(table.column("toxic"), np.int64) > 0).astype(float)
    terms, counts = (table.column(c).combine_chunks() for c in ("terms", "n"))
    size = np.diff(np.asarray(terms.offsets)) if len(ids) else np.zeros(0, np.int64)
    flat = lambda x, kind: np.array(x.flatten(), kind) if len(ids) else np.zeros(0, kind)
    return ids, toxic, flat(terms, np.int64).view(tb.U), np.repeat(np.arange(len(ids)), size), flat(counts, np.int64)


def score(docs: DataFrame, index: Index, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence, *carry)``; evidence: doc_ids of the nearest examples.

    ``carry`` names columns to keep; one whose name is an own column's makes that name stand twice.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(index)
    hand_back()  # its pickled copy

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            for part in tb.pieces(batch, "_text"):
                votes, near = _votes(ix, *term_counts(part.column("_text")), part.num_rows)
                scores = np.where(np.isnan(votes), ix.base, ix.score(np.nan_to_num(votes)))
                seen = [ix.ids[x[:3]].tolist() for x in near]
                keep = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(scores), pa.array(seen, pa.list_(pa.int64()))], [*names, "_score", "_evidence"])

    kept = [f"_k{i}" for i in range(len(carry))]
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), held_out().alias("_held"), *[F.col(f"`{c}`").alias(k) for c, k in zip(carry, kept, strict=True)], F.col("text").cast("string").alias("_text"))
    names = [c for c in rows.columns if c != "_text"]
    kinds = StructType([f for f in rows.schema if f.name != "_text"]).add("_score", "double").add("_evidence", ArrayType(LongType()))
    out = rows.mapInArrow(run, kinds)
    return out.select(F.col("_id").alias("doc_id"), F.col("_held").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"), F.col("_evidence").alias("evidence"), *[F.col(k).alias(c) for c, k in zip(carry, kept, strict=True)])
