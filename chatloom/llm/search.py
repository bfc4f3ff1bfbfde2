"""Ranked lexical search for many items at once, by multi-query common-subexpression evaluation.

Term sets that items share are mined within blocks of items: terms that stand in the same items become one node,
then the two nodes that most items hold together become a node, again and again, until no two are shared. The nodes
form a DAG over the terms; every item is a sum of nodes. Documents are read once a pass and kept as counts of the
items' terms; over each slice of them a node's scores are added up once, whatever the number of items above it, and
nodes without a term in the slice cost nothing. Tasks keep each item's best documents so far and hand these on.

A pass takes items of PASS_TERMS different terms in all, and the longest item; its vocabulary and its DAG are all
that is broadcast. Further items are further passes over the documents.

Defined results: null and blank documents and items have no terms and appear in no result; each row is a document of
its own, so repeated rows are ranked beside each other, and rows of one item id are ranked each for itself; null
doc_ids come last among equal scores; empty tables give no rows; further columns are ignored. Terms are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table
from chatloom.llm.textops import chunks, plain_words, span_hashes
from chatloom.operators.ordering import running_total

#: Terms of the items of a block, in which shared sets are mined, and of a pass; one item may go beyond.
BLOCK_TERMS, PASS_TERMS = 4096, 1 << 19
#: Documents whose scores are added up together.
SLICE = 1024
#: Parts that an item's finds are dealt to before its best are taken.
SALTS = 32
#: Stands for a null doc_id while documents are compared.
_NONE = np.iinfo(np.int64).max

PLAN = "block long, items array<long>, terms array<long>, times array<long>, child_at array<int>, children array<int>, root_at array<int>, roots array<int>"


def _term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all terms, index of each row's first one)."""
    low, starts, ends, first = plain_words(data, offsets)
    return span_hashes(low, starts, ends), first


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, terms, times) of (item, text), for items with terms."""
    for batch in batches:
        for part, data, offsets in chunks(batch, "text", lower=False):
            hashes, first = _term_counts(data, offsets)
            own = [np.unique(hashes[a:b].view(np.int64), return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
            some = np.array([len(t) > 0 for t, _ in own], dtype=bool)
            terms = pa.array([t for t, _ in own if len(t)], pa.list_(pa.int64()))
            times = pa.array([k for _, k in own if len(k)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("item").filter(pa.array(some)), terms, times], ["item", "terms", "times"])


def _most_shared(held: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of nodes merged one after the other, always the two that most items of held (items by nodes) hold together,
    the k-th as node n + k of n; and what nodes each item holds in the end. Merged nodes are at most as many as nodes."""
    n = held.shape[1]
    own = np.zeros((held.shape[0], 2 * n), dtype=np.float32)
    own[:, :n] = held
    together = own.T @ own
    np.fill_diagonal(together, 0)
    # A node's best partner never shares more than it once did, so a stale figure is a bound.
    best, pairs = together.max(axis=1, initial=0), []
    for new in range(n, 2 * n):
        a = int(best.argmax())
        while together[a].max() < best[a]:
            best[a] = together[a].max()
            a = int(best.argmax())
        if best[a] < 2:
            break
        b = int(together[a].argmax())
        both = own[:, a] * own[:, b]
        own[:, a] -= both
        own[:, b] -= both
        own[:, new] = both
        for x in (a, b, new):
            shared = own.T @ own[:, x]
            shared[x] = 0
            together[x], together[:, x], best[x] = shared, shared, shared.max()
        pairs.append((a, b))
    return pairs, own[:, : n + len(pairs)] > 0


def share(items: list[np.ndarray], leaves: int) -> tuple[list[list[int]], list[list[int]]]:
    """(children, roots) of items given as sets of leaf numbers below leaves: node leaves + k is the sum of children[k],
    and an item the sum of its roots."""
    n_items = np.bincount(np.concatenate([*items, np.zeros(0, dtype=np.int64)]), minlength=leaves)
    shared = np.flatnonzero(n_items > 1)
    roots = [[int(x) for x in own if n_items[x] < 2] for own in items]
    if not len(shared):
        return [], roots
    held = np.zeros((len(items), len(shared)), dtype=bool)
    for i, own in enumerate(items):
        held[i, np.searchsorted(shared, own[n_items[own] > 1])] = True
    # Leaves of the same items are one node.
    kinds, kind = np.unique(np.packbits(held, axis=0), axis=1, return_inverse=True)
    children, nodes = [], []
    first = np.zeros(kinds.shape[1], dtype=np.int64)
    for k in range(kinds.shape[1]):
        own = np.flatnonzero(kind.ravel() == k)
        first[k] = own[0]
        if len(own) > 1:
            children.append([int(x) for x in shared[own]])
        nodes.append(leaves + len(children) - 1 if len(own) > 1 else int(shared[own[0]]))
    pairs, holds = _most_shared(held[:, first])
    for a, b in pairs:
        nodes.append(leaves + len(children))
        children.append([nodes[a], nodes[b]])
    for i, own in enumerate(holds):
        roots[i] += [nodes[x] for x in np.flatnonzero(own)]
    return children, roots


def _flat(lists: list[list[int]]) -> tuple[list[int], list[int]]:
    return [0, *np.cumsum([len(x) for x in lists]).tolist()], [x for own in lists for x in own]


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a block of items: its leaves (a term as often as an item has it), inner nodes and roots."""
    rows = rows.sort_values("item")
    every = np.array([np.concatenate(list(rows[c])) for c in ("terms", "times")]).T
    leaves, leaf = np.unique(every, axis=0, return_inverse=True)
    items = np.split(leaf.ravel(), np.cumsum([len(x) for x in rows["terms"]])[:-1])
    children, roots = share(items, len(leaves))
    out = [rows["block"].iloc[0], rows["item"].to_numpy(), leaves[:, 0], leaves[:, 1], *_flat(children), *_flat(roots)]
    return pd.DataFrame({name.split()[0]: [x] for name, x in zip(PLAN.split(", "), out, strict=True)})


def _documents(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, times) of documents with terms: how many in all, and those of the vocabulary by their place there."""
    for batch in batches:
        for part, data, offsets in chunks(batch, "text", lower=False):
            hashes, first = _term_counts(data, offsets)
            n = np.diff(first)
            at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
            known = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, dtype=np.int64)
            row = np.repeat(np.arange(len(n)), n)[known]
            pairs, times = np.unique(row * len(vocabulary) + at[known], return_counts=True)
            row, term = np.divmod(pairs, max(len(vocabulary), 1))
            some = np.flatnonzero(n)
            ends = pa.array(np.concatenate([[0], np.searchsorted(row, some, "right")]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, times)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(some)), pa.array(n[some]), *lists], ["doc_id", "n", "terms", "times"])


def _holding(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(term, df): a task's counts of documents by term."""
    df = np.zeros(size, dtype=np.int64)
    for batch in batches:
        df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])


def _added(values: list[np.ndarray | None]) -> np.ndarray | None:
    """The sum of accumulators, of which None is all zeros; one alone is not copied."""
    some = [v for v in values if v is not None]
    if len(some) < 2:
        return some[0] if some else None
    out = some[0] + some[1]
    for v in some[2:]:
        out += v
    return out


class Evaluation:
    """The DAGs of a pass over its vocabulary, with the weights of the terms and the size of the collection."""

    def __init__(self, plans: list[dict[str, Any]], vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.weights, self.n_docs, self.n_terms, self.blocks = weights, n_docs, n_terms, []
        lists = lambda at, x: [x[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        for p in plans:
            terms = np.searchsorted(vocabulary, np.array(p["terms"], dtype=np.int64).view(np.uint64))
            self.blocks.append((p["items"], terms, np.array(p["times"]), lists(p["child_at"], p["children"]), lists(p["root_at"], p["roots"])))

    def scores(self, n: np.ndarray, row: np.ndarray, term: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, scores of all documents) for items that any document has a term of; n by document, the rest by posting."""
        m = 25 + 75 * n * self.n_docs // self.n_terms
        impact = self.weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m[row]))
        order = np.argsort(term, kind="stable")
        term, row, impact = term[order], row[order], impact[order]
        for items, terms, counts, children, roots in self.blocks:
            acc: list[np.ndarray | None] = [None] * (len(terms) + len(children))
            low, high = np.searchsorted(term, terms, "left"), np.searchsorted(term, terms, "right")
            for leaf in np.flatnonzero(high > low):
                own = acc[leaf] = np.zeros(len(n), dtype=np.int64)
                own[row[low[leaf] : high[leaf]]] = impact[low[leaf] : high[leaf]] * counts[leaf]
            for k, below in enumerate(children):
                acc[len(terms) + k] = _added([acc[x] for x in below])
            for item, below in zip(items, roots, strict=True):
                if (total := _added([acc[x] for x in below])) is not None:
                    yield item, total


def _best(batches: Iterator[pa.RecordBatch], own: Evaluation, k: int) -> Iterator[pa.RecordBatch]:
    """(item, doc_id, score): each item's k best documents of the task."""
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            batch = whole.slice(start, SLICE)
            ids = batch.column("doc_id").fill_null(int(_NONE)).to_numpy()
            ends = np.cumsum(batch.column("terms").value_lengths().to_numpy())
            row = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
            flat = [batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "times")]
            for item, scores in own.scores(batch.column("n").to_numpy(), row, *flat):
                now, docs = best.get(item, (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
                found = np.flatnonzero(scores >= (now[-1] if len(now) == k else 1))
                if len(found):
                    now, docs = np.concatenate([now, scores[found]]), np.concatenate([docs, ids[found]])
                    first = np.lexsort((docs, -now))[:k]
                    best[item] = now[first], docs[first]
    for item, (scores, docs) in best.items():
        doc_ids = pa.array(docs, mask=docs == _NONE)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), item)), doc_ids, pa.array(scores)], ["item", "doc_id", "score"])


def _one_pass(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents for items(item, block, terms, times) of one pass."""
    plans = items.groupBy("block").applyInPandas(_plan, PLAN).toArrow().to_pylist()
    vocabulary = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(np.array(p["terms"]) for p in plans)]).astype(np.int64).view(np.uint64))
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(vocabulary)
    kept = stored(docs.mapInArrow(lambda b: _documents(b, known.value), "doc_id long, n long, terms array<int>, times array<int>"), "terms-of-documents")
    size = len(vocabulary)
    total = kept.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counts = kept.select("terms").mapInArrow(lambda b: _holding(b, size), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, dtype=np.int64)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    weights = np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)
    own = sc.broadcast(Evaluation(plans, vocabulary, weights, total.docs, max(total.terms, 1)))
    return kept.mapInArrow(lambda b: _best(b, own.value, k), "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of docs(doc_id, text) for each row of items(item_id, text)."""
    spark = docs.sparkSession
    own = stored(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    terms = own.select("item", "text").mapInArrow(_items, "item long, terms array<long>, times array<long>")
    # Items whose least hash is the same are likely to share terms.
    placed = running_total(terms.withColumn("least", F.array_min("terms")), ["least", "item"], F.size("terms"), "before")
    placed = stored(placed.withColumns({"block": F.floor(F.col("before") / BLOCK_TERMS), "pass": F.floor(F.col("before") / PASS_TERMS)}), "placed-items")
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for n in range((placed.agg(F.max("pass")).first()[0] or 0) + 1):
        found = found.unionByName(_one_pass(texts, placed.where(F.col("pass") == n).select("item", "block", "terms", "times"), k))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(own.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')] AS ts FROM documents WHERE text IS NOT NULL),
i AS (SELECT row_number() OVER () AS i, item_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR x IN regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')] AS ts FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT i, item_id, t, count(*) AS k FROM (SELECT i, item_id, unnest(ts) AS t FROM i) GROUP BY ALL),
s AS (SELECT count(*) AS nd, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY t, nd),
g AS (SELECT q.i, q.item_id, p.r, p.doc_id, sum(q.k * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * s.nd) // s.l))))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN w USING (t), s GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM g WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10
"""
