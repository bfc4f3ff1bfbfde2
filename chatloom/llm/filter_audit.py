"""Filter interaction audit: what a chain of filters removes, in every order, by sorted posting lists.

Each filter's failing rows are kept as sorted lists of row numbers, by part and by ranges of numbers. The merge of
several lists is a stable sort of their concatenation: it takes sorted lists as runs and merges them all, galloping where
one of them lies ahead. What a filter removes after others is the difference of its list and their union, found
by binary searches that go on from each other; sizes are added over the ranges. A range has at most RANGE_ROWS
rows of one part, so a part of any size is many ranges, dealt by sorting.

Defined results: null text is the empty text, which fails the filter of short texts alone and, if it repeats, that of
copies; a null part is the empty string; rows are counted, so repeated rows count each, and of rows with one doc_id and
text none is a copy of the other; a null doc_id is no copy and has no labels; a row whose labels say 1 anywhere is
labelled; an empty table gives no rows; further columns are ignored. Copies are found by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table, words

#: Rows of one part that a range has at most.
RANGE_ROWS = 1 << 16
#: A text of more copies than HEAVY and 1 / GROUPS of all rows is looked up by a broadcast, which has GROUPS rows at most.
HEAVY, GROUPS = 1000, 100_000
FILTERS = "ABCDE"
#: Lists of a range: failing rows by filter, then those of labels.
LISTS = [*FILTERS, "good", "toxic"]
POSTINGS = "part string, first_row long, n long, " + ", ".join(f"`{x}` array<long>" for x in LISTS)
SIZES = "part string, place int, n long, good long, toxic long"


def failing(text: Column) -> dict[str, Column]:
    """The conditions of filters A to D on a text."""
    own = words(text)
    n = F.size(own)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {"A": n < 50, "B": 100 * F.size(F.array_distinct(own)) < 65 * n, "C": 100 * capitals > 5 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, doc_id, part, A, B, C, D, E, good, toxic) of docs(doc_id, text, source) and labels(doc_id, quality, toxic): a number, all verdicts and labels for each row."""
    text = F.coalesce("text", F.lit(""))
    # Texts are read once; a row number stays as it was written.
    own = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *(c.alias(k) for k, c in failing(text).items()))
    own = stored(own, "judged-rows")
    # A text's first row by id, for texts that stand more than once.
    firsts = stored(own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).where("copies > 1"), "repeated-texts")
    heavy = F.col("copies") > max(HEAVY, own.count() // GROUPS)
    large = F.broadcast(firsts.where(heavy).select("digest", F.col("first").alias("large_first")))
    own = own.join(large, "digest", "left")
    rest = own.where("large_first IS NULL").join(firsts.where(~heavy).select("digest", "first"), "digest", "left")
    both = rest.unionByName(own.where("large_first IS NOT NULL").withColumn("first", F.col("large_first")))
    both = both.withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("digest", "first", "large_first")
    told = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    said = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(told("quality"), told("toxic")).withColumnRenamed("quality", "good")
    known = both.where("doc_id IS NOT NULL").join(said, "doc_id", "left").fillna(False, ["good", "toxic"])
    return known.unionByName(both.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)}))


def _lists(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A row of posting lists for each run of at most `most` rows of a part, of rows sorted by part and number."""
    for whole in batches:
        parts = whole.column("part")
        ends = np.flatnonzero(np.append(np.asarray(parts[1:].to_numpy(False) != parts[:-1].to_numpy(False), dtype=bool), True)) + 1
        start = 0
        for end in ends:
            for low in range(start, end, most):
                batch = whole.slice(low, min(most, end - low))
                rows = batch.column("row")
                lists = [pa.array([rows.filter(batch.column(x)).to_numpy()], pa.list_(pa.int64())) for x in LISTS]
                yield pa.RecordBatch.from_arrays([batch.column("part").slice(0, 1), rows.slice(0, 1), pa.array([batch.num_rows]), *lists], ["part", "first_row", "n", *LISTS])
            start = end


def posting_lists(rows: DataFrame) -> DataFrame:
    """(part, first_row, n, A to E, good, toxic): by ranges of a part's rows how many there are, and the sorted numbers of those that fail each filter or are so labelled."""
    own = stored(rows.select("part", "row", *LISTS), "verdicts")
    return own.repartitionByRange("part", "row").sortWithinPartitions("part", "row").mapInArrow(lambda b: _lists(b, RANGE_ROWS), POSTINGS)


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """The union of sorted lists of different numbers, sorted: a galloping merge of all of them."""
    every = np.concatenate([*lists, np.zeros(0, dtype=np.int64)])
    every.sort(kind="stable")
    return every[np.append(True, every[1:] != every[:-1])[: len(every)]]


def without(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The numbers of a sorted list that another one lacks."""
    return own[np.append(other, -1)[np.searchsorted(other, own)] != own] if len(other) else own


def place(before: int, filter_no: int) -> int:
    """Where the size of a filter's list without those of the set before is kept; filter_no 5: the size of the set's union."""
    return before * 6 + filter_no


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, place, n, good, toxic): sizes of unions and differences of a range's lists, those above 0, and at -1 its rows."""
    for batch in batches:
        for row in range(batch.num_rows):
            lists = [batch.column(x)[row].values.to_numpy() for x in LISTS]
            fails, labelled = lists[: len(FILTERS)], lists[len(FILTERS) :]
            out = [(-1, batch.column("n")[row].as_py(), 0, 0)]
            size = lambda own: (len(own), *(len(x) - len(without(x, own)) for x in labelled))
            for before in range(1 << len(FILTERS)):
                union = merged([x for f, x in enumerate(fails) if before >> f & 1])
                out.append((place(before, len(FILTERS)), *size(union)))
                out += [(place(before, f), *size(without(x, union))) for f, x in enumerate(fails) if not before >> f & 1]
            some = np.array([x for x in out if any(x[1:])], dtype=np.int64).reshape(-1, 4).T
            parts = pa.array([batch.column("part")[row].as_py()] * some.shape[1], pa.string())
            yield pa.RecordBatch.from_arrays([parts, pa.array(some[0].astype(np.int32)), *map(pa.array, some[1:])], ["part", "place", "n", "good", "toxic"])


def audit(lists: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of posting lists: a row for each part, order and step."""
    sizes = lists.mapInArrow(_sizes, SIZES).groupBy("part", "place").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    own = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct("n", "good", "toxic")))).alias("sizes"))
    at = lambda place_no, of="n": F.coalesce(F.col("sizes")[place_no][of], F.lit(0))
    k = len(FILTERS)
    # As often as a set stands before a filter in an order of all.
    orders_of = lambda s: factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())
    credit = [reduce(lambda a, b: a + b, (at(F.lit(place(s, f))) * orders_of(s) for s in range(1 << k) if not s >> f & 1)) for f in range(k)]
    own = own.select("part", "sizes", F.array(*credit).alias("credit"), F.explode(F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))).alias("filter_order"))
    own = own.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    # The numbers of the step's filter and of the set before it.
    number = f"instr('{FILTERS}', substring(filter_order, {{}}, 1)) - 1"
    own = own.withColumn("f", F.expr(number.format("step")))
    own = own.withColumn("before", F.expr(f"aggregate(sequence(1, step), 0, (s, i) -> IF(i < step, s | shiftleft(1, {number.format('i')}), s))"))
    f, before, bit = F.col("f"), F.col("before"), F.expr("shiftleft(1, f)")
    removed = place(before, f)
    return own.select(
        "part", "filter_order", "step", (at(F.lit(-1)) - at(place(before.bitwiseOR(bit), k))).alias("kept"), at(removed).alias("removed"),
        (at(place(F.lit(0), f)) - at(removed)).alias("redundant"), at(place(F.lit((1 << k) - 1).bitwiseXOR(bit), f)).alias("unique_fails"),
        at(removed, "good").alias("good_lost"), at(removed, "toxic").alias("toxic_lost"), F.get("credit", f).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(posting_lists(rows))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
m AS (SELECT text AS t, min(doc_id) AS first FROM d GROUP BY 1),
j AS (SELECT part, len(w) < 50 AS A, 100 * len(list_distinct(w)) < 65 * len(w) AS B, 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS C,
  regexp_matches(text, '[#$%&*|]') AS D, coalesce(doc_id > first, false) AS E,
  doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM d JOIN m ON t = text),
v AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [A, B, C, D, E] AS fails, count(*) AS n FROM j GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || x.c || y.c || z.c AS filter_order FROM l a, l b, l x, l y, l z WHERE len(list_distinct([a.c, b.c, x.c, y.c, z.c])) = 5),
s AS (SELECT filter_order, step, ascii(filter_order[step]) - 64 AS f, [ascii(filter_order[i]) - 64 FOR i IN range(1, step)] AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS bad, len([b FOR b IN before IF fails[b]]) > 0 AS gone, len([x FOR x IN fails IF x]) = 1 AS alone FROM s, v),
g AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND bad), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND bad), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (bad AND alone), 0)::BIGINT AS unique_fails, coalesce(sum(n) FILTER (NOT gone AND bad AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (NOT gone AND bad AND toxic), 0)::BIGINT AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM g
"""


