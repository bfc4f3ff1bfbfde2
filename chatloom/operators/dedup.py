"""Exact and similar duplicates of conversations, on hashes, signatures and openings.

Order is the column seq (arrival). Rule for similarity: a row goes if any earlier row is similar, which is
set-based, deterministic and stricter than the order-dependent rule that only accepted rows block others;
resolve_greedy gives that rule on the pairs. Equal strings are similar to each other; a string without words
is similar to none. Strings are compared once each, by their first rows, and rows follow by membership, so no
group of equal rows is expanded into pairs.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import content_hash, normalize, tokens
from chatloom.operators.ordering import numbered
from chatloom.operators.validation import assistant_texts
from chatloom.sources.scratch import stored

SEPARATOR = "|||"


#: Entries of one key that a task pairs with all on the other side.
HEAVY = 2000
#: Sets of this many words or fewer meet on two words of their beginnings, larger ones on one.
PAIRED = 120


def replies_of(turns: Column) -> Column:
    """The assistant's replies without blank ones."""
    return F.filter(assistant_texts(turns), lambda x: x.rlike(r"\S"))


def signature(replies: Column, text: Column) -> Column:
    """First 30 words of the first reply, a separator, last 20 of the last; without replies 200 characters of the text."""
    n = F.size(replies)
    first, last = F.split(F.get(replies, F.lit(0)), " "), F.split(F.get(replies, n - 1), " ")
    tail = F.slice(last, F.greatest(F.size(last) - 19, F.lit(1)), F.lit(20))
    own = F.concat_ws(f" {SEPARATOR} ", F.array_join(F.slice(first, 1, 30), " "), F.array_join(tail, " "))
    return F.when(n > 0, own).otherwise(F.substring(normalize(text), 1, 200))


def opening(replies: Column) -> Column:
    """The first reply; '' without one."""
    return F.coalesce(F.get(replies, F.lit(0)), F.lit(""))


def keyed(convs: DataFrame) -> DataFrame:
    """convs(seq, conv_id, turns, text) with hash, signature and opening."""
    # A generator in between keeps the optimizer from making the replies anew in every place that names them.
    own = convs.select("*", F.explode(F.array(replies_of(F.col("turns")))).alias("_said"))
    # Only the first and the last reply are asked for, so only these are normalised.
    ends = F.concat(F.slice("_said", 1, 1), F.slice("_said", -1, 1))
    own = own.select("*", F.explode(F.array(F.transform(ends, normalize))).alias("_replies")).drop("_said")
    text, replies = F.col("text"), F.col("_replies")
    return own.withColumns({"hash": content_hash(text), "signature": signature(replies, text), "opening": opening(replies)}).drop("_replies")


def repeats(df: DataFrame, key: str, first: str = "first") -> DataFrame:
    """(seq, key, first) rows that an earlier row of equal key precedes, and its seq; the earliest of each key is found by partial aggregation."""
    known = df.groupBy(key).agg(F.min("seq").alias(first), F.count("*").alias("_n")).where("_n > 1").select(key, first)
    return df.join(known, key).where(F.col("seq") > F.col(first)).select("seq", key, first)


def exact_dups(df: DataFrame, key: str = "hash") -> DataFrame:
    """(conv_id, seq, dup_rank): rank of each row among the rows of its key, 1 the earliest."""
    return numbered(df.select("conv_id", "seq", key), ["seq"], "dup_rank", [key], lazy=True).select("conv_id", "seq", (F.col("dup_rank") + 1).alias("dup_rank"))


def exact_against(df: DataFrame, seen: DataFrame) -> DataFrame:
    """df's rows whose hash is in seen(hash)."""
    return df.join(seen.select("hash"), "hash", "left_semi")


def prefix_keys(num: int, den: int) -> Column:
    """An array of (h, at, before) for columns words, in order from rare to frequent, and n: the keys that a set meets others on, the place of the key's last word and how many of it come before."""
    # n - ceil(t n) + 1 in whole numbers.
    head = (F.col("n") - F.floor((F.col("n") * num + den - 1) / den) + 1).cast("int")
    two = F.least(head + 1, F.col("n").cast("int"))
    word = lambda i: F.get("words", i)
    key = lambda h, at, before: F.struct(h.alias("h"), at.alias("at"), F.lit(before).alias("before"))
    inner = lambda i: F.transform(F.sequence(i + 1, two - 1), lambda j: key(F.xxhash64(word(i), word(j)), j, 1))
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), two - 2), inner))
    singles = F.transform(F.sequence(F.lit(0), head - 1), lambda i: key(F.xxhash64(word(i)), i, 0))
    none = F.slice(singles, 1, 0)
    alone = F.array(key(F.xxhash64(word(F.lit(0)), word(F.lit(0))), F.lit(0), 0))
    small = F.when(F.col("n") == 1, alone).when(F.col("n") <= PAIRED, pairs).otherwise(none)
    return F.concat(small, F.when(F.col("n") * den >= PAIRED * num, singles).otherwise(none))


def reachable(nx: str, ax: str, ny: str, ay: str, num: int, den: int) -> Column:
    """Whether two sets that meet on a key with column before can be similar, by their sizes and the key's places in them."""
    # Of the first words that the two share the key's last one is the last; from it on they share no more than either has left.
    most = F.col("before") + F.least(F.col(nx) - F.col(ax), F.col(ny) - F.col(ay))
    return most * (num + den) > F.lit(num) * (F.col(nx) + F.col(ny))


def similar_values(values: DataFrame, num: int, den: int, banded: bool = False) -> DataFrame:
    """Pairs (a, b, common, either), a < b, of distinct strings values(id, value) with Jaccard over num / den, strictly.

    Prefix filter: words are ordered from rare to frequent; two sets over the threshold, which is a half or more, share
    l of their first n - ceil(t * n) + l words. Sets of up to PAIRED words meet on two such words (single words on
    themselves), larger ones, whose pairs would be many, on one, and those that a partner on either side may have on
    both. Keys carry the set's length and the last word's place; both bound what two sets can share. Ids alone are
    made distinct, and only then the words are compared exactly. Keys that many sets hold are dealt over several tasks.
    With banded, values(id, value, block) of one block are compared with those of the same block and the one before,
    and ids grow with the blocks.
    """
    if 2 * num < den:
        raise ValueError("the threshold must be a half or more")
    block = F.col("block") if banded else F.lit(0)
    words = tokens(F.col("value"))
    own = values.select("id", block.cast("long").alias("block"), words.alias("words")).where(F.size("words") > 0)
    count = own.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    ranked = own.select("id", "block", F.explode("words").alias("word")).join(count, "word")
    ordered = ranked.groupBy("id", "block").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("w"))
    ordered = stored(ordered.select("id", "block", F.col("w.word").alias("words"), F.size("w").cast("long").alias("n")), "ordered-words")
    entries = ordered.select("id", "block", "n", F.explode(prefix_keys(num, den)).alias("key")).select("id", "block", "n", "key.*")
    # A key's sets are those that can meet: all, or with banded those of a block and the one before, however many blocks hold the key.
    reach = entries.withColumn("in", F.explode(F.array(F.col("block"), F.col("block") + 1))) if banded else entries.withColumn("in", F.col("block"))
    shared = reach.groupBy("h", "in").agg(F.count("*").alias("k"), F.count_if(F.col("in") == F.col("block")).alias("own")).where("k > 1 AND own > 0")
    met = stored(reach.join(shared.select("h", "in", F.ceil(F.col("k") / HEAVY).cast("int").alias("salts")), ["h", "in"]), "prefix-keys")
    left = met.where(F.col("in") == F.col("block")).select("h", "in", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("at").alias("ax"), "before", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"))
    right = met.select("h", "in", "block", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("at").alias("ay"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    # Of one block the earlier set stands on the right; those of the block before are all earlier.
    order = (F.col("block") < F.col("in")) | (F.col("y") < F.col("x"))
    near = order & reachable("nx", "ax", "ny", "ay", num, den)
    found = stored(left.join(right, ["h", "in", "salt"]).where(near).select(F.col("y").alias("a"), F.col("x").alias("b")).distinct(), "candidates")
    of = lambda i, w: ordered.select(F.col("id").alias(i), F.col("words").alias(w))
    common = F.size(F.array_intersect("wa", "wb"))
    both = found.join(of("a", "wa"), "a").join(of("b", "wb"), "b").select("a", "b", common.alias("common"), (F.size("wa") + F.size("wb")).alias("sum"))
    pairs = both.select("a", "b", "common", (F.col("sum") - F.col("common")).alias("either"))
    return pairs.where(F.col("common") * den > F.col("either") * num)


def _firsts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.min("seq").alias("id"))


def similar_pairs(df: DataFrame, column: str, num: int, den: int) -> DataFrame:
    """(a, b, sim): the similar pairs of different strings, by their first rows' seq, and for every later row of a string
    its first row, at 1: pairs of representatives and the membership of all others."""
    firsts = stored(_firsts(df, column), "firsts")
    pairs = similar_values(firsts.select("id", F.col(column).alias("value")), num, den)
    out = pairs.select("a", "b", F.round(F.col("common") / F.col("either"), 6).alias("sim"))
    return out.unionByName(repeats(df.where(F.size(tokens(F.col(column))) > 0), column, "a").select("a", F.col("seq").alias("b"), F.lit(1.0).alias("sim")))


def similar_to_earlier(df: DataFrame, column: str, num: int, den: int) -> DataFrame:
    """(seq,) of the rows that an earlier row with another, similar string precedes; only each string's first row is compared."""
    firsts = stored(_firsts(df, column), "firsts")
    pairs = similar_values(firsts.select("id", F.col(column).alias("value")), num, den)
    both = F.explode(F.array(F.struct(F.col("b").alias("id"), F.col("a").alias("blocker")), F.struct(F.col("a").alias("id"), F.col("b").alias("blocker")))).alias("x")
    earliest = pairs.select(both).groupBy(F.col("x.id").alias("id")).agg(F.min("x.blocker").alias("blocker"))
    blocked = firsts.join(earliest, "id").select(column, "blocker")
    return df.join(blocked, column).where(F.col("seq") > F.col("blocker")).select("seq")


def similar_within(df: DataFrame, column: str, num: int, den: int, n: int, blank_equal: bool = False) -> DataFrame:
    """(seq,) of the rows that one of the n rows before, by number in the order of arrival, is similar or equal to.

    Rows are numbered in order and cut into blocks of n, so what a row is compared with lies in its block or the one
    before. A string stands once a block, by its first and last row there. Strings without words equal each other
    only with blank_equal.
    """
    rows = numbered(df.select("seq", F.col(column).alias("value")), ["seq"], "number").withColumn("block", F.floor(F.col("number") / n))
    rows = stored(rows, "numbered-rows")
    strings = rows.groupBy("block", "value").agg(F.min("number").alias("id"), F.max("number").alias("last"))
    strings = stored(strings, "strings-of-blocks")
    pairs = similar_values(strings.select("id", "value", "block"), num, den, banded=True).select("a", "b")
    span = lambda i, p: strings.select(F.col("id").alias(i), F.col("block").alias(f"{p}_block"), F.col("last").alias(f"{p}_last"))
    met = pairs.join(span("a", "a"), "a").join(span("b", "b"), "b")
    same = F.col("a_block") == F.col("b_block")
    # In one block the later string's rows follow the other's first row, and the other's rows after the later one's first follow that.
    one = met.select(F.col("b").alias("id"), F.when(same, F.col("a")).otherwise(F.col("a_last")).alias("earlier"))
    two = met.where(same).select(F.col("a").alias("id"), F.col("b").alias("earlier"))
    has_words = F.size(tokens(F.col("value"))) > 0
    equal = strings if blank_equal else strings.where(has_words)
    before = equal.select("value", (F.col("block") + 1).alias("block"), F.col("last").alias("earlier"))
    own = equal.select("id", F.col("id").alias("earlier")).unionByName(equal.join(before, ["value", "block"]).select("id", "earlier"))
    near = one.unionByName(two).unionByName(own).groupBy("id").agg(F.collect_set("earlier").alias("earlier"))
    hit = F.exists("earlier", lambda e: (e < F.col("number")) & (F.col("number") - e <= n))
    ids = strings.join(near, "id").select("block", "value", "earlier")
    return rows.join(ids, ["block", "value"]).where(hit).select("seq")


def dup_reason(keyed_rows: DataFrame, sig: tuple[int, int] = (9, 10), opn: tuple[int, int] = (19, 20)) -> DataFrame:
    """(conv_id, seq, dup_reason): exact hash, similar signature, equal opening, similar opening, else unique; equal signatures are similar."""
    rows = stored(keyed_rows.select("conv_id", "seq", "hash", "signature", "opening"), "keyed")
    marks = [
        (repeats(rows, "hash").select("seq"), "exact_hash_duplicate"),
        (repeats(rows.where(F.size(tokens(F.col("signature"))) > 0), "signature").select("seq").unionByName(similar_to_earlier(rows, "signature", *sig)), f"signature_similarity>{sig[0] / sig[1]:.2f}"),
        (repeats(rows, "opening").select("seq"), "exact_opening_duplicate"),
        (similar_to_earlier(rows, "opening", *opn), f"opening_similarity>{opn[0] / opn[1]:.2f}"),
    ]
    union = None
    for rank, (found, reason) in enumerate(marks):
        own = found.select("seq", F.lit(rank).alias("rank"), F.lit(reason).alias("reason"))
        union = own if union is None else union.unionByName(own)
    first = union.groupBy("seq").agg(F.min_by("reason", "rank").alias("_first"))
    return rows.select("conv_id", "seq").join(first, "seq", "left").select("conv_id", "seq", F.coalesce("_first", F.lit("unique")).alias("dup_reason"))


def resolve(marked: DataFrame, policy: str = "drop") -> DataFrame:
    """drop: only the unique rows; keep_marked: all, duplicates under the reason of a used-up retry."""
    if policy == "drop":
        return marked.where("dup_reason = 'unique'")
    kept = F.when(F.col("dup_reason") == "unique", F.col("dup_reason")).otherwise(F.lit("accepted_after_dedup_retries_exhausted"))
    return marked.withColumn("dup_reason", kept)


#: Similar pairs that a sweep's task takes in order, and undecided neighbours of one row that it holds at once.
SLICE_PAIRS, HELD = 500_000, 100_000
#: What is known of a row: its own fate, or that it is kept as root is (flip: as root is not).
KNOWN = "row long, root long, flip boolean, kept boolean"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """KNOWN rows of what a slice of (b, a, flip), sorted by b, settles, and with edge true what it leaves: b is kept unless for some of its rows a's fate
    (flip: its opposite) is to be kept; without a, flip itself says whether b is blocked."""
    fates: dict[int, tuple[int | None, bool]] = {}
    out: list[tuple] = []

    def settle(b: int, blockers: set[tuple[int, bool]], blocked: bool, parts: bool) -> None:
        opposite = any((root, not flip) in blockers for root, flip in blockers)
        if blocked or opposite:
            fates[b] = None, False
        elif parts or len(blockers) > 1:
            out.extend((b, root, flip, None, True) for root, flip in blockers)
            return
        elif blockers:
            (root, flip), = blockers
            fates[b] = root, not flip
        else:
            fates[b] = None, True
        root, flip = fates[b]
        out.append((b, root, None if root is None else flip, flip if root is None else None, False))

    def rows() -> Iterator[tuple[int, int | None, bool]]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("b", "a", "flip")), strict=True)

    for b, own in itertools.groupby(rows(), key=lambda x: x[0]):
        blockers: set[tuple[int, bool]] = set()
        blocked = parts = False
        for _, a, flip in own:
            root, other = (None, False) if a is None else fates.get(a, (a, False))
            if root is None:
                blocked |= other != flip
            elif not blocked:
                blockers.add((root, other != flip))
            if len(blockers) > HELD:
                out.extend((b, x, f, None, True) for x, f in blockers)
                blockers, parts = set(), True
        settle(b, blockers, blocked, parts)
        if len(out) > HELD:
            yield pa.RecordBatch.from_pylist([dict(zip(SWEPT.names, x, strict=True)) for x in out], SWEPT)
            out.clear()
    yield pa.RecordBatch.from_pylist([dict(zip(SWEPT.names, x, strict=True)) for x in out], SWEPT)


SWEPT = pa.schema([("row", pa.int64()), ("root", pa.int64()), ("flip", pa.bool_()), ("kept", pa.bool_()), ("edge", pa.bool_())])


def resolve_greedy(rows: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """(seq, kept) of all rows(seq, column): in order of arrival a row goes if a kept earlier one is similar or equal, by pairs(a, b), a < b.

    pairs as of similar_pairs over the column. A later row of a string always goes: either the string's first row is
    kept, or what that one goes for is kept. The first rows are settled by sweeps: the pairs are dealt in slices by the
    order of b, and a task goes through its slice once. A row with one undecided earlier neighbour is kept just if that
    one is not, so chains of any length end as a row before the slice and a parity; these are followed from slice
    to slice, each step twice as far. Rows with several such neighbours wait. Every sweep settles the first slice that
    has any rows left, and all that depends on one row alone.
    """
    copies = stored(repeats(rows.where(F.size(tokens(F.col(column))) > 0), column).select(F.col("seq").alias("b")), "copies")
    left = pairs.select("a", "b").distinct().join(copies, "b", "left_anti").select("b", "a", F.lit(False).alias("flip"))
    left = stored(left, "undecided")
    heads = left.select("a").distinct().join(left.select(F.col("b").alias("a")), "a", "left_anti")
    known = stored(heads.select(F.col("a").alias("row"), F.lit(None).cast("long").alias("root"), F.lit(None).cast("boolean").alias("flip"), F.lit(True).alias("kept")), "known")
    n = left.count()
    while n:
        of = lambda name: known.select(F.col("row").alias(name), F.col("root").alias("_root"), F.col("flip").alias("_flip"), F.col("kept").alias("_kept"))
        told = F.coalesce(F.col("_flip"), F.col("_kept"), F.lit(False)) != F.col("flip")
        root = F.when(F.col("_kept").isNull(), F.coalesce("_root", "a"))
        dealt = left.join(of("a"), "a", "left").select("b", root.alias("a"), told.alias("flip"))
        dealt = dealt.repartitionByRange(-(-n // SLICE_PAIRS), "b").sortWithinPartitions("b", "a")
        swept = stored(dealt.mapInArrow(_sweep, KNOWN + ", edge boolean"), "swept")
        known = stored(known.unionByName(swept.where("NOT edge").drop("edge")), "known")
        while known.where("root IS NOT NULL").head(1):
            # A root that waits, and is known of no more, stays.
            new_root = F.when(F.col("_kept").isNull(), F.coalesce("_root", "root"))
            both = F.coalesce("_flip", "_kept", F.lit(False)) != F.col("flip")
            loose, settled = known.where("root IS NOT NULL"), known.where("root IS NULL")
            jumped = loose.join(of("root"), "root", "left").select("row", new_root.alias("root"), F.when(F.col("_kept").isNull(), both).alias("flip"), F.when(F.col("_kept").isNotNull(), both).alias("kept"), F.col("_root").isNotNull().alias("_more"))
            jumped = stored(jumped, "jumped")
            known = stored(settled.unionByName(jumped.drop("_more")), "known")
            if not jumped.where("_more").head(1):
                break
        rest = swept.where("edge").select(F.col("row").alias("b"), F.col("root").alias("a"), "flip").join(known.select(F.col("row").alias("b")), "b", "left_anti")
        left = stored(rest.select("b", "a", "flip"), "undecided")
        n = left.count()
    gone = copies.unionByName(known.where("NOT kept").select(F.col("row").alias("b"))).select(F.col("b").alias("seq"), F.lit(False).alias("kept"))
    return rows.select("seq").join(gone, "seq", "left").select("seq", F.coalesce("kept", F.lit(True)).alias("kept"))


#: Sightings of long hashes that a slice has.
SLICE_ROWS = 1_000_000
#: A hash of more sightings than LONG, and than one in LONG_HASHES of all, is dealt over several tasks; there are LONG_HASHES of these at most.
LONG, LONG_HASHES = 10_000, 100_000


def _walk(cells: np.ndarray, offsets: np.ndarray, enter: int) -> Iterator[tuple[int, int]]:
    """(cell, offset) of the anchors of a slice, sorted by cell and offset, from its first sighting of cell enter on, for as long as the slice has the next one."""
    cell, offset = enter, -1
    while True:
        low, high = np.searchsorted(cells, [cell, cell + 1])
        at = low + int(np.searchsorted(offsets[low:high], offset))
        if at == high:
            return
        offset = int(offsets[at])
        yield cell, offset
        cell += 1


def _same(name: str | None, n: int) -> pd.Series:
    """A hash n times, as plain strings."""
    return pd.Series([name] * n, dtype=object)


def _leads(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
    """Where a walk that enters the slice by a cell ends."""
    own = own.sort_values(["cell", "offset"])
    cells, offsets = own["cell"].to_numpy(), own["offset"].to_numpy()
    every = np.unique(cells)
    ends = [c + sum(1 for _ in _walk(cells, offsets, c)) - 1 for c in every]
    return pd.DataFrame({"hash": _same(key[0], len(every)), "slice": key[1], "cell": every, "last": ends})


def _route(key: tuple, leads: pd.DataFrame) -> pd.DataFrame:
    """The cells by which the walk from the hash's first sighting enters slices: after its last cell of a slice it goes to the next
    slice above that has the cell after, else to the lowest slice of the first cell after that one."""
    last = {(s, c): e for s, c, e in zip(leads["slice"], leads["cell"], leads["last"], strict=True)}
    slices: dict[int, list[int]] = {}
    for s, c in sorted(last):
        slices.setdefault(c, []).append(s)
    cells = sorted(slices)
    at: tuple[int, int] | None = (slices[cells[0]][0], cells[0])
    out = []
    while at:
        out.append(at)
        end = last[at]
        above = slices.get(end + 1, [])
        k = bisect.bisect_right(above, at[0])
        j = bisect.bisect_left(cells, end + 2)
        at = (above[k], end + 1) if k < len(above) else (slices[cells[j]][0], cells[j]) if j < len(cells) else None
    return pd.DataFrame({"hash": _same(key[0], len(out)), "slice": [s for s, _ in out], "cell": [c for _, c in out]})


def _long_anchors(sightings: DataFrame, span: int) -> DataFrame:
    """(hash, us) of the anchors of sightings(hash, us) of which each hash has many.

    Time is cut into cells as long as the memory, so a cell has one anchor at most, and an anchor stands at the next
    cell's first sighting of no smaller offset: while the cells go on, offsets only grow. The sightings are dealt
    in slices by offset. A walk enters a slice from below, or anew after a gap, so by its first sighting of a cell; a
    slice is summed up as a map from that cell to where the walk leaves. The maps are composed hash by hash, and
    the slices then walked from the cells that are entered.
    """
    own = sightings.select("hash", F.expr(f"us - pmod(us, {span}L)").alias("start"), F.expr(f"pmod(us, {span}L)").alias("offset"))
    own = own.select("hash", F.expr(f"start div {span}L").alias("cell"), "offset")
    own = stored(own, "sightings-by-offset")
    slices = max(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-own.count() // SLICE_ROWS))
    placed = stored(own.repartitionByRange(slices, "hash", "offset").withColumn("slice", F.spark_partition_id()), "slices-of-sightings")
    leads = placed.groupBy("hash", "slice").applyInPandas(_leads, "hash string, slice int, cell long, last long")
    route = stored(leads.groupBy("hash").applyInPandas(_route, "hash string, slice int, cell long"), "routes")

    def apply(key: tuple, slice_rows: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        slice_rows = slice_rows.sort_values(["cell", "offset"])
        cells, offsets = slice_rows["cell"].to_numpy(), slice_rows["offset"].to_numpy()
        found = [c * span + x for enter in entered["cell"] for c, x in _walk(cells, offsets, enter)]
        return pd.DataFrame({"hash": _same(key[0], len(found)), "us": np.array(found, dtype=np.int64)})

    return placed.groupBy("hash", "slice").cogroup(route.groupBy("hash", "slice")).applyInPandas(apply, "hash string, us long")


def ttl_anchor(df: DataFrame, days: int = 90) -> DataFrame:
    """(hash, created_at, duplicate): sightings by time; one within days of its anchor repeats it, a later one is the next anchor.

    A hash's sightings are gone through in order, in its own row; those of hashes with very many are dealt over tasks.
    However long the time, the jobs are the same. Sightings without a time are left out.
    """
    span = days * 86_400_000_000
    us = F.unix_micros("created_at").alias("us")
    sightings = stored(df.where("created_at IS NOT NULL").select("hash", us).groupBy("hash", "us").agg(F.count("*").alias("n")), "sightings")
    by_hash = sightings.groupBy("hash").agg(F.count("*").alias("times"))
    long = stored(by_hash.where(F.col("times") > max(LONG, sightings.count() // LONG_HASHES)).select("hash"), "long-hashes")
    some = bool(long.head(1))
    known = F.broadcast(long.select(F.col("hash").alias("_long")))
    is_long = F.col("hash").eqNullSafe(F.col("_long"))
    short = sightings.join(known, is_long, "left_anti") if some else sightings
    rows = short.groupBy("hash").agg(F.array_sort(F.collect_list(F.struct("us", "n"))).alias("s"))
    newest = lambda a: F.get(a, F.size(a) - 1)
    walk = lambda a, t: F.when((F.size(a) == 0) | (t >= newest(a) + span), F.concat(a, F.array(t))).otherwise(a)
    rows = rows.withColumn("anchors", F.aggregate("s.us", F.array().cast("array<bigint>"), walk))
    out = rows.select("hash", "anchors", F.explode("s").alias("x")).select("hash", "x.us", "x.n", F.array_contains("anchors", F.col("x.us")).alias("anchor"))
    if some:
        own = sightings.join(known, is_long, "left_semi")
        anchors = _long_anchors(own.select("hash", "us"), span).select(F.col("hash").alias("_hash"), F.col("us").alias("_us"), F.lit(True).alias("anchor"))
        marked = own.join(anchors, F.col("hash").eqNullSafe(F.col("_hash")) & (F.col("us") == F.col("_us")), "left")
        out = out.unionByName(marked.select("hash", "us", "n", F.coalesce("anchor", F.lit(False)).alias("anchor")))
    again = ~F.col("anchor") | (F.col("k") > 1)
    each = out.select("hash", "us", "anchor", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("k"))
    return each.select("hash", F.timestamp_micros("us").alias("created_at"), again.alias("duplicate"))


def against_history(df: DataFrame, history: DataFrame, days: int = 90) -> DataFrame:
    """df(hash, created_at) rows that history(hash, created_at) remembers."""
    near = F.col("h.created_at") + F.expr(f"INTERVAL {days} DAYS") > F.col("d.created_at")
    return df.alias("d").join(history.alias("h"), (F.col("d.hash") == F.col("h.hash")) & near, "left_semi")


def update_state(state: DataFrame, accepted: DataFrame, caps: dict[str, int]) -> DataFrame:
    """state(kind, value, created_at) with the accepted rows' values, each kind cut to its newest cap; kinds without a cap keep each value's first."""
    from chatloom.operators.reporting import latest_n_per_kind

    both = state.unionByName(accepted)
    capped = latest_n_per_kind(both.where(F.col("kind").isin(*caps)), caps)
    rest = both.where(~F.col("kind").isin(*caps)).groupBy("kind", "value").agg(F.min("created_at").alias("created_at"))
    return capped.unionByName(rest)
