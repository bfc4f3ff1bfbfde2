"""SentencePiece encoding and decoding (BPE models) by suffix-array matching.

A batch's texts are cut before each space that follows another character: no piece reaches over such a
place, so equal units have equal tokens and each distinct unit is encoded once. The distinct units are
concatenated and their suffixes sorted to the length of the longest piece; a binary search for every piece
of the vocabulary gives the range of its occurrences. The occurrences are edges of a lattice. Sorted by
end position, they are relaxed: a position keeps the edge whose piece may follow the piece kept at the
edge's start. A BPE text has exactly one such path: a sequence of pieces is what the merges give if and only
if each two neighbours, taken alone, stay apart, and this is decided by undoing their merges in reverse.

Defined results: null and empty texts have no tokens; characters outside the vocabulary become byte tokens;
U+2581 counts as a space, as in the format itself; equal rows get equal results; an empty table gives no
rows; further columns are ignored. Works for models with an identity normalizer, dummy prefix and byte
fallback. The model's path is a parameter and must be readable on every executor.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from chatloom.llm.common import table
from chatloom.llm.textops import chunks, span_hashes

#: The public vocabulary that the query uses.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, CUT = 0x20, 0xFF
#: Distinct units that a task remembers before it starts anew.
REMEMBERED = 1_000_000
UNKNOWN = -1


class Vocabulary:
    """The model's pieces in order of merging: single characters first, then by falling score."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain, byte_ids = {}, {}
        for i in range(model.vocab_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain[text.replace("▁", " ")] = (i, model.get_score(i))
        self.bytes = np.array([byte_ids[b] for b in range(256)], dtype=np.int32)
        ranks = {t: (-s, i) for t, (i, s) in plain.items()}
        runs = {t for t in plain if len(t) > 1 and not t.strip(" ")}
        self.runs = {len(t): plain[t][0] for t in runs} | {1: plain[" "][0]}
        self.run_ranks = {len(t): ranks[t] for t in runs}
        chars = sorted({c for t in plain for c in t})
        multi = sorted((t for t in plain if len(t) > 1 and t not in runs), key=ranks.__getitem__)
        self.n_chars = len(chars)
        order = {t: k for k, t in enumerate(chars + multi)}
        left, right = list(range(len(chars))), list(range(len(chars)))
        reached = [True] * len(chars)
        for t in multi:
            parts = _last_merge(t, order)
            reached.append(parts is not None)
            left.append(order[parts[0]] if parts else 0)
            right.append(order[parts[1]] if parts else 0)
        self.left, self.right = np.array(left, dtype=np.int32), np.array(right, dtype=np.int32)
        names = chars + multi
        self.spelled = [t.encode() for t in names]
        self.lengths = np.array([len(t) for t in self.spelled], dtype=np.int32)
        self.ids = np.array([plain[t][0] if t in plain else -1 for t in names], dtype=np.int32)
        keep = np.flatnonzero(np.array(reached))
        self.search = keep[np.argsort(np.array([self.spelled[k] for k in keep], dtype=object), kind="stable")]
        width = 8 * -(-int(self.lengths.max()) // 8)
        padded = np.zeros((len(self.search), width), dtype=np.uint8)
        for r, k in enumerate(self.search):
            padded[r, : self.lengths[k]] = list(self.spelled[k])
        self.low = padded.view(">u8").astype(np.uint64)
        for r, k in enumerate(self.search):
            padded[r, self.lengths[k] :] = 0xFF
        self.high = padded.view(">u8").astype(np.uint64)
        self._pair_table(order, [t for t, ok in zip(names, reached, strict=True) if ok and len(t) > 1])
        size = model.vocab_size()
        out = [b""] * size
        for t, (i, _) in plain.items():
            out[i] = t.encode()
        for b, i in byte_ids.items():
            out[i] = bytes([b])
        self.out_at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)
        self.out = np.frombuffer(b"".join(out), dtype=np.uint8)

    def _pair_table(self, order: dict[str, int], merged: list[str]) -> None:
        keys, values = [], []
        for t in merged:
            for cut in range(1, len(t)):
                a, b = order.get(t[:cut]), order.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(order[t])
        bits = 20
        while len(keys) * 3 > 1 << bits:
            bits += 1
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 64, -1, dtype=np.int64)
        self.merged = np.full((1 << bits) + 64, -1, dtype=np.int32)
        spots = self._spot(np.array(keys, dtype=np.int64)) if keys else []
        for k, v, s in zip(keys, values, spots, strict=True):
            while self.slots[s] >= 0:
                s += 1
            self.slots[s], self.merged[s] = k, v

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place in the order of the piece that a and b make together, or -1."""
        keys = a.astype(np.int64) << 32 | b
        spots = self._spot(keys)
        got = self.slots[spots]
        out = np.where(got == keys, self.merged[spots], -1)
        open_ = np.flatnonzero((got != keys) & (got >= 0))
        while len(open_):
            spots[open_] += 1
            got = self.slots[spots[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.merged[spots[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave a and b apart when they stand side by side."""
        ok = np.ones(len(a), dtype=bool)
        at, x, y = np.arange(len(a)), a.astype(np.int32), b.astype(np.int32)
        limit = np.full(len(a), np.iinfo(np.int32).max, dtype=np.int32)
        while len(at):
            both = self.joined(x, y)
            bad = (both >= 0) & (both < limit)
            ok[at[bad]] = False
            go = ~bad & (np.maximum(x, y) >= self.n_chars)
            at, x, y = at[go], x[go], y[go]
            first = x > y
            limit = np.where(first, x, y + 1)
            x, y = np.where(first, self.right[x], x), np.where(first, y, self.left[y])
        return ok

    @lru_cache(maxsize=4096)
    def run(self, n: int) -> tuple[int, ...]:
        """Tokens of n spaces that no letter takes up: the leftmost of the best pairs merges first."""
        parts = [1] * n
        while True:
            best = min(((self.run_ranks[a + b][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.run_ranks), default=None)
            if best is None:
                return tuple(self.runs[p] for p in parts)
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


def _last_merge(text: str, order: dict[str, int]) -> tuple[str, str] | None:
    """The two pieces whose merge makes text, or None if the merges never make it whole."""
    parts = list(text)
    while len(parts) > 1:
        best = min(((order[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in order), default=None)
        if best is None:
            return None
        if len(parts) == 2:
            return parts[0], parts[1]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return None


def merge_by_heap(text: str, order: dict[str, int]) -> list[str]:
    """Plain BPE of one unit, for tests."""
    parts: list[str | None] = list(text)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int, j: int) -> None:
        if 0 <= i and j < len(parts) and (both := parts[i] + parts[j]) in order:
            heapq.heappush(heap, (order[both], i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i, i + 1)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= len(parts) or parts[j] != b:
            continue
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    return [p for p in parts if p is not None]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _spread(lows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges [low, low + size), one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - lows, sizes)


def piece_edges(data: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(start, piece) of every occurrence of a piece in data, through its truncated suffix array."""
    width = voc.low.shape[1]
    padded = np.concatenate([data, np.full(8 * width + 8, CUT, dtype=np.uint8)])
    n = len(data)
    key = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | padded[j : j + n]
    suffixes = np.argsort(key)
    key = key[suffixes]
    lo = np.searchsorted(key, voc.low[:, 0], "left")
    hi = np.searchsorted(key, voc.high[:, 0], "right")
    long = voc.lengths[voc.search] > 8
    short = np.flatnonzero(~long & (hi > lo))
    starts = [suffixes[_spread(lo[short], hi[short] - lo[short])]]
    pieces = [np.repeat(voc.search[short], hi[short] - lo[short])]
    # Suffixes that begin like a longer piece are sorted on, eight bytes at a time, within their range.
    begun = np.flatnonzero(long & (hi > lo))
    rows = {}
    for r in begun:
        rows.setdefault((lo[r], hi[r]), []).append(r)
    for (a, b), members in rows.items():
        own = suffixes[a:b]
        tails = np.zeros((len(own), width - 1), dtype=np.uint64)
        for w in range(1, width):
            for j in range(8):
                tails[:, w - 1] = tails[:, w - 1] << np.uint64(8) | padded[own + 8 * w + j]
        for r in members:
            w = -(-int(voc.lengths[voc.search[r]]) // 8)
            hit = np.ones(len(own), dtype=bool)
            for k in range(1, w):
                hit &= (tails[:, k - 1] >= voc.low[r, k]) & (tails[:, k - 1] <= voc.high[r, k])
            starts.append(own[hit])
            pieces.append(np.full(int(hit.sum()), voc.search[r]))
    return np.concatenate(starts), np.concatenate(pieces).astype(np.int32)


def encode_units(data: np.ndarray, at: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of units, and their offsets by unit; unit u is data[at[u] : at[u + 1] - 1], followed by one CUT byte.

    A unit is at most one space and then characters other than spaces.
    """
    n, units = len(data), len(at) - 1
    start, piece = piece_edges(data, voc)
    single = np.zeros(n, dtype=bool)
    single[start[piece < voc.n_chars]] = True
    heads = np.flatnonzero(((data & 0xC0) != 0x80) & (data != CUT) & ~single)
    wide = np.ones(256, dtype=np.int64)
    wide[0xC0:0xE0], wide[0xE0:0xF0], wide[0xF0:] = 2, 3, 4
    start = np.concatenate([start, heads])
    length = np.concatenate([voc.lengths[piece].astype(np.int64), wide[data[heads]]])
    piece = np.concatenate([piece, np.full(len(heads), UNKNOWN, dtype=np.int32)])
    unit = np.repeat(np.arange(units), np.diff(at))
    local = start + length - at[unit[start]]
    order = np.argsort(local.astype(np.uint16) if int(local.max(initial=0)) < 65536 else local, kind="stable")
    start, length, piece, local = start[order], length[order], piece[order], local[order]
    bounds = np.flatnonzero(np.concatenate([[True], local[1:] != local[:-1], [True]])) if len(local) else np.zeros(1, dtype=np.int64)
    kept = np.full(n + 1, UNKNOWN, dtype=np.int32)
    size = np.zeros(n + 1, dtype=np.int64)
    opens = np.zeros(n + 1, dtype=bool)
    opens[at[:-1]] = True
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        s, p, k = start[a:b], piece[a:b], length[a:b]
        before = kept[s]
        free = opens[s] | (before == UNKNOWN) | (p == UNKNOWN)
        ask = np.flatnonzero(~free)
        free[ask] = voc.may_follow(before[ask], p[ask])
        ends = s[free] + k[free]
        kept[ends], size[ends] = p[free], k[free]
    # Walk every unit back from its end, one token a round.
    cursor, base = at[1:] - 1, at[:-1]
    who = np.flatnonzero(cursor > base)
    back_unit, back_pos, rounds = [], [], []
    here, turn = cursor[who], 0
    while len(who):
        back_unit.append(who), back_pos.append(here), rounds.append(np.full(len(who), turn))
        here = here - size[here]
        go = here > base[who]
        who, here, turn = who[go], here[go], turn + 1
    if not back_unit:
        return np.zeros(0, dtype=np.int32), np.zeros(units + 1, dtype=np.int64)
    back_unit, back_pos = np.concatenate(back_unit), np.concatenate(back_pos)
    order = np.argsort(back_pos, kind="stable")
    back_unit, back_pos = back_unit[order], back_pos[order]
    piece = kept[back_pos]
    ids = np.where(piece >= 0, voc.ids[piece], -1)
    spelled = np.where(ids >= 0, 1, size[back_pos])
    out = np.repeat(ids, spelled)
    odd = np.flatnonzero(out < 0)
    out[odd] = voc.bytes[data[_spread(back_pos - size[back_pos], np.where(ids >= 0, 0, size[back_pos]))]]
    counts = np.bincount(back_unit, weights=spelled, minlength=units).astype(np.int64)
    return out.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


class Encoder:
    """Encodes batches and remembers the units it has met."""

    def __init__(self, path: str) -> None:
        self.voc = vocabulary(path)
        self.known = np.zeros(0, dtype=np.uint64)
        self.tokens, self.at = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        if len(self.known) > REMEMBERED:
            self.known, self.tokens, self.at = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        sizes = ends - starts
        at = np.concatenate([[0], np.cumsum(sizes + 1)])
        own = np.full(at[-1], CUT, dtype=np.uint8)
        own[_spread(at[:-1], sizes)] = data[_spread(starts, sizes)]
        tokens, offsets = encode_units(own, at, self.voc)
        keys = np.concatenate([self.known, keys])
        counts = np.concatenate([np.diff(self.at), np.diff(offsets)])
        begins = np.concatenate([self.at[:-1], offsets[:-1] + len(self.tokens)])
        tokens = np.concatenate([self.tokens, tokens])
        order = np.argsort(keys)
        self.known, counts = keys[order], counts[order]
        self.tokens = tokens[_spread(begins[order], counts)]
        self.at = np.concatenate([[0], np.cumsum(counts)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by row) of rows data[offsets[i] : offsets[i + 1]]; each non-empty row begins with its dummy space."""
        n = len(data)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        space = data == SPACE
        head = np.zeros(n + 1, dtype=bool)
        head[offsets] = True
        head = head[:-1]
        before = np.concatenate([[True], space[:-1]])
        after = np.concatenate([space[1:], [True]])
        ends_row = np.zeros(n + 1, dtype=bool)
        ends_row[offsets] = True
        # A unit starts at a row's start and at the last space before another character, or at such a character.
        word = space & ~after & ~ends_row[1:]
        starts = np.flatnonzero(word | (~space & head))
        stray = np.flatnonzero(space & ~word)
        stop = np.sort(np.concatenate([starts, stray, offsets[1:]]))
        ends = stop[np.searchsorted(stop, starts, "right")]
        keys = span_hashes(data, starts, ends)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        seen = np.zeros(len(unique), dtype=bool)
        inside = at < len(self.known)
        seen[inside] = self.known[at[inside]] == unique[inside]
        if len(self.known) > REMEMBERED:
            seen[:] = False
        new = np.flatnonzero(~seen)
        if len(new):
            self._learn(data, starts[first[new]], ends[first[new]], unique[new])
            at = np.searchsorted(self.known, unique)
        mine = at[inverse]
        counts = self.at[mine + 1] - self.at[mine]
        begins = self.at[mine]
        if not len(stray):
            ids = self.tokens[_spread(begins, counts)]
            return ids, np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets, "left")]
        return self._with_runs(starts, begins, counts, stray, offsets, data)

    def _with_runs(self, starts, begins, counts, stray, offsets, data):
        """As encode's end, where runs of spaces stand before words or at a row's end."""
        voc = self.voc
        breaks = np.flatnonzero(np.concatenate([[True], (np.diff(stray) > 1) | np.isin(stray[1:], offsets[:-1])]))
        run_at, run_n = stray[breaks], np.diff(np.concatenate([breaks, [len(stray)]]))
        # A word's own space that no letter took up belongs to the run before it.
        follows = np.searchsorted(starts, run_at + run_n, "left")
        has = (follows < len(starts)) & (starts[np.minimum(follows, len(starts) - 1)] == run_at + run_n) if len(starts) else np.zeros(len(run_at), dtype=bool)
        has &= ~np.isin(run_at + run_n, offsets[:-1])
        begins, counts, run_n = begins.copy(), counts.copy(), run_n.copy()
        lone = np.flatnonzero(has)
        if len(lone):
            w = follows[lone]
            bare = (counts[w] > 0) & (self.tokens[np.minimum(begins[w], len(self.tokens) - 1)] == voc.runs[1])
            begins[w[bare]] += 1
            counts[w[bare]] -= 1
            run_n[lone[bare]] += 1
        run_tokens = [voc.run(int(k)) for k in run_n]
        pool = np.concatenate([self.tokens, *(np.array(t, dtype=np.int32) for t in run_tokens)])
        run_counts = np.array([len(t) for t in run_tokens])
        run_begins = len(self.tokens) + np.concatenate([[0], np.cumsum(run_counts)[:-1]])
        where = np.concatenate([starts, run_at])
        order = np.argsort(where, kind="stable")
        counts = np.concatenate([counts, run_counts])[order]
        begins = np.concatenate([begins, run_begins])[order]
        ids = pool[_spread(begins, counts)]
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(where[order], offsets, "left")]


def decode_rows(ids: np.ndarray, at: np.ndarray, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets by row) of rows of ids, the dummy space taken off."""
    sizes = voc.out_at[ids + 1] - voc.out_at[ids]
    data = voc.out[_spread(voc.out_at[ids], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])[at]
    full = np.diff(ends) > 0
    keep = np.ones(len(data), dtype=bool)
    keep[ends[:-1][full]] = False
    return data[keep], ends - np.concatenate([[0], np.cumsum(full)])


def prefixed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with (raw, text) and its own columns under their places: text has the dummy space and plain spaces, raw is what decoding must give."""
    text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
    raw = pc.replace_substring(text, "▁", " ")
    some = pc.greater(pc.binary_length(raw), 0)
    space = pa.scalar(" ", pa.large_string())
    full = pc.if_else(some, pc.binary_join_element_wise(space, raw, pa.scalar("", pa.large_string())), raw)
    return pa.RecordBatch.from_arrays([raw, full, *batch.columns], ["raw", "text", *map(str, range(batch.num_columns))])


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, carried: list[str]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        places = [str(batch.schema.get_field_index(c)) for c in carried]
        for part, data, offsets in chunks(prefixed(batch), "text", lower=False):
            ids, at = encoder.encode(data, offsets)
            back, ends = decode_rows(ids, at, encoder.voc)
            full = np.diff(offsets) > 0
            want = np.ones(len(data), dtype=bool)
            want[offsets[:-1][full]] = False
            want = data[want]
            same = np.diff(ends) == np.diff(offsets) - full
            if len(want) == len(back) and same.all():
                wrong = np.concatenate([[0], np.cumsum(want != back)])
                same = wrong[ends[1:]] == wrong[ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(k) for k in places),
                    pa.array(np.diff(at)),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                    pa.array(same),
                ],
                [*carried, *RESULT],
            )


RESULT = ["n_tokens", "token_ids", "decodes_back"]


def encode(docs: DataFrame, path: str = MODEL, carried: list[str] | None = None) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decodes_back) of docs(doc_id, text), or the carried columns in the place of doc_id."""
    carried = carried or ["doc_id"]
    found = StructType.fromDDL("n_tokens long, token_ids array<int>, decodes_back boolean")
    schema = StructType([docs.schema[c] for c in carried] + found.fields)
    return docs.select(*dict.fromkeys([*carried, "text"])).mapInArrow(lambda b: encode_batches(b, path, carried), schema)


def _decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    voc = vocabulary(path)
    for batch in batches:
        lists = batch.column("token_ids")
        lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        data, ends = decode_rows(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at, voc)
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of tokens(doc_id, token_ids); null ids decode to an empty text."""
    return tokens.select("doc_id", "token_ids").mapInArrow(lambda b: _decode_batches(b, path), "doc_id long, text string")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
