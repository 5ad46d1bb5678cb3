"""Byte-level BPE encoding and decoding by DuckDB recursive queries, one database per Python worker.

A text is cut by the tokenizer's pattern; each distinct piece of a partition is encoded once. Encoding starts from a piece's bytes
as tokens. Each step of the recursive query unfolds a piece's tokens into rows by position, joins each token and the
next to the merge table, and takes per piece the smallest (rank, position). Words of up to ``SHORT`` bytes contract that one pair a step (``STEP``).
In longer rows (``ENCODE``), where a step a pair would cost the square of their length, a rank that is met once is contracted alike; one that is met more often, at each non-overlapping occurrence from the left, which is what contracting them one by one comes to: a pair of the
merged token and a neighbour can have a smaller rank only if the longer token doesn't come of its own bytes by merges up to its rank, and the merged
tokens of which that holds (none in the usual vocabularies; ``Codec`` looks) are contracted one at a time. A piece without a pair leaves
the recursion, which keeps the newest tokens of a piece only. Decoding joins tokens to the vocabulary and adds up their bytes by an ordered aggregation.

Pieces are parted where two bytes stand that no token holds side by side, since no merge crosses that place. What is longer than ``WINDOW``
bytes after that is contracted by windows: the next one begins where a token of the last one ends, and the tokens on both sides of that
place must be what the two of them encode to. Tokens of which this holds for each two neighbours are what the whole
encodes to: the first merge across one of their bounds would be one of the two tokens' own, too. Where it doesn't hold, the window before is given up by a token, and the next one is longer.
So memory is bounded by bytes, whatever a piece's length.
"""

from __future__ import annotations

import base64
import os
import sys
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import begin, with_fields

#: Bytes that are contracted as one row.
WINDOW = 1 << 16
#: Bytes (of pieces) or four times as many tokens in one query.
BLOCK = 1 << 18
#: Tokens at a window's end that the next window reads again, since what follows may change them.
AGAIN = 16
#: Bytes that a worker remembers of pieces, at most; then those stay that were met most often, up to half of it.
CACHED = 64 << 20
#: Bytes that a piece takes besides its own, its ids and its decoded text: entries of the dictionary and of the arrays, and a number.
ENTRY = 120
#: Pieces, and four times as many characters of new ones, that wait to be encoded together.
WAITING = 1_000_000
#: Characters of a text that are cut at once.
STRETCH = 1 << 20

#: Bytes of a row of which one pair is contracted a step.
SHORT = 64

STEP = """
with recursive r(w, ts) as (
    select w, ts from pieces
    union all
    select r.w, list_concat(list_append(ts[:(best & 1048575) - 1], (best >> 20)::int), ts[(best & 1048575) + 2:])
    from r join (
        select w, min((merged::bigint << 20) | p) as best
        from (select w, unnest(ts[:-2]) as a, unnest(ts[2:]) as b, unnest(range(1, len(ts))) as p from r)
        join merges on pair = (a::bigint << 20) | b
        group by w
    ) x on r.w = x.w
)
select w, arg_min(ts, len(ts)) as ids from r group by w order by w
"""
ENCODE = """
with recursive r(w, ts) using key (w) as (
    select w, ts from pieces
    union
    (with best as materialized (
        select w, min((merged::bigint << 28) | (one::bigint << 27) | p, 2) as m
        from (select w, unnest(ts[:-2]) as a, unnest(ts[2:]) as b, unnest(range(1, len(ts))) as p from r)
        join merges on pair = (a::bigint << 20) | b
        group by w
    ), step as (
        select w, (m[1] >> 28)::int as merged, (m[1] & 134217727)::int as p, coalesce(m[1] >> 27 = m[2] >> 27 and (m[1] >> 27) & 1 = 0, false) as more from best
    ), hits as (
        select w, merged, p, row_number() over (partition by w order by p) as n
        from (select w, unnest(ts[:-2]) as a, unnest(ts[2:]) as b, unnest(range(1, len(ts))) as p from r where w in (select w from step where more))
        join merges on pair = (a::bigint << 20) | b
        join (select w, merged from step where more) using (w, merged)
    ), chosen as (
        select w, p, merged from (select w, p, merged, row_number() over (partition by w, p - n order by p) as k from hits) where k % 2 = 1
    )
    select r.w, list_concat(list_append(ts[:p - 1], merged), ts[p + 2:]) from r join step using (w) where not more
    union all
    select u.w, list(coalesce(c.merged, u.t) order by u.p)
    from (select w, unnest(ts) as t, unnest(range(1, len(ts) + 1)) as p from r where w in (select w from step where more)) u
    left join chosen c on c.w = u.w and c.p = u.p left join chosen d on d.w = u.w and d.p = u.p - 1
    where d.p is null group by u.w)
)
select w, ts as ids from r order by w
"""
#: The same with the merges up to a token's own rank, by which a row is named.
ORDERLY = ENCODE.replace("(a::bigint << 20) | b", "(a::bigint << 20) | b and merged <= w")
DECODE = """
select w, string_agg(hex, '' order by p) as hex
from (select w, unnest(ids) as id, unnest(range(len(ids))) as p from encoded) join vocabulary using (id)
group by w order by w
"""

#: From GPT-2's published tokenizer: the pattern that cuts text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _blocks(sizes: list[int], bound: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours whose sizes add up to ``bound`` at most, or one that is larger."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > bound:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _in_order(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of n rows, one after another, and how many each has, from parts: rows, their ids and how many these are."""
    counts = np.zeros(n, np.int64)
    for at, _, each in parts:
        counts[at] = each
    begins = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)
    for at, flat, each in parts:
        out[_ranges(begins[at], each)] = flat
    return out, counts


def _binaries(flat: np.ndarray | bytes, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


class _Pieces(dict):
    """The number of each piece that is known. One that is asked for first gets the next number and waits to be encoded."""

    def __init__(self, *known):
        super().__init__(*known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class Codec:
    """Encoder and decoder over a rank file (base64 token and rank a line)."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {i: t for t, i in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.forget()
        # Blocks are bounded by bytes; nothing is written to local folders. What a query has freed goes back at once.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": "", "allocator_flush_threshold": "1MB", "allocator_bulk_deallocation_flush_threshold": "1MB"})
        pairs, merged = [], []
        self.together = np.zeros((256, 256), bool)
        for t, rank in self.ranks.items():
            for i in range(1, len(t)):
                self.together[t[i - 1], t[i]] = True
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs.append(a << 20 | b)
                    merged.append(rank)
        pairs, merged = np.array(pairs, np.int64), np.array(merged, np.int32)
        self._table("vocabulary", pa.table({"id": pa.array(list(self.token), pa.int32()), "hex": pa.array([t.hex() for t in self.token.values()])}))
        # Which tokens don't come of their bytes by merges up to their rank, contracting one pair a step?
        self._table("merges", pa.table({"pair": pairs, "merged": merged, "one": np.ones(len(pairs), bool)}))
        tokens = sorted(self.token)
        odd = np.array([r for r, ids in zip(tokens, self._contract([self.token[r] for r in tokens], tokens, ORDERLY), strict=True) if len(ids) > 1], np.int32)
        inside = np.isin(merged, odd)
        a, b = pairs[inside] >> 20, pairs[inside] & ((1 << 20) - 1)
        alone = np.unique(np.concatenate([a[a > merged[inside]], b[b > merged[inside]]]))
        self._table("merges", pa.table({"pair": pairs, "merged": merged, "one": np.isin(merged, alone)}))

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"create or replace temp table {name} as select * from incoming")
        self.db.unregister("incoming")

    def _contract(self, rows: list[bytes], names: list[int] | None = None, query: str = ENCODE) -> list[np.ndarray]:
        """Token ids of each row by the recursive query, in blocks of ``BLOCK`` bytes or one row. names: ascending."""
        out: list[np.ndarray] = []
        for lo, hi in _blocks([len(x) for x in rows], BLOCK):
            ends = np.zeros(hi - lo + 1, np.int32)
            np.cumsum([len(x) for x in rows[lo:hi]], out=ends[1:])
            tokens = pa.array(self.single[np.frombuffer(b"".join(rows[lo:hi]), np.uint8)])
            self._table("pieces", pa.table({"w": pa.array(names[lo:hi] if names else range(hi - lo), pa.int32()), "ts": pa.ListArray.from_arrays(ends, tokens)}))
            ids = self.db.sql(query).to_arrow_table().column("ids").combine_chunks()
            flat, at = np.asarray(ids.values).astype(np.int32), np.asarray(ids.offsets)
            out += [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return out

    def _windows(self, row: bytes) -> np.ndarray:
        """Token ids of a row longer than a window."""
        out: list[int] = []
        at, room = 0, WINDOW
        while True:
            ids = self._contract([row[at : at + room]])[0]
            if out and len(self._contract([self.token[out[-1]] + self.token[int(ids[0])]])[0]) != 2:
                at -= len(self.token[out.pop()])
                room *= 2
                continue
            if at + room >= len(row):
                return np.array([*out, *ids], np.int32)
            kept = [int(x) for x in ids[:-AGAIN]] if len(ids) > AGAIN else []
            if not kept:
                room *= 2
                continue
            out += kept
            at += sum(len(self.token[x]) for x in kept)
            room = WINDOW

    def _contract_parts(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, query: str) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of stretches of ``raw``, one after another, and how many each has; in blocks of ``BLOCK`` bytes or one stretch."""
        flat, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for lo, hi in _blocks(sizes.tolist(), BLOCK):
            ends = np.concatenate([[0], np.cumsum(sizes[lo:hi])])
            tokens = pa.array(self.single[raw[_ranges(starts[lo:hi], sizes[lo:hi])]])
            self._table("pieces", pa.table({"w": pa.array(np.arange(hi - lo, dtype=np.int32)), "ts": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), tokens)}))
            ids = self.db.sql(query).to_arrow_table().column("ids").combine_chunks()
            at = np.asarray(ids.offsets)
            flat.append(np.asarray(ids.values)[at[0] : at[-1]].astype(np.int32))
            counts.append(np.diff(at).astype(np.int64))
        return np.concatenate(flat), np.concatenate(counts)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces, one after another, and how many each has; of a piece that is a token, that one. ``BLOCK`` bytes of pieces, or one, are parted at a time."""
        found = [self._merge(pieces[lo:hi]) for lo, hi in _blocks([len(p) for p in pieces], BLOCK)]
        return np.concatenate([np.empty(0, np.int32), *(x for x, _ in found)]), np.concatenate([np.empty(0, np.int64), *(x for _, x in found)])

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int32, len(pieces))
        left = np.flatnonzero(whole < 0)
        own = np.flatnonzero(whole >= 0)
        raw = np.frombuffer(b"".join([pieces[i] for i in left]), np.uint8)
        first = np.concatenate([[0], np.cumsum([len(pieces[i]) for i in left], dtype=np.int64)]).astype(np.int64)
        bounds = np.union1d(np.flatnonzero(~self.together[raw[:-1], raw[1:]]) + 1, first)
        starts, sizes = bounds[:-1], np.diff(bounds)
        one, short = np.flatnonzero(sizes == 1), np.flatnonzero((sizes > 1) & (sizes <= min(SHORT, WINDOW)))
        long, longer = np.flatnonzero((sizes > max(1, SHORT)) & (sizes <= WINDOW)), np.flatnonzero((sizes > WINDOW) & (sizes > 1))
        parts = [(one, self.single[raw[starts[one]]], np.ones(len(one), np.int64))]
        parts += [(at, *self._contract_parts(raw, starts[at], sizes[at], query)) for at, query in ((short, STEP), (long, ENCODE))]
        for i in longer:
            ids = self._windows(raw[starts[i] : starts[i] + sizes[i]].tobytes())
            parts.append((np.array([i]), ids, np.array([len(ids)])))
        flat, counts = _in_order(parts, len(sizes))
        ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(bounds, first)]
        return _in_order([(own, whole[own], np.ones(len(own), np.int64)), (left, flat, np.diff(ends))], len(pieces))

    def unmerge(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of lists of ids that stand one after another, by the ordered aggregation, and how many each list has; long lists by stretches."""
        bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)
        cuts = np.unique(np.concatenate([bounds, *(np.arange(bounds[i], bounds[i + 1], BLOCK) for i in np.flatnonzero(counts > BLOCK))]))
        raw, sizes = [], [np.zeros(1, np.int64)]
        for lo, hi in _blocks(np.diff(cuts).tolist(), BLOCK):
            lists = pa.ListArray.from_arrays(pa.array((cuts[lo : hi + 1] - cuts[lo]).astype(np.int32)), pa.array(ids[cuts[lo] : cuts[hi]].astype(np.int32)))
            self._table("encoded", pa.table({"w": pa.array(np.arange(hi - lo, dtype=np.int32)), "ids": lists}))
            hexes = self.db.sql(DECODE).to_arrow_table().column("hex").combine_chunks().cast(pa.large_string())
            at, buffer = np.frombuffer(hexes.buffers()[1], np.int64, hi - lo + 1) // 2, hexes.buffers()[2]
            raw.append(bytes.fromhex(buffer.to_pybytes()[: 2 * int(at[-1])].decode()))
            sizes.append(np.diff(at))
        return b"".join(raw), np.diff(np.cumsum(np.concatenate(sizes))[np.searchsorted(cuts, bounds)])

    def forget(self) -> None:
        """Drops the pieces that are known."""
        self.known, self.uses, self.held = _Pieces(), np.zeros(0, np.int64), 0
        self.ids, self.raw = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())

    def _learn(self) -> None:
        """Encodes and decodes the pieces that wait."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        flat, counts = self.merge([p.encode() for p in new])
        raw, sizes = self.unmerge(flat, counts)
        self.ids, self.raw = pa.concat_arrays([self.ids, _binaries(flat, 4 * counts)]), pa.concat_arrays([self.raw, _binaries(raw, sizes)])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.held += flat.nbytes + len(raw) + sum(map(sys.getsizeof, new)) + ENTRY * len(new)

    def _spare(self) -> None:
        """Keeps the pieces that were met most often, of ``CACHED / 2`` bytes at most."""
        least, pieces = 2, list(self.known)
        cost = np.diff(np.frombuffer(self.ids.buffers()[1], np.int64, len(pieces) + 1)) + np.diff(np.frombuffer(self.raw.buffers()[1], np.int64, len(pieces) + 1))
        cost += np.fromiter(map(sys.getsizeof, pieces), np.int64, len(pieces)) + ENTRY
        while int(cost[self.uses >= least].sum()) > CACHED // 2:
            least *= 2
        at = np.flatnonzero(self.uses >= least)
        self.known = _Pieces((pieces[i], k) for k, i in enumerate(at.tolist()))
        self.ids, self.raw, self.uses, self.held = self.ids.take(pa.array(at)), self.raw.take(pa.array(at)), self.uses[at] // 2, int(cost[at].sum())

    def stretches(self, text: str) -> Iterator[list[str]]:
        """The text's pieces, by stretches. A stretch ends with a whole piece: its last one is cut again with what follows."""
        at = 0
        while at < len(text):
            if len(text) - at <= STRETCH:
                yield self.pattern.findall(text, at)
                return
            room = STRETCH
            while True:
                pieces = self.pattern.findall(text, at, min(len(text), at + room))
                # Two pieces short of the end, nothing behind it can change the cut.
                if len(pieces) > 3 or at + room >= len(text):
                    break
                room *= 2
            if at + room < len(text):
                pieces = pieces[:-3]
            yield pieces
            at += sum(map(len, pieces))

    def round_trip(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian int32, decoded bytes) of each text."""
        out, parts, waiting, held = [], ([], []), [], 0

        def settle():
            nonlocal waiting, held
            self._learn()
            numbers = np.concatenate([np.empty(0, np.int32), *(n for _, n in waiting)])
            self.uses += np.bincount(numbers, minlength=len(self.uses))
            at, before = np.cumsum([0, *(len(n) for _, n in waiting)]), len(parts[0])
            for found, known in zip(parts, (self.ids, self.raw), strict=True):
                taken = known.take(pa.array(numbers))
                ends = np.frombuffer(taken.buffers()[1], np.int64, len(numbers) + 1)[at].tolist() if len(numbers) else [0] * len(at)
                flat = memoryview(taken.buffers()[2] or b"")
                found += [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            lo = 0
            for hi in [before + i + 1 for i, (last, _) in enumerate(waiting) if last]:
                out.append((b"".join(parts[0][lo:hi]), b"".join(parts[1][lo:hi])))
                lo = hi
            for found in parts:  # of the text that goes on
                found[:] = map(bytes, found[lo:])
            waiting, held = [], 0
            if self.held > CACHED:
                self._spare()

        try:
            for text in texts:
                for pieces in self.stretches(text):
                    before = len(self.known.new)
                    waiting.append((False, np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces))))
                    held += len(pieces) + sum(map(len, self.known.new[before:])) // 4
                    if held > WAITING:
                        settle()
                waiting.append((True, np.empty(0, np.int32)))
            settle()
        except BaseException:
            self.forget()
            raise
        return out


_codecs: dict[tuple, Codec] = {}


def codec(path: str, pattern: str = PATTERN) -> Codec:
    """This worker's codec for a rank file."""
    key = (os.getpid(), path, pattern)
    begin("bpe", _drop)
    if key not in _codecs:
        _drop()
        _codecs[key] = Codec(path, pattern)
    return _codecs[key]


def _drop() -> None:
    for c in _codecs.values():
        c.db.close()
    _codecs.clear()


def _ids_array(raw: list[bytes | None]) -> pa.Array:
    ends = np.zeros(len(raw) + 1, np.int32)
    np.cumsum([len(r or b"") // 4 for r in raw], out=ends[1:])
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(r or b"" for r in raw), np.int32)))


def round_trip(df: DataFrame, path: str, text_col: str = "text", pattern: str = PATTERN, ids_out: str = "ids", decoded_out: str = "decoded") -> DataFrame:
    """``df`` with the token ids of each whole text (ARRAY<INT>) and the bytes that decoding them gives (BINARY).

    Null and empty texts have no ids and decode to nothing. A very long text is cut by stretches and contracted by windows, so that only its ids
    and its bytes are held as a whole. Repeated rows each get their own output; there are no ties, as the leftmost pair goes first. An empty table
    gives no rows. Columns named like the outputs are replaced; all others are kept as they are. Text that looks like a special token is ordinary text.
    """
    rest = [c for c in df.columns if c not in (ids_out, decoded_out)]
    rows = df.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"))
    kept = rows.schema["_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(0)).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // (4 << 20))) + 1, [batch.num_rows]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                found = c.round_trip(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(1), _ids_array([x[0] for x in found]), pa.array([x[1] for x in found], pa.binary())], names=["_row", ids_out, decoded_out])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, with_fields(kept, f"`{ids_out}` array<int>, `{decoded_out}` binary")).select("_row.*", ids_out, decoded_out)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each row's token ids; null ids give null."""
    rest = [c for c in df.columns if c != out]
    rows = df.select(F.col(ids_col).cast("array<int>").alias("_ids"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("_row"))
    kept = rows.schema["_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            sizes = np.array([len(x or ()) for x in ids], np.int64)
            raw, n = c.unmerge(np.array([i for x in ids for i in x or ()], np.int32), sizes)
            ends = np.cumsum(n).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([raw[e - k : e] if x is not None else None for x, e, k in zip(ids, ends, n.tolist(), strict=True)], pa.binary())], names=["_row", out])

    return rows.mapInArrow(run, with_fields(kept, f"`{out}` binary")).select("_row.*", out)
