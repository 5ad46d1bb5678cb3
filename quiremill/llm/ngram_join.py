"""N-gram Jaccard join by parity sketches, and the classes that its links make.

A document's set holds the 64-bit hashes of its distinct shingles of ``SHINGLE`` words; documents with one set are one
node (the hash of the set). If two sets have a Jaccard similarity of at least num / den, their symmetric difference is
at most d = (den - num) * (a + b) / (den + num) for sizes a and b. Sizes are cut into bands; a node is sketched for its own
band and for each above that may hold a partner, so that every pair meets in the band of its larger set, under one d.

A band's sketch has ceil((d + 1) / 2) blocks of three words; each shingle flips one of a word's 2 ** 64 bits, the one that its hash names, and a word is held as the XOR of the hashes whose bits are set: few
shingles fall on a word, and words of 64 bits, of which two say little with two or three bits set, would be shared by ever more unrelated sets as the corpus grows. A differing bit needs a shingle that only one
set has, so the Hamming distance is at most d, and some block differs in one bit at most. Of that block's three words two are equal: blocks are joined on each two of their words. No partner
within d can be missed. A set smaller than its band's largest is further from none of its partners than a smaller d, so that more blocks differ in one bit at most; of those
beyond one, half may be left out by either of two partners, and a set leaves out blocks with the fewest bits. Two words with a bit at most say little (one passage that many documents share), and unrelated sets would share them: up to ``LOW`` bits the third word joins the key, as it is and with each of its bits
cleared, since the partner's differs in one bit at most. Where no bit is left at all the key is joined by each of a set's least shingles, of which similar sets share one: the n - ceil(J * n) + 1 least ones of n.
A set with ``SURE`` blocks of two bits or more goes without these last keys: at most two differences fall on a block on average, so that each block differs in one bit at most with a probability
of 0.4 (less those that say nothing), and none of 48 with 1e-10.

Nodes that share a key form a run. Keys are counted first, by cells, so that those of heavy cells are dealt into ``SALTS`` runs each, whose centres are made one afterwards: no
task gets more of a run than its share. First each node is verified against one centre, the least node of a run with which it shares
most keys; the links make classes. Two nodes of a run are both in the group of the run's centre. Groups that still hold
several classes are compared by larger sketches, in tiles of bounded size; the nodes whose Hamming distance to one of another class
allows a link meet again in their tiles with their texts, and a tile gives the links that join its classes, never
its pairs. Tiles are bounded by rows and by shingles. Verification counts the whole sets of whole texts.

Shingles and sets are hashed to 64 bits, keys to 56. Keys only find candidates; two sets with one hash would be taken for one, of which the chance is n * n / 2 ** 65 for n sets.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import BLOCKS, added, begin, checkpointed, packed, release, small, with_small
from quiremill.llm.components import components

SHINGLE = 4
NUM, DEN = 85, 100
RATIO = 1.3
#: Bits of two words that are few, and blocks that say something of which one is good enough as surely as hashes differ.
LOW, SURE = 1, 48
#: Bits of a key that are kept: 56, so that a shuffled row takes a byte less. Of 1e13 keys (some 100 TB) one in 7,000 is met by chance, which costs a comparison.
KEY = np.uint64(~0xFF & (1 << 64) - 1)
TILE = 512
#: Shingles of a tile's part, on average at most; their hashes and texts take some 16 bytes each.
TILE_SHINGLES = 500_000
#: Cells in which keys are counted, and runs into which a key of a heavy cell is dealt. A cell is heavy above twice the mean and ``HEAVY``.
CELLS, CELL_BLOCK = 1 << 16, 1 << 12
SALTS = 64
HEAVY = 1000
PART = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


#: Bytes of a text that are hashed at once; a stretch ends at white space, or grows until it does.
STRETCH = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)[_LOWER]
_BASE = 0xF1357AEA2E62A9C5
_STEPS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2 ** 64."""
    if len(_STEPS.get("up", ())) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _STEPS[name] = np.multiply.accumulate(steps)
    return _STEPS["up"][:n], _STEPS["down"][:n]


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text: polynomials over random values of its lower-cased bytes, from differences of one running sum."""
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + STRETCH)
        while end < len(raw) and not _SPACE[raw[end]] and not _SPACE[raw[end - 1]]:
            cut = end
            while cut > at and not _SPACE[raw[cut - 1]]:
                cut -= 1
            end = cut if cut > at else min(len(raw), end + STRETCH)
        b = np.frombuffer(raw, np.uint8, end - at, at)
        blank = np.ones(len(b) + 2, np.int8)
        blank[1:-1] = _SPACE[b]
        edge = np.diff(blank)
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _powers(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * up[1:], out=total[1:])
        out.append(_mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles. A word is a run without ASCII white space, A-Z lower-cased."""

    def __init__(self, size: int = SHINGLE):
        self.size = size

    def __call__(self, text: str | None) -> np.ndarray:
        h = word_hashes((text or "").encode("utf-8", "surrogatepass"))
        if not len(h):
            return h
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            out = out * _ODD + h[k : len(h) - size + 1 + k]
        out = np.sort(_mix(out))
        new = np.ones(len(out), bool)
        np.not_equal(out[1:], out[:-1], out=new[1:])
        return out[new]


def _xored(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` words the XOR of the values that fall on it; ``at``, their words, ascends."""
    words = np.zeros(size, np.uint64)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    words[at[start]] = np.bitwise_xor.reduceat(values, start)
    return words


def _flips(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Words of 64 bits in which each hash has flipped the bit of its low digits, in word ``at`` (ascending)."""
    return _xored(np.uint64(1) << (h & np.uint64(63)), at, size)


def node_of(h: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes()))))


@functools.cache
def bands(ratio: float = RATIO, top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """First and last size of each band."""
    lows = [1]
    while lows[-1] < top:
        lows.append(max(lows[-1] + 1, math.ceil(lows[-1] * ratio)))
    lows = np.array(lows, np.int64)
    return lows[:-1], lows[1:] - 1


def difference(a: int, b: int, num: int = NUM, den: int = DEN) -> int:
    """The largest symmetric difference of sets of these sizes that are similar enough."""
    return (den - num) * (a + b) // (den + num)


def sketch_keys(h: np.ndarray, num: int = NUM, den: int = DEN, ratio: float = RATIO) -> np.ndarray:
    """Join keys of a set in its own band and those above that may hold larger partners."""
    lows, highs = bands(ratio)
    n, out = len(h), []
    first = int(np.searchsorted(lows, n, "right")) - 1
    last = int(np.searchsorted(lows, n * den // num, "right")) - 1
    for band in range(first, last + 1):
        d = difference(int(highs[band]), int(highs[band]), num, den)
        if not d:
            continue  # only equal sets link, and those are one node
        blocks = (d + 2) // 2
        at = (((h >> np.uint64(32)) * np.uint64(3 * blocks)) >> np.uint64(32)).astype(np.int64)
        begin = np.searchsorted(at, np.arange(3 * blocks + 1))
        w, bits = _xored(h, at, 3 * blocks).reshape(blocks, 3), np.diff(begin).reshape(blocks, 3)
        spare = (blocks - difference(n, min(int(highs[band]), n * den // num), num, den) // 2 - 1) // 2
        kept = np.argsort(bits.sum(1), kind="stable")[spare:] if spare > 0 else np.arange(blocks)
        w, bits = w[kept], bits[kept]
        tag = ((kept.astype(np.uint64) << np.uint64(20)) | np.uint64(band << 2))[:, None] | np.arange(3, dtype=np.uint64)
        keys = _mix(_mix(w[:, [0, 0, 1]].ravel() + tag.ravel() * _ODD) + w[:, [1, 2, 2]].ravel())
        two, third = (bits[:, [0, 0, 1]] + bits[:, [1, 2, 2]]).ravel(), w[:, [2, 1, 0]].ravel()
        few = two <= LOW
        out.append(keys[~few])
        keys, two, third = keys[few], two[few], third[few]
        word = (kept[:, None] * 3 + [2, 1, 0]).ravel()[few]
        held = begin[word + 1] - begin[word]
        each = np.repeat(np.arange(len(word)), held)
        bit = h[begin[word][each] + np.arange(len(each)) - np.repeat(np.cumsum(held) - held, held)]
        more = np.concatenate([_mix(keys + _mix(third + _ODD)), _mix(keys[each] + _mix((third[each] ^ bit) + _ODD))])
        empty = np.concatenate([(two == 0) & (held == 0), (two[each] == 0) & (held[each] == 1)])
        out.append(more[~empty])
        if empty.any() and (bits.sum(1) > 1).sum() < SURE:
            least = h[: n - -(-num * n // den) + 1]
            out.append(_mix(np.unique(more[empty])[:, None] + least * _ODD).ravel())
    return (np.concatenate(out) & KEY).view(np.int64) if out else np.empty(0, np.int64)


def parity(h: np.ndarray) -> bytes:
    """A sketch of a power of two of bits, at least the shingles and 512. Half as many bits: neighbouring words XORed."""
    words = max(8, 1 << max(0, (len(h) - 1).bit_length() - 6))
    at = h >> np.uint64(64 - (words.bit_length() - 1))
    return _flips(h, at.astype(np.int64), words).tobytes()


def fold(x: np.ndarray, width: int) -> np.ndarray:
    """Sketches (rows of words) brought to ``width`` words."""
    while x.shape[1] > width:
        x = x[:, 0::2] ^ x[:, 1::2]
    return x


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("ngram_join")
        shingles = Shingler(size)
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), batch.column(2), pa.array([parity(s) if len(s) else None for s in sets], pa.binary()), *batch.columns[3:]], names=["id", "n", "node", "h", "sketch", "key"][: 5 + batch.num_columns - 3])

    return run


def _each_keys(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """(node, keys) of the batches' sets; copies within a task give their keys once."""
    begin("ngram_join")
    shingles, seen = Shingler(size), set()
    for batch in batches:
        for text in batch.column(0):
            s = shingles(text.as_py())
            if len(s) and (node := node_of(s)) not in seen:
                seen.add(node)
                yield node, sketch_keys(s, num, den)


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _counts(size: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held = np.zeros(CELLS, np.int64), [], 0
        for _, k in _each_keys(batches, size, num, den):
            waiting.append(k)
            held += len(k)
            if held > 200_000:
                counts += np.bincount(_cell(np.concatenate(waiting)), minlength=CELLS)
                waiting, held = [], 0
        if held:
            counts += np.bincount(_cell(np.concatenate(waiting)), minlength=CELLS)
        yield packed(dict(enumerate(counts.reshape(-1, CELL_BLOCK))))

    return run


def heavy_cells(docs: DataFrame, size: int, num: int, den: int) -> np.ndarray:
    """Which cells hold so many keys that some key of theirs may be shared by very many nodes, as one of ``PART`` texts, by their hash, says. Runs depend on it for their size only: no result does."""
    counts = np.zeros((CELLS // CELL_BLOCK, CELL_BLOCK), np.int64)
    part = docs.where(F.pmod(F.xxhash64("text", F.lit("part")), F.lit(PART)) == 0)
    for r in added(part.select("text").mapInArrow(_counts(size, num, den), BLOCKS)).collect():  # CELLS / CELL_BLOCK rows at most
        counts[r.block] += np.frombuffer(r.counts, np.int64)
    counts = counts.ravel() * PART
    return counts > max(2 * counts.mean(), HEAVY)


#: A run's name: a key with its last bit cleared; of a heavy key moved by its salt, with the last bit set.
_MOVE = np.uint64(0xB5026F5AA96619E8)


def _salt(node: np.ndarray) -> np.ndarray:
    return (_mix(node.view(np.uint64)) % np.uint64(SALTS) + np.uint64(1)) * _MOVE


def run_names(key: np.ndarray, node: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    plain = key.view(np.uint64) & ~np.uint64(1)
    return np.where(heavy[_cell(key)], plain + _salt(node) | np.uint64(1), plain).view(np.int64)


def key_of(run: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The key (but for its last bit) of a run of a heavy one."""
    return ((run.view(np.uint64) & ~np.uint64(1)) - _salt(node)).view(np.int64)


def _keys(size: int, num: int, den: int, heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0

        def full():
            node = np.concatenate(nodes)
            return pa.RecordBatch.from_arrays([pa.array(run_names(np.concatenate(keys), node, heavy)), pa.array(node)], names=["run", "node"])

        for node, k in _each_keys(batches, size, num, den):
            keys.append(k)
            nodes.append(np.full(len(k), node, np.int64))
            held += len(k)
            if held > 200_000:
                yield full()
                keys, nodes, held = [], [], 0
        if held:
            yield full()

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by run and node: rows of runs of two nodes or more, with the run's least node as centre; streamed, whatever a run's length. Runs of heavy keys are given even if they have one node, with their key."""
    last_run = last_node = centre = None
    told = True
    for batch in batches:
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        if last_run is not None:
            key, node = np.concatenate([[last_run], key]), np.concatenate([[last_node], node])
        begins = np.ones(len(key), bool)
        begins[1:] = key[1:] != key[:-1]
        again = np.zeros(len(key), bool)
        again[1:] = ~begins[1:] & (node[1:] == node[:-1])
        start = np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
        c = node[start].copy()
        skip = np.zeros(len(key), bool)
        if last_run is not None:
            c[start == 0] = centre
            skip[0] = True
        member = ~begins & ~again & ~skip
        heavy = key & 1 == 1
        # The centre's own row is told when the first other member turns up; that of a heavy key at once.
        firsts = np.unique(start[member & ~heavy])
        own = firsts if last_run is None else np.array([s for s in firsts if s != 0 or not told], np.int64)
        own = np.union1d(own, np.flatnonzero(begins & heavy & ~skip)).astype(np.int64)
        at = np.flatnonzero(member)
        if len(at) or len(own):
            rows, nodes = np.concatenate([own, at]), np.concatenate([c[own], node[at]])
            h = heavy[rows]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(c[rows]), pa.array(np.where(h, key_of(key[rows], nodes), 0), mask=~h)], names=["node", "centre", "heavy"])
        same = start[-1] == 0 and last_run is not None
        told = (told if same else False) or bool(member[start == start[-1]].any())
        last_run, last_node, centre = key[-1], node[-1], c[-1]


def _verified(size: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            good, last, held = np.zeros(len(a), bool), None, None
            for i, (s, t) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                if a[i] != last:
                    last, held = a[i], shingles(s.as_py())
                other = shingles(t.as_py())
                both = len(np.intersect1d(held, other, assume_unique=True))
                good[i] = den * both >= num * (len(held) + len(other) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["u", "v"])

    return run


def _plausible(num: int, den: int):
    """Over rows (u, v, n_u, n_v, sketch_u, sketch_v): the pairs whose sizes and sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ok = den * np.minimum(a, b) >= num * np.maximum(a, b)
            for i in np.flatnonzero(ok):
                p, q = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64)[None, :] for c in (4, 5))
                width = min(p.shape[1], q.shape[1])
                far = int(np.bitwise_count(fold(p, width) ^ fold(q, width)).sum())
                ok[i] = far * (den + num) <= (den - num) * int(a[i] + b[i])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["u", "v"])

    return run


def _tiles(solve):
    """Calls ``solve`` on each run of rows of one (centre, tile), over rows sorted by these; what it yields are columns of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _ended(batches):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                rest = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            if rest is None or not rest.num_rows:
                continue
            centre, tile = rest.column("centre").to_numpy(), rest.column("tile").to_numpy()
            ends = (np.flatnonzero((centre[1:] != centre[:-1]) | (tile[1:] != tile[:-1])) + 1).tolist()
            if batch is None:
                ends.append(rest.num_rows)
            lo = 0
            for hi in ends:
                if hi - lo > 1 and (out := solve(rest.slice(lo, hi - lo))) is not None:
                    yield out
                lo = hi
            rest = rest.slice(lo)

    return run


def _partners(i: int, n, part, cross: bool, sketches: dict, width, at: dict, num: int, den: int) -> np.ndarray:
    """Rows after row i whose sizes and sketches allow a link with it; in a tile of two parts, of the other part."""
    found = []
    for x, rows in at.items():
        rows = rows[(rows > i) & (den * np.minimum(n[rows], n[i]) >= num * np.maximum(n[rows], n[i]))]
        if cross:
            rows = rows[part[rows] != part[i]]
        if len(rows):
            w = min(x, width[i])
            own = fold(sketches[width[i]][np.searchsorted(at[width[i]], i)][None, :], w)
            far = np.bitwise_count(fold(sketches[x][np.searchsorted(at[x], rows)], w) ^ own).sum(1)
            found.append(rows[far * (den + num) <= (den - num) * (n[rows] + n[i])])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _stacked(raw: list[np.ndarray]) -> tuple[np.ndarray, dict, dict]:
    width = np.array([len(x) for x in raw])
    at = {int(w): np.flatnonzero(width == w) for w in np.unique(width)}
    return width, at, {w: np.stack([raw[i] for i in rows]) for w, rows in at.items()}


def _flagged(num: int, den: int):
    """The rows of a tile that may link with a row of another class."""

    def solve(t: pa.Table):
        n, label, part = (t.column(c).to_numpy() for c in ("n", "label", "part"))
        width, at, sketches = _stacked([np.frombuffer(x, np.uint64) for x in t.column("sketch").to_pylist()])
        cross, keep = bool(t.column("cross")[0].as_py()), np.zeros(len(n), bool)
        for i in range(len(n)):
            j = _partners(i, n, part, cross, sketches, width, at, num, den)
            j = j[label[j] != label[i]]
            if len(j):
                keep[i] = True
                keep[j] = True
        if keep.any():
            return t.select(["centre", "tile", "node", "label", "part", "cross"]).filter(pa.array(keep)).combine_chunks().to_batches()[0]

    return _tiles(solve)


def _tile_links(size: int, num: int, den: int):
    """Links between the classes of a tile, found by whole sets: one for each two classes that it joins, never its pairs."""
    shingles = Shingler(size)

    def solve(t: pa.Table):
        node, label, part = (t.column(c).to_numpy() for c in ("node", "label", "part"))
        sets = [shingles(x.as_py()) for x in t.column("text")]
        n = np.array([len(x) for x in sets])
        width, at, sketches = _stacked([np.frombuffer(parity(x), np.uint64) for x in sets])
        cross, root, out = bool(t.column("cross")[0].as_py()), label.copy(), []
        for i in range(len(n)):
            for j in _partners(i, n, part, cross, sketches, width, at, num, den):
                if root[i] == root[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if den * both >= num * (n[i] + n[j] - both):
                    root[root == root[j]] = root[i]
                    out.append((node[i], node[j]))
        if out:
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["u", "v"])

    return _tiles(solve)


def _ended(batches):
    yield from batches
    yield None


def _verify(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v) of nodes whose whole sets are similar enough; a text moves once to its node and once to each pair of which it is v."""
    v = pairs.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v")
    both = v.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(_verified(size, num, den), "u long, v long")


def _node_texts(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text), one text for each node of ``pairs``: that of the document which stands for it."""
    wanted = reps.join(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "node", "left_semi")
    at = checkpointed(wanted.select(F.col("rep.id").alias("rep_id"), F.col("rep.h").alias("rep_h"), "node"))
    found = checkpointed(docs.join(at, docs["id"].eqNullSafe(at["rep_id"]) & (docs["h"] == at["rep_h"])).select("node", "text"))
    one = found.groupBy("node").count().where("count > 1").take(1)  # rows that are repeated
    return checkpointed(found.dropDuplicates(["node"])) if one else found


def similar_classes(df: DataFrame, size: int = SHINGLE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row per row of ``df``: id, n_shingles (size of its set) and component_id (smallest id reachable by links, itself included).

    Null and empty texts and those without words have no shingles and link with nothing. Very long texts are hashed by stretches, as a whole. Rows with one set are linked,
    repeated rows among them; of centres that tie in shared keys the least node counts, which no result depends on; rows that share an id are each classed by their own text. Null ids never give a class its
    name unless all its ids are null. An empty table gives no rows; other columns are ignored.
    """
    out = classes_of(df, size, num, den, id_col, text_col, tile)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def representatives(df: DataFrame, key: str, size: int = SHINGLE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(id, ``key``, rows) of what stays if one row of each class does: the one with the least id, then the least key; null ids come last. Rows of one id and key are one here, and ``rows`` says how many they are.

    Rows without words are in no class and all stay; of them, rows is 1.
    """
    out = classes_of(df, size, num, den, id_col, text_col, tile, key)
    alone = out.where("class is null").select("id", "key").distinct().withColumn("rows", F.lit(1).cast("long"))
    one = F.struct(F.col("id").isNull().alias("null"), "id", "key")
    counted = out.where("class is not null").groupBy("class", "id", "key").agg(F.count(F.lit(1)).alias("rows"))
    kept = counted.groupBy("class").agg(F.min_by("rows", one).alias("rows"), F.min(one).alias("r")).select("r.id", "r.key", "rows")
    return kept.unionByName(alone).select(F.col("id").alias(id_col), F.col("key").alias(key), "rows")


def classes_of(df: DataFrame, size: int, num: int, den: int, id_col: str, text_col: str, tile: int, key: str | None = None) -> DataFrame:
    """id, n, class (null without words), component_id (least id of the class), and ``key`` as key if one is given (a long)."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([F.col(key).alias("key")] if key else [])).withColumn("h", F.xxhash64("text"))
    kind = dict(docs.dtypes)["id"]
    slim = checkpointed(docs.select("id", "text", "h", *(["key"] if key else [])).mapInArrow(_sets(size), f"id {kind}, n long, node long, h long, sketch binary" + (", key long" if key else "")))

    known = F.struct(F.col("id").isNull().alias("null"), "id", "h")
    nodes = slim.where("node is not null").groupBy("node").agg(F.min(known).alias("rep"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    nodes = checkpointed(nodes)
    reps, sketches = nodes.select("node", "rep"), nodes.select("node", "n", "sketch")

    # Runs of nodes that share a key, and the first links.
    keyed = docs.select("text").mapInArrow(_keys(size, num, den, heavy_cells(docs, size, num, den)), "run long, node long")
    found = checkpointed(keyed.repartition("run").sortWithinPartitions("run", "node").mapInArrow(_runs, "node long, centre long, heavy long"))
    tops = checkpointed(found.where("heavy is not null").groupBy("heavy").agg(F.min("centre").alias("top")))
    dealt = found.where("heavy is not null").join(small(tops), "heavy").select("node", F.col("top").alias("centre"))
    runs = found.where("heavy is null").select("node", "centre").unionAll(dealt)
    release(spark)
    # By node once: its centres, of which a text's keys bound the number, and the one with which it shares most keys.
    most = F.max(F.when(F.col("node") != F.col("centre"), F.struct("count", F.bitwise_not("centre").alias("c"))))
    met = checkpointed(runs.repartition("node").groupBy("node", "centre").count().groupBy("node").agg(most.alias("most"), F.collect_list("centre").alias("centres")))
    first = met.where("most is not null").select(F.bitwise_not("most.c").alias("u"), F.col("node").alias("v"))
    side = lambda x: sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    near = first.join(side("v"), "v").join(side("u"), "u").select("u", "v", "n_u", "n_v", "sketch_u", "sketch_v").mapInArrow(_plausible(num, den), "u long, v long")
    near = checkpointed(near)
    links = checkpointed(_verify(near, _node_texts(docs, reps, near), size, num, den))
    release(spark)
    classes = components(links)

    # What is left: two nodes of one run that are still in different classes. Runs of one centre are one group: both nodes are in it.
    labels = nodes.join(classes, "node", "left").select("node", "n", F.coalesce("component", "node").alias("label"))
    labelled = checkpointed(met.select("node", "centres").join(labels, "node").select(F.explode("centres").alias("centre"), "node", "label", "n"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / tile, F.sum("n") / TILE_SHINGLES)).cast("int")
    split = labelled.groupBy("centre").agg(F.min("label").alias("a"), F.max("label").alias("b"), parts.alias("parts")).where("a <> b").select("centre", "parts")
    rows = with_small(labelled, checkpointed(split), "centre", "node").withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("centre", (F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).cast("long").alias("tile"), "node", "label", "part", (F.col("part") != F.col("other")).cast("int").alias("cross"))
    tiled = rows.join(sketches, "node").select("centre", "tile", "node", "label", "part", "cross", "n", "sketch").repartition("centre", "tile").sortWithinPartitions("centre", "tile")
    flagged = checkpointed(tiled.mapInArrow(_flagged(num, den), "centre long, tile long, node long, label long, part int, cross int"))
    release(spark)
    if flagged.take(1):
        texts = _node_texts(docs, reps, flagged.select(F.col("node").alias("u"), F.col("node").alias("v")))
        whole = flagged.join(texts, "node").select("centre", "tile", "node", "label", "part", "cross", "text").repartition("centre", "tile").sortWithinPartitions("centre", "tile")
        more = checkpointed(whole.mapInArrow(_tile_links(size, num, den), "u long, v long"))
        classes = components(links.unionAll(more))

    named = reps.join(classes, "node", "left").select("node", F.col("rep.id").alias("rep"), F.coalesce("component", "node").alias("class"))
    # A class is named by its least id; nulls come last.
    least = named.groupBy("class").agg(F.min("rep").alias("component_id"))
    named = checkpointed(named.join(least, "class").select("node", "class", "component_id"))
    return slim.select("id", "n", "node", *(["key"] if key else [])).join(named, "node", "left").drop("node")
