"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors of a label are first made one row with a count. Each such row gets one signature of ``bits`` signs in each
of ``tables`` tables; rows of a label with one signature form a bucket. Buckets above ``TILE`` rows are dealt into
tiles, so that every pair of a bucket meets in exactly one tile and no task holds more than about two tiles' rows. Only ids and
signatures travel to the tiles of all tables. A pair counts in the first table whose signatures agree, and all its signs must differ in few
enough places; rows with such a partner meet again in their tile with their vectors, and all their cosines are computed there in double
precision. A tile gives a count per row and one link per row to its local component, never its pairs.

Two vectors at the threshold share a table's signature with probability (1 - acos(threshold) / pi) ** bits. ``tables``
follows from ``bits`` and the share of such pairs that may be missed; pairs above the threshold are missed less. The number of signs in which a pair at the threshold differs
is binomial; the bound on it is passed with a hundredth of that probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import checkpointed, small
from quiremill.llm.components import components

THRESHOLD = 0.93
MISSED = 1e-5
TILE = 1024
#: Rows whose signs are compared with a tile's at once.
STRIP = 128


def plan_tables(n_rows: int, threshold: float = THRESHOLD, missed: float = MISSED) -> tuple[int, int]:
    """(bits, tables): about 32 rows a bucket if signs are even and labels ten, and few enough misses at the threshold."""
    bits = min(20, max(8, round(math.log2(max(1, n_rows) / 320))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log1p(-agree))


def most_signs(bits: int, tables: int, threshold: float = THRESHOLD, missed: float = MISSED) -> int:
    """The number of signs that a pair at the threshold exceeds with probability ``missed`` / 100 at most."""
    n, p = bits * tables, math.acos(threshold) / math.pi
    at, above = n, 0.0
    while at > 0:
        above += math.exp(math.lgamma(n + 1) - math.lgamma(at + 1) - math.lgamma(n - at + 1) + at * math.log(p) + (n - at) * math.log1p(-p))
        if above > missed / 100:
            break
        at -= 1
    return at


def planes(dim: int, bits: int, tables: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables)).astype(np.float32)


def _kind(bits: int) -> str:
    return "<u1" if bits <= 8 else "<u2" if bits <= 16 else "<u4"


def _signed(bits: int, tables: int):
    weights = 1 << np.arange(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            rid, vector = batch.column(0), batch.column(1)
            lengths = np.asarray(pa.compute.list_value_length(vector))
            sigs: list = [None] * batch.num_rows
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                x = np.asarray(vector.take(pa.array(at)).flatten(), dtype=np.float64).reshape(len(at), dim)
                x = (x / np.abs(x).max(1, keepdims=True)).astype(np.float32)
                h = held.setdefault(int(dim), planes(int(dim), bits, tables))
                s = ((x @ h) > 0).reshape(len(at), tables, bits) @ weights
                for k, i in enumerate(at):
                    sigs[i] = s[k].astype(_kind(bits)).tobytes()
            yield pa.RecordBatch.from_arrays([rid, pa.array(sigs, pa.binary())], names=["rid", "sigs"])

    return run


def _placed(bits: int, tables: int):
    """A row for each table: its bucket (a hash of table, label, length and signature)."""
    mix = np.uint64(0xD6E8FEB86659FD93)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rid, label = batch.column("rid").to_numpy(), batch.column("label").to_numpy().view(np.uint64)
            raw = batch.column("sigs")
            s = np.frombuffer(b"".join(x.as_py() for x in raw), _kind(bits)).reshape(len(rid), tables).astype(np.uint64)
            x = (s * np.uint64(tables) + np.arange(tables, dtype=np.uint64) ^ label[:, None]) * mix
            x = (x ^ (x >> np.uint64(32))) * mix
            bucket = (x ^ (x >> np.uint64(29))).view(np.int64)
            again = np.repeat(np.arange(len(rid)), tables)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel()), pa.array(np.tile(np.arange(tables, dtype=np.int16), len(rid))), pa.array(rid[again]), raw.take(pa.array(again))], names=["bucket", "table", "rid", "sigs"])

    return run


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _pairs(t: pa.Table, bits: int, tables: int, most: int, meets) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile (i < j, or i and j of the two sides) that ``meets`` allows, that agree in the tile's table first, and whose signs differ in ``most`` places at most."""
    n, table = t.num_rows, int(t.column("table")[0].as_py())
    s = np.frombuffer(b"".join(t.column("sigs").to_pylist()), _kind(bits)).reshape(n, tables)
    width = -(-s.dtype.itemsize * tables // 8) * 8
    signs = np.zeros((n, width), np.uint8)
    signs[:, : s.dtype.itemsize * tables] = np.ascontiguousarray(s).view(np.uint8)
    signs = signs.view(np.uint64)
    cross, side = bool(t.column("cross")[0].as_py()), t.column("side").to_numpy()
    a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(n), np.arange(n))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(0, len(a), STRIP):
        rows = a[lo : lo + STRIP]
        far = np.zeros((len(rows), len(b)), np.uint16)
        for w in range(signs.shape[1]):
            far += np.bitwise_count(signs[rows, w][:, None] ^ signs[b, w])
        x, y = np.nonzero(far <= most)
        i, j = rows[x], b[y]
        if not cross:
            i, j = i[i < j], j[i < j]
        ok = meets(i, j)
        i, j = i[ok], j[ok]
        first = (s[i, table] == s[j, table]) & ~(s[i, :table] == s[j, :table]).any(1)
        out.append((i[first], j[first]))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _near(bits: int, tables: int, most: int):
    """The rows of a tile that have a partner by signs."""

    def solve(t: pa.Table):
        i, j = _pairs(t, bits, tables, most, lambda i, j: slice(None))
        keep = np.zeros(t.num_rows, bool)
        keep[i] = keep[j] = True
        if keep.any():
            return t.select(["bucket", "tile", "table", "rid", "cross", "side"]).filter(pa.array(keep)).combine_chunks().to_batches()[0]

    return _tiles(solve)


def _linked(threshold: float, bits: int, tables: int, most: int):
    """Cosines of a tile's pairs: links per row, and one link per row to its local component."""

    def solve(t: pa.Table):
        label, size = t.column("label").to_numpy(), np.asarray(pa.compute.list_value_length(t.column("v").combine_chunks()))
        unit: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        place = np.zeros(t.num_rows, np.int64)
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            x = np.asarray(t.column("v").combine_chunks().take(pa.array(at)).flatten(), dtype=np.float64).reshape(len(at), dim)
            x = x / np.abs(x).max(1, keepdims=True)
            place[at] = np.arange(len(at))
            unit[int(dim)] = x / np.sqrt((x * x).sum(1, keepdims=True))

        def meets(i, j):
            ok = (label[i] == label[j]) & (size[i] == size[j])
            for dim, x in unit.items():
                at = np.flatnonzero(ok & (size[i] == dim))
                for lo in range(0, len(at), 4096):
                    k = at[lo : lo + 4096]
                    ok[k] = np.einsum("ij,ij->i", x[place[i[k]]], x[place[j[k]]]) >= threshold
            return ok

        i, j = _pairs(t, bits, tables, most, meets)
        if not len(i):
            return None
        rid, copies = t.column("rid").to_numpy(), t.column("copies").to_numpy()
        links = np.bincount(i, copies[j], len(rid)) + np.bincount(j, copies[i], len(rid))
        root = _local_roots(len(rid), i, j)
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(rid[at]), pa.array(links[at].astype(np.int64)), pa.array(rid[root[at]])], names=["rid", "links", "root"])

    return _tiles(solve)


def _tiles(solve):
    """Calls ``solve`` on each run of rows of one (bucket, tile), over rows sorted by these; what it gives is a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _ended(batches):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                rest = t if rest is None or not rest.num_rows else pa.concat_tables([rest, t]).combine_chunks()
            if rest is None or not rest.num_rows:
                continue
            bucket, tile = rest.column("bucket").to_numpy(), rest.column("tile").to_numpy()
            ends = (np.flatnonzero((bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])) + 1).tolist()
            if batch is None:
                ends.append(rest.num_rows)
            lo, found = 0, []
            for hi in ends:
                if hi - lo > 1 and (out := solve(rest.slice(lo, hi - lo))) is not None:
                    found.append(out)
                lo = hi
            if found:
                yield from pa.Table.from_batches(found).combine_chunks().to_batches()
            rest = rest.slice(lo)

    return run


def _ended(batches):
    yield from batches
    yield None


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, missed: float = MISSED, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """One row per row of ``df``: id, n_links (other rows linked to it), component_id (least id reachable, null ids last), kept (id = component_id).

    Vectors are compared only within one label and one length. A null label, a null, zero or empty vector, or one with
    a null or non-finite component links with nothing and is its own component. Rows repeated with one vector link with
    each other, and rows that tie in id are counted each; equal vectors are told by 128 bits of hashes. A cosine at the threshold is a link. An empty table
    gives no rows; columns other than the three are ignored.
    """
    vector = F.col(vector_col)
    rows = df.select(F.col(id_col).alias("id"), vector.alias("v"), F.col(label_col).alias("label"))
    fine = F.col("label").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    label = F.col("label").cast("string")
    rows = rows.select("id", "v", F.when(fine, F.xxhash64(label, "v")).alias("h1"), F.when(fine, F.xxhash64(F.lit(29), "v", label)).alias("h2"), F.xxhash64(label).alias("label"))
    reps = rows.where("h1 is not null").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.any_value("v").alias("v"), F.any_value("label").alias("label"))
    reps = checkpointed(reps.withColumn("rid", F.monotonically_increasing_id()))
    bits, tables = plan_tables(reps.count(), threshold, missed)
    most = most_signs(bits, tables, threshold, missed)

    signed = reps.select("rid", "v").mapInArrow(_signed(bits, tables), "rid long, sigs binary")
    signed = checkpointed(signed.join(reps.select("rid", "label"), "rid"))
    placed = signed.mapInArrow(_placed(bits, tables), "bucket long, table short, rid long, sigs binary")
    heavy = checkpointed(placed.groupBy("bucket").count().where(F.col("count") > tile).select("bucket", F.ceil(F.col("count") / tile).cast("int").alias("parts")))

    # A row of part c goes to the tiles {c, j} for every j; tile {c, c} holds one part, {i, j} two.
    placed = placed.join(small(heavy), "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("rid", F.lit("part")), F.col("parts")).cast("int")
    placed = placed.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiled = placed.select(
        "bucket", (F.least("part", "other") * F.col("parts") + F.greatest("part", "other")).cast("long").alias("tile"), "table", "rid", "sigs",
        (F.col("part") != F.col("other")).cast("byte").alias("cross"), (F.col("part") > F.col("other")).cast("byte").alias("side"),
    )
    tiled = tiled.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")
    near = checkpointed(tiled.mapInArrow(_near(bits, tables, most), "bucket long, tile long, table short, rid long, cross byte, side byte"))
    whole = near.join(signed.join(reps.select("rid", "copies", "v"), "rid"), "rid").repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")
    found = checkpointed(whole.mapInArrow(_linked(threshold, bits, tables, most), "rid long, links long, root long"))

    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    members = components(found.select(F.col("rid").alias("u"), F.col("root").alias("v")))
    members = reps.select("rid", "least").join(members.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    known = members.join(least, "component").select("rid", "component_id").join(links, "rid", "left").join(reps.select("rid", "h1", "h2", "copies"), "rid").drop("rid")
    out = rows.select("id", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("id")).otherwise(F.col("component_id"))
    n_links = F.when(F.col("h1").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long")
    return out.select(F.col("id").alias(id_col), n_links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
