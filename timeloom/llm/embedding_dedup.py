"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

A vector is rotated at random several times and keeps the signs, one bit a
coordinate. Bands of these bits bring together vectors that may be close; in
a bucket all members are compared by their codes alone.

With the bits go four factors. The rotations form two families; the signs of
one, rotated back, point along the vector, and the inner product of both (the
first factor) scales them so that the estimate of an inner product with any
other vector is unbiased, its error lying in a random direction of known
length (the second factor). One family of the one vector is taken with the
other family of the other, so the two errors are independent, and so are the
two estimates that are averaged. A pair is recomputed exactly, in double
precision, where its confidence interval reaches the limit, and only there.

A pair that meets in several bands is chosen in the first of them, so links
are counted once. Chosen pairs travel as one packed list a task, not as rows.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.components import connected_components, stars
from timeloom.llm.runtime import cut, map_arrow, per_group, release
from timeloom.llm.textarrays import mix

CROWD = 1024  # members of a bucket compared at once; fuller buckets are dealt out in pairs of such blocks
FEW = 16  # buckets of so many members are compared many at a time
BITS = 512  # of a code, at least
SURE = 5.0  # standard errors of an interval
LISTED = 500_000  # chosen pairs of one task that recomputes them


@functools.lru_cache(64)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(1_000_003 * dim + number).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def unit_rows(vectors: list) -> list[np.ndarray | None]:
    """Vectors of length one; None for null, empty, zero and non-finite ones."""
    out = []
    for v in vectors:
        x = None if v is None or any(c is None for c in v) else np.asarray(v, np.float64)
        if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
            out.append(None)
        else:
            x = x / np.abs(x).max()
            out.append(x / np.sqrt(x @ x))
    return out


def band_plan(n: int, limit: float, miss: float = 2e-4) -> tuple[int, int]:
    """(bits, bands): buckets stay small as ``n`` grows, and a pair at the limit is missed with probability ``miss``."""
    bits = max(8, math.ceil(math.log2(max(n, 2))) + 2)
    meet = (1 - math.acos(limit) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-meet))


def shape_of(dim: int, bits: int, bands: int) -> tuple[int, int]:
    """How many rotations there are, and how many of them are the first family."""
    count = max(2, -(-max(bits * bands, BITS) // dim))
    return count, count // 2


def signs_of(x: np.ndarray, bits: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of unit rows of one dimension in all rotations, and the factors of both families: scale and length of the error."""
    count, first = shape_of(x.shape[1], bits, bands)
    signs = np.concatenate([x @ rotation(x.shape[1], r) > 0 for r in range(count)], axis=1)
    factors = []
    for part in (slice(0, first), slice(first, count)):
        back = _rotated_back(signs, x.shape[1], part)
        scale = np.einsum("ij,ij->i", back, x)
        factors += [scale, np.sqrt(np.maximum(0.0, np.einsum("ij,ij->i", back, back) / scale**2 - 1))]
    return signs, np.stack(factors, axis=1).astype(np.float32)


def _rotated_back(signs: np.ndarray, dim: int, part: slice) -> np.ndarray:
    """The signs of a family of rotations as vectors, each rotated back."""
    out = np.zeros((len(signs), dim))
    for r in range(part.start, part.stop):
        out += (signs[:, r * dim : (r + 1) * dim] * 2.0 - 1.0) @ rotation(dim, r).T
    return out


def band_keys(signs: np.ndarray, bits: int, bands: int, dim: int) -> np.ndarray:
    """Band keys from the first sign bits."""
    some = signs[:, : bits * bands].reshape(len(signs), bands, bits)
    keys = np.zeros((len(signs), bands), np.uint64)
    for i in range(bits):
        keys = keys << np.uint64(1) | some[:, :, i].astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(keys * np.uint64(0x9E3779B97F4A7C15) + np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(dim)).view(np.int64)


@functools.lru_cache(16)
def _family(dim: int, start: int, stop: int) -> np.ndarray:
    """The rotations of a family below each other, in single precision: what intervals allow for is far more."""
    return np.concatenate([rotation(dim, r).T for r in range(start, stop)]).astype(np.float32)


class Codes:
    """Codes of one dimension as they travel: dimension, factors and sign bits; and what estimates need of them."""

    def __init__(self, raw: np.ndarray, bits: int, bands: int) -> None:
        self.dim = int(np.ascontiguousarray(raw[0, :4]).view(np.uint32)[0])
        count, first = shape_of(self.dim, bits, bands)
        factors = np.ascontiguousarray(raw[:, 4:20]).view(np.float32).astype(np.float64)
        self.signs, self.plan = np.unpackbits(raw[:, 20:], axis=1, count=count * self.dim), (bits, bands)
        each = self.signs.astype(np.float32) * np.float32(2) - np.float32(1)
        self.a = each[:, : first * self.dim] @ _family(self.dim, 0, first) / factors[:, :1].astype(np.float32)
        self.b = each[:, first * self.dim :] @ _family(self.dim, first, count) / factors[:, 2:3].astype(np.float32)
        self.ra, self.rb = factors[:, 1], factors[:, 3]

    def keys_of(self, rows: np.ndarray) -> np.ndarray:
        """Band keys of some rows."""
        return band_keys(self.signs[rows], *self.plan, self.dim)

    @staticmethod
    def packed(signs: np.ndarray, factors: np.ndarray, dim: int) -> list[bytes]:
        head = np.full((len(signs), 1), dim, np.uint32).view(np.uint8)
        return [r.tobytes() for r in np.concatenate((head, np.ascontiguousarray(factors).view(np.uint8), np.packbits(signs, axis=1)), axis=1)]

    def interval(self, x, y, limit: float) -> np.ndarray:
        """By how much the estimates of the pairs may err for vectors at the limit; x and y index rows and broadcast."""
        ra, rb, sa, sb = self.ra[x], self.rb[x], self.ra[y], self.rb[y]
        side = 1 - limit * limit
        spread = ((ra**2 + sb**2 + rb**2 + sa**2) * side + ra**2 * sb**2 + rb**2 * sa**2) / (4 * max(1, self.dim - 1))
        most = ((ra + sb + rb + sa) * math.sqrt(side) + ra * sb + rb * sa) / 2
        return np.minimum(SURE * np.sqrt(spread), most) + 1e-5

    def pairs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Estimates of the inner products of rows x with rows y, one by one."""
        return (np.einsum("ij,ij->i", self.a[x], self.b[y]) + np.einsum("ij,ij->i", self.b[x], self.a[y])) / 2

    def table(self, here: slice) -> np.ndarray:
        """The same of all rows of a slice with each other."""
        half = self.a[here] @ self.b[here].T
        return (half + half.T) / 2


def _by_dim(arrays: list) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, x in enumerate(arrays):
        if x is not None:
            out.setdefault(len(x), []).append(i)
    return out


def prepare(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, ``key`` (of equal vectors; null: links with nothing) and the unit vector's bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            raw = [None if u is None else u.tobytes() for u in unit_rows(batch.column("embedding").to_pylist())]
            keys = [None if b is None else xxhash.xxh64_intdigest(b) - (1 << 63) for b in raw]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.int64()), pa.array(raw, pa.binary())], names=["vec_id", "key", "unit"])

    return map_arrow(embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")), work, "vec_id bigint, key bigint, unit binary", 2000)


def _units(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.float64) for b in column.to_pylist()]


def choose(place: np.ndarray, band: np.ndarray, side: np.ndarray, crossed: np.ndarray, packed: list[bytes], limit: float, bits: int, bands: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) whose interval reaches the limit, among all members of each place (of both sides, where crossed), in the first band in which they meet."""
    by_size: dict[tuple[int, bytes], list[int]] = {}
    for i, raw in enumerate(packed):
        by_size.setdefault((len(raw), raw[:4]), []).append(i)
    for members in by_size.values():
        rows = np.array(members)[np.argsort(place[members], kind="stable")]
        codes = Codes(np.frombuffer(b"".join(packed[i] for i in rows), np.uint8).reshape(len(rows), -1), bits, bands)
        where, part, cross, met = place[rows], side[rows], crossed[rows], band[rows]

        def first_met(i: np.ndarray, j: np.ndarray, codes: Codes = codes, met: np.ndarray = met) -> np.ndarray:
            keep = np.ones(len(i), bool)
            if len(i):
                some, flat = np.unique(np.concatenate((i, j)), return_inverse=True)
                keys, (p, q) = codes.keys_of(some), flat.reshape(2, -1)
                for t in range(int(met[i].max())):
                    keep &= (keys[p, t] != keys[q, t]) | (met[i] <= t)
            return keep

        starts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        sizes = np.diff(np.append(starts, len(rows)))
        each = np.repeat(sizes, sizes)
        for step in range(1, min(FEW, int(sizes.max()))):
            at = np.flatnonzero((where[step:] == where[:-step]) & (each[step:] <= FEW))
            at = at[~cross[at] | (part[at] != part[at + step])]
            for i in np.array_split(at, len(at) // 65536 + 1):
                i = i[codes.pairs(i, i + step) + codes.interval(i, i + step, limit) >= limit]
                i = i[first_met(i, i + step)]
                yield rows[i], rows[i + step]
        for start, n in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
            own = np.arange(start, start + n)
            near = codes.table(slice(start, start + n)) + codes.interval(own[:, None], own[None, :], limit) >= limit
            if cross[start]:
                near &= part[own][:, None] != part[own][None, :]
            i, j = np.nonzero(np.triu(near, 1))
            keep = first_met(own[i], own[j])
            yield rows[own[i[keep]]], rows[own[j[keep]]]


def chosen_pairs(vectors: DataFrame, limit: float) -> DataFrame:
    """The pairs to recompute, a row a task: ``keys``, and ``pairs`` of places in them, packed."""
    bits, bands = band_plan(vectors.count(), limit)

    def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, own = _units(batch.column("unit")), batch.column("key").to_numpy()
            for dim, rows in _by_dim(units).items():
                signs, factors = signs_of(np.stack([units[i] for i in rows]), bits, bands)
                keys = band_keys(signs, bits, bands, dim)
                codes = pa.array(Codes.packed(signs, factors, dim), pa.binary()).take(pa.array(np.repeat(np.arange(len(rows)), bands)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(rows))), pa.array(np.repeat(own[rows], bands)), codes], names=["bucket", "band", "key", "code"])

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        place = group.groupby(["bucket", "i", "j"], sort=False).ngroup().to_numpy()
        key = group["key"].to_numpy()
        made, held, n = [], [], 0

        def flush() -> None:
            a, b = (np.concatenate([key[h[k]] for h in held]) for k in (0, 1))
            keys, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
            made.append((keys.tolist(), zlib.compress(flat.astype(np.int32).tobytes(), 1)))

        for i, j in choose(place, group["band"].to_numpy(), group["side"].to_numpy(), (group["i"] != group["j"]).to_numpy(), group["code"].tolist(), limit, bits, bands):
            for at in range(0, len(i), LISTED):
                held.append((i[at : at + LISTED], j[at : at + LISTED]))
                n += len(held[-1][0])
                if n >= LISTED:
                    flush()
                    held, n = [], 0
        if n:
            flush()
        return pd.DataFrame(made, columns=["keys", "pairs"])

    members = map_arrow(vectors, members_of, "bucket bigint, band int, key bigint, code binary", 1000)
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    sizes = cut(sizes.select("bucket", F.ceil(F.col("n") / CROWD).cast("int").alias("blocks"), "n"))
    rows = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    parts = max(1, rows // 16_384)
    dealt = members.join(sizes.select("bucket", "blocks"), "bucket").withColumn("side", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", "band", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "key", "code")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(parts)))
    return per_group(dealt, "part", compare, "keys array<bigint>, pairs binary")


def recompute(units: pd.DataFrame, lists: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Of one task's pairs, those that reach the limit: per key the weight linked, and the least key linked with it here."""
    if not len(lists) or not len(units):
        return pd.DataFrame({"key": [], "links": [], "head": []}).astype("int64")
    keys = np.asarray(lists["keys"].iat[0], np.int64)
    i, j = np.frombuffer(zlib.decompress(lists["pairs"].iat[0]), np.int32).reshape(2, -1)
    held = units.set_index("key").loc[keys]
    x, copies = np.frombuffer(b"".join(held["unit"]), np.float64).reshape(len(keys), -1) if held["unit"].str.len().nunique() == 1 else None, held["copies"].to_numpy()
    if x is None:  # pairs are of one dimension, keys of a task need not be
        raw = [np.frombuffer(b, np.float64) for b in held["unit"]]
        cosine = np.array([raw[p] @ raw[q] for p, q in zip(i, j, strict=True)])
    else:
        cosine = np.concatenate([np.einsum("ij,ij->i", x[i[at : at + 65536]], x[j[at : at + 65536]]) for at in range(0, len(i), 65536)])
    hit = cosine >= limit
    i, j = i[hit], j[hit]
    links = np.bincount(i, weights=copies[j], minlength=len(keys)) + np.bincount(j, weights=copies[i], minlength=len(keys))
    head = keys.copy()
    if len(i):
        node, root = stars(keys[i], keys[j])
        head[np.searchsorted(keys, node)] = root
    some = links > 0
    return pd.DataFrame({"key": keys[some], "links": links[some].astype(np.int64), "head": head[some]})


def link_vectors(embeddings: DataFrame, limit: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector.

    Null, empty, zero and non-finite vectors, and vectors of another
    dimension, link with nothing. Equal vectors link with each other; rows that repeat a
    vec_id count as vectors of their own. Distinct vectors are told apart by
    a 64-bit hash of their direction.
    """
    rows = cut(prepare(embeddings))
    classes = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"), F.min("unit").alias("unit"))
    classes = cut(classes)
    lists = cut(chosen_pairs(classes.select("key", "unit"), limit).withColumn("task", F.monotonically_increasing_id()))
    asked = lists.select(F.col("task").alias("of"), F.explode("keys").alias("key")).join(classes.select("key", "unit", "copies"), "key")

    def exact(units: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        made = recompute(units, lists, limit)
        release(collect=False)
        return made

    counted = cut(asked.groupBy("of").cogroup(lists.groupBy("task")).applyInPandas(exact, "key bigint, links bigint, head bigint"))
    links = counted.groupBy("key").agg(F.sum("links").alias("links"))
    joined = connected_components(counted.select(F.col("key").alias("a"), F.col("head").alias("b")))
    joined = joined.join(classes.select(F.col("key").alias("id"), "first"), "id")
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    found = joined.join(least, "component").select(F.col("id").alias("key"), "least")
    per_class = classes.select("key", "copies", "first").join(links, "key", "left").join(found, "key", "left")
    per_class = per_class.select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    done = rows.select("vec_id", "key").join(per_class, "key", "left")
    done = done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return done.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
