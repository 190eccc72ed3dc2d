"""Vector code compression: product codes by exact k-means with norm-of-sum bounds.

Each component becomes the integer floor(4096 * x), each vector is cut into
``PARTS`` equal parts, and each part position has a codebook of ``ENTRIES``
entries, refined in ``ROUNDS`` rounds. All distances are sums of integer
squares, so assignments and ties are exact.

A part keeps its entry's distance (an upper bound) and the distance of the next
nearest entry (a lower bound for all others), each with the round it was
measured in. The whole history of codebooks is retained: an upper bound of round
s grows by the net displacement of its entry from round s to now, a lower one
shrinks by the largest net displacement of any other entry since its round
(Newling and Fleuret 2016, norm of the sum). An entry that moves back and forth
costs nothing, where the sum of its drifts would only grow. If the bounds don't
part, the distance to the own entry is measured; if that doesn't decide, all
entries are, exactly. Bounds are rounded outwards, so they never decide a tie.

Vectors and bounds lie in blocks, one row each. A round is one narrow pass that
writes the blocks with their new bounds and one row per task: how the sums and
counts of entries changed. These rows are summed in Spark; only the codebooks'
own sums reach the driver. Codebooks (at most 8 x 16 entries a round) go out
with the tasks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, join_totals, mapped

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Vectors in a block; distances stay below 2 ** 62.
BLOCK = 4096
MOST = 1 << 62
# Relative error allowed for in square roots and sums of bounds.
SLACK = 1e-9


def integers(vectors: np.ndarray, parts: int) -> np.ndarray:
    """floor(4096 * x) of each component, in (vector, part, place); places are filled up with zeros to equal parts."""
    n, d = vectors.shape
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    width = -(-d // parts)
    if n and float(np.abs(scaled).max()) ** 2 * 4 * width >= MOST:
        raise ValueError("components too large: squared distances of their integers would not fit 64 bits")
    return np.pad(scaled.astype(np.int64), ((0, 0), (0, parts * width - d))).reshape(n, parts, width)


def _packed(x: np.ndarray) -> bytes:
    """The integers in the smallest type that holds them, its size first."""
    top = int(np.abs(x).max()) if x.size else 0
    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def _unpacked(data: bytes, parts: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64).reshape(-1, parts, width)


@dataclass
class Bounds:
    """Of each vector's parts: entry, upper and lower bound, and the rounds that these were measured in."""

    entry: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_round: np.ndarray
    lower_round: np.ndarray

    KINDS = ("u1", "<f4", "<f4", "u1", "u1")

    def fields(self) -> list[np.ndarray]:
        return [self.entry, self.upper, self.lower, self.upper_round, self.lower_round]

    def packed(self) -> bytes:
        return b"".join(f.astype(k).tobytes() for f, k in zip(self.fields(), self.KINDS))

    @classmethod
    def unpacked(cls, data: bytes, parts: int) -> Bounds:
        n = len(data) // sum(np.dtype(k).itemsize for k in cls.KINDS)
        fields, at = [], 0
        for k in cls.KINDS:
            fields.append(np.frombuffer(data, k, n, at).reshape(-1, parts).copy())
            at += n * np.dtype(k).itemsize
        return cls(*fields)

    @classmethod
    def none(cls, n: int, parts: int) -> Bounds:
        """Bounds that decide nothing."""
        return cls(np.zeros((n, parts), "u1"), np.full((n, parts), np.inf, "f4"), np.zeros((n, parts), "f4"),
                   np.zeros((n, parts), "u1"), np.zeros((n, parts), "u1"))


def displacements(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(round, part, entry): net displacement of the entry since that round, and the largest one of the others."""
    net = np.sqrt(((history[-1].astype(np.float64) - history) ** 2).sum(-1)) * (1 + SLACK)
    others = np.zeros_like(net)
    if net.shape[-1] > 1:
        ranked = np.sort(net, axis=-1)
        others = np.where(net == ranked[..., -1:], ranked[..., -2:-1], ranked[..., -1:])
    return net, others


def assign(x: np.ndarray, history: np.ndarray, bounds: Bounds) -> tuple[Bounds, dict[str, int]]:
    """Bounds with the nearest entry of the latest codebooks for each part, and how many parts took which test."""
    now, books = len(history) - 1, history[-1]
    net, others = displacements(history)
    work = {"kept": 0, "measured": 0, "rescanned": 0}
    for p in range(x.shape[1]):
        entry, upper, lower, upper_round, lower_round = (f[:, p] for f in bounds.fields())
        high = (upper.astype(np.float64) + net[upper_round, p, entry]) * (1 + SLACK)
        low = (lower.astype(np.float64) - others[lower_round, p, entry]) * (1 - SLACK)
        open_ = np.flatnonzero(~(high < low))
        work["kept"] += len(x) - len(open_)
        own = ((x[open_, p] - books[p, entry[open_]]) ** 2).sum(-1)
        upper[open_] = np.nextafter((np.sqrt(own) * (1 + SLACK)).astype("f4"), np.float32(np.inf))
        upper_round[open_] = now
        still = ~(upper[open_].astype(np.float64) < low[open_])
        work["measured"] += len(open_) - int(still.sum())
        open_ = open_[still]
        work["rescanned"] += len(open_)
        every = ((x[open_, p, None, :] - books[p][None]) ** 2).sum(-1)
        nearest = every.argmin(1)  # the first of equals
        entry[open_] = nearest
        best = every[np.arange(len(open_)), nearest]
        upper[open_] = np.nextafter((np.sqrt(best) * (1 + SLACK)).astype("f4"), np.float32(np.inf))
        if books.shape[1] > 1:
            every[np.arange(len(open_)), nearest] = MOST
            second = np.sqrt(every.min(1)) * (1 - SLACK)
        else:
            second = np.full(len(open_), np.inf)
        lower[open_] = np.nextafter(second.astype("f4"), np.float32(0))
        lower_round[open_] = now
    return bounds, work


def changes(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """How the sums and counts of each part's entries change when parts go from old entries (None: from none) to new ones."""
    n, parts, width = x.shape
    sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    for p in range(parts):
        moved = slice(None) if old is None else np.flatnonzero(old[:, p] != new[:, p])
        for side, sign in ((new, 1), (old, -1)):
            if side is None:
                continue
            own = side[moved, p]
            np.add.at(sums[p], own, sign * x[moved, p])
            counts[p] += sign * np.bincount(own, minlength=entries)
    return sums, counts


@dataclass
class Codes:
    """``rows`` has (id, code, error, label_error); ``codebooks`` is an integer array (part, entry, place)."""

    rows: DataFrame
    codebooks: np.ndarray
    history: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def _whole(table: DataFrame) -> DataFrame:
    """Rows with a vector of finite components, as many as that of the smallest id."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = table.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    first = found.agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.size("v").alias("d")))["d"]).first()[0]
    return found.where(F.size("v") == (first or 0))


def _first_books(found: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, one per id (its least vector)."""
    ids = [r.id for r in found.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()]
    chosen = F.col("id").isin([i for i in ids if i is not None])
    chosen = F.coalesce(chosen, F.lit(False)) | (F.col("id").isNull() if None in ids else F.lit(False))
    rows = {r.id: r.v for r in found.where(chosen).groupBy("id").agg(F.min("v").alias("v")).collect()}
    return integers(np.array([rows[i] for i in ids], np.float64), parts).transpose(1, 0, 2)


def vector_codes(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes | None:
    """Product codes of the vectors of ``table``; None if no row has a vector to be coded.

    Rows whose vector is null, empty, or holds a null or non-finite component
    are dropped, as are vectors of another length than the smallest id's.
    Parts are filled up with zeros where ``parts`` doesn't divide the length.
    The codebooks begin as the vectors of the smallest ids, each id once (a null
    id last; of an id's rows the least vector); with fewer ids they are smaller.
    ``error`` is the sum of a row's squared distances to its entries;
    ``label_error`` sums it over equal labels, nulls together. Repeated rows
    have a row each. Other columns don't matter, whatever their names.
    Components whose integers are too large for exact 64-bit distances (over
    about 2 ** 16 in value) raise ValueError.
    """
    slim = table.select(*(table[f"`{c}`"].alias(n) for c, n in ((id_col, "id"), (vector_col, "v"), (label_col, "label"))))
    found = _whole(slim)
    first = found.select(F.size("v").alias("d")).first()
    if first is None:
        return None
    width = -(-first.d // parts)
    books = _first_books(found, parts, entries)
    entries = books.shape[1]
    kinds = {c: dict(slim.dtypes)[c] for c in ("id", "label")}
    schema = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, x binary, state binary"

    def blocks(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                own = batch.slice(s, BLOCK)
                flat = own.column("v").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
                x = integers(flat.reshape(own.num_rows, -1), parts)
                ends = pa.array([0, own.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, own.column("id")), pa.ListArray.from_arrays(ends, own.column("label")),
                     pa.array([_packed(x)], pa.binary()), pa.array([None], pa.binary())], names=["ids", "labels", "x", "state"])

    def refined(history: np.ndarray):
        def rows(batches):
            sums = counts = None
            for batch in batches:
                states = []
                for data, state in zip(batch.column("x").to_pylist(), batch.column("state").to_pylist()):
                    x = _unpacked(data, parts, width)
                    old = Bounds.unpacked(state, parts) if state else None
                    before = old.entry.copy() if old else None
                    new, _ = assign(x, history, old or Bounds.none(len(x), parts))
                    s, c = changes(x, before, new.entry, entries)
                    sums, counts = (s, c) if sums is None else (sums + s, counts + c)
                    states.append(new.packed())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(states, pa.binary())], names=batch.schema.names)
            if sums is not None:  # the task's own row
                none = [pa.nulls(1, batch.schema.field(c).type) for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*none, pa.array([sums.tobytes()], pa.binary()),
                                                  pa.array([counts.tobytes()], pa.binary())], names=batch.schema.names)
        return rows

    def listed(batches):
        for batch in batches:
            for data, state in zip(batch.column("x").to_pylist(), batch.column("state").to_pylist()):
                values = np.concatenate([np.frombuffer(data, np.int64), np.frombuffer(state, np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["slot", "value"])

    def coded(history: np.ndarray):
        def rows(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    x = _unpacked(batch.column("x")[i].as_py(), parts, width)
                    entry = assign(x, history, Bounds.unpacked(batch.column("state")[i].as_py(), parts))[0].entry
                    own = history[-1][np.arange(parts), entry]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[i].values, batch.column("labels")[i].values,
                         pa.array([e.tobytes().hex() for e in entry]), pa.array(((x - own) ** 2).sum((1, 2)))],
                        names=["id", "label", "code", "error"])
        return rows

    history = books[None]
    sums, counts = np.zeros(parts * entries * width, object), np.zeros(parts * entries, object)
    current = mapped(found, blocks, schema)
    for _ in range(rounds):
        current = checkpointed(mapped(current.where("ids IS NOT NULL") if len(history) > 1 else current,
                                      refined(history), schema))
        moved = mapped(current.where("ids IS NULL").select("x", "state"), listed, "slot long, value long")
        total = moved.groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        for r in total.collect():  # a number for each component and entry of the codebooks
            side, at = (sums, r.slot) if r.slot < len(sums) else (counts, r.slot - len(sums))
            side[at] += int(r.value)
        n = np.repeat(counts, width)
        means = [s // c if c else old for s, c, old in zip(sums, n, history[-1].reshape(-1).tolist())]
        history = np.concatenate([history, np.array(means, np.int64).reshape(1, parts, entries, width)])
    rows = checkpointed(mapped(current.where("ids IS NOT NULL"), coded(history),
                               f"id {kinds['id']}, label {kinds['label']}, code string, error long"))
    key = F.when(F.col("label").isNull(), "none").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = rows.withColumn("key", key)
    totals = rows.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    with_totals = join_totals(rows, checkpointed(totals), "key", "n")
    return Codes(with_totals.select(F.col("id").alias(id_col), "code", "error", "label_error"), history[-1], history)


def _oracle() -> str:
    """The same codes in DuckDB SQL, without bounds."""
    def nearest(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
  SELECT rid, p, min({{'d': d, 'j': j}}) AS best FROM (
    SELECT x.rid, x.p, c.j, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM x JOIN c{r} c ON c.p = x.p)
  GROUP BY rid, p)"""

    def means(r: int) -> str:
        return f"""c{r} AS MATERIALIZED (
  SELECT o.p, o.j, coalesce(m.v, o.v) AS v FROM c{r - 1} o LEFT JOIN (
    SELECT p, j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT x.p, a.best.j AS j, g.i, sum(x.v[g.i])::HUGEINT AS s, count(*)::HUGEINT AS n
      FROM x JOIN a{r - 1} a ON a.rid = x.rid AND a.p = x.p, range(1, (SELECT w + 1 FROM dims)) g(i)
      GROUP BY ALL) GROUP BY p, j) m ON m.p = o.p AND m.j = o.j)"""

    steps = [nearest(0)]
    for r in range(1, ROUNDS + 1):
        steps += [means(r), nearest(r)]
    chain = ",\n".join(steps)
    return f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
dims AS MATERIALIZED (SELECT max(len(embedding)) // {PARTS} AS w FROM kept),
x AS MATERIALIZED (
  SELECT rid, p, list_transform(embedding[(p * w + 1):((p + 1) * w)],
         lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS HUGEINT)) AS v
  FROM kept, dims, range({PARTS}) r(p)),
c0 AS MATERIALIZED (SELECT p, rid - 1 AS j, v FROM x WHERE rid <= {ENTRIES}),
{chain},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, j)) AS h FROM c{ROUNDS}),
coded AS (
  SELECT rid, string_agg(printf('%02x', best.j), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY rid)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       b.h AS codebooks_sha256
FROM kept k JOIN coded c ON c.rid = k.rid, books b"""


ORACLE = _oracle()
