"""Vector codes: a k-means codebook for every part of the vectors, with norm-of-sum bounds.

A component x becomes the integer floor(scale * x), and vectors are cut into
equal parts. A codebook starts as the parts of the first vectors by id; every
round assigns each part to its nearest entry and moves the entries to the
rounded means; a last assignment follows. All distances and means are exact.

Assignments after the first avoid most distances. The entries of a codebook are
in groups, and a part keeps, for every group, a lower bound of its distance to
the entries other than its own, and the round in which the bound was taken (its
stamp). All codebooks so far are kept. An entry that stood at c(s) when the
bound was taken and stands at c(t) now has moved by the net displacement
|c(t) - c(s)|, however far it went in between; so the bound now is the old one
less the largest net displacement in the group, which is never less than the
bound that subtracts each round's drift. Only groups whose bound does not exceed
the exact distance to the part's own entry are scanned again. Bounds are rounded
down and distances up, so ties still go to the lower index. ``compared`` counts
the distances that were computed.

Vectors that are null or hold a null, NaN or infinite component take no part, as
do vectors of another length than the one with the smallest id; null ids come
last, equal ids are ordered by their vectors, and repeated rows count as often as
they occur. With fewer vectors than entries there are fewer entries. A length
that the parts do not divide is filled up with zeros. Integers are limited to
2 ** 60 in size, and sums of squares above the range of a long are given as its
largest value. An empty table gives an empty table.

A task holds one Arrow batch. Means come from sums per entry, added up within
each task first, so neither a hot label nor copies of one vector meet in one
task. The driver holds the codebooks alone: entries x length numbers for each
round. State between rounds lies in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.plans.joins import lookup_join
from tasador.plans.workspace import materialize

_LARGEST = 1 << 60
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """``groups``: groups of entries with a bound of their own, for each part."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    groups: int = 4


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has only finite components."""
    def odd(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return rows.filter(F.col(vector).isNotNull() & ~F.exists(vector, odd))


def integers(values: np.ndarray, width: int, s: Settings) -> np.ndarray:
    """Flat components as (vectors, parts, components of a part): floats that hold exact
    integers where all sums of squares fit, else Python integers."""
    x = np.floor(values.astype("f8") * s.scale).reshape(-1, width)
    fill = -width % s.parts
    x = np.pad(x, ((0, 0), (0, fill))).reshape(len(x), s.parts, (width + fill) // s.parts)
    most = max(1.0, float(np.abs(x).max(initial=0.0)))
    if 16 * x.shape[2] * most * most < 2.0**53:
        return x
    whole = [min(_LARGEST, max(-_LARGEST, int(v))) for v in x.reshape(-1)]
    return np.array(whole, dtype=object).reshape(x.shape)


def _matching(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and codebook in one number type that is exact for both."""
    most = max(1, *(abs(int(v)) for v in (book.min(initial=0), book.max(initial=0))))
    if x.dtype == object or 16 * book.shape[-1] * most * most >= 2**53:
        return np.array([int(v) for v in x.reshape(-1)], dtype=object).reshape(x.shape), book
    return x, book.astype("f8")


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries."""
    if x.dtype == object:
        return ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def _above(squares: np.ndarray) -> np.ndarray:
    """Square roots, rounded up."""
    return np.nextafter(np.sqrt(squares.astype("f8")) * (1 + 2.0**-50), np.inf)


def _below(squares: np.ndarray) -> np.ndarray:
    """Square roots, rounded down to four bytes."""
    low = np.sqrt(squares.astype("f8")) * (1 - 2.0**-50)
    return np.nextafter(np.minimum(low, 3e38).astype("f4"), np.float32(-np.inf))


def groups_of(entries: int, groups: int) -> list[np.ndarray]:
    return [g for g in np.array_split(np.arange(entries), groups) if len(g)]


def displacements(history: list[np.ndarray], s: Settings) -> np.ndarray:
    """(round, part, group): how far any entry of the group is now from where it was then."""
    now = history[-1]
    out = []
    for then in history:
        moved = _above(((now - then) ** 2).sum(axis=2))
        out.append([[moved[p, g].max() for g in groups_of(now.shape[1], s.groups)]
                    for p in range(now.shape[0])])
    return np.array(out, dtype="f8")


@dataclass
class State:
    """What is known of the parts of some vectors: entry, bounds and their stamps."""

    code: np.ndarray
    low: np.ndarray
    stamp: np.ndarray


def assign(
    x: np.ndarray, history: list[np.ndarray], state: State | None, s: Settings,
    net: np.ndarray | None = None,
) -> tuple[State, np.ndarray, np.ndarray]:
    """Nearest entries by the last codebook; squared distances, and how many were computed."""
    x, book = _matching(x, history[-1])
    n, now = len(x), len(history) - 1
    groups = groups_of(book.shape[1], s.groups)
    if state is None:
        state = State(np.zeros((n, s.parts), "u1"), np.zeros((n, s.parts, len(groups)), "f4"),
                      np.zeros((n, s.parts, len(groups)), "u1"))
        known = False
    else:
        state, known = State(state.code.copy(), state.low.copy(), state.stamp.copy()), True
        net = displacements(history, s) if net is None else net
    total = np.zeros(n, dtype=object if x.dtype == object else "f8")
    compared = np.zeros(n, "i8")
    rows = np.arange(n)
    for p in range(s.parts):
        own, mine = state.code[:, p].astype("i8"), x[:, p]
        nearest = ((mine - book[p, own]) ** 2).sum(axis=1)
        compared += 1
        if known:
            bound = state.low[:, p] - net[state.stamp[:, p], p, np.arange(len(groups))]
            bound = np.nextafter(bound, -np.inf)
            scan = bound <= _above(nearest)[:, None]
        else:
            bound, scan = state.low[:, p], np.ones((n, len(groups)), bool)
        best, distance = own.copy(), nearest.copy()
        seen = []
        for g, members in enumerate(groups):
            at = np.flatnonzero(scan[:, g])
            compared[at] += len(members)
            d = _squares(mine[at], book[p, members])
            first = d.argmin(axis=1) if len(at) else np.zeros(0, "i8")
            least = d[np.arange(len(at)), first]
            d[np.arange(len(at)), first] = _LARGEST**3 if d.dtype == object else np.inf
            second = d.min(axis=1) if len(at) else least
            entry = members[first] if len(at) else first
            seen.append((at, entry, least, second))
            closer = (least < distance[at]) | ((least == distance[at]) & (entry < best[at]))
            best[at[closer]], distance[at[closer]] = entry[closer], least[closer]
        for g, (at, entry, least, second) in enumerate(seen):
            others = np.where(entry == best[at], second, least)
            state.low[at, p, g], state.stamp[at, p, g] = _below(others), now
        # A left entry counts among the others of its group from now on.
        left = np.searchsorted([g[0] for g in groups], own, "right") - 1
        at = rows[(best != own) & ~scan[rows, left]]
        state.low[at, p, left[at]] = np.nextafter(np.minimum(
            bound[at, left[at]].astype("f4"), _below(nearest[at])
        ), np.float32(-np.inf))
        state.stamp[at, p, left[at]] = now
        state.code[:, p] = best
        total += distance
    return state, total, compared


# --- On Spark ---------------------------------------------------------------

_STATE = "code binary, low binary, stamp binary"


def _vectors(batch: pa.RecordBatch, width: int, s: Settings) -> np.ndarray:
    values = batch.column("embedding").flatten()
    return integers(values.to_numpy(zero_copy_only=False), width, s)


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _read(column: pa.Array, dtype: str, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


def _assigned(
    batches: Iterator[pa.RecordBatch], history: list[np.ndarray], width: int, s: Settings, last: bool
) -> Iterator[pa.RecordBatch]:
    net = displacements(history, s)
    n_groups = len(groups_of(history[-1].shape[1], s.groups))
    for batch in batches:
        if not batch.num_rows:
            continue
        state = None
        if "code" in batch.schema.names:
            state = State(_read(batch.column("code"), "u1", (s.parts,)),
                          _read(batch.column("low"), "f4", (s.parts, n_groups)),
                          _read(batch.column("stamp"), "u1", (s.parts, n_groups)))
        state, total, compared = assign(_vectors(batch, width, s), history, state, s, net)
        if "compared" in batch.schema.names:
            compared = compared + batch.column("compared").to_numpy()
        kept = [batch.column(c) for c in ("vec_id", "label")]
        if last:
            error = pa.array([min(_LONG, int(e)) for e in total], pa.int64())
            text = pa.array([c.tobytes().hex() for c in state.code], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*kept, text, error, pa.array(compared)],
                names=["vec_id", "label", "code", "error", "compared"],
            )
        else:
            yield pa.RecordBatch.from_arrays(
                [*kept, batch.column("embedding"), _bytes(state.code), _bytes(state.low),
                 _bytes(state.stamp), pa.array(compared)],
                names=["vec_id", "label", "embedding", "code", "low", "stamp", "compared"],
            )


def _sums(
    batches: Iterator[pa.RecordBatch], shape: tuple[int, int, int], width: int, s: Settings
) -> Iterator[pa.RecordBatch]:
    """Rows and component sums of every entry that a task's vectors have."""
    sums, counts = np.zeros(shape, dtype=object), np.zeros(shape[:2], "i8")
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _vectors(batch, width, s)
        code = _read(batch.column("code"), "u1", (s.parts,))
        for p in range(s.parts):
            counts[p] += np.bincount(code[:, p], minlength=shape[1])
            for i in range(shape[2]):
                if x.dtype == object:
                    np.add.at(sums[p, :, i], code[:, p], x[:, p, i])
                else:
                    own = np.bincount(code[:, p], weights=x[:, p, i], minlength=shape[1])
                    sums[p, :, i] += [int(v) for v in own]
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([
        pa.array(part.astype("i4")), pa.array(entry.astype("i4")), pa.array(counts[part, entry]),
        pa.array([[Decimal(int(v)) for v in sums[p, e]] for p, e in zip(part, entry)],
                 pa.list_(pa.decimal128(38, 0))),
    ], names=["part", "entry", "n", "sums"])


def _moved(state: DataFrame, book: np.ndarray, width: int, s: Settings) -> np.ndarray:
    """The next codebook; entries without vectors stay."""
    found = state.select("embedding", "code").mapInArrow(
        partial(_sums, shape=book.shape, width=width, s=s),
        "part int, entry int, n long, sums array<decimal(38,0)>",
    ).select("part", "entry", "n", F.posexplode("sums").alias("i", "total"))
    # At most parts x entries x components rows come back.
    means = found.groupBy("part", "entry", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = book.copy()
    for r in means.collect():
        after[r["part"], r["entry"], r["i"]] = int(r["total"]) // r["n"]
    return after


def compress(rows: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, compared`` of all usable rows, and the final codebooks
    (parts, entries, components)."""
    rows = usable(rows.select("vec_id", "label", "embedding"))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1).collect()
    width = len(first[0]["embedding"]) if first else 0
    if not width:
        nothing = rows.limit(0).select(
            "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("compared"))
        return nothing, np.zeros((s.parts, 0, 0), dtype=object)
    rows = rows.filter(F.size("embedding") == width)
    heads = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(s.entries).collect()
    start = integers(np.array([v for r in heads for v in r["embedding"]]), width, s)
    book = np.array([int(v) for v in start.reshape(-1)], dtype=object).reshape(start.shape)
    history = [np.ascontiguousarray(book.transpose(1, 0, 2))]
    kept = {f.name: f.dataType.simpleString() for f in rows.schema}
    head = f"vec_id {kept['vec_id']}, label {kept['label']}"
    state = rows
    for _ in range(s.rounds):
        state = materialize(state.mapInArrow(
            partial(_assigned, history=list(history), width=width, s=s, last=False),
            f"{head}, embedding {kept['embedding']}, {_STATE}, compared long",
        ), "vector-codes")
        history.append(_moved(state, history[-1], width, s))
    coded = state.mapInArrow(
        partial(_assigned, history=list(history), width=width, s=s, last=True),
        f"{head}, code string, error long, compared long",
    )
    return materialize(coded, "vector-codes"), history[-1]


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in book.reshape(-1)).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors of all rows of a label, null being a label."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(_LONG)))
    totals = materialize(
        coded.groupBy("label").agg(total.cast("long").alias("label_error")), "label-errors"
    )
    return lookup_join(coded, totals, ["label"], ["vec_id", "code"])


def oracle(s: Settings = Settings()) -> str:
    """The same for DuckDB, all distances computed."""
    steps = []
    for t in range(s.rounds + 1):
        steps.append(f"""
near{t} AS MATERIALIZED (
  SELECT rid, p, min(d) AS d, arg_min(e, (d, e)) AS e FROM (
    SELECT x.rid, x.p, c.e, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
    FROM flat x JOIN book{t} c USING (p, i) GROUP BY ALL) GROUP BY rid, p)""")
        if t < s.rounds:
            steps.append(f"""
means{t} AS (
  SELECT p, e, i, sum(v)::BIGINT AS total, count(*)::BIGINT AS n
  FROM flat JOIN near{t} USING (rid, p) GROUP BY ALL),
book{t + 1} AS MATERIALIZED (
  SELECT p, e, i, coalesce((total - ((total % n) + n) % n) // n, v) AS v
  FROM book{t} LEFT JOIN means{t} USING (p, e, i))""")
    last = s.rounds
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor({s.scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT rid, len(v) // {s.parts} AS w, unnest(v) AS v,
  unnest(range(len(v))) AS k FROM kept),
flat AS MATERIALIZED (SELECT rid, (k // w)::INT AS p, (k % w)::INT AS i, v FROM cells),
book0 AS MATERIALIZED (SELECT p, rid::INT AS e, i, v FROM flat WHERE rid < {s.entries}),
{",".join(steps)},
rows AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code,
    sum(d)::BIGINT AS error
  FROM near{last} JOIN kept USING (rid) GROUP BY rid, vec_id, label),
totals AS (SELECT label, sum(error)::BIGINT AS label_error FROM rows GROUP BY label)
SELECT vec_id, code, error, label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, i)) FROM book{last}) AS codebooks_sha256
FROM rows JOIN totals ON rows.label IS NOT DISTINCT FROM totals.label
"""
