"""Vector code compression: product codes whose codebooks are trained by Elkan's variant of Lloyd's rounds.

Vectors become integers (floor of `scale` times each component) and are cut into equal parts; each
part position has a codebook. A round assigns every part to its nearest entry and moves entries to
the floor of their parts' mean. Between rounds each part keeps an upper bound of the distance to
its entry and a lower bound for every entry, in a table of the shared folder. When entries move, bounds are
shifted by their movement. An entry is only looked at if no bound says that it is farther than the
present one: its lower bound, and half the distance between both entries. Both tests are strict and
rounded to the safe side; what passes is decided by exact integer distances, ties to the lower index,
so codes are those of an exhaustive search.

Lower bounds are kept as half floats, rounded down: 2 * parts * entries bytes a vector. Sums for new
entries are made in each task (one row for an entry), and parts * entries rows meet in the driver,
however many vectors there are.

Defined results: a vector that is null, or holds a null, a non-finite or an out-of-range component
(|scale * x| of 2**24 or more), is dropped, as is one whose length is no multiple of the parts or
differs from that of the first vector that is left; rows that repeat an id are coded alike, and count as often as
they come for the means; a null id sorts behind all others; fewer vectors than entries
give smaller codebooks; equal labels, nulls together, share a label error; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if, dropped, slim, stored

LIMIT = 1 << 24
#: Vectors that are worked on at once.
ROWS = 2048
#: Widens what a bound is compared with, far beyond the error of double precision.
SLACK = 1e-9


def integers(vectors: DataFrame, *, parts: int, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """_id, _label, _vec (integers) of the vectors that are kept; a stored table."""
    x = lambda v: v.cast("double") * F.lit(float(scale))
    sound = F.forall("_v", lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(x(v)) < float(LIMIT)), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_v")).where("_v is not null")
    rows = rows.where((F.size("_v") > 0) & (F.size("_v") % parts == 0) & sound)
    rows = stored(rows.select("_id", "_label", F.transform("_v", lambda v: F.floor(x(v)).cast("int")).alias("_vec")), "codes-vectors")
    first = rows.orderBy(F.asc_nulls_last("_id"), F.size("_vec"), "_vec").select(F.size("_vec")).head()
    return rows.where(F.size("_vec") == (first[0] if first else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, parts: int) -> np.ndarray:
    """Row, part, position."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1)


def _bytes(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), *shape)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _down(x: np.ndarray) -> np.ndarray:
    """x as half floats, none of them larger than x."""
    y = np.minimum(x, 65504.0).astype(np.float16)
    return np.where(y.astype(np.float64) > x, np.nextafter(y, np.float16(-np.inf)), y)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x to each entry."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += np.square(x[:, j, None] - entries[None, :, j])
    return out


def nearest_all(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entries of rows of one part, upper bounds, lower bounds and how many distances were worked out."""
    d = _squares(x, book)
    at = d.argmin(1)
    root = np.sqrt(d)
    return at, root[np.arange(len(x)), at] * (1 + SLACK), _down(root * (1 - SLACK)), d.size


def nearest_bounded(x: np.ndarray, book: np.ndarray, moved: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """As nearest_all, from what it gave for the entries before they moved by `moved`."""
    n, k = len(x), len(book)
    lower = np.maximum(lower.astype(np.float64) - moved * (1 + SLACK), 0.0)
    upper = (upper + moved[at]) * (1 + SLACK)
    between = np.sqrt(_squares(book, book)) * (0.5 * (1 - SLACK))

    def open_(rows: np.ndarray) -> np.ndarray:
        """Entries that may be as near as the present one."""
        u = upper[rows, None]
        out = (lower[rows] <= u) & (between[at[rows]] <= u)
        out[np.arange(len(rows)), at[rows]] = False
        return out

    rows = np.flatnonzero(open_(np.arange(n)).any(1))
    mine = np.square(x[rows] - book[at[rows]]).sum(1)
    upper[rows] = np.sqrt(mine) * (1 + SLACK)
    lower[rows, at[rows]] = np.sqrt(mine) * (1 - SLACK)
    # with the exact distance as bound fewer are open
    r, e = np.nonzero(open_(rows))
    d = np.square(x[rows[r]] - book[e]).sum(1)
    lower[rows[r], e] = np.sqrt(d) * (1 - SLACK)
    table = np.full((len(rows), k), np.iinfo(np.int64).max)
    table[np.arange(len(rows)), at[rows]] = mine
    table[r, e] = d
    best = table.argmin(1)
    at = at.copy()
    at[rows] = best
    upper[rows] = np.sqrt(table[np.arange(len(rows)), best]) * (1 + SLACK)
    return at, upper, _down(lower), len(rows) + len(d)


def _assigned(rows: DataFrame, books: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """rows with _code, _upper, _lower, _error and _worked (distances that were worked out)."""
    parts, entries, _ = books.shape
    moved = None if before is None else np.sqrt(np.square(books - before).sum(2))

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _matrix(batch["_vec"], parts)
                n = len(x)
                code, upper, lower = np.zeros((n, parts), np.uint8), np.zeros((n, parts)), np.zeros((n, parts, entries), np.float16)
                if moved is not None:
                    old = [_bytes(batch[c], kind, *shape) for c, kind, shape in (("_code", np.uint8, (parts,)), ("_upper", np.float64, (parts,)), ("_lower", np.float16, (parts, entries)))]
                error, worked = np.zeros(n, np.int64), 0
                for p in range(parts):
                    if moved is None:
                        code[:, p], upper[:, p], lower[:, p], m = nearest_all(x[:, p], books[p])
                    else:
                        code[:, p], upper[:, p], lower[:, p], m = nearest_bounded(x[:, p], books[p], moved[p], old[0][:, p].astype(np.int64), old[1][:, p], old[2][:, p])
                    worked += m
                    error += np.square(x[:, p] - books[p][code[:, p]]).sum(1)
                share = np.full(n, worked // n)
                share[: worked % n] += 1
                yield pa.RecordBatch.from_arrays([batch["_id"], batch["_label"], batch["_vec"], _binary(code), _binary(upper), _binary(lower), pa.array(error), pa.array(share)], ["_id", "_label", "_vec", "_code", "_upper", "_lower", "_error", "_worked"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"_id {kind['_id']}, _label {kind['_label']}, _vec array<int>, _code binary, _upper binary, _lower binary, _error long, _worked long")


def _moved(coded: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with each entry at the floor of its parts' mean; unused ones stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x, code = _matrix(batch["_vec"], parts), _bytes(batch["_code"], np.uint8, parts)
            for p in range(parts):
                n[p] += np.bincount(code[:, p], minlength=entries)
                for j in range(width):
                    # below 2 ** 53, so exact
                    total[p, :, j] += np.bincount(code[:, p], x[:, p, j], entries).astype(np.int64)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    sums = coded.select("_vec", "_code").mapInArrow(run, "part int, entry int, n long, total array<long>")
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(width)])
    out = books.copy()
    for r in sums.collect():  # at most parts * entries rows
        out[r["part"], r["entry"]] = [r[f"t{j}"] // r["n"] for j in range(width)]
    return out


def compress(vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes and codebooks. The codes are a stored table: `id_col`, `label_col`, codes (an array of entries by part),
    error (sum of squared distances) and worked (distances worked out in the last assignment, spread over the
    rows of a block). The codebooks are integers by part, entry and position (entries at most 256)."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    rows = integers(vectors, parts=parts, scale=scale, id_col=id_col, vector_col=vector_col, label_col=label_col)
    first = [r["_vec"] for r in rows.orderBy(F.asc_nulls_last("_id"), "_vec").select("_vec").take(entries)]
    columns = lambda df: df.select(F.col("_id").alias(id_col), F.col("_label").alias(label_col), F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda i: F.conv(F.hex(F.substring("_code", i, F.lit(1))), 16, 10).cast("int")).alias("codes"), F.col("_error").alias("error"), F.col("_worked").alias("worked"))
    if not first:
        kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        none = rows.sparkSession.createDataFrame([], f"{id_col} {kind['_id']}, {label_col} {kind['_label']}, codes array<int>, error long, worked long")
        return none, np.zeros((parts, 0, 0), np.int64)
    books = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    before, state = None, rows
    for _ in range(rounds):
        following = stored(_assigned(state, books, before), "codes-bounds")
        dropped(state)
        state, before = following, books
        books = _moved(state, books)
    coded = stored(columns(_assigned(state, books, before)), "codes")
    dropped(state)
    return coded, books


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """coded with label_error, the sum of errors over equal labels. Labels are summed in each task first."""
    sums = stored(coded.groupBy(F.col(label_col).alias("_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    return coded.join(broadcast_if(sums), F.col(label_col).eqNullSafe(F.col("_label"))).drop("_label")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
