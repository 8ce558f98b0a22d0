"""Vector code compression: product codes with whole-number centroids, assigned by memoised grid cells.

Components become floor(scale * x); a vector is cut to equal consecutive parts,
and each part position has a codebook.  Rounds assign every part to its nearest
entry and move each entry to the floor of its parts' mean.

*Grid cells.*  A part lies in a cell of a grid of side ``cell``.  For a cell seen
first, the least and the largest squared distance from its box to every entry
are computed; an entry whose least distance exceeds another's largest is
dominated everywhere in the box.  The others are remembered under the cell, and
only they are evaluated exactly, for every part that falls into the cell.  A
task forgets its cells when it holds ``MAX_CELLS`` of them.

The codebooks (parts x entries x part length numbers, for each vector length)
are the only thing that reaches the driver or a task whole; a round is one pass
over the vectors whose sums combine before the shuffle.

Numbers are exact: distances are computed in 64 bits where these hold every
sum, else in whole numbers without bound, and sums travel as limbs of 60 bits.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, a null vec_id is not (it comes last where ids are
ordered); the first codebooks are the vectors of the smallest vec_ids, of rows
with one vec_id those that are smaller as sequences; fewer vectors than entries
give fewer entries; vectors of unlike length have codebooks of their own, and
their digest is of these; where the length is no multiple of the parts, the
first parts are a component longer; repeated rows count and return as often as
they stand; an empty vector has error 0; an error beyond a long is null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, lean, ship

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
CELL = 512
MAX_CELLS = 100_000
BLOCK = 4096  # vectors at a time
LIMB = 60


def part_bounds(length: int, parts: int) -> list[tuple[int, int]]:
    """First and last (exclusive) component of every part."""
    each, more = divmod(length, parts)
    cuts = [i * each + min(i, more) for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def whole(rows, scale: int):
    """floor(scale * x) of rows of finite doubles: int64 where that holds, else Python's whole numbers."""
    import numpy as np

    x = np.asarray(rows, np.float64)
    if not x.size:
        return np.zeros((len(rows), 0), np.int64)
    with np.errstate(over="ignore"):
        floor = np.floor(x * scale)
    if np.abs(floor).max() < 2**53:
        return floor.astype(np.int64)
    return np.array([[int(Fraction(v) * scale // 1) for v in r] for r in x.tolist()], dtype=object)


def _fitting(x, entries):
    """Both as int64 if every squared distance fits, else as whole numbers without bound."""
    import numpy as np

    most = max((int(abs(a).max()) for a in (x, entries) if a.size), default=0)
    kind = np.int64 if (2 * most + 2) ** 2 * max(1, x.shape[1]) < 2**62 else object
    return x.astype(kind), entries.astype(kind)


class CellCodes:
    """The nearest entries of one codebook, with the entries that matter remembered by grid cell."""

    def __init__(self, entries, cell: int):
        self.entries, self.cell = entries, cell
        self._forget()

    def _forget(self) -> None:
        import numpy as np

        self.known: dict = {}
        self.masks = np.zeros((0, len(self.entries)), bool)

    def _candidates(self, corners):
        """For boxes from ``corners`` on: which entries are not dominated."""
        import numpy as np

        low, entries = _fitting(corners, self.entries)
        if low.dtype != object and (2 * (np.abs(low).max(initial=0) + np.abs(entries).max(initial=0) + self.cell)) ** 2 * max(1, low.shape[1]) >= 2**62:
            low, entries = low.astype(object), entries.astype(object)
        low, e = low[:, None, :], entries[None, :, :]
        below, above = low - e, e - (low + (self.cell - 1))
        near = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(np.abs(below), np.abs(above))
        least, largest = (near * near).sum(axis=2), (far * far).sum(axis=2)
        return least <= largest.min(axis=1, keepdims=True)

    def assign(self, x):
        """(entry, squared distance) of every row of ``x``; ties go to the lower entry."""
        import numpy as np

        n = len(x)
        if not n or not x.shape[1]:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        grid = x // self.cell
        if grid.dtype == object:
            names = [tuple(r) for r in grid]
        else:
            names = [r.tobytes() for r in grid]
        if len(self.known) + n > MAX_CELLS:
            self._forget()
        new = {name: i for i, name in enumerate(names) if name not in self.known}
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.masks = np.concatenate([self.masks, self._candidates(grid[list(new.values())] * self.cell)])
        mask = self.masks[[self.known[name] for name in names]]
        row, entry = np.nonzero(mask)
        a, e = _fitting(x, self.entries)
        d = a[row] - e[entry]
        d = (d * d).sum(axis=1)
        # rows are in order and each has an entry: the least of each run, the first one on ties
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        best = np.minimum.reduceat(d, start)
        at = np.flatnonzero(d == np.repeat(best, np.diff(np.append(start, len(row)))))
        first = at[np.flatnonzero(np.append(True, row[at][1:] != row[at][:-1]))]
        return entry[first], best


def _coders(books: dict, cell: int) -> dict:
    """By vector length: the parts' bounds and their CellCodes."""
    import numpy as np

    return {n: (bounds, [CellCodes(np.array(b, dtype=object).reshape(len(b), z - a), cell) for (a, z), b in zip(bounds, parts)]) for n, (bounds, parts) in books.items()}


def _by_length(column, scale: int) -> Iterator[tuple]:
    """(length, rows, whole numbers) of an Arrow list column, by vector length, in blocks."""
    import numpy as np

    offsets, values = np.asarray(column.offsets), np.asarray(column.values)
    sizes = np.diff(offsets)
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        for at in range(0, len(rows), BLOCK):
            some = rows[at : at + BLOCK]
            yield n, some, whole(values[offsets[some][:, None] + np.arange(n)], scale)


def _limbs(value: int, count: int) -> list[int]:
    """``value`` in base 2^LIMB, all limbs but the last from 0 on."""
    out = []
    for _ in range(count - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _sums(books: dict, scale: int, cell: int, limbs: int):
    """(v) -> (len, part, entry, at, n, limb, total): sums of a task's parts by the entry they are assigned to."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coders = _coders(books, cell)
        totals: dict = {}
        for b in batches:
            for length, _, x in _by_length(b.column(0), scale):
                bounds, codes = coders[length]
                for p, ((a, z), code) in enumerate(zip(bounds, codes)):
                    entry, _ = code.assign(x[:, a:z])
                    for e in np.unique(entry).tolist():
                        mine = x[entry == e, a:z]
                        if mine.dtype != object and mine.size and int(np.abs(mine).max()) * len(mine) >= 2**62:
                            mine = mine.astype(object)
                        n, old = totals.get((length, p, e), (0, 0))
                        totals[length, p, e] = (n + len(mine), old + mine.sum(axis=0).astype(object))
        rows = [
            (length, p, e, at, n, limb, x)
            for (length, p, e), (n, total) in totals.items()
            for at, value in enumerate(total.tolist())
            for limb, x in enumerate(_limbs(int(value), limbs))
        ]
        kinds = [pa.int32()] * 4 + [pa.int64(), pa.int32(), pa.int64()]
        columns = list(zip(*rows)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["len", "part", "entry", "at", "n", "limb", "total"])

    return run


def _encode(books: dict, scale: int, cell: int):
    """(vec_id, label, v) -> (vec_id, label, len, code, error); error as text, as it may have any length."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coders = _coders(books, cell)
        for b in batches:
            code, error = [""] * b.num_rows, ["0"] * b.num_rows
            for length, rows, x in _by_length(b.column(2), scale):
                bounds, codes = coders[length]
                found = [c.assign(x[:, a:z]) for (a, z), c in zip(bounds, codes)]
                entries = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
                for i, r, d in zip(rows.tolist(), entries, zip(*(f[1].tolist() for f in found))):
                    code[i], error[i] = r.tobytes().hex(), str(sum(d))
            sizes = pa.array(np.diff(np.asarray(b.column(2).offsets)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), sizes, pa.array(code), pa.array(error)], names=["vec_id", "label", "len", "code", "error"])

    return run


def _moved(length: int, book: list, moved: dict) -> list:
    """Entries at the floor of their parts' mean; an entry without parts stays."""
    out = []
    for p, part in enumerate(book):
        out.append([])
        for e, entry in enumerate(part):
            means = [moved.get((length, p, e, i)) for i in range(len(entry))]
            out[-1].append([m[1] // m[0] if m else x for m, x in zip(means, entry)])
    return out


def codebooks_sha256(parts: list) -> str:
    """The digest of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for part in parts for entry in part for x in entry).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, cell: int = CELL) -> tuple[DataFrame, dict]:
    """((vec_id, label, code, error, label_error, codebooks_sha256) of every row that stays, the codebooks by vector length)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits, so 1 to 256 entries")
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    v = F.col("embedding").cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
    rows = scratch.save(rows, "rows")

    ranked = rows.withColumn("len", F.size("v"))
    limit = ranked.groupBy("len").agg(F.max(F.array_max(F.transform("v", F.abs))).alias("most")).collect()
    books: dict = {}
    for row in limit:  # one row a vector length
        few = ranked.where(F.col("len") == row.len).orderBy(F.col("vec_id").isNull(), "vec_id", "v").limit(entries).select("v").collect()
        start = whole([r.v for r in few], scale).tolist()
        bounds = part_bounds(row.len, parts)
        books[row.len] = (bounds, [[e[a:z] for e in start] for a, z in bounds])
    most = max((int(r.most or 0) for r in limit), default=0) * scale + scale
    limbs = 1 + (most.bit_length() + 40) // LIMB  # a task sums no 2^40 rows

    for _ in range(rounds):
        if not books:
            break
        sums = rows.select("v").mapInArrow(lean(_sums(books, scale, cell, limbs)), "len int, part int, entry int, at int, n long, limb int, total long")
        sums = sums.groupBy("len", "part", "entry", "at", "limb").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        moved: dict = {}
        for r in sums.collect():  # parts x entries x part length rows a vector length, whatever the table
            n, total = moved.get((r.len, r.part, r.entry, r.at), (0, 0))
            moved[r.len, r.part, r.entry, r.at] = (r.n, total + (int(r.total) << (LIMB * r.limb)))
        books = {length: (bounds, _moved(length, book, moved)) for length, (bounds, book) in books.items()}

    label = vectors.schema["label"].dataType.simpleString()
    coded = rows.mapInArrow(lean(_encode(books, scale, cell)), f"vec_id long, label {label}, len int, code string, error string")
    digests = F.lit(None).cast("string")
    for length, (_, book) in books.items():
        digests = F.when(F.col("len") == length, codebooks_sha256(book)).otherwise(digests)
    coded = scratch.save(coded.withColumn("codebooks_sha256", digests), "coded")
    exact = F.col("error").try_cast("decimal(38,0)")
    by_label = coded.groupBy("label").agg(F.sum(exact).try_cast("long").alias("label_error"), F.count_if(exact.isNull()).alias("beyond"))
    by_label = by_label.select(F.col("label").alias("its"), F.when(F.col("beyond") == 0, F.col("label_error")).alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("its")))
    return out.select("vec_id", "label", "code", F.col("error").try_cast("long").alias("error"), "label_error", "codebooks_sha256"), books


ship(__name__)
