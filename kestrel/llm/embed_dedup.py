"""Near-duplicate embeddings with an inverted multi-index.

1. Equal vectors are one class (its smallest id stands for it), so copies never meet in pairs. Classes are found by a
   128-bit hash of the vectors; the vectors themselves are shuffled once for this.
2. A coarse codebook, fitted by k-means on a bounded sample (``SAMPLE`` classes), deals the classes to cells of some
   thousands. A class is shipped to its own cell, and as a visitor to the cells whose border is near. Of two neighbours
   one at least has to visit the other's cell, which is the nearer of two ways to a border: few visits are shipped.
   Vectors of each dimension have cells and a sample of their own. Cells are shipped in rounds of about the size of the
   table, each verified before the next, so the disk holds one round at a time.
3. In a cell, the members lie in a grid: the product of two independent codebooks, one per half of the vectors, fitted
   on the members. A vector visits the cells of the grid whose cost - the sum, over the halves, of the squared distance
   to the border of the codeword's region - is at most the cost at which ``RECALL`` of neighbours lying exactly on the
   threshold (the hardest ones), drawn around sample vectors, and of the sample's own neighbours, have been reached.
   The coarse cells' distance is calibrated alike; each of the two may miss half of what ``RECALL`` leaves.
4. A visited cell verifies: cosine in double precision wherever single precision does not decide. Coarse cells are cut
   into blocks of members and of visitors, so a cell with a third of all rows is many tasks. Each vector counts its
   links; of the links themselves only a spanning forest per block leaves the task, so dense
   groups are not expanded. Components follow from these.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import Scratch, cut, in_batches
from kestrel.llm.components import components

THRESHOLD = 0.95
SAMPLE = 8_192
RECALL = 0.9999
PER_CELL = 128              # members per cell of a grid aimed at
CELL, CELLS, LARGE = 2_048, 64, 32_768  # members per coarse cell aimed at: the first up to so many cells, at most the last
MEMBERS, VISITORS = 131_072, 1_048_576   # rows per block
ROUND_BYTES, ROUND = 256 << 20, 1.25     # shipped in a round: so many bytes, or so many times the vectors
QUERIES, SCORES = 8_192, 1 << 22         # visitors and scores held at a time
BOUND = 24                               # directions of the bound on the cosine
BITS = 63                                # rounds that share a bit are told apart by their cells
SEED = 3


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows as normalised doubles."""
    a = raw.astype(np.float64)
    a /= np.abs(a).max(1, keepdims=True)              # no overflow or underflow in the norm
    return a / np.sqrt((a * a).sum(1, keepdims=True)) + 0.0


def _linkable(col):
    """(places, rows) per dimension of the vectors that can link: not null, empty or zero, all components finite."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    values = col.flatten().to_numpy(zero_copy_only=False)     # null components are NaN here
    for d in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == d)
        raw = values.reshape(-1, d) if len(at) * d == len(values) else values[start[at][:, None] + np.arange(d)]
        ok = np.isfinite(raw).all(1) & (raw != 0).any(1)
        if ok.any():
            yield at[ok], raw[ok]


def _hashes(raw):
    whole, width = memoryview(_unit(raw).tobytes()), 8 * raw.shape[1]
    return [blake2b(whole[i:i + width], digest_size=16).digest() for i in range(0, len(whole), width)]


def _keys(batches):
    """vec_id, h, d: the hash of the normalised vector, null if it links with nothing, and its dimension."""
    for batch in batches:
        h, d = np.full(batch.num_rows, None, object), np.zeros(batch.num_rows, np.int32)
        for at, raw in _linkable(batch.column("embedding")):
            h[at], d[at] = _hashes(raw), raw.shape[1]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").cast(pa.int64()), pa.array(h, pa.binary()), pa.array(d)], names=["vec_id", "h", "d"])


def _vectors(batches):
    """vec_id, h, v: the hash and the components, as they are, of the vectors that can link."""
    for batch in batches:
        ids = batch.column("vec_id").cast(pa.int64())
        for at, raw in _linkable(batch.column("embedding")):
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(_hashes(raw), pa.binary()), _binary(raw)], names=["vec_id", "h", "v"])


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    ends = np.arange(len(rows) + 1, dtype=np.int64) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(col, kind) -> np.ndarray:
    """A binary column of rows of one length as a matrix."""
    return _joined(col, kind).reshape(len(col), -1)


def _joined(col, kind) -> np.ndarray:
    """The contents of a binary column without nulls, one after the other."""
    col = col.cast(pa.binary())
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])), kind)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)
        for i in range(len(c)):
            rows = x[own == i]
            c[i] = rows.mean(0) if len(rows) else x[rng.integers(len(x))]
    return c


class Grid:
    """Codebooks, one per part of the vectors, and the stopping cost; plain arrays.

    ``both``: of two neighbours it is enough that one visits the other's cell.
    """

    def __init__(self, sample: np.ndarray, k: int, threshold: float, parts: int = 2, both: bool = False):
        rng = np.random.default_rng(SEED)
        self.d = sample.shape[1]
        half = self.d if parts == 1 else self.d // 2 or 1
        self.cut = half
        self.held = held = len(sample) // 4 if len(sample) >= 4 * k else 0     # codewords lie nearer to what they were fitted on
        fit, test = (sample[held:], sample[:held]) if held else (sample, sample)
        self.books = [_kmeans(fit[:, :half], k, rng), _kmeans(fit[:, half:], k, rng) if self.d > half else np.zeros((1, 0), sample.dtype)]
        self.gaps = [2 * np.sqrt(np.maximum(((c * c).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * c @ c.T), 1e-12)) for c in self.books]
        # neighbours on the threshold in random directions and towards other vectors, and the sample's own neighbours
        base = np.repeat(test[:2048], 16 * max(1, 2048 // len(test)), axis=0)
        costs = [self._near(base, rng.normal(size=base.shape).astype(base.dtype), threshold, both),
                 self._near(base, test[rng.integers(len(test), size=len(base))], threshold, both)]
        own = []
        for i in range(0, len(test), 1024):
            a, b = np.nonzero(test[i:i + 1024] @ sample.T >= threshold)
            a, b = a[a + i != b], b[a + i != b]
            few = rng.permutation(len(a))[:4096]
            own.append(self._cost_of(test[i:i + 1024][a[few]], sample[b[few]], both))
        costs.append(np.concatenate(own))
        self.stop = max(float(np.quantile(c, 1 - (1 - RECALL) / 2)) for c in costs if len(c)) + 1e-7

    def _near(self, base, step, threshold, both):
        step = step - (step * base).sum(1, keepdims=True) * base
        step /= np.maximum(np.linalg.norm(step, axis=1, keepdims=True), 1e-6)
        return self._cost_of(base, threshold * base + np.sqrt(1 - threshold ** 2).astype(base.dtype) * step, both)

    def halves(self, x):
        return x[:, :self.cut], x[:, self.cut:]

    def costs(self, x):
        """Per part: squared distance of every vector to the border of every codeword's region."""
        out = []
        for part, c, gap in zip(self.halves(x), self.books, self.gaps, strict=True):
            d = (c * c).sum(1)[None] - 2 * part @ c.T
            own, at = d.argmin(1), np.arange(len(d))
            d -= d[at, own][:, None]
            d /= gap[own]
            d[at, own] = 0
            out.append((np.square(d, out=d), own))
        return out

    def cells(self, x):
        out = np.zeros(len(x), np.int64)
        for i in range(0, len(x), QUERIES):
            (_, a), (_, b) = self.costs(x[i:i + QUERIES])
            out[i:i + QUERIES] = a * len(self.books[1]) + b
        return out

    def _cost_of(self, x, y, both):
        out = [np.zeros(0)]
        for i in range(0, len(x), 2048):
            (ca, xa), (cb, xb) = self.costs(x[i:i + 2048])
            (da, ya), (db, yb) = self.costs(y[i:i + 2048])
            at = np.arange(len(xa))
            cost = ca[at, ya] + cb[at, yb]
            out.append(np.minimum(cost, da[at, xa] + db[at, xb]) if both else cost)
        return np.concatenate(out)

    def visits(self, x):
        """Matrix: does this vector (row) visit this cell? Each visits its own."""
        (ca, _), (cb, _) = self.costs(x)
        return (ca[:, :, None] + cb[:, None, :] <= self.stop).reshape(len(x), -1)


def _grid(state) -> Grid:
    grid = Grid.__new__(Grid)
    grid.__dict__.update(state)
    return grid


class Dealer:
    """Where the classes of one dimension go: the coarse cells, their blocks and rounds; plain arrays.

    Block ``first + i * vb + j`` of a cell has its members number i and its visitors number j.
    """

    def __init__(self, sample: np.ndarray, kind: str, total: int, threshold: float, first: int):
        k = int(np.clip(total / CELL, 1, CELLS))
        self.grid = vars(Grid(sample.astype(np.float32), int(np.clip(total / LARGE, k, max(1, len(sample) // 4))), threshold, parts=1, both=True))
        self.kind, self.d = kind, sample.shape[1]
        grid, cells = _grid(self.grid), len(self.grid["books"][0])
        test = sample[:grid.held] if grid.held else sample        # as in the table: not what the codewords were fitted on
        own = np.bincount(grid.cells(sample.astype(np.float32)), minlength=cells) * (total / len(sample))
        seen = sum(grid.visits(test[i:i + 1024].astype(np.float32)).sum(0) for i in range(0, len(test), 1024)) * (total / len(test))
        self.mb = np.maximum(1, np.ceil(own / MEMBERS)).astype(np.int64)
        self.vb = np.maximum(1, np.ceil(seen / VISITORS)).astype(np.int64)
        self.first = first + np.cumsum(self.mb * self.vb) - self.mb * self.vb
        self.end = first + int((self.mb * self.vb).sum())
        width = sample.shape[1] * np.dtype(kind).itemsize
        self.bytes = (own * self.vb + np.where(self.mb * self.vb > 1, seen, np.maximum(seen - own, 0)) * self.mb) * (width + 80)
        self.width = total * width

    def alone(self):
        """Cells that are one block, in which the members are the visitors of their own cell as well."""
        return self.mb * self.vb == 1


def _dealer(state) -> Dealer:
    out = Dealer.__new__(Dealer)
    out.__dict__.update(state)
    return out


VECTORS = "vec_id long, h binary, v binary"
SEEN = "rep long, copies long, rounds long, seen binary, v binary"
ROWS = "k long, own int, rep long, copies long, seen binary, v binary"   # own: the visitor's own cell, -1 of a member


def _expand(n):
    """(place, 0 .. n[place] - 1) of every place, so often."""
    at = np.repeat(np.arange(len(n)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)


def _see(model):
    """rep, copies, rounds, seen, v: the coarse cells that a class visits, its own first, and a bit for each of their rounds."""
    def run(batches):
        dealers = [_dealer(state) for state in model.value]
        for whole in batches:
            size = pc.binary_length(whole.column("v")).to_numpy(zero_copy_only=False)
            for dealer in dealers:
                fits = np.flatnonzero(size == dealer.d * np.dtype(dealer.kind).itemsize)
                if not len(fits):
                    continue
                batch, grid = whole.take(pa.array(fits)), _grid(dealer.grid)
                x = _unit(_matrix(batch.column("v"), dealer.kind)).astype(np.float32)
                own, visits, at = grid.cells(x), grid.visits(x), np.arange(len(x))
                visits[at, own] = False
                row, cell = np.nonzero(visits)
                by = np.argsort(np.concatenate([at, row]), kind="stable")
                ends = np.concatenate([[0], np.cumsum(visits.sum(1) + 1)]) * 4
                cells = np.concatenate([own, cell])[by].astype(np.int32)
                seen = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(cells)])
                rounds = np.bitwise_or.reduceat(np.int64(1) << dealer.round[cells], ends[:-1] // 4)
                yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("copies"), pa.array(rounds), seen, batch.column("v")],
                                                 names=["rep", "copies", "rounds", "seen", "v"])
    return run


def _place(model, now, keys):
    """The rows of the round ``now``: per dealer, its cells of this round; ``keys`` has the key of each block."""
    def run(batches):
        dealers = [_dealer(state) for state in model.value]
        for whole in batches:
            size = pc.binary_length(whole.column("v")).to_numpy(zero_copy_only=False)
            for dealer, cells in zip(dealers, now, strict=True):
                fits = np.flatnonzero(size == dealer.d * np.dtype(dealer.kind).itemsize)
                if not len(fits) or not cells.any():
                    continue
                batch = whole if len(fits) == len(size) else whole.take(pa.array(fits))
                raw, seen = _matrix(batch.column("v"), dealer.kind), batch.column("seen")
                rep, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "copies"))
                n = pc.binary_length(seen).to_numpy(zero_copy_only=False) // 4
                row, cell = np.repeat(np.arange(len(n)), n), _joined(seen, np.int32).astype(np.int64)
                own = cell[np.cumsum(n) - n]
                dealt = ((rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
                # members go to all blocks of visitors, visitors to all blocks of members
                m = np.flatnonzero(cells[own])
                at, o = _expand(dealer.vb[own[m]])
                m = m[at]
                keep = cells[cell] & ((cell != own[row]) | ~dealer.alone()[cell])
                v, c = row[keep], cell[keep]
                to, p = _expand(dealer.mb[c])
                v, c = v[to], c[to]
                pick = np.concatenate([m, v])
                k = keys[np.concatenate([dealer.first[own[m]] + dealt[m] % dealer.mb[own[m]] * dealer.vb[own[m]] + o,
                                         dealer.first[c] + p * dealer.vb[c] + dealt[v] % dealer.vb[c]])]
                side = np.concatenate([np.full(len(m), -1), own[v]]).astype(np.int32)
                told = pa.array(np.concatenate([m, np.full(len(v), -1)]), mask=side >= 0)
                step = max(1, (32 << 20) // (raw.shape[1] * raw.itemsize))
                for i in range(0, len(pick), step):
                    part = pick[i:i + step]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k[i:i + step]), pa.array(side[i:i + step]), pa.array(rep[part]), pa.array(copies[part]),
                         seen.take(told[i:i + step]), _binary(raw[part])], names=["k", "own", "rep", "copies", "seen", "v"])
    return run


class Bound:
    """An upper bound on the cosine from the ``BOUND`` main directions of some vectors, as one short product.

    With u and w the differences of two vectors to the mean, of length p and q outside the directions, u w is at most
    their product in the directions, plus p q.
    """

    def __init__(self, some: np.ndarray):
        self.mean = some.mean(0)
        u, rng = some - self.mean, np.random.default_rng(SEED)
        self.axes = rng.normal(size=(some.shape[1], BOUND)).astype(some.dtype)
        for _ in range(3):
            self.axes = np.linalg.qr(u.T @ (u @ self.axes) + 1e-6 * self.axes)[0]
        self.slack = (some.shape[1] + 64) * 2.0 ** -22

    def sides(self, x):
        """The rows' two sides: the product of a left and a right one, plus 1, is at least the cosine less ``slack``."""
        u = x - self.mean
        inside, whole = u @ self.axes, (u * u).sum(1)
        rest, one = np.sqrt(np.maximum(whole - (inside * inside).sum(1), 0)), np.ones(len(x), x.dtype)
        return (np.column_stack([inside, rest, whole / -2, one]), np.column_stack([inside, rest, one, whole / -2]))


class Block:
    """One block: members first, then visitors; counts links and joins what is linked."""

    def __init__(self, k, dealers, threshold):
        self.dealer = next(d for d in dealers if d.first[0] <= k < d.end)
        self.cell = int(np.searchsorted(self.dealer.first, k, "right")) - 1
        self.threshold = threshold
        self.close = (self.dealer.d + 4) * 2.0 ** -23     # single precision decides beyond this
        self.members, self.visitors, self.waiting, self.ready = [], [], 0, False

    def add(self, rows):
        own = rows.column("own").to_numpy()
        n = int(np.searchsorted(own, 0))
        if n:
            self.members.append(rows.slice(0, n))
        if n < len(own):
            self.visitors.append(rows.slice(n))
            self.waiting += len(own) - n
            if self.waiting >= QUERIES:
                yield from self.answer()

    def read(self, pieces):
        rep, copies = (np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in pieces]) for c in ("rep", "copies"))
        raw = np.concatenate([_matrix(p.column("v"), self.dealer.kind) for p in pieces])
        return rep, copies, raw

    def index(self):
        """The members by their cells of the grid, in the order of their ids there."""
        self.ready = True
        rep, copies, raw = self.read(self.members)
        seen = [s for p in self.members for s in p.column("seen").to_pylist()]
        self.members = None
        by = np.argsort(rep, kind="stable")
        rep, copies, raw, seen = rep[by], copies[by], raw[by], [seen[i] for i in by]
        x = np.concatenate([_unit(raw[i:i + QUERIES]).astype(np.float32) for i in range(0, len(raw), QUERIES)])
        k = int(np.sqrt(len(x) / PER_CELL))
        self.grid, self.starts = None, np.array([0, len(x)])
        if k >= 4:        # fewer are compared with all members
            few = np.random.default_rng(SEED).permutation(len(x))[:SAMPLE]
            self.grid = Grid(x[few], k, self.threshold)
            cells = self.grid.cells(x)
            by = np.argsort(cells, kind="stable")
            rep, copies, raw, seen, x = rep[by], copies[by], raw[by], [seen[i] for i in by], x[by]
            self.starts = np.searchsorted(cells[by], np.arange(len(self.grid.books[0]) * len(self.grid.books[1]) + 1))
        self.rep, self.copies, self.raw, self.x = rep, copies, raw, x
        self.bound = Bound(x[np.random.default_rng(SEED).permutation(len(x))[:SAMPLE]]) if self.dealer.d > 2 * BOUND else None
        if self.bound is not None:
            self.sides = np.concatenate([self.bound.sides(x[i:i + QUERIES])[1] for i in range(0, len(x), QUERIES)])
        n = np.array([len(s) // 4 for s in seen])
        cell, row = np.frombuffer(b"".join(seen), np.int32), np.repeat(np.arange(len(x)), n)
        self.bits = np.zeros((len(x), len(self.dealer.mb) // 8 + 1), np.uint8)
        np.bitwise_or.at(self.bits, (row, cell >> 3), (1 << (cell & 7)).astype(np.uint8))
        self.label, self.links = np.arange(len(x)), np.zeros(len(x), np.int64)

    def scores(self, x):
        """(p, r, cosine) of vectors and members that may link, as single precision has it; few at a time."""
        low = np.float32(self.threshold - self.close)
        visits = None if self.grid is None else np.ascontiguousarray(self.grid.visits(x).T)
        short = None if self.bound is None else self.bound.sides(x)[0]
        least = None if self.bound is None else np.float32(self.threshold - 1 - self.bound.slack)
        for cell in range(len(self.starts) - 1):
            s, e = int(self.starts[cell]), int(self.starts[cell + 1])
            if s == e:
                continue
            rows = np.arange(len(x)) if visits is None else np.flatnonzero(visits[cell])
            step = max(1, SCORES // (e - s))
            for i in range(0, len(rows), step):
                part = rows[i:i + step]
                if short is not None:       # few pairs reach the bound, or the whole product is cheaper
                    hit = np.flatnonzero(short[part] @ self.sides[s:e].T >= least)
                    if len(hit) * 16 < len(part) * (e - s):
                        if len(hit):
                            p, r = part[hit // (e - s)], s + hit % (e - s)
                            g = np.einsum("ij,ij->i", x[p], self.x[r])
                            yes = g >= low
                            yield p[yes], r[yes], g[yes]
                        continue
                g = x[part] @ self.x[s:e].T
                hit = np.flatnonzero(g >= low)
                if len(hit):
                    yield part[hit // (e - s)], s + hit % (e - s), g.reshape(-1)[hit]

    def batches_of_hits(self, x, raw, rep):
        """(p, r) of vectors and members that link."""
        held, n = [], 0
        for found in self.scores(x):
            held.append(found)
            n += len(found[0])
            if n >= SCORES // 4:
                yield self.exact(held, raw, rep)
                held, n = [], 0
        if held:
            yield self.exact(held, raw, rep)

    def exact(self, held, raw, rep):
        p, r, g = (np.concatenate(z) for z in zip(*held, strict=True))
        keep = rep[p] != self.rep[r]
        unsure = np.flatnonzero(keep & (g < self.threshold + self.close))
        for i in range(0, len(unsure), QUERIES):
            at = unsure[i:i + QUERIES]
            keep[at] = (_unit(raw[p[at]]) * _unit(self.raw[r[at]])).sum(1) >= self.threshold
        return p[keep], r[keep]

    def unite(self, a, b):
        """Members a[i] and b[i] get one label, the smallest."""
        while True:
            la, lb = self.label[a], self.label[b]
            if (la == lb).all():
                return
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]

    def answer(self):
        """Links of the visitors that wait."""
        if not self.ready and self.members:
            self.index()
        pieces, self.visitors, self.waiting = self.visitors, [], 0
        if not self.ready or not pieces:
            return
        rep, copies, raw = self.read(pieces)
        own = np.concatenate([p.column("own").to_numpy() for p in pieces])
        for i in range(0, len(rep), QUERIES):
            s = slice(i, i + QUERIES)
            yield self.visit(rep[s], copies[s], raw[s], own[s])

    def visit(self, rep, copies, raw, own):
        links, linked = np.zeros(len(rep), np.int64), np.full(len(rep), -1)
        for p, r in self.batches_of_hits(_unit(raw).astype(np.float32), raw, rep):
            np.add.at(links, p, self.copies[r])
            # a member that does not visit the visitor's cell counts the link here
            back = own[p] != self.cell
            back &= (self.bits[r, own[p] >> 3] >> (own[p] & 7) & 1) == 0
            np.add.at(self.links, r[back], copies[p[back]])
            new = linked[p] < 0
            linked[p[new][::-1]] = r[new][::-1]
            self.unite(linked[p], r)
        some = linked >= 0
        return _found(rep[some], links[some], self.rep[linked[some]], np.zeros(int(some.sum()), bool))

    def end(self):
        yield from self.answer()
        if not self.ready and self.members:
            self.index()
        if not self.ready:
            return
        if self.dealer.alone()[self.cell]:
            for i in range(0, len(self.x), QUERIES):
                s = slice(i, i + QUERIES)
                for p, r in self.batches_of_hits(self.x[s], self.raw[s], self.rep[s]):
                    np.add.at(self.links, p + i, self.copies[r])
                    self.unite(p + i, r)
        joined = self.label != np.arange(len(self.label))
        some = joined | (self.links > 0)
        yield _found(self.rep[some], self.links[some], self.rep[self.label[some]], ~joined[some])


def _found(a, n, b, mask):
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(n), pa.array(b, mask=mask)], names=["a", "n", "b"])


def _verify(model, threshold, blocks):
    """Links of the members and visitors of each block; ``blocks`` has the block of each key."""
    def run(batches):
        dealers, block, last = [_dealer(state) for state in model.value], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("k").to_numpy()
            edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if last != k[s]:
                    if block is not None:
                        yield from block.end()
                    last = int(k[s])
                    block = Block(blocks[last], dealers, threshold)
                yield from block.add(batch.slice(s, e - s))
        if block is not None:
            yield from block.end()

    return run


def _rounds(dealers) -> list[list[np.ndarray]]:
    """Per round and dealer: which cells. A round ships at most ``ROUND_BYTES``, or ``ROUND`` times the vectors, or one cell."""
    limit = max(ROUND_BYTES, ROUND * sum(d.width for d in dealers))
    cost = np.concatenate([d.bytes for d in dealers])
    least = max(1, int(np.ceil(cost.sum() / limit)))
    of, load = np.zeros(len(cost), np.int64), np.zeros(least)
    for c in np.argsort(-cost, kind="stable"):        # the largest first, each to the round with the least
        of[c] = load.argmin()
        load[of[c]] += cost[c]
    ends = np.cumsum([len(d.bytes) for d in dealers])[:-1]
    return [np.split(of == i, ends) for i in range(least)]


def _keys_of(spark, n: int) -> list[int]:
    """A key for each of ``n`` blocks, so that hash partitioning by key into ``n`` partitions gives each its own."""
    ids = spark.range(32 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).collect()
    first = {r.p: r.id for r in reversed(ids)}
    return [first.get(p, 32 * n + p) for p in range(n)]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector.

    Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing; vectors of different dimensions do not link; rows that repeat id and vector
    count once; a null id links with nothing
    and has a null component; an empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession)
    try:
        return cut(_near_duplicates(vectors, threshold, scratch))
    finally:
        scratch.close()


def _near_duplicates(vectors: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    spark = vectors.sparkSession
    kind, of = ("f4", "array<float>") if dict(vectors.dtypes)["embedding"] == "array<float>" else ("f8", "array<double>")
    base = in_batches(vectors).select(F.col("vec_id"), F.col("embedding").cast(of).alias("embedding"))
    units = scratch.cut(base.mapInArrow(_keys, "vec_id long, h binary, d int").distinct())
    classes = scratch.cut(units.where("h is not null and vec_id is not null").groupBy("h")
                          .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("d").alias("d")))
    dims = sorted((r.d, r.n) for r in classes.groupBy("d").agg(F.count(F.lit(1)).alias("n")).collect())
    links = None
    counts = classes.select(F.col("rep").alias("a"), F.lit(0).cast("long").alias("n")).limit(0)
    if dims:
        dealers = []
        for d, total in dims:
            some = classes.where(F.col("d") == d)
            if total > 4 * SAMPLE:      # a hash sample first, so that the order is taken over few rows
                some = some.where(F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * 1.5 * SAMPLE / total))
            some = some.orderBy(F.xxhash64("rep"), "rep", "h").limit(SAMPLE).select("rep", "h").collect()
            some = F.broadcast(spark.createDataFrame([(r.rep, r.h) for r in some], "rep long, _h binary"))
            shown = base.join(some.select(F.col("rep").alias("vec_id")).distinct(), "vec_id").mapInArrow(_vectors, VECTORS)
            shown = {bytes(r.h): bytes(r.v) for r in shown.join(some, (F.col("h") == F.col("_h")) & (F.col("vec_id") == F.col("rep"))).orderBy("v").collect()}
            sample = _unit(np.array([np.frombuffer(shown[h], kind) for h in sorted(shown)]))
            dealers.append(Dealer(sample, kind, total, threshold, dealers[-1].end if dealers else 0))
        rounds = _rounds(dealers)
        for number, dealer in enumerate(dealers):
            dealer.round = sum(np.where(now[number], i % BITS, 0) for i, now in enumerate(rounds)).astype(np.int64)
        model = spark.sparkContext.broadcast([vars(d) for d in dealers])   # codebooks and blocks, bounded by the samples
        shown = base.where("vec_id is not null").mapInArrow(_vectors, VECTORS)
        shown = (shown.join(classes.withColumnRenamed("h", "_h"), (F.col("h") == F.col("_h")) & (F.col("vec_id") == F.col("rep")))
                 .dropDuplicates(["h", "vec_id"]).select("rep", "copies", "v"))
        shown = scratch.cut(shown.mapInArrow(_see(model), SEEN))
        scratch.release()
        found = None
        for i, now in enumerate(rounds):
            blocks = np.flatnonzero(np.concatenate([np.repeat(c, d.mb * d.vb) for d, c in zip(dealers, now, strict=True)])).tolist()
            keys = np.zeros(dealers[-1].end, np.int64)
            keys[blocks] = _keys_of(spark, len(blocks))
            rows = shown.where(F.col("rounds").bitwiseAND(F.lit(1 << i % BITS)) != 0).mapInArrow(_place(model, now, keys), ROWS)
            part = scratch.cut(rows.repartition(len(blocks), "k").sortWithinPartitions("k", "own")
                               .mapInArrow(_verify(model, threshold, dict(zip(keys[blocks].tolist(), blocks, strict=True))), "a long, n long, b long"))
            found = part if found is None else found.union(part)
            del rows, part
            scratch.release()
        scratch.drop(shown)
        counts = found.groupBy("a").agg(F.sum("n").alias("n"))
        links = found.where("b is not null").select("a", "b")
    labels = components(links, scratch=scratch) if links is not None else counts.select(F.col("a").alias("id"), F.col("n").alias("component"))
    named = (classes.join(counts, classes["rep"] == counts["a"], "left").join(labels, F.col("rep") == labels["id"], "left")
             .select(F.col("h").alias("_h"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_n"),
                     F.coalesce("component", "rep").alias("_c")))
    out = units.join(named, (units["h"] == named["_h"]) & units["vec_id"].isNotNull(), "left")
    return out.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("_c", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("_c", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))


def op3_embedding_dedup(spark, sf_dir):
    from kestrel.llm.common import table

    return near_duplicates(table(spark, sf_dir, "embeddings"))
