"""A small causal self-attention model over subword ids, in numpy.

Every piece of the vocabulary has a row of its own with its query, key, key
bias, value and output; the sum of attended values and the piece's own output
predicts the class of the next piece. The most frequent pieces are classes of
their own, the others share classes by frequency, and a piece within a class is
predicted by its count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import as_strided

#: Width of queries and keys, width of values, classes (of which shared).
HEAD, WIDTH, CLASSES, SHARED_CLASSES = 8, 16, 64, 8
#: Columns of a piece's row; the one after the query and before the value is always 1, so that products add the bias and sum the weights.
K, B, Q, ONE = slice(0, HEAD), HEAD, slice(HEAD + 1, 2 * HEAD + 1), 2 * HEAD + 1
V, R = slice(ONE + 1, ONE + 1 + WIDTH), slice(ONE + 1 + WIDTH, ONE + 1 + 2 * WIDTH)
COLUMNS = R.stop
#: Key and bias, query and one, one and value.
KB, QO, OV = slice(0, HEAD + 1), slice(Q.start, ONE + 1), slice(ONE, V.stop)
#: Earlier pieces a window repeats for context, and pieces it scores.
CONTEXT, STRIDE = 64, 64
WINDOW = CONTEXT + STRIDE
BEGIN, END, PAD, SPECIALS = 0, 1, 2, 3  # after the vocabulary
#: Bounds of attention scores before the exponential, once one is above or, as PAD with its bias of -40 never is, below three times the lower.
LIMIT = 20
#: Most and least that the log chance of a class may be before the exponential.
CLASS_LIMIT = 80
#: Consecutive windows that are learnt, and scored, side by side: the context of one is what the one before scores.
RUN, SCORE_RUN = 4, 32
#: Runs that are cut out of a stream at once.
RUNS_CUT = 128
#: Gradients of a row that are added one by one, before the rest of frequent rows.
FEW = 4


@dataclass
class Pieces:
    """What the counts of pieces fix: rows (by falling count) and classes of all pieces, and log chances within classes."""

    size: int
    row: np.ndarray
    cls: np.ndarray
    inside: np.ndarray
    class_log: np.ndarray

    @property
    def pad(self) -> int:
        return int(self.row[self.size + PAD])


def arrange(counts: np.ndarray) -> Pieces:
    """Rows and classes from the counts of all vocabulary pieces and of END (last)."""
    size = len(counts) - 1
    full = np.zeros(size + SPECIALS)
    full[:size], full[size + END] = counts[:size], counts[size]
    order = np.argsort(-full, kind="stable")
    own = CLASSES - SHARED_CLASSES
    cls = np.zeros(len(full), np.int32)
    cls[order[:own]] = np.arange(own)
    rest = order[own:]
    mass = np.cumsum(full[rest] + 0.5)
    cls[rest] = own + np.minimum(SHARED_CLASSES - 1, (mass - 0.25) / mass[-1] * SHARED_CLASSES).astype(np.int32)
    row = np.zeros(len(full), np.int32)
    row[order] = np.arange(len(full))
    smooth = full + 0.5
    sums = np.bincount(cls, smooth, minlength=CLASSES)
    return Pieces(size, row, cls, np.log(smooth / sums[cls]), np.log(np.maximum(sums, 0.5) / np.maximum(sums, 0.5).sum()))


def initial(pieces: Pieces, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def small(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.1, shape).astype(np.float32)

    rows = small(len(pieces.row), COLUMNS)
    rows[:, B], rows[:, ONE] = 0, 1
    rows[pieces.pad, B] = -2 * LIMIT
    return {"rows": rows, "pq": small(STRIDE, HEAD), "pk": small(WINDOW, HEAD), "w": small(CLASSES, WIDTH), "o": pieces.class_log.astype(np.float32)}


#: Parameters that every window uses.
SHARED = ("o", "pk", "pq", "w")


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    """The parameters that every window uses, as one vector."""
    return np.concatenate([params[k].ravel() for k in SHARED])


def unflat(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in SHARED:
        out[k] = vector[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


@dataclass
class Stream:
    """Documents one after the other: the input row and the target of every place, and where documents start."""

    rows: np.ndarray
    target: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    pad: int

    @classmethod
    def of(cls, ids: np.ndarray, lengths: np.ndarray, pieces: Pieces) -> Stream:
        """Inputs are BEGIN and the pieces of a document, targets its pieces and END."""
        ends = np.cumsum(lengths + 1)
        starts = ends - lengths - 1
        inputs = np.full(len(ids) + len(lengths), pieces.size + BEGIN, np.int32)
        inner = np.ones(len(inputs), bool)
        inner[starts] = False
        inputs[inner] = ids
        target = np.full(len(inputs), pieces.size + END, np.int32)
        target[:-1][inner[1:]] = inputs[1:][inner[1:]]
        return cls(pieces.row[inputs], target, starts, ends, pieces.pad)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and first scored place of every window; a place is scored in one window."""
        per = -(-(self.ends - self.starts) // STRIDE)
        doc = np.repeat(np.arange(len(per)), per)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        return doc, self.starts[doc] + nth * STRIDE

    def cut(self, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input rows of some windows (PAD outside the document), places to score, and which of them are there."""
        at = first[:, None] + np.arange(-CONTEXT, STRIDE)
        there = (at >= self.starts[doc][:, None]) & (at < self.ends[doc][:, None])
        at = np.clip(at, 0, len(self.rows) - 1)
        return np.where(there, self.rows[at], self.pad), at[:, CONTEXT:], there[:, CONTEXT:]


def side_by_side(stream: Stream, classes: np.ndarray, run: int) -> tuple[np.ndarray, ...]:
    """All windows of a stream, ``run`` after one another: input rows (context first), target classes, places to score, new documents, and the documents of the windows.

    The last run is filled with windows of PAD.
    """
    doc, first = stream.windows()
    runs = -(-len(doc) // run)
    rows, goals, scored = np.full((runs, run + 1, STRIDE), stream.pad, np.int32), np.zeros((runs, run, STRIDE), classes.dtype), np.zeros((runs, run, STRIDE), bool)
    for i in range(0, runs, RUNS_CUT):
        part = slice(i * run, (i + RUNS_CUT) * run)
        found, at, there = stream.cut(doc[part], first[part])
        rows[i : i + RUNS_CUT, 0] = found[::run, :CONTEXT]
        n, more = -(-len(found) // run), ((0, -len(found) % run), (0, 0))
        for whole, cut, rest in ((rows[i : i + n, 1:], found[:, CONTEXT:], stream.pad), (goals[i : i + n], classes[at], 0), (scored[i : i + n], there, False)):
            whole[...] = np.pad(cut, more, constant_values=rest).reshape(n, run, STRIDE)
    fresh = np.r_[first == stream.starts[doc], np.ones(runs * run - len(doc), bool)].reshape(runs, run)
    return rows.reshape(runs, -1), goals.reshape(runs, -1), scored.reshape(runs, -1), fresh, doc


#: The context is before every place to score; of the places themselves each sees those up to itself.
_HALF = STRIDE // 2
_CAUSAL = np.tril(np.ones((_HALF, _HALF), np.float32))


def _attend(p: dict, rows: np.ndarray, fresh: np.ndarray | None, bounded: bool = False) -> tuple[np.ndarray, ...]:
    """Of a batch of runs: queries (then 1) and keys (then bias) with places along rows, values (after 1), outputs, and the masked exponentials of the scores."""
    x = np.take(p["rows"], rows.reshape(len(rows), -1, STRIDE), axis=0)
    n, windows = len(x), x.shape[1] - 1
    q, k = np.empty((n, windows, HEAD + 1, STRIDE), x.dtype), np.empty((n, windows, HEAD + 1, WINDOW), x.dtype)
    q[...] = x[:, 1:, :, QO].swapaxes(2, 3)
    q[:, :, :HEAD] += p["pq"].T
    k[..., :CONTEXT], k[..., CONTEXT:] = x[:, :-1, :, KB].swapaxes(2, 3), x[:, 1:, :, KB].swapaxes(2, 3)
    k[:, :, :HEAD] += p["pk"].T
    v = as_strided(x[..., OV], (n, windows, WINDOW, WIDTH + 1), x.strides, writeable=False)
    e = q.swapaxes(2, 3) @ k
    if not bounded and (e.max() > LIMIT or e.min() < -3 * LIMIT):
        np.clip(e, -LIMIT, LIMIT, out=e)
    np.exp(e, out=e)
    e[:, :, :_HALF, CONTEXT : CONTEXT + _HALF] *= _CAUSAL
    e[:, :, :_HALF, CONTEXT + _HALF :] = 0
    e[:, :, _HALF:, CONTEXT + _HALF :] *= _CAUSAL
    if fresh is not None:
        e[..., :CONTEXT][fresh] = 0
    return q, k, v, x[:, 1:, :, R], e


def _outputs(p: dict, v: np.ndarray, r: np.ndarray, e: np.ndarray, bounded: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the weights, weighted means of the values (after 1), vectors (after 1) and unscaled log chances of the classes, one place a row."""
    seen = (e @ v).reshape(-1, WIDTH + 1)
    sums = np.maximum(seen[:, :1], np.finfo(seen.dtype).tiny)
    seen /= sums
    h = seen.copy()
    h.reshape(*r.shape[:3], -1)[..., 1:] += r
    logits = h @ np.concatenate([p["o"][None], p["w"].T])
    if not bounded and (logits.max() > CLASS_LIMIT or logits.min() < -CLASS_LIMIT):
        np.clip(logits, -CLASS_LIMIT, CLASS_LIMIT, out=logits)
    return sums, seen, h, logits


def _bounded(p: dict) -> bool:
    """Whether no window at all can reach a limit (PAD aside): the largest lengths, multiplied."""

    def most(x: np.ndarray) -> float:
        return float(np.sqrt((x * x).sum(-1).max()))

    rows = p["rows"]
    bias = rows[:, B]
    score = (most(rows[:, Q]) + most(p["pq"])) * (most(rows[:, K]) + most(p["pk"])) + float(np.abs(bias[bias != -2 * LIMIT]).max(initial=0))
    return score < LIMIT and (most(rows[:, V]) + most(rows[:, R])) * most(p["w"]) + float(np.abs(p["o"]).max()) < CLASS_LIMIT


def log_chances(p: dict, rows: np.ndarray, classes: np.ndarray, fresh: np.ndarray | None = None, bounded: bool = False) -> np.ndarray:
    """Natural log chance of the target class at each place to score: masked attention over a batch of runs of windows."""
    _, _, v, r, e = _attend(p, rows, fresh, bounded)
    logits = _outputs(p, v, r, e, bounded)[3]
    goal = logits[np.arange(len(logits)), classes.ravel()]
    np.exp(logits, out=logits)
    return (goal - np.log(logits @ np.ones(CLASSES, logits.dtype))).reshape(classes.shape)


def gradients(p: dict, rows: np.ndarray, classes: np.ndarray, scored: np.ndarray, fresh: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray, dict]:
    """Mean loss of the scored places, the rows used with their gradients, and gradients of the shared parameters.

    Rows are a context and the places of one window or of several that follow one another; ``fresh`` windows have no context.
    Weights stay without their sums; what comes back from a place is divided by its sum instead.
    """
    q, k, v, r, e = _attend(p, rows, fresh)
    sums, seen, h, d = _outputs(p, v, r, e)
    n, places, goals, there = max(1, int(scored.sum())), np.arange(len(d)), classes.ravel(), scored.ravel()
    goal = d[places, goals]
    np.exp(d, out=d)
    total = d @ np.ones(CLASSES, d.dtype)
    loss = float(((np.log(total) - goal) * there).sum() / n)
    share = (there / n).astype(d.dtype)
    d *= (share / total)[:, None]
    d[places, goals] -= share
    dh = d @ p["w"]
    back = np.empty_like(h)
    np.divide(dh, sums, out=back[:, 1:])
    back[:, 0] = -np.einsum("ij,ij->i", back[:, 1:], seen[:, 1:])
    back = back.reshape(*r.shape[:3], -1)
    ds = back @ np.ascontiguousarray(v.swapaxes(2, 3))
    ds *= e
    dk, dv = (q @ ds).swapaxes(2, 3), e.swapaxes(2, 3) @ back[..., 1:]
    dx = np.zeros((len(rows), r.shape[1] + 1, STRIDE, COLUMNS), d.dtype)
    dx[:, :-1, :, KB], dx[:, :-1, :, V] = dk[:, :, :CONTEXT], dv[:, :, :CONTEXT]
    own = dx[:, 1:]
    own[..., KB] += dk[:, :, CONTEXT:]
    own[..., V] += dv[:, :, CONTEXT:]
    own[..., Q], own[..., R] = ds @ k[:, :, :HEAD].swapaxes(2, 3), dh.reshape(r.shape)
    dw = d.T @ h
    shared = {"w": dw[:, 1:], "o": dw[:, 0], "pq": own[..., Q].sum((0, 1)), "pk": dk[..., :HEAD].sum((0, 1))}
    return loss, *_by_row(rows.ravel(), dx.reshape(-1, COLUMNS)), shared


def _by_row(rows: np.ndarray, dx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sums of their gradients; most rows occur once or a few times."""
    order = np.argsort(rows.astype(np.uint16) if rows.max() < 1 << 16 else rows, kind="stable")
    at = rows[order]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[starts, len(at)])
    out = np.take(dx, order[starts], axis=0)
    for nth in range(1, FEW):
        more = np.flatnonzero(sizes > nth)
        out[more] += np.take(dx, order[starts[more] + nth], axis=0)
    more = np.flatnonzero(sizes > FEW)
    if len(more):
        left = sizes[more] - FEW
        first = np.cumsum(left) - left
        rest = np.repeat(starts[more] + FEW - first, left) + np.arange(int(left.sum()))
        out[more] += np.add.reduceat(np.take(dx, order[rest], axis=0), first, axis=0)
    return at[starts], out


class Adagrad:
    """Steps by the root of the squared gradients so far; rows that a batch does not use stay as they are."""

    def __init__(self, params: dict, rate: float):
        self.rate, self.sums = rate, {k: np.zeros_like(x) for k, x in params.items()}

    def _step(self, param: np.ndarray, sums: np.ndarray, g: np.ndarray, at: np.ndarray | slice) -> None:
        total = g * g
        total += sums[at]
        sums[at] = total
        np.sqrt(total, out=total)
        total += 1e-7
        np.divide(g, total, out=total)
        total *= self.rate
        param[at] -= total

    def step(self, params: dict, at: np.ndarray, g: np.ndarray, shared: dict) -> None:
        self._step(params["rows"], self.sums["rows"], g, at)
        for k, x in shared.items():
            self._step(params[k], self.sums[k], x, slice(None))


def train(params: dict, ids: np.ndarray, lengths: np.ndarray, pieces: Pieces, rate: float, batch: int = 32, seed: int = 0, run: int = RUN) -> tuple[float, np.ndarray]:
    """One pass over the windows of some documents, in place; mean loss, and how often each row was an input.

    A step takes a batch of windows: some runs from any place of the documents.
    """
    stream = Stream.of(ids, lengths, pieces)
    rows, classes, scored, fresh, _ = side_by_side(stream, pieces.cls[stream.target], run)
    order, steps, total = np.random.default_rng(seed).permutation(len(rows)), Adagrad(params, rate), 0.0
    for i in range(0, len(order), max(1, batch // run)):
        part = order[i : i + max(1, batch // run)]
        loss, used, g, shared = gradients(params, rows[part], classes[part], scored[part], fresh[part])
        own = used != pieces.pad
        steps.step(params, used[own], g[own], shared)
        total += loss * int(scored[part].sum())
    return total / max(1, len(stream.rows)), np.bincount(stream.rows, minlength=len(pieces.row))


def score(params: dict, ids: np.ndarray, lengths: np.ndarray, pieces: Pieces, batch: int = SCORE_RUN) -> np.ndarray:
    """Decimal log probability of each document."""
    if not len(lengths):
        return np.zeros(0)
    stream = Stream.of(ids, lengths, pieces)
    out = np.add.reduceat(pieces.inside[stream.target], stream.starts)
    rows, classes, scored, fresh, doc = side_by_side(stream, pieces.cls[stream.target], batch)
    bounded, found = _bounded(params), np.empty((len(rows), batch))
    for i in range(len(rows)):
        chances = log_chances(params, rows[i : i + 1], classes[i : i + 1], fresh[i : i + 1], bounded)
        chances *= scored[i : i + 1]
        found[i] = chances.reshape(-1, STRIDE).sum(1, dtype=np.float64)
    out += np.bincount(doc, found.ravel()[: len(doc)], minlength=len(out))
    return out / np.log(10)
