"""Feed-forward nets by mini-batch descent, many of them in the same jobs.

Rows are dealt once, by a hash of their key, into shards of bounded size. A job takes every open
net through some epochs: within a shard mini-batches follow each other in an order drawn
from key and epoch, dropout masks are drawn from key, step and unit, and the weights, the
optimizer's moments and the running means of the batch normalisation that result are
averaged over the shards by their rows. Averages are sums of exact decimals, and all draws come from keys, so a
rerun on another layout gives the same net to the last bit. With one shard this is plain mini-batch
descent. All settings, and all folds of a cross validation, advance together; nets that differ only in their number of epochs are one run, measured on the way.
A task holds several shards at once, and the nets of all of them take each step in the same arrays.

Hashed categories enter through learned embeddings. A shard returns only the rows of the
buckets it holds, weighted by how often; they are added up by (net, place), and buckets
that no shard holds keep their values. What is sent out is bounded by buckets x size x columns, all parameters.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.session import rows_at_once

SHARD_ROWS = 16_384
SYNC_EPOCHS = 10
STACK_NETS = 40  # that take their steps together
STACK_BYTES = 64 << 20  # of shards that a task holds at once
_EPS, _MOMENTUM = 1e-3, 0.99  # of batch normalisation
_BETA1, _BETA2, _ADAM_EPS = 0.9, 0.999, 1e-7

ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda z, a: (z > 0).astype(float)),
    "tanh": (np.tanh, lambda z, a: 1.0 - a * a),
    "sigmoid": (lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))), lambda z, a: a * (1.0 - a)),
}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def salted(*salt: int | np.ndarray) -> np.ndarray:
    """What the salts, numbers or arrays of one shape or another, make of each other."""
    seed = np.zeros(1, np.uint64)
    for s in salt:
        s = np.array([s % 2**64], np.uint64) if isinstance(s, int) else s.astype(np.uint64)
        seed = mixed((seed ^ s) + np.uint64(0x9E3779B97F4A7C15))
    return seed


def uniforms(keys: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for each key, another one for every salt."""
    return (mixed(keys ^ salted(*salt)[0]) >> np.uint64(11)).astype(float) / 2.0**53


def shuffled(keys: np.ndarray, *salt: int) -> np.ndarray:
    """Places of the keys in an order drawn from them; equal draws stay in place."""
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    ranked = np.sort(mixed(keys ^ salted(*salt)[0]) & ~low | np.arange(len(keys), dtype=np.uint64))  # a draw and its place in one number
    return (ranked & low).astype(np.intp)


@dataclass(frozen=True)
class NetSpec:
    """What a net is and how it learns. ``embed`` is the number of hashed columns."""

    n_inputs: int
    layer_units: tuple[int, ...] = (3, 2)
    activation: str = "relu"
    dropout: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    batch_norm: bool = True
    optimizer: str = "adam"
    learning_rate: float = 0.01
    batch_size: int = 256
    seed: int = 12345
    embed: int = 0
    buckets: int = 250
    embed_dim: int = 8

    def __post_init__(self):
        if not self.layer_units or self.n_inputs + self.embed < 1:
            raise ValueError("a net needs inputs and at least one hidden layer")
        if self.activation not in ACTIVATIONS or self.optimizer not in ("adam", "sgd"):
            raise ValueError(f"unknown activation {self.activation!r} or optimizer {self.optimizer!r}")
        if not 0 <= self.dropout < 1 or self.batch_size < 1 or self.learning_rate <= 0:
            raise ValueError("dropout lies in [0, 1), batch size and learning rate are positive")

    @cached_property
    def sizes(self) -> list[int]:
        return [self.n_inputs + self.embed * self.embed_dim, *self.layer_units, 1]

    @cached_property
    def shapes(self) -> dict[str, tuple[int, ...]]:
        """Every array of the state: step count, then each parameter with its two moments, then running means."""
        trained = {f"e{c}": (self.buckets, self.embed_dim) for c in range(self.embed)}
        running = {}
        for i, (n, m) in enumerate(zip(self.sizes, self.sizes[1:])):
            trained[f"w{i}"] = (n, m)
            trained |= {f"g{i}": (m,), f"b{i}": (m,)} if self.batch_norm else {f"b{i}": (m,)}
            if self.batch_norm:
                running |= {f"mean{i}": (m,), f"var{i}": (m,)}
        moments = {f"{p}{n}": s for n, s in trained.items() for p in ("m_", "v_")} if self.optimizer == "adam" else {}
        return {"t": (1,)} | trained | moments | running

    @cached_property
    def trained(self) -> list[str]:
        return [n for n in self.shapes if n != "t" and not n.startswith(("m_", "v_", "mean", "var"))]

    @cached_property
    def places(self) -> dict[str, slice]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name], at = slice(at, at + size), at + size
        return out

    def unpack(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        return {n: vector[p].reshape(self.shapes[n]) for n, p in self.places.items()}

    def start(self) -> np.ndarray:
        """Normal weights scaled by the layer's sizes, offsets 0, scales 1."""
        rng, vector = np.random.default_rng(self.seed), np.zeros(max(p.stop for p in self.places.values()))
        state = self.unpack(vector)
        for name in self.trained:
            if name[0] == "w":
                state[name][:] = rng.normal(0, np.sqrt(2.0 / sum(self.shapes[name])), self.shapes[name])
            elif name[0] == "e":
                state[name][:] = rng.normal(0, 1 / np.sqrt(self.embed_dim), self.shapes[name])
            elif name[0] == "g":
                state[name][:] = 1.0
        for name in state:
            if name.startswith("var"):
                state[name][:] = 1.0
        return vector

    # computing ---------------------------------------------------------------------

    def inputs(self, state: dict, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return np.hstack([*[state[f"e{c}"][codes[:, c]] for c in range(self.embed)], x])

    def predict(self, state: dict, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        a = self.inputs(state, x, codes)
        act, last = ACTIVATIONS[self.activation][0], len(self.sizes) - 2
        for i in range(last + 1):
            z = a @ state[f"w{i}"]
            if self.batch_norm:
                z = (z - state[f"mean{i}"]) / np.sqrt(state[f"var{i}"] + _EPS) * state[f"g{i}"]
            z = z + state[f"b{i}"]
            a = ACTIVATIONS["sigmoid"][0](z) if i == last else act(z)
        return a[:, 0]

    def masks(self, keys: np.ndarray, step: int) -> list[np.ndarray]:
        """Which units of the hidden layers each row keeps in a step, scaled so that the mean stays."""
        if not self.dropout:
            return []
        return [np.stack([uniforms(keys, self.seed, step, i, j) >= self.dropout for j in range(m)], axis=1) / (1.0 - self.dropout)
                for i, m in enumerate(self.layer_units)]

    def loss_and_slopes(self, state: dict, x: np.ndarray, codes: np.ndarray, y: np.ndarray, masks: list[np.ndarray]) -> tuple[float, dict, dict]:
        """Mean loss with penalties, its slopes, and the batch's means and variances."""
        act, slope_of = ACTIVATIONS[self.activation]
        last, n = len(self.sizes) - 2, len(y)
        a, kept, stats = self.inputs(state, x, codes), [], {}
        for i in range(last + 1):
            z = raw = a @ state[f"w{i}"]
            spread = None
            if self.batch_norm:
                mean, var = raw.mean(axis=0), raw.var(axis=0)
                stats[f"mean{i}"], stats[f"var{i}"] = mean, var
                spread = np.sqrt(var + _EPS)
                raw = (raw - mean) / spread
                z = raw * state[f"g{i}"]
            z = z + state[f"b{i}"]
            kept.append((a, raw, spread, z))
            if i < last:
                out = act(z)
                kept[-1] += (out,)
                a = out * masks[i] if masks else out
        logit = z[:, 0]
        loss = float((np.logaddexp(0.0, logit) - y * logit).mean())
        slopes, down = {}, (ACTIVATIONS["sigmoid"][0](logit) - y)[:, None] / n
        for i in range(last, -1, -1):
            a, raw, spread, z, *out = kept[i]
            if i < last:
                down = down * masks[i] if masks else down
                down = down * slope_of(z, out[0])
            slopes[f"b{i}"] = down.sum(axis=0)
            if self.batch_norm:
                slopes[f"g{i}"] = (down * raw).sum(axis=0)
                inner = down * state[f"g{i}"]
                down = (inner - inner.mean(axis=0) - raw * (inner * raw).mean(axis=0)) / spread
            w = state[f"w{i}"]
            slopes[f"w{i}"] = a.T @ down + self.l1 * np.sign(w) + 2 * self.l2 * w
            loss += self.l1 * float(np.abs(w).sum()) + self.l2 * float((w * w).sum())
            down = down @ w.T
        for c in range(self.embed):
            table = np.zeros((self.buckets, self.embed_dim))
            np.add.at(table, codes[:, c], down[:, c * self.embed_dim : (c + 1) * self.embed_dim])
            slopes[f"e{c}"] = table
        return loss, slopes, stats

    def descend(self, state: dict, slopes: dict, stats: dict, codes: np.ndarray) -> None:
        """One step of the optimizer, in place; embeddings move only where the batch has rows."""
        state["t"] += 1
        t = state["t"][0]
        for name in self.trained:
            rows = np.unique(codes[:, int(name[1:])]) if name[0] == "e" else slice(None)
            g = slopes[name][rows]
            if self.optimizer == "adam":
                m, v = state[f"m_{name}"], state[f"v_{name}"]
                m[rows] = _BETA1 * m[rows] + (1 - _BETA1) * g
                v[rows] = _BETA2 * v[rows] + (1 - _BETA2) * g * g
                g = (m[rows] / (1 - _BETA1**t)) / (np.sqrt(v[rows] / (1 - _BETA2**t)) + _ADAM_EPS)
            state[name][rows] -= self.learning_rate * g
        for name, value in stats.items():
            state[name][:] = _MOMENTUM * state[name] + (1 - _MOMENTUM) * value

    def train(self, vector: np.ndarray, x: np.ndarray, codes: np.ndarray, y: np.ndarray, keys: np.ndarray, first: int, last: int) -> np.ndarray:
        """The state after the epochs from ``first`` up to, not with, ``last`` over one shard, step by step; ``train_stack`` does the same for many nets."""
        vector = vector.copy()
        state, batches = self.unpack(vector), -(-len(y) // self.batch_size)
        for epoch in range(first, last):
            order = shuffled(keys, self.seed, epoch)
            for b in range(batches):
                own = order[b * self.batch_size : (b + 1) * self.batch_size]
                masks = self.masks(keys[own], epoch * batches + b)
                _, slopes, stats = self.loss_and_slopes(state, x[own], codes[own], y[own], masks)
                self.descend(state, slopes, stats, codes[own])
        return vector


    @cached_property
    def kind(self) -> NetSpec:
        """The net without what may differ between nets that are trained in one stack."""
        return replace(self, dropout=0.0, l1=0.0, l2=0.0, learning_rate=1.0, seed=0)


@dataclass(frozen=True)
class Part:
    """Nets of one kind and seed, a shard, and which of its rows they learn from (None: all)."""

    specs: Sequence[NetSpec]
    vectors: Sequence[np.ndarray]
    x: np.ndarray
    codes: np.ndarray
    y: np.ndarray
    keys: np.ndarray
    rows: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.y if self.rows is None else self.rows)


def train_stack(specs: Sequence[NetSpec], vectors: Sequence[np.ndarray], x: np.ndarray, codes: np.ndarray, y: np.ndarray, keys: np.ndarray,
                first: int, last: int) -> np.ndarray:
    """The states of nets of one kind after the epochs from ``first`` up to, not with, ``last`` over one shard."""
    of = [[k for k, s in enumerate(specs) if s.seed == seed] for seed in sorted({s.seed for s in specs})]
    parts = [Part([specs[k] for k in own], [vectors[k] for k in own], x, codes, y, keys) for own in of]
    out = np.empty((len(specs), len(vectors[0])))
    for p, states in train_parts(parts, first, last):
        out[of[p]] = states
    return out


def train_parts(parts: Sequence[Part], first: int, last: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part's place and the states of its nets; parts of as many nets of one kind go together, up to ``STACK_NETS`` nets at a time."""
    alike: dict = {}
    for p, part in enumerate(parts):
        alike.setdefault((part.specs[0].kind, len(part.specs)), []).append(p)
    for (_, nets), places in alike.items():
        most = max(1, STACK_NETS // nets)
        for s in range(0, len(places), most):
            own = sorted(places[s : s + most], key=lambda p: -len(parts[p]))
            yield from zip(own, _train_alike([parts[p] for p in own], first, last))


def _train_alike(parts: Sequence[Part], first: int, last: int) -> np.ndarray:
    """The states, by part and net, of parts of as many nets, those with more rows first.

    A step is taken by all nets at once, in arrays with a net in front and the rows last; what a net does depends on no other.
    Parts whose last batch is a smaller one take it by themselves. Factors that all rows of a unit share are left out of the
    arrays and put to the weights and slopes, which are few.
    """
    one, each, n = parts[0].specs[0].kind, len(parts[0].specs), np.array([len(p) for p in parts])
    specs, whole = [s for p in parts for s in p.specs], np.stack([v for p in parts for v in p.vectors])
    nets, size, depth, width, m0 = len(specs), one.batch_size, len(one.layer_units), one.n_inputs, one.layer_units[0]
    lead, dim, adam, normed, relu = one.embed * one.embed_dim, one.embed_dim, one.optimizer == "adam", one.batch_norm, one.activation == "relu"
    act, slope_of = ACTIVATIONS[one.activation]
    state = {name: whole[:, p].reshape(nets, *one.shapes[name]) for name, p in one.places.items()}
    trained, kinds = [name for name in one.trained if name[0] != "e"], ("", "m_", "v_") if adam else ("",)

    def views(names: Sequence[str], prefix: str = "") -> dict[str, np.ndarray]:
        """Arrays of the state; the first weights as those of the embeddings, ``we``, and, turned, those of the numbers, ``wx``."""
        found = {name: state[prefix + name] for name in names}
        if "w0" in found:
            both = found.pop("w0")
            found |= {"we": both[:, :lead], "wx": turned(both[:, lead:])}
        return found

    like = {prefix: views(trained, prefix) for prefix in kinds}
    like["run"] = views([name for name in state if name.startswith(("mean", "var"))])
    flats = {k: np.concatenate([v.reshape(nets, -1) for v in found.values()], axis=1) for k, found in like.items() if found}
    flats |= {"slope": np.zeros_like(flats[""])} | ({"met": np.zeros_like(flats["run"])} if normed else {})  # met: the batch's own means and variances

    def parts_of(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        ends = np.cumsum([0, *[v[0].size for v in like.values()]])
        return {name: flat[:, low:high].reshape(len(flat), *v.shape[1:]) for (name, v), low, high in zip(like.items(), ends, ends[1:])}

    column = lambda name: np.array([[getattr(s, name)] for s in specs])
    rate, l1, l2, drop, t = column("learning_rate"), column("l1")[:, None], column("l2")[:, None], column("dropout")[:, None], state["t"].copy()
    penal, drops = bool(l1.any() or l2.any()), bool(drop.any())
    grown = 1.0 / (1.0 - drop)  # what a unit that is kept stands for
    units = np.array([(i, j) for i, m in enumerate(one.layer_units) for j in range(m)])
    edges = np.cumsum([0, *one.layer_units])
    shards = list({id(p.x): p for p in parts}.values())  # parts that leave out different rows share a shard
    start = dict(zip([id(p.x) for p in shards], np.cumsum([0, *[len(p.y) for p in shards]])))
    # the buckets that a shard holds, of all columns one after the other, net by net, as one table
    held_by = {id(p.x): [np.unique(p.codes[:, c], return_inverse=True) for c in range(one.embed)] for p in shards}
    from_ = np.cumsum([0, *[max(len(held[c][0]) for held in held_by.values()) for c in range(one.embed)]])
    own_buckets = int(from_[-1])
    sides = [(slice(c * dim, (c + 1) * dim), slice(from_[c], from_[c + 1])) for c in range(one.embed)]
    table = np.empty((sum(len(p.y) for p in shards), width + 1 + one.embed))  # numbers, label, buckets: what a row has is met at once
    for p in shards:
        own = table[start[id(p.x)] :][: len(p.y)]
        own[:, :width], own[:, width] = p.x, p.y
        for c, (_, inverse) in enumerate(held_by[id(p.x)]):
            own[:, width + 1 + c] = inverse + from_[c]
    if one.embed:
        tables = [np.zeros((nets, own_buckets, dim)) for _ in kinds]
        owners = [(k, slice(i * each, (i + 1) * each), c, found, slice(from_[c], from_[c] + len(found)))
                  for k in range(len(kinds)) for i, p in enumerate(parts) for c, (found, _) in enumerate(held_by[id(p.x)])]
        for k, own, c, found, line in owners:
            tables[k][own, line] = state[f"{kinds[k]}e{c}"][own][:, found]
    rooms: dict = {}

    def room(low: int, high: int, rows: int) -> tuple:
        """What a step of the parts from ``low`` to ``high`` works on: views of all that is kept, and arrays to fill."""
        if (low, high, rows) not in rooms:
            own, lines = slice(low * each, high * each), max(2, each * m0)
            cut = {k: v[own] for k, v in flats.items()}
            w, g = parts_of(cut[""], like[""]), parts_of(cut["slope"], like[""])
            stats = parts_of(cut["met"], like["run"]) if normed else {}
            first_cell = (np.arange((high - low) * each * m0) * own_buckets).reshape(-1, m0, 1)
            wide, raws, downs = (np.zeros((high - low, lines, k)) for k in (width, rows, rows))
            rooms[low, high, rows] = own, cut, w, g, stats, first_cell, wide, raws, downs
        return rooms[low, high, rows]

    def drawn(part: Part, epoch: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Places of a part's rows in the order of the epoch, and a number in [0, 1) for each unit and each of them."""
        keys, batches = part.keys if part.rows is None else part.keys[part.rows], -(-len(part) // size)
        order = shuffled(keys, part.specs[0].seed, epoch)
        chance = None
        if drops:
            steps = salted(part.specs[0].seed, (epoch * batches + np.arange(batches))[None, :], units[:, :1], units[:, 1:])
            chance = (mixed(keys[order] ^ np.repeat(steps, size, axis=1)[:, : len(part)]) >> np.uint64(11)).astype(float) / 2.0**53
        return (order if part.rows is None else part.rows[order]) + start[id(part.x)], chance

    def move(value: np.ndarray, m: np.ndarray, v: np.ndarray, slopes: np.ndarray, pull: np.ndarray, root: np.ndarray) -> None:
        m += (slopes - m) * (1 - _BETA1)
        v += (slopes * slopes - v) * (1 - _BETA2)
        value -= m * pull / (np.sqrt(v) * root + _ADAM_EPS)

    def step(low: int, high: int, b: int, rows: int) -> None:
        own, cut, w, g, stats, first_cell, wide, raws, downs = room(low, high, rows)
        some, at, kept = own.stop - own.start, slice(b * size, b * size + rows), []
        seen = orders[low:high, at]
        # forward
        met = table.take(seen, axis=0)
        numbers, label = met[:, :, :width], met[:, None, :, width]
        wide[:, : each * m0] = w["wx"].reshape(high - low, each * m0, width)
        np.matmul(wide, turned(numbers), out=raws)
        raw = raws[:, : each * m0].reshape(some, m0, rows)
        if one.embed:  # a bucket's share in the units is worked out once, not for each row
            spots = met[:, :, width + 1 :].transpose(2, 0, 1).astype(np.intp)
            spots = (np.repeat(spots, each, axis=1) if each > 1 else spots)[:, :, None] + first_cell  # column, net, unit, row
            share = np.empty((some, m0, own_buckets))
            for side, held in sides:
                share[:, :, held] = turned(tables[0][own, held] @ w["we"][:, side])
            raw += np.add.reduce(share.take(spots), axis=0)
        a = None
        for i in range(depth + 1):
            if i:
                raw = turned(w[f"w{i}"] * grown[own] if drops else w[f"w{i}"]) @ a
            if normed:
                mean = np.add.reduce(raw, axis=2) / rows
                raw -= mean[:, :, None]
                stats[f"mean{i}"][:] = mean
                var = np.vecdot(raw, raw) / rows
                stats[f"var{i}"][:] = var
                spread = np.sqrt(var + _EPS)
                z = raw * (w[f"g{i}"] / spread)[:, :, None]
                z += w[f"b{i}"][:, :, None]
            else:
                spread, z = None, raw + w[f"b{i}"][:, :, None]
            if i == depth:
                kept.append((a, raw, spread, None))
                break
            if drops:
                keep = masks[:, edges[i] : edges[i + 1], at].take(mask_of[own], axis=0)
            if relu:
                open_ = z > 0
                if drops:
                    open_ &= keep
                out = z * open_ if drops else np.maximum(z, 0.0)
            else:
                out = act(z)
                open_ = slope_of(z, out)
                if drops:
                    open_, out = open_ * keep, out * keep
            kept.append((a, raw, spread, open_))
            a = out
        # backward, in sums over the rows
        down = np.exp(np.minimum(np.negative(z, out=z), 700, out=z), out=z)
        down += 1
        np.divide(1, down, out=down)
        down.reshape(high - low, each, rows)[:] -= label
        for i in range(depth, -1, -1):
            a, raw, spread, open_ = kept[i]
            if i == 0:
                down = np.multiply(down, open_, out=downs[:, : each * m0].reshape(some, m0, rows))
            elif open_ is not None:
                down *= open_
            shift = np.add.reduce(down, axis=2)
            g[f"b{i}"][:] = shift
            pull = None
            if normed:
                along = np.vecdot(down, raw) / spread
                g[f"g{i}"][:] = along
                down -= (shift / rows)[:, :, None]  # the mean and the spread of the batch move with the weights too
                down -= raw * (along / (spread * rows))[:, :, None]
                pull = w[f"g{i}"] / spread
            if i:
                slopes, heavy = a @ turned(down), w[f"w{i}"]
                if drops:
                    slopes, heavy = slopes * grown[own], heavy * grown[own]
                if normed:
                    slopes, heavy = slopes * pull[:, None], heavy * pull[:, None]
                g[f"w{i}"][:] = slopes
                down = heavy @ down
                continue
            slopes = (downs @ numbers)[:, : each * m0].reshape(some, m0, width)
            np.multiply(slopes, pull[:, :, None] if normed else 1.0, out=g["wx"])
            if one.embed:
                sums = np.bincount(spots.ravel(), np.concatenate([down.ravel()] * one.embed), some * m0 * own_buckets).reshape(some, m0, own_buckets)
                if normed:
                    sums *= pull[:, :, None]
                turn, sums = np.empty((some, own_buckets, dim)), turned(sums)
                for side, held in sides:
                    g["we"][:, side] = turned(tables[0][own, held]) @ sums[:, held]
                    turn[:, held] = sums[:, held] @ turned(w["we"][:, side])
                turn /= rows
                often = np.bincount(spots[:, :, 0].ravel(), minlength=some * m0 * own_buckets).reshape(some, m0, own_buckets)[:, 0]
        slope = cut["slope"]
        slope /= rows
        if penal:
            for name, value in w.items():
                if name[0] == "w":
                    g[name] += l1[own] * np.sign(value) + 2 * l2[own] * value
        pull, root = (pulls[own, b, None], roots[own, b, None]) if adam else (rate[own], None)
        if one.embed:  # embeddings move only where the batch has rows
            hit = np.flatnonzero(often)
            of, lines, turn = hit // own_buckets, [v[own].reshape(-1, dim) for v in tables], turn.reshape(-1, dim)
            if not adam:
                lines[0][hit] -= pull[of] * turn[hit]
            elif len(hit) == len(turn):
                move(*[v[own] for v in tables], turn.reshape(some, own_buckets, dim), pull[:, None], root[:, None])
            else:
                moved = [v.take(hit, axis=0) for v in lines]
                move(*moved, turn.take(hit, axis=0), pull[of], root[of])
                for line, value in zip(lines, moved):
                    line[hit] = value
        if normed:
            cut["run"] += (cut["met"] - cut["run"]) * (1 - _MOMENTUM)
        if adam:
            move(cut[""], cut["m_"], cut["v_"], slope, pull, root)
        else:
            cut[""] -= pull * slope

    rates_out, mask_of = np.unique(drop, return_inverse=True)
    mask_of = mask_of.ravel() + np.repeat(np.arange(len(parts)) * len(rates_out), each)
    orders, masks = np.zeros((len(parts), n[0]), np.intp), np.zeros((len(parts) * len(rates_out), len(units), n[0]), bool) if drops else None
    full_of = [int((n >= (b + 1) * size).sum()) for b in range(-(-int(n[0]) // size))]  # parts have the more rows the earlier they come
    for epoch in range(first, last):
        for p, part in enumerate(parts):
            orders[p, : n[p]], chance = drawn(part, epoch)
            if drops:
                masks[p * len(rates_out) : (p + 1) * len(rates_out), :, : n[p]] = chance >= rates_out[:, None, None]
        steps = t + np.arange(1, len(full_of) + 1)
        pulls, roots = (rate / (1 - _BETA1**steps), 1 / np.sqrt(1 - _BETA2**steps)) if adam else (None, None)
        for b in range(len(full_of)):
            full = full_of[b]
            if full:
                step(0, full, b, size)
            for p in range(full, len(parts)):
                if n[p] > b * size:
                    step(p, p + 1, b, int(n[p]) - b * size)
        t += np.repeat(-(-n // size), each)[:, None]
    state["t"][:] = t
    for prefix, found in like.items():
        if found:
            for name, value in parts_of(flats[prefix], found).items():
                found[name][:] = value
    if one.embed:
        for k, own, c, found, line in owners:
            state[f"{kinds[k]}e{c}"][own][:, found] = tables[k][own, line]
    return whole.reshape(len(parts), each, -1)


def turned(a: np.ndarray) -> np.ndarray:
    return a.transpose(0, 2, 1)


@dataclass(frozen=True)
class NetModel:
    spec: NetSpec
    epochs: int
    vector: tuple[float, ...]

    def getLayers(self) -> list[int]:
        return self.spec.sizes

    def to_json(self) -> str:
        return json.dumps({"spec": asdict(self.spec), "epochs": self.epochs, "vector": self.vector})

    @classmethod
    def from_json(cls, text: str) -> NetModel:
        s = json.loads(text)
        return cls(NetSpec(**{**s["spec"], "layer_units": tuple(s["spec"]["layer_units"])}), s["epochs"], tuple(s["vector"]))


@dataclass(frozen=True)
class Run:
    """A net, after which epochs it is wanted, and the fold it does not see."""

    spec: NetSpec
    epochs: tuple[int, ...]
    without_fold: int | None = None


def pack_shards(rows: DataFrame, key: str, label: str, n_rows: int, copies: int, features: str = "features", codes: str | None = None,
                fold: str | None = None, shard_rows: int = SHARD_ROWS, parts: int | None = None) -> tuple[DataFrame, int]:
    """One row for each shard and copy with its numbers as bytes, in an order that depends on keys alone, dealt evenly to the partitions; and the number of shards.

    Copies let several tasks train different nets on the same shard where there are fewer shards than tasks.
    """
    shards = max(1, -(-n_rows // shard_rows))
    parts = parts or shards * copies
    key_hash = F.xxhash64(F.col(key))
    columns = {"y": F.col(label).cast("double"), "h": key_hash, "x": vector_to_array(features), "fold": F.col(fold).cast("int") if fold else F.lit(-1),
               "codes": F.col(codes) if codes else F.array().cast("array<int>")}
    dealt = rows.select(F.pmod(key_hash, F.lit(shards)).cast("int").alias("shard"), *[c.alias(n) for n, c in columns.items()]).filter(F.col("y").isNotNull())
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))) if copies > 1 else F.lit(0)
    dealt = dealt.select("*", copy.alias("copy")).withColumn("place", F.col("shard") * copies + F.col("copy"))
    dealt = dealt.select((F.col("place").cast("bigint") * parts / (shards * copies)).cast("int").alias("part"), "place", *columns)

    def pack(group: pa.Table) -> pa.Table:
        n, flat = group.num_rows, {k: group.column(k).combine_chunks() for k in ("x", "codes")}
        y, h, fold_ = (group.column(k).to_numpy() for k in ("y", "h", "fold"))
        x, codes_ = (flat[k].flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for k in ("x", "codes"))
        order = np.argsort(h, kind="stable")
        if n and (np.diff(h[order]) == 0).any():  # rows of one hash by all they hold
            order = np.lexsort((*x.T, *codes_.T, y, h))
        arrays = {"x": x.astype(float, copy=False)[order], "y": y[order], "h": h[order], "codes": codes_.astype(np.int32, copy=False)[order], "fold": fold_[order]}
        return pa.table({"place": group.column("place")[:1].combine_chunks(), "n": pa.array([n], pa.int32()), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in arrays.items()}})

    grouped = dealt.repartitionById(parts, "part").groupBy("part", "place")  # rows move once, to where they stay
    return grouped.applyInArrow(pack, "place int, n int, x binary, y binary, h binary, codes binary, fold binary"), shards


def stacks(open_: dict[int, tuple[Run, np.ndarray]], copies: int, copy: int) -> list[tuple[int | None, list[tuple[int, Run, np.ndarray]]]]:
    """The nets that a copy of a shard trains: as many as the other copies do, in stacks of one kind that leave out the same fold."""
    order: dict = {}
    for i, (one, vector) in sorted(open_.items()):
        order.setdefault((one.spec.kind, one.without_fold), []).append((i, one, vector))
    out, j = [], 0
    for (_, without_fold), nets in order.items():
        own = [net for k, net in enumerate(nets, j) if k * copies // len(open_) == copy]
        j += len(nets)
        if own:
            out.append((without_fold, own))
    return out


def shard_parts(batch: pa.RecordBatch, open_: dict[int, tuple[Run, np.ndarray]], copies: int) -> tuple[list[Part], list[list[int]]]:
    """What is to be trained on the shards of a batch, and the runs of each part."""
    parts, runs = [], []
    for r in range(batch.num_rows):
        place, n = (batch.column(k)[r].as_py() for k in ("place", "n"))
        y, h, fold, x, codes = (np.frombuffer(batch.column(k)[r].as_buffer(), kind) for k, kind in
                                (("y", float), ("h", np.uint64), ("fold", np.int32), ("x", float), ("codes", np.int32)))
        x, codes = x.reshape(n, -1), codes.reshape(n, -1)
        seen = {f: None if f is None else np.flatnonzero(fold != f) for f in {one.without_fold for one, _ in open_.values()}}
        for without_fold, own in stacks(open_, copies, place % copies):
            rows = seen[without_fold]
            if not (n if rows is None else len(rows)):
                continue
            for seed in sorted({one.spec.seed for _, one, _ in own}):
                nets = [net for net in own if net[1].spec.seed == seed]
                parts.append(Part([one.spec for _, one, _ in nets], [vector for _, _, vector in nets], x, codes, y, h, rows))
                runs.append([i for i, _, _ in nets])
    return parts, runs


def weighted(part: Part, states: np.ndarray, runs: Sequence[int]) -> pa.RecordBatch:
    """The numbers of a part's nets times the rows that stand behind them; buckets without rows are not sent."""
    spec, weight = part.specs[0], np.full(states.shape[1], float(len(part)))
    for c in range(spec.embed):
        held = part.codes[:, c] if part.rows is None else part.codes[part.rows, c]
        often = np.repeat(np.bincount(held, minlength=spec.buckets).astype(float), spec.embed_dim)
        for name in (f"e{c}", f"m_e{c}", f"v_e{c}"):
            if name in spec.places:
                weight[spec.places[name]] = often
    some = np.flatnonzero(weight)
    arrays = np.repeat(np.array(runs, np.int32), len(some)), np.tile(some.astype(np.int32), len(runs)), (states[:, some] * weight[some]).ravel(), np.tile(weight[some], len(runs))
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["run", "at", "value", "weight"])


def train_runs(packed: DataFrame, copies: int, runs: Sequence[Run], sync: int = SYNC_EPOCHS, at_once: int = 1) -> list[list[NetModel]]:
    """For every run the nets after each of its epochs. ``packed`` should be held: each job reads it, ``at_once`` shards at a time."""
    states = [r.spec.start() for r in runs]
    stops = sorted({e for r in runs for e in r.epochs})
    found, done = [{} for _ in runs], 0
    while done < stops[-1]:
        until = min(done + sync, min(e for e in stops if e > done))
        open_ = {i: (runs[i], states[i]) for i in range(len(runs)) if max(runs[i].epochs) > done}
        sent = packed.sparkSession.sparkContext.broadcast(open_)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, first=done, last=until) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts, of = shard_parts(batch, sent.value, copies)
                for p, states in train_parts(parts, first, last):
                    yield weighted(parts[p], states, of[p])

        trained = packed.mapInArrow(run, "run int, at int, value double, weight double")
        exact = F.sum(F.col("value").cast("decimal(38,20)")).cast("double")
        with rows_at_once(packed.sparkSession, at_once):
            sums = trained.groupBy("run", "at").agg(exact.alias("value"), F.sum("weight").alias("weight")).toArrow()  # the open nets' numbers
        run_, at, value, weight = (sums.column(k).to_numpy() for k in ("run", "at", "value", "weight"))
        for i in np.unique(run_):
            own = run_ == i
            states[i][at[own]] = value[own] / weight[own]
        for i in open_:
            if until in runs[i].epochs:
                found[i][until] = NetModel(runs[i].spec, until, tuple(states[i].tolist()))
        done = until
    return [[f[e] for e in r.epochs] for r, f in zip(runs, found)]


def fit_nets(rows: DataFrame, key: str, label: str, runs: Sequence[Run], codes: str | None = None, fold: str | None = None,
             shard_rows: int = SHARD_ROWS, sync: int = SYNC_EPOCHS) -> list[list[NetModel]]:
    """Train all runs on rows with a key, a label and a ``features`` vector."""
    n_rows = rows.count()
    if not n_rows:
        raise ValueError("there are no rows to train on")
    tasks, shards = rows.sparkSession.sparkContext.defaultParallelism, max(1, -(-n_rows // shard_rows))
    copies = max(1, min(len(runs), tasks // shards))
    at_once = max(1, min(STACK_NETS, STACK_BYTES // (8 * shard_rows * (2 + max(r.spec.n_inputs + r.spec.embed for r in runs)))))
    parts = min(shards * copies, tasks * -(-shards * copies // (tasks * at_once)))  # as many rounds of tasks as shards at once allow
    packed, _ = pack_shards(rows, key, label, n_rows, copies, codes=codes, fold=fold, shard_rows=shard_rows, parts=parts)
    packed = packed.persist()
    try:
        return train_runs(packed, copies, runs, sync, at_once)
    finally:
        packed.unpersist()


def score_nets(df: DataFrame, models: Sequence[NetModel], keep: Sequence[str], features: str = "features", codes: str | None = None) -> tuple[DataFrame, list[str]]:
    """``keep`` and one probability column a net, from one pass."""
    names = [f"p1_{i}" for i in range(len(models))]
    sent = df.sparkSession.sparkContext.broadcast([(m.spec, np.array(m.vector)) for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = (batch.column(len(keep) + i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for i in (0, 1))
            found = [pa.array(spec.predict(spec.unpack(vector), x, at)) for spec, vector in sent.value]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *found], [*keep, *names])

    at = F.col(codes) if codes else F.array().cast("array<int>")
    kept = df.select(*keep)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema], *[f"{n} double" for n in names]])
    return df.select(*keep, vector_to_array(features).alias("__x"), at.alias("__codes")).mapInArrow(run, schema), names


def spec_of(n_inputs: int, **setting) -> tuple[NetSpec, int]:
    """A net and its number of epochs from the arguments of a search."""
    epochs = setting.pop("epochs", 100)
    if "layer_units" in setting:
        setting["layer_units"] = tuple(setting["layer_units"])
    return replace(NetSpec(n_inputs, **setting)), epochs
