"""The two regressors of the grouped step, in numpy: a forest of trees without a depth limit and a small neural network."""

from __future__ import annotations

import numpy as np


class Tree:
    """A regression tree as lists of nodes: feature (-1 at a leaf), threshold, left and right child, value, and each feature's gain.

    A node is split at the midpoint between two neighbouring distinct values of a feature, the place that lowers the squared
    error most; ties go to the first feature and the lowest place. Nodes are split until their values are all the same, or no
    feature tells their rows apart, or `depth` is reached."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, value: np.ndarray, gain: np.ndarray):
        self.feature, self.threshold, self.left, self.right, self.value, self.gain = feature, threshold, left, right, value, gain

    @classmethod
    def grow(cls, x: np.ndarray, order: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int | None) -> Tree:
        """order (features, rows): rows by value of each feature. Rows of weight 0 take no part.

        All nodes of a level are split at once. Each feature's rows stay sorted by node and value from level to level, so a
        level costs a few passes over the rows that are left, and rows of finished nodes leave."""
        width = x.shape[1]
        rows = order[weight[order] > 0].reshape(width, -1)  # each feature's rows by value
        root = rows[0]
        center = np.average(y[root], weights=weight[root])
        raw, y = y, y - center
        parts: dict[str, list[np.ndarray]] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
        sizes, gains, made, level = np.array([rows.shape[1]]), np.zeros(width), 1, 0
        while len(sizes):
            count = len(sizes)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            w, wy = weight[rows], weight[rows] * y[rows]
            total_w, total_y = np.add.reduceat(w[0], starts), np.add.reduceat(wy[0], starts)
            own = y[rows[0]]
            pure = np.maximum.reduceat(own, starts) == np.minimum.reduceat(own, starts)
            parts["value"].append(np.where(pure, raw[rows[0][starts]], total_y / total_w + center))
            feature, threshold = np.full(count, -1), np.zeros(count)
            left, right = np.full(count, -1), np.full(count, -1)
            if depth is None or level < depth:
                best, place = cls._best(x, y, rows, w, wy, starts, sizes, total_w, total_y)
                split = ~pure & (place >= 0)
                k = np.flatnonzero(split)
                f, at = np.divmod(place[k], rows.shape[1])
                low, high = x[rows[f, at], f], x[rows[f, at + 1], f]
                middle = low + (high - low) / 2
                # Between neighbouring doubles the midpoint may be the upper one.
                threshold[k], feature[k] = np.where(middle < high, middle, low), f
                np.add.at(gains, f, best[k] - total_y[k] ** 2 / total_w[k])
                left[k], right[k] = made + 2 * np.arange(len(k)), made + 2 * np.arange(len(k)) + 1
                made += 2 * len(k)
            else:
                k = np.zeros(0, int)
            for name, values in (("feature", feature), ("threshold", threshold), ("left", left), ("right", right)):
                parts[name].append(values)
            rows, sizes = cls._parted(x, rows, sizes, feature, threshold, k)
            level += 1
        return cls(*(np.concatenate(parts[k]) for k in ("feature", "threshold", "left", "right", "value")), gains)

    @staticmethod
    def _best(x, y, rows, w, wy, starts, sizes, total_w, total_y) -> tuple[np.ndarray, np.ndarray]:
        """Of each node the best sum of squares over weights after a split, and where (feature * rows + place of the last row on the left), -1 for nowhere."""
        n = rows.shape[1]
        node = np.repeat(np.arange(len(sizes)), sizes)
        before = lambda s: s.cumsum(1) - np.concatenate([np.zeros((len(s), 1)), s.cumsum(1)], 1)[:, starts][:, node]
        lw, ly = before(w), before(wy)
        rw, ry = total_w[node] - lw, total_y[node] - ly
        values = np.take_along_axis(x.T, rows, 1)
        ends = np.zeros(n, bool)
        ends[starts + sizes - 1] = True
        # A split stands between two rows of one node whose values differ.
        apart = np.concatenate([values[:, 1:] > values[:, :-1], np.zeros((len(values), 1), bool)], 1) & ~ends
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(apart, ly**2 / lw + ry**2 / rw, -np.inf)
        top = np.maximum.reduceat(score, starts, axis=1)
        # What differs by rounding only is a tie: scores are at most the node's sum of squares, which tells their size.
        near = top.max(0) - 1e-9 * np.add.reduceat(w[0] * y[rows[0]] ** 2, starts)
        feature = (top >= near).argmax(0)
        chosen = score[feature[node], np.arange(n)]
        hit = np.where((chosen >= near[node]) & np.isfinite(chosen), np.arange(n), n)
        at = np.minimum.reduceat(hit, starts)
        return score[feature, np.minimum(at, n - 1)], np.where(at < n, feature * n + at, -1)

    @staticmethod
    def _parted(x, rows, sizes, feature, threshold, k) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the nodes k that were split, sorted by child and value again, and the sizes of the children."""
        node = np.repeat(np.arange(len(sizes)), sizes)
        stays = np.isin(np.arange(len(sizes)), k)[node]
        rows, node = rows[:, stays], node[stays]
        if not rows.shape[1]:
            return rows, np.zeros(0, int)
        # The side of each row is one for all features; children stand in order, left before right.
        right = np.zeros(len(x), np.int64)
        right[rows[0]] = x[rows[0], feature[node]] > threshold[node]
        number = np.full(len(sizes), -1)
        number[k] = np.arange(len(k))
        child = 2 * number[node] + right[rows]
        return np.take_along_axis(rows, np.argsort(child, axis=1, kind="stable"), 1), np.bincount(child[0], minlength=2 * len(k))

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, live = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(live):
            at = node[live]
            inner = self.feature[at] >= 0
            live, at = live[inner], at[inner]
            node[live] = np.where(x[live, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.value[node]


class Forest:
    """Trees over bootstrap samples, each of all features; depth None is no limit. Predictions and importances are the trees' means."""

    def __init__(self, trees: int = 100, depth: int | None = None, seed: int = 42, bootstrap: bool = True):
        self.count, self.depth, self.seed, self.bootstrap = trees, depth, seed, bootstrap

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        n = len(x)
        order = np.argsort(x, axis=0, kind="stable").T
        rng = np.random.default_rng(self.seed)
        draw = lambda: rng.multinomial(n, np.full(n, 1 / n)).astype(float) if self.bootstrap else np.ones(n)
        self.width = x.shape[1]
        self.trees = [Tree.grow(x, order, y, draw(), self.depth) for _ in range(self.count)]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sum((t.predict(x) for t in self.trees), np.zeros(len(x))) / self.count

    @property
    def importances(self) -> np.ndarray:
        """Each feature's share of what splits gained, averaged over trees that split at all; zeros if none did."""
        gains = [t.gain for t in self.trees if t.gain.sum() > 0]
        shares = np.mean([g / g.sum() for g in gains], 0) if gains else np.zeros(self.width)
        return shares / (shares.sum() or 1.0)


class Network:
    """Two hidden layers with rectifiers and one linear output, trained by Adam on squared error.

    `scaled` sets how inputs and outputs are standardised and draws the weights; `train` goes on from the weights and the
    optimiser's state as they are, so it can be called for one part of the rows after another; `fit` does both."""

    def __init__(self, hidden: tuple[int, int] = (128, 64), epochs: int = 50, batch: int = 10, rate: float = 1e-3, seed: int = 42):
        self.hidden, self.epochs, self.batch, self.rate, self.seed = hidden, epochs, batch, rate, seed

    def scaled(self, x: np.ndarray, y: np.ndarray) -> Network:
        """Means and population deviations of all rows given; a feature that does not vary is only centred."""
        self.rng = np.random.default_rng(self.seed)
        self.mean, self.spread = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
        self.level, self.scale = y.mean(), y.std() or 1.0
        sizes = [x.shape[1], *self.hidden, 1]
        self.w = [self.rng.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b)) for a, b in zip(sizes, sizes[1:])]
        self.b = [np.zeros(b) for b in sizes[1:]]
        self.first, self.second = ([np.zeros_like(p) for p in (*self.w, *self.b)] for _ in range(2))
        self.steps = 0
        return self

    def train(self, x: np.ndarray, y: np.ndarray) -> Network:
        x, y = (x - self.mean) / self.spread, (y - self.level) / self.scale
        params = [*self.w, *self.b]
        for _ in range(self.epochs):
            order = self.rng.permutation(len(x))
            for k in range(0, len(x), self.batch):
                own = order[k : k + self.batch]
                layers = self._layers(x[own])
                delta = 2 * (layers[-1] - y[own, None]) / len(own)
                gw, gb = [], []
                for layer in (2, 1, 0):
                    gw.insert(0, layers[layer].T @ delta)
                    gb.insert(0, delta.sum(0))
                    if layer:
                        delta = (delta @ self.w[layer].T) * (layers[layer] > 0)
                self.steps += 1
                for p, g, a, b in zip(params, [*gw, *gb], self.first, self.second, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= self.rate * (a / (1 - 0.9**self.steps)) / (np.sqrt(b / (1 - 0.999**self.steps)) + 1e-7)
        return self

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        return self.scaled(x, y).train(x, y)

    def _layers(self, x: np.ndarray) -> list[np.ndarray]:
        a = np.maximum(0, x @ self.w[0] + self.b[0])
        c = np.maximum(0, a @ self.w[1] + self.b[1])
        return [x, a, c, c @ self.w[2] + self.b[2]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._layers((x - self.mean) / self.spread)[-1][:, 0] * self.scale + self.level
