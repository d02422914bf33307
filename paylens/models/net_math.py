"""Array arithmetic of the embedding network: one mini-batch at a time, inside a task.

Only numpy and pandas are used here, so the functions can be sent to executors
that do not have this package installed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd


@dataclass(frozen=True)
class Layout:
    """Shapes of the network's arrays inside one flat vector."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    cards: tuple[int, ...]
    hidden: tuple[int, int]

    def shapes(self) -> dict[str, tuple[int, ...]]:
        widths = [min(32, card // 2 + 1) for card in self.cards]
        sizes = [len(self.numbers) + sum(widths), *self.hidden, 1]
        shapes = {f"embedding_{c}": (n, w) for c, n, w in zip(self.categories, self.cards, widths)}
        for i, (rows, cols) in enumerate(zip(sizes, sizes[1:]), 1):
            shapes |= {f"weight_{i}": (rows, cols), f"bias_{i}": (cols,)}
        return shapes

    @cached_property
    def places(self) -> list[tuple[str, int, int, tuple[int, ...]]]:
        """Name, begin, end and shape of every array in the flat vector."""
        out, at = [], 0
        for name, shape in self.shapes().items():
            end = at + int(np.prod(shape))
            out.append((name, at, end, shape))
            at = end
        return out

    def size(self) -> int:
        return self.places[-1][2]

    def arrays(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Views into the flat vector, by name."""
        return {name: flat[begin:end].reshape(shape) for name, begin, end, shape in self.places}

    def start(self, seed: int) -> np.ndarray:
        """Embeddings from the unit normal, dense layers uniform in 1/sqrt(inputs)."""
        rng = np.random.default_rng(seed)
        flat = np.empty(self.size())
        fan_in = 1
        for name, view in self.arrays(flat).items():
            if name.startswith("embedding"):
                view[:] = rng.standard_normal(view.shape)
                continue
            if name.startswith("weight"):
                fan_in = view.shape[0]
            bound = 1 / np.sqrt(max(1, fan_in))
            view[:] = rng.uniform(-bound, bound, view.shape)
        return flat


def inputs(pdf: pd.DataFrame, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, category codes and scaled target of one Arrow batch."""
    return (
        pdf[list(layout.numbers)].to_numpy(np.float32),
        pdf[list(layout.categories)].to_numpy(np.int64),
        pdf["y_scaled"].to_numpy(np.float32),
    )


def forward(w: dict, numbers: np.ndarray, codes: np.ndarray, layout: Layout) -> tuple[np.ndarray, list]:
    """Prediction, with the layer outputs the gradient needs."""
    looked_up = [w[f"embedding_{c}"][codes[:, i]] for i, c in enumerate(layout.categories)]
    x = np.hstack([numbers, *looked_up])
    h1 = np.maximum(x @ w["weight_1"] + w["bias_1"], 0)
    h2 = np.maximum(h1 @ w["weight_2"] + w["bias_2"], 0)
    return (h2 @ w["weight_3"] + w["bias_3"])[:, 0], [x, h1, h2]


def gradient(flat: np.ndarray, numbers, codes, y, layout: Layout) -> tuple[np.ndarray, float]:
    """Gradient of the mean squared error over finite rows, and the error itself."""
    w = layout.arrays(flat)
    predicted, outputs = forward(w, numbers, codes, layout)
    error = predicted - y
    usable = np.isfinite(error)
    error = np.where(usable, error, 0.0)
    n = max(1, int(usable.sum()))
    grad = np.zeros_like(flat)
    g = layout.arrays(grad)
    delta = (2 / n * error)[:, None]
    for i in (3, 2, 1):
        below = outputs[i - 1]
        g[f"weight_{i}"][:] = below.T @ delta
        g[f"bias_{i}"][:] = delta.sum(axis=0)
        delta = delta @ w[f"weight_{i}"].T
        if i > 1:
            delta = delta * (below > 0)
    at = len(layout.numbers)
    for i, c in enumerate(layout.categories):
        table = g[f"embedding_{c}"]
        width = table.shape[1]
        # one flat index: numpy adds at rows of a matrix many times slower, in the same order
        np.add.at(table.reshape(-1), (codes[:, i, None] * width + np.arange(width)).ravel(), delta[:, at:at + width].ravel())
        at += width
    return grad, float((error ** 2).sum() / n)


def adamw_step(
    state: np.ndarray, steps: int, grad: np.ndarray, lr: float, weight_decay: float, max_norm: float
) -> None:
    """One clipped AdamW step in place; ``state`` holds weights and both moments as rows."""
    norm = float(np.sqrt(grad @ grad))
    if norm > max_norm:
        grad = grad * (max_norm / (norm + 1e-6))
    w, m, v = state
    w *= 1 - lr * weight_decay
    m += 0.1 * (grad - m)
    v += 0.001 * (grad * grad - v)
    w -= lr * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)


def minibatches(chunks: Iterable[tuple], size: int, rng: np.random.Generator) -> Iterator[tuple]:
    """Cut a stream of row arrays into shuffled mini-batches; the remainder is carried on."""
    rest = None
    for chunk in chunks:
        order = rng.permutation(len(chunk[0]))
        rows = [part[order] for part in chunk]
        if rest is not None:
            rows = [np.concatenate(pair) for pair in zip(rest, rows)]
        full = len(rows[0]) // size * size
        for at in range(0, full, size):
            yield tuple(part[at:at + size] for part in rows)
        rest = [part[full:] for part in rows]
    if rest is not None and len(rest[0]):
        yield tuple(rest)
