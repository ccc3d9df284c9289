"""Byte-pair merges of many short stretches side by side."""

from __future__ import annotations

import numpy as np

from wordflow.llm.sentencepiece_model import Model

# Stretches that are merged together.
ROWS = 4096
NEVER = np.float32(np.inf)


class Merges:
    """The pairs of pieces that a model joins, as sorted tables.

    All stretches of a block take their best merge, the leftmost of equals, in the
    same step, until none has any left: what a queue does for one stretch at a time.
    """

    def __init__(self, model: Model) -> None:
        self.size = len(model.pieces)
        found: dict[int, tuple[float, int]] = {}
        for piece, cost in model.merges.items():
            for k in range(1, len(piece)):
                left, right = model.ids.get(piece[:k]), model.ids.get(piece[k:])
                if left is not None and right is not None:
                    found[left * self.size + right] = cost, model.ids[piece]
        self.keys = np.array(sorted(found) or [-1], np.int64)
        self.costs = np.array([found[k][0] if k in found else NEVER for k in self.keys.tolist()], np.float32)
        self.joined = np.array([found[k][1] if k in found else -1 for k in self.keys.tolist()], np.int32)
        if self.size**2 < 1 << 31:
            self.keys = self.keys.astype(np.int32)
        self.letters = np.full(0x110000, -1, np.int32)
        for piece, number in model.ids.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = number
        self.lengths = np.array(list(map(len, model.pieces)), np.int32)
        #: Models that never use some pieces, or have pieces of their users, need more than merges.
        self.enough = not model.unused and model.user_words is None

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What joining costs, and the piece it makes."""
        wanted = left.astype(self.keys.dtype) * self.keys.dtype.type(self.size) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(hit, self.costs[at], NEVER), self.joined[at]

    def _merged(self, grid: np.ndarray) -> np.ndarray:
        """Rows of symbols, filled up with -1, after all merges."""
        costs, joined = self._pairs(grid[:, :-1], grid[:, 1:])
        columns = np.arange(grid.shape[1])
        rows = np.arange(len(grid))
        while len(rows):
            best = costs[rows].argmin(axis=1)
            open_ = costs[rows, best] < NEVER
            rows, best = rows[open_], best[open_]
            if not len(rows):
                break
            every = np.arange(len(rows))
            own, cost, made = grid[rows], costs[rows], joined[rows]
            own[every, best] = made[every, best]
            # The right one of the two goes, and what stands behind it moves up.
            behind = columns[None, :] > best[:, None]
            from_ = np.minimum(columns + behind, len(columns) - 1)
            own = np.take_along_axis(own, from_, axis=1)
            own[:, -1] = -1
            gone = columns[None, :-1] >= best[:, None]
            from_ = np.minimum(columns[:-1] + gone, len(columns) - 2)
            cost, made = (np.take_along_axis(x, from_, axis=1) for x in (cost, made))
            cost[:, -1] = NEVER
            for at in (best - 1, best):
                there = np.flatnonzero((at >= 0) & (at < len(columns) - 1))
                place = at[there]
                cost[there, place], made[there, place] = self._pairs(own[there, place], own[there, place + 1])
            grid[rows], costs[rows], joined[rows] = own, cost, made
        return grid

    def encode(self, stretches: list[str], longest: int) -> list[bytes | None]:
        """Pairs of id and size per stretch, as bytes; None for long ones and those with unknown letters."""
        out: list[bytes | None] = [None] * len(stretches)
        if not self.enough or not stretches:
            return out
        sizes = np.array(list(map(len, stretches)), np.int64)
        points = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        symbols = self.letters[points]
        begins = np.cumsum(sizes) - sizes
        known = (np.minimum.reduceat(symbols, begins) >= 0) & (sizes <= longest)
        chosen = np.flatnonzero(known)
        chosen = chosen[np.argsort(sizes[chosen], kind="stable")]
        for begin in range(0, len(chosen), ROWS):
            own = chosen[begin : begin + ROWS]
            places = np.arange(int(sizes[own].max()) + 1)
            inside = places < sizes[own][:, None]
            at = np.minimum(begins[own][:, None] + places, len(symbols) - 1)
            grid = self._merged(np.where(inside, symbols[at], np.int32(-1)))
            made = np.stack([grid, self.lengths[grid]], axis=2).astype(np.int32)
            for row, i, n in zip(made, own.tolist(), (grid >= 0).sum(axis=1).tolist(), strict=True):
                out[i] = row[:n].tobytes()
        return out
