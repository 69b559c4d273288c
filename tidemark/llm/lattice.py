"""A piece vocabulary compiled into states and arcs, composed with many chunks of text at once.

States are the nodes of a trie over the characters of all pieces; an arc is a
piece (or a character that has none, which bytes stand for).  The weight of an
arc depends on the arc before it: zero if merging leaves the two apart, infinite
if it doesn't.  It is found by undoing the merges of both, latest first: if two
parts that stood side by side at the boundary would have merged before either
was taken up elsewhere, the boundary never lasted.

Weights being zero or infinite, the shortest path of the composition in the
tropical semiring is its only path of weight zero, and the search may try the
longest arc first and go back where no arc goes on.  A place and the arc that
led there have one finite path before them, so none is met twice and the search
takes no more steps than there are arcs.  All chunks take their steps together,
as columns of numpy arrays.
"""

from __future__ import annotations

import numpy as np

# Symbol of a character that no piece holds; it joins with nothing.
FOREIGN = 0
LANES = 1 << 14


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class _Table:
    """Numbers by key: sorted keys, searched; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1)


class Lattice:
    """The arcs of a byte-pair model; ``scores`` gives every piece's, higher ones merge first, equal ones from the left.

    Refuses (``ValueError``) models in which a piece merges before its parts:
    the order of merges would not follow from scores.
    """

    def __init__(self, scores: dict[str, float], ids: dict[str, int]) -> None:
        single = dict.fromkeys(c for p in scores for c in p)
        self.texts = ["", *single, *(p for p in sorted(scores, key=len) if len(p) > 1)]
        self.symbols = {t: i for i, t in enumerate(self.texts) if i}
        n = self.n = len(self.texts)
        self.size = np.array([len(t) or 1 for t in self.texts])
        order = {score: r for r, score in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = np.array([order[scores[t]] if t in scores else -1 for t in self.texts])
        self.made = np.where(self.size > 1, rank, -1)  # when a symbol comes to be; characters are there before
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.out = np.array([ids.get(t, -1) for t in self.texts])
        self._compile_merges()
        self._compile_states()

    def _compile_merges(self) -> None:
        """How each piece comes about, shortest first: of its cuts, the one whose two parts stay apart till then."""
        cuts = [
            (s, a, b)
            for s, t in enumerate(self.texts)
            for i in range(1, len(t))
            if (a := self.symbols.get(t[:i])) and (b := self.symbols.get(t[i:]))
        ]
        whole, a, b = np.array(cuts, np.int64).reshape(-1, 3).T
        self.pairs = _Table(a * self.n + b, self.made[whole])
        self.reached = self.size == 1
        for size in range(2, self.size.max() + 1):
            w, x, y = (v[self.size[whole] == size] for v in (whole, a, b))
            open_ = self.reached[x] & self.reached[y]
            w, x, y = w[open_], x[open_], y[open_]
            fits = self.apart(x, y, self.made[w])
            w, x, y = w[fits], x[fits], y[fits]
            if (self.made[w] < np.maximum(self.made[x], self.made[y])).any():
                raise ValueError("a piece merges before its parts")
            self.left[w], self.right[w], self.reached[w] = x, y, True

    def apart(self, x: np.ndarray, y: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether the boundary between symbols ``x`` and ``y`` lasts (``until``: up to the merge of that rank)."""
        lasts = np.zeros(len(x), bool)
        lane = np.arange(len(x))
        until = np.full(len(x), self.n) if until is None else until
        while len(lane):
            rank = self.pairs[x * self.n + y]
            made_x, made_y = self.made[x], self.made[y]
            kept = (rank < 0) | (rank >= until)
            done = kept & (made_x < 0) & (made_y < 0)
            lasts[lane[done]] = True
            on = kept & ~done
            lane, x, y, made_x, made_y = lane[on], x[on], y[on], made_x[on], made_y[on]
            # Of equal merges the left one comes first: the right one is undone before it, and waits for the boundary.
            undo_x = made_x > made_y
            until = np.where(undo_x, made_x, made_y + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return lasts

    def _compile_states(self) -> None:
        """The trie, and the pieces that a state's text begins with: the longest, and from each the next shorter."""
        arcs = sorted(t for t, ok in zip(self.texts, self.reached) if ok and t)
        codes = sorted({ord(t) for t in arcs if len(t) == 1})
        self.char_class = np.zeros(max(codes, default=0) + 2, np.int64)  # 0: no piece holds it
        self.char_class[codes] = np.arange(1, len(codes) + 1)
        self.n_class = len(codes) + 1
        nodes: dict[str, int] = {"": 0}
        best, shorter = [FOREIGN], np.full(self.n, -1)
        keys, targets = [], []
        for text in arcs:  # in this order a piece comes after those it begins with
            for i in range(1, len(text) + 1):
                if text[:i] not in nodes:
                    parent = nodes[text[: i - 1]]
                    nodes[text[:i]] = len(best)
                    keys.append(parent * self.n_class + int(self.char_class[ord(text[i - 1])]))
                    targets.append(len(best))
                    best.append(best[parent])
            symbol, node = self.symbols[text], nodes[text]
            shorter[symbol] = best[nodes[text[:-1]]] or -1
            best[node] = symbol
        self.next = _Table(np.array(keys, np.int64), np.array(targets, np.int64))
        self.best, self.shorter = np.array(best), shorter

    def longest(self, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The longest arc from each place of a text given as classes of characters, which ends with class 0."""
        found = np.zeros(len(at), np.int64)
        lane, node, at = np.arange(len(at)), np.zeros(len(at), np.int64), at.copy()
        while len(lane):
            c = classes[at]
            node = np.where(c > 0, self.next[node * self.n_class + c], -1)
            on = node >= 0
            lane, node, at = lane[on], node[on], at[on] + 1
            found[lane] = self.best[node]
        return found

    def paths(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of the shortest paths, a row for each chunk, and how many each has."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        codes = _codes([c + "\0" for c in chunks])
        classes = self.char_class[np.minimum(codes, len(self.char_class) - 1)]
        ends = np.cumsum(lengths + 1) - 1
        classes[ends] = 0
        trail = np.zeros((len(chunks), int(lengths.max(initial=0)) + 1), np.int64)
        depth = np.zeros(len(chunks), np.int64)
        lane = np.flatnonzero(lengths)
        at = (ends - lengths)[lane]
        left = np.zeros(len(lane), np.int64)  # joins with nothing, as the beginning does
        arc = self.longest(classes, at)
        while len(lane):
            free = self.apart(left, arc)
            on = np.flatnonzero(free)
            trail[lane[on], depth[lane[on]]] = arc[on]
            depth[lane[on]] += 1
            at[on] += self.size[arc[on]]
            left[on] = arc[on]
            going = on[at[on] < ends[lane[on]]]
            refused = np.flatnonzero(~free)
            arc[refused] = self.shorter[arc[refused]]
            arc[going] = self.longest(classes, at[going])
            back = refused[arc[refused] < 0]
            while len(back):  # no way on from here: a shorter arc must have led here
                depth[lane[back]] -= 1
                last = trail[lane[back], depth[lane[back]]]
                at[back] -= self.size[last]
                arc[back] = self.shorter[last]
                before = depth[lane[back]] - 1
                left[back] = np.where(before >= 0, trail[lane[back], before], FOREIGN)
                back = back[arc[back] < 0]
            live = at < ends[lane]
            if not live.all():
                lane, at, left, arc = lane[live], at[live], left[live], arc[live]
        return trail, depth

    def encode(self, chunks: list[str], kind: str, byte_ids: dict[int, int]) -> list[bytes]:
        """The ids of each chunk as numpy writes ``kind``; ``byte_ids`` stand for characters without a piece."""
        out: list[bytes] = []
        for first in range(0, len(chunks), LANES):
            part = chunks[first : first + LANES]
            trail, depth = self.paths(part)
            symbols = trail[np.arange(trail.shape[1]) < depth[:, None]]
            ids = self.out[symbols]
            ends = np.cumsum(depth)
            raw = ids.astype(kind)
            width, raw = raw.itemsize, raw.tobytes()
            bounds = [0, *(ends * width).tolist()]
            out += [raw[a:b] for a, b in zip(bounds, bounds[1:])]
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), side="right")).tolist():
                spelled, at = [], 0
                for symbol in trail[i, : depth[i]].tolist():
                    size = int(self.size[symbol])
                    if self.out[symbol] < 0:
                        spelled += [byte_ids[b] for b in part[i][at : at + size].encode()]
                    else:
                        spelled.append(int(self.out[symbol]))
                    at += size
                out[first + i] = np.array(spelled, kind).tobytes()
        return out
