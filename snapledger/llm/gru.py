"""A gated recurrent language model in numpy, with a class-factored softmax and carried state.

Ids: 0 is the end of a document (and what stands before its first word), then the modelled words by
falling count, then one id for each tail class. A modelled word's probability is that of its class
times that of the word within the class; both depend on the state. A tail class is predicted only
as a class, what lies within it is the caller's part.

Documents are laid on lanes one after the other. Windows of ``STEPS`` tokens run over all lanes at
once; the state goes on from window to window and is reset where a document starts, so a document's
likelihood is that of the whole text. Learning truncates gradients at the window's start.
"""

from __future__ import annotations

import numpy as np

HIDDEN, STEPS, LANES, WORD_CLASSES = 16, 32, 512, 47
PART, BATCH = 2_048, 16_384
RATE, CLIP = 0.08, 5.0
CHUNK = 1_024  # rows whose class probabilities stay in a core's cache
WIDEST = 60.0  # exponentials of 32 bits and their sums are finite up to here


def classes_of(counts: np.ndarray, n_classes: int = WORD_CLASSES) -> np.ndarray:
    """Class of each modelled word (falling counts, the end apart): equal shares of root counts."""
    if not len(counts):
        return np.zeros(0, np.int64)
    share = np.cumsum(np.sqrt(counts))
    return np.minimum((share - 1e-9) / share[-1] * n_classes, n_classes - 1).astype(np.int64)


class Shape:
    """Which id is in which class. ``counts``: of the end, then of the modelled words."""

    def __init__(self, counts: np.ndarray, tail_masses: np.ndarray):
        words = len(counts)
        inner = classes_of(counts[1:])
        inner = np.unique(inner, return_inverse=True)[1] if len(inner) else inner
        self.n_words, self.n_tails = words, len(tail_masses)
        self.n_word_classes = 1 + (int(inner.max()) + 1 if len(inner) else 0)
        self.n_classes = self.n_word_classes + self.n_tails
        self.class_of = np.concatenate([[0], inner + 1, self.n_word_classes + np.arange(self.n_tails)]).astype(np.int64)
        # words of a class follow each other
        self.first = np.searchsorted(self.class_of[:words], np.arange(self.n_word_classes + 1))
        self.counts, self.tail_masses = counts, tail_masses

    def fresh(self, seed: int = 0) -> dict[str, np.ndarray]:
        """Parameters that begin with the counts' own distribution."""
        rng = np.random.default_rng(seed)
        size, h = self.n_words + self.n_tails, HIDDEN
        mass = np.add.reduceat(self.counts + 0.1, self.first[:-1])
        class_mass = np.concatenate([mass, self.tail_masses])
        return {
            "x": (rng.standard_normal((size, 3 * h)) * 0.1).astype("f4"),
            "gates": (rng.standard_normal((h, 2 * h)) / np.sqrt(h)).astype("f4"),
            "new": (rng.standard_normal((h, h)) / np.sqrt(h)).astype("f4"),
            "classes": np.zeros((h, self.n_classes), "f4"),
            "class_bias": np.log(class_mass / class_mass.sum()).astype("f4"),
            "words": np.zeros((self.n_words, h), "f4"),
            "word_bias": np.log((self.counts + 0.1) / mass[self.class_of[:self.n_words]]).astype("f4"),
        }


def lay_out(sizes: list[int], lanes: int = LANES) -> list[list[int]]:
    """Documents by lane, longest lane first: the longest documents go to the emptiest lanes."""
    import heapq
    lanes = max(1, min(lanes, len(sizes)))
    heap = [(0, lane) for lane in range(lanes)]
    out: list[list[int]] = [[] for _ in range(lanes)]
    for doc in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, lane = heapq.heappop(heap)
        out[lane].append(doc)
        heapq.heappush(heap, (load + sizes[doc], lane))
    return sorted(out, key=lambda docs: -sum(sizes[d] for d in docs))


def _exp(logits: np.ndarray, wide: bool) -> np.ndarray | float:
    """Exponentials in place. Returns what the logarithm of a row's sum lacks: only ``wide`` logits are moved first."""
    top = logits.max(axis=1, keepdims=True) if wide else 0.0
    if wide:
        logits -= top
    np.exp(logits, out=logits)
    return top[:, 0] if wide else top


def _summed(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by ``at``."""
    out = np.zeros((size, rows.shape[1]), "f4")
    order = np.argsort(at.astype(np.int16 if size <= 32_767 else at.dtype), kind="stable")  # short ones sort by radix
    ids, starts = np.unique(at[order], return_index=True)
    out[ids] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class Gru:
    def __init__(self, shape: Shape, params: dict[str, np.ndarray]):
        self.shape, self.p = shape, params
        self.sums = {k: np.full(v.shape, 1e-3, "f4") for k, v in params.items()}

    def run(self, docs: list[np.ndarray], learn: bool = False) -> np.ndarray:
        """Natural log-likelihood of each document, given as ids that end with 0.

        To learn, documents are cut into parts of ``PART`` tokens, so that a few very long ones
        don't leave most lanes empty; the state starts anew with a part, the token before it is
        known. Likelihoods are of whole documents.
        """
        out = np.zeros(len(docs))
        if not docs:
            return out
        step = PART if learn else max(map(len, docs))
        parts = [(d, at) for d, doc in enumerate(docs) for at in range(0, len(doc), step)]
        lanes = lay_out([min(step, len(docs[d]) - at) for d, at in parts])
        order = [parts[k] for lane in lanes for k in lane]
        sizes = np.array([min(step, len(docs[d]) - at) for d, at in order])
        ends = np.cumsum(sizes)
        lengths = np.add.reduceat(sizes, np.cumsum([0, *map(len, lanes)])[:-1])
        # lanes end to end: token, the one before it, document
        target = np.concatenate([docs[d][at:at + step] for d, at in order]).astype(np.int32)
        owner = np.repeat(np.array([d for d, _ in order], np.int32), sizes)
        fresh = np.zeros(len(target), bool)
        fresh[ends - sizes] = True
        before = np.empty_like(target)
        before[1:] = target[:-1]
        before[ends - sizes] = [docs[d][at - 1] if at else 0 for d, at in order]
        offset = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        state = np.zeros((len(lanes), HIDDEN), "f4")
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = 0

        def settle() -> None:
            hidden = np.concatenate([x for x, _ in held])
            where = np.concatenate([x for _, x in held])
            out[:] += np.bincount(owner[where], self._output(hidden, target[where], False)[0], len(docs))

        for start in range(0, int(lengths[0]), STEPS):
            active = int(np.searchsorted(-lengths, -start, side="left"))  # lanes longer than start
            steps = min(STEPS, int(lengths[0]) - start)
            at = offset[:active, None] + start + np.arange(steps)
            inside = start + np.arange(steps) < lengths[:active, None]
            # time first
            at, inside = np.where(inside, at, offset[:active, None]).T, inside.T
            states, kept = self._states(before[at], fresh[at], state[:active])
            state[:active] = states[-1]
            rows = np.flatnonzero(inside)  # of the window, time first
            places, hidden = at.ravel()[rows], states.reshape(-1, HIDDEN)[rows]
            if learn:
                logs, d_hidden, grads = self._output(hidden, target[places], True)
                out += np.bincount(owner[places], logs, len(docs))
                d_states = np.zeros_like(states)
                d_states.reshape(-1, HIDDEN)[rows] = d_hidden
                self._learn(before[at], *kept, d_states, grads, len(logs))
                continue
            held.append((hidden, places))
            n_held += len(places)
            if n_held >= BATCH:
                settle()
                held, n_held = [], 0
        if held:
            settle()
        return out

    def _states(self, before, fresh, state):
        """States after each token of a window, and what learning needs of the way there.

        Each gate has its own block of memory, and weights are scaled once a window, so that the
        logistic function is 1 / (1 + exp(x)) and the hyperbolic tangent 2 / (1 + exp(x)) - 1.
        """
        p, h = self.p, HIDDEN
        steps, lanes = before.shape
        scaled = p["x"] * np.repeat(np.array([-1, -1, -2], "f4"), h)
        x = np.empty((3, steps, lanes, h), "f4")
        for k in range(3):
            np.take(scaled[:, k * h:(k + 1) * h].copy(), before, axis=0, out=x[k], mode="clip")
        to_gates = -p["gates"].reshape(h, 2, h).transpose(1, 0, 2).copy()
        to_new = p["new"] * -2
        olds = np.empty((steps, lanes, h), "f4")
        gates = np.empty((steps, 2, lanes, h), "f4")
        news = np.empty((steps, lanes, h), "f4")
        states = np.empty((steps, lanes, h), "f4")
        with np.errstate(over="ignore"):  # 1 / (1 + inf) is 0
            for t in range(steps):
                old = olds[t]
                old[:] = state
                old[fresh[t]] = 0
                g = np.matmul(old, to_gates, out=gates[t])
                g += x[:2, t]
                np.exp(g, out=g)
                g += 1
                np.reciprocal(g, out=g)
                z, r = g
                new = np.matmul(r * old, to_new, out=news[t])
                new += x[2, t]
                np.exp(new, out=new)
                new += 1
                np.divide(2, new, out=new)
                new -= 1
                state = np.subtract(old, new, out=states[t])
                state *= z
                state += new
        return states, (olds, gates, news, fresh)

    def _output(self, hidden, goal, learn):
        """Log-probabilities of the goals; the rows are worked on in the order of their goals.

        A last column of ones carries the biases. Of a gradient, probabilities less the goal's one,
        the ones are sums over equal goals; dividing by a row's sum is left to its narrow side.
        States lie between -1 and 1, so the weights tell whether exponentials may overflow.
        """
        p, shape = self.p, self.shape
        n, h = len(goal), HIDDEN
        order = np.argsort(goal.astype(np.int16 if len(p["x"]) <= 32_767 else goal.dtype), kind="stable")
        goal = goal[order]
        rows = np.ones((n, h + 1), "f4")
        rows[:, :h] = hidden[order]
        to_class = np.vstack([p["classes"], p["class_bias"]])
        to_word = np.hstack([p["words"], p["word_bias"][:, None]])
        several = np.diff(shape.first) > 1  # a class of one word leaves nothing to choose
        chosen = several[shape.class_of[:shape.n_words]]
        own = to_class.T[shape.class_of]
        own[:shape.n_words][chosen] += to_word[chosen]
        own = np.take(own, goal, axis=0)
        logs = np.einsum("ij,ij->i", rows, own).astype(float)
        back = np.negative(own, out=own) if learn else None
        wide = np.abs(to_class).sum(axis=0).max() > WIDEST
        class_sums, word_sums = np.zeros_like(to_class), np.zeros_like(to_word)
        ones = np.ones(max(shape.n_classes, shape.n_words), "f4")
        for start in range(0, n, CHUNK):
            here = slice(start, start + CHUNK)
            part = rows[here]
            e = part @ to_class
            top = _exp(e, wide)
            total = e @ ones[:shape.n_classes]
            logs[here] -= np.log(total) + top
            if learn:
                total = np.reciprocal(total)[:, None]
                class_sums += (part * total).T @ e
                back[here] += (e @ to_class.T) * total
        wide = bool(chosen.any()) and np.abs(to_word[chosen]).sum(axis=1).max() > WIDEST
        ends = np.searchsorted(goal, shape.first)
        for c in np.flatnonzero(several & (np.diff(ends) > 0)):
            words, here = slice(shape.first[c], shape.first[c + 1]), slice(ends[c], ends[c + 1])
            part, weights = rows[here], to_word[words]
            e = part @ weights.T
            top = _exp(e, wide)
            total = e @ ones[:len(weights)]
            logs[here] -= np.log(total) + top
            if learn:
                total = np.reciprocal(total)[:, None]
                word_sums[words] = e.T @ (part * total)
                back[here] += (e @ weights) * total
        out = np.empty_like(logs)
        out[order] = logs
        if not learn:
            return out, None, {}
        goals, starts = np.unique(goal, return_index=True)
        seen = np.zeros((len(shape.class_of), h + 1), "f4")
        seen[goals] = np.add.reduceat(rows, starts, axis=0)
        word_sums[chosen] -= seen[:shape.n_words][chosen]
        class_sums -= np.add.reduceat(seen, np.searchsorted(shape.class_of, np.arange(shape.n_classes)), axis=0).T
        d_hidden = np.empty((n, h), "f4")
        d_hidden[order] = back[:, :h]
        return out, d_hidden, {"classes": class_sums[:h], "class_bias": class_sums[h],
                               "words": word_sums[:, :h], "word_bias": word_sums[:, h]}

    def _learn(self, before, olds, gates, news, fresh, d_states, grads, n):
        p, h = self.p, HIDDEN
        steps, lanes = before.shape
        d_x = np.empty((3, steps, lanes, h), "f4")
        d_next = np.zeros((lanes, h), "f4")
        z_back, r_back = p["gates"].T[:h].copy(), p["gates"].T[h:].copy()
        new_back = p["new"].T.copy()
        for t in range(steps - 1, -1, -1):
            old, new, (z, r) = olds[t], news[t], gates[t]
            d_z, d_r, d_new = d_x[:, t]
            d = d_states[t]
            d += d_next
            less = 1 - z
            less *= d
            np.multiply(new, new, out=d_new)
            np.subtract(1, d_new, out=d_new)
            d_new *= less
            d_mixed = d_new @ new_back
            np.subtract(old, new, out=d_z)
            d_z *= z
            d_z *= less
            d_mixed *= r
            np.subtract(1, r, out=d_r)
            d_r *= old
            d_r *= d_mixed
            d_next = np.multiply(d, z, out=d)
            d_next += d_mixed
            d_next += d_z @ z_back
            d_next += d_r @ r_back
            d_next[fresh[t]] = 0
        d_x = d_x.reshape(3, -1, h)
        old = olds.reshape(-1, h)
        grads["gates"] = np.hstack([old.T @ d_x[0], old.T @ d_x[1]])
        grads["new"] = (gates[:, 1].reshape(-1, h) * old).T @ d_x[2]
        grads["x"] = _summed(np.hstack(list(d_x)), before.reshape(-1), len(p["x"]))
        for name, grad in grads.items():
            grad *= 1 / np.sqrt(n)
            np.clip(grad, -CLIP, CLIP, out=grad)
            self.sums[name] += grad * grad
            p[name] -= RATE * grad / np.sqrt(self.sums[name])
