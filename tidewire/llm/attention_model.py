"""A small causal self-attention language model in numpy: training with hand-written gradients, batched scoring.

One head looks back over at most a window of positions with learnt relative-position biases. A token's probability is
that of its class given the context, times that of its place in the class given the context. All rare tokens of a
class share its last place and follow their counts there, so the probabilities of all tokens add up to one.
"""

import zlib

import numpy as np

CLASSES, PLACES, FORMS = 64, 32, 24
RANKED = CLASSES * (PLACES - 1)
KEY, VALUE, OWN = 16, 16, 32
HIDDEN = OWN + VALUE
#: Positions that a window scores, and positions before them that it only reads.
STRIDE, CONTEXT = 48, 16
SPAN = STRIDE + CONTEXT
SMOOTHING = 0.1
#: Windows whose attention is computed together.
CACHED = 32


def _form(token: bytes) -> int:
    """Group of a rare token: how it begins and ends."""
    text = token.decode("utf-8", "replace")
    shape = (text[:1].isspace(), text.strip()[:1].isupper(), text[-1:].isalnum(), text.strip()[:1].isalpha(), text[-1:])
    return zlib.crc32(repr(shape).encode()) % FORMS


class Vocabulary:
    """Class, place, input row and share of its place of every token id, from the counts of all ids."""

    def __init__(self, counts: np.ndarray, tokens: list[bytes]):
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.classes = rank % CLASSES
        self.places = np.minimum(rank // CLASSES, PLACES - 1)
        self.inputs = np.where(rank < RANKED, rank, RANKED + np.array([_form(t) for t in tokens], np.int64))
        self.start = RANKED + FORMS  # stands before the first token
        self.rows = self.start + 1
        slot = self.classes * PLACES + self.places
        smooth = counts + SMOOTHING
        totals = np.bincount(slot, smooth, CLASSES * PLACES)
        self.within = np.log10(smooth / totals[slot])
        totals = np.maximum(totals, 1e-9).reshape(CLASSES, PLACES)
        self.class_prior = np.log(totals.sum(axis=1) / totals.sum())
        self.place_prior = np.log(totals / totals.sum(axis=1, keepdims=True))


def _lowered(logits: np.ndarray) -> np.ndarray:
    """The same logits, by row less their largest if any is too large for ``exp``; in place."""
    if not logits.max() < 60:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _log_chosen(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of each row's probability of ``chosen``; uses up the logits."""
    picked = _lowered(logits)[np.arange(len(logits)), chosen]
    np.exp(logits, out=logits)
    return picked - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


class Attention:
    def __init__(self, vocabulary: Vocabulary, seed: int = 5):
        random = np.random.default_rng(seed)
        normal = lambda *shape: (0.1 * random.standard_normal(shape)).astype(np.float32)
        self.p = {
            "q": normal(vocabulary.rows, KEY), "k": normal(vocabulary.rows, KEY), "v": normal(vocabulary.rows, VALUE),
            "x": normal(vocabulary.rows, OWN), "near": np.zeros(SPAN, np.float32),
            "out": normal(HIDDEN, CLASSES), "bias": vocabulary.class_prior.astype(np.float32),
            "inner": normal(CLASSES, HIDDEN, PLACES), "inner_bias": vocabulary.place_prior.astype(np.float32),
        }
        self.moments = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in self.p.items()}
        back = np.arange(SPAN)[:, None] - np.arange(SPAN)[None, :]
        self.back, self.causal = np.clip(back, 0, SPAN - 1), back >= 0
        self.rooms = {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array whose memory the next call with this name and shape has again: fresh memory costs more than the work in it."""
        key = name, shape, self.p["x"].dtype
        if key not in self.rooms:
            self.rooms = {k: v for k, v in self.rooms.items() if k[0] != name} | {key: np.empty(shape, key[2])}
        return self.rooms[key]

    @staticmethod
    def _class_order(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each class begins in the order of the classes, and that order."""
        order = np.argsort(classes.astype(np.uint8), kind="stable")
        return np.searchsorted(classes[order], np.arange(CLASSES + 1)), order

    def _with_biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of classes and places, the biases as their last row."""
        return np.concatenate([self.p["out"], self.p["bias"][None]]), np.concatenate([self.p["inner"], self.p["inner_bias"][:, None]], axis=1)

    def prepare(self) -> None:
        """Tables for scoring: a last row of zeros stands for padding, and a column of ones adds up the weights."""
        p = self.p
        ones = np.ones((len(p["v"]), 1), np.float32)
        tables = {"q": p["q"], "k": p["k"], "v": np.concatenate([p["v"], ones], axis=1), "x": p["x"]}
        self.tables = {name: np.concatenate([t, np.zeros((1, t.shape[1]), np.float32)]) for name, t in tables.items()}
        self.out, self.inner = self._with_biases()
        rows = slice(CONTEXT, SPAN)
        self.near = np.where(self.causal[rows], np.exp(p["near"][self.back[rows]]), 0).astype(np.float32)

    def log_probabilities(self, inputs, padded, classes, places) -> np.ndarray:
        """Natural log of the probability of class and place at the last ``STRIDE`` positions of each window."""
        p, tables, room = self.p, self.tables, self._room
        inputs = np.where(padded, len(p["v"]), inputs)
        count = classes.size
        hidden = room("read", len(inputs), STRIDE, HIDDEN + 1)  # the last column of ones stands for the biases
        hidden[..., HIDDEN] = 1
        for start in range(0, len(inputs), CACHED):  # a part's weights stay in the processor's cache
            part = inputs[start:start + CACHED]
            own = part[:, CONTEXT:]
            scores = np.matmul(
                tables["q"].take(own, axis=0), tables["k"].take(part, axis=0).transpose(0, 2, 1),
                out=room("read_scores", len(part), STRIDE, SPAN))
            np.exp(scores, out=scores)  # at most exp(KEY * 1.5 ** 2), times exp(20): the weights are clipped after training
            scores *= self.near
            seen = scores @ tables["v"].take(part, axis=0)
            hidden[start:start + CACHED, :, :OWN] = tables["x"].take(own, axis=0)
            np.divide(seen[..., :-1], seen[..., -1:], out=hidden[start:start + CACHED, :, OWN:HIDDEN])
        ends, order = self._class_order(classes.reshape(-1))
        hidden = hidden.reshape(count, -1).take(order, axis=0, out=room("read_ordered", count, HIDDEN + 1), mode="clip")
        ranked = _log_chosen(np.matmul(hidden, self.out, out=room("read_class", count, CLASSES)), classes.reshape(-1)[order])
        logits = room("read_place", count, PLACES)
        for c in range(CLASSES):
            np.matmul(hidden[ends[c]:ends[c + 1]], self.inner[c], out=logits[ends[c]:ends[c + 1]])
        ranked += _log_chosen(logits, places.reshape(-1)[order])
        made = np.empty_like(ranked)
        made[order] = ranked
        return made.reshape(len(inputs), STRIDE)

    def gradients(self, inputs, classes, places, real=None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the positions of windows, where ``real`` is false left out, and its gradients."""
        loss, grads, used, rows = self._gradients(inputs, classes, places, real)
        for name, of_rows in rows.items():
            grads[name] = np.zeros_like(self.p[name])
            grads[name][used] = of_rows
        return loss, grads

    def _gradients(self, inputs, classes, places, real):
        """Loss, gradients of the dense weights, the input rows that occur, and the gradients of those by table.

        Positions are put in the order of their classes once, so that all softmax steps run over whole arrays. The
        attention is never divided by its sums: a last column of ones in the values adds them up on the way there, and
        takes the mean gradient of each position off on the way back.
        """
        p, kind = self.p, self.p["x"].dtype
        real = np.ones(classes.shape, kind) if real is None else real.astype(kind)
        share = real.reshape(-1) / max(1.0, float(real.sum()))
        classes, places = np.where(share > 0, classes.reshape(-1), 0), np.where(share > 0, places.reshape(-1), 0)
        ends, order = self._class_order(classes)
        room, count, shape = self._room, inputs.size, inputs.shape
        q, k = (p[name].take(inputs, axis=0, out=room(name, *shape, KEY), mode="clip") for name in "qk")
        values = room("values", *shape, VALUE + 1)
        values[..., :VALUE], values[..., VALUE] = p["v"].take(inputs, axis=0), 1
        scores = np.matmul(q, k.transpose(0, 2, 1), out=room("scores", *shape, SPAN))
        np.exp(scores, out=scores)  # bounded as in log_probabilities
        scores *= np.exp(p["near"]).take(self.back) * self.causal
        seen = np.matmul(scores, values, out=room("seen", *shape, VALUE + 1))
        sums = seen[..., VALUE:]
        both = room("both", *shape, HIDDEN + 1)  # the last column of ones stands for the biases
        both[..., :OWN], both[..., HIDDEN] = p["x"].take(inputs, axis=0), 1
        seen = np.divide(seen[..., :VALUE], sums, out=both[..., OWN:HIDDEN])
        both = both.reshape(count, -1).take(order, axis=0, out=room("ordered", count, HIDDEN + 1), mode="clip")
        classes, places = classes[order], places[order]
        share, at = share[order], np.arange(len(order))

        def softmax(logits, chosen):
            """Loss, and ``logits`` turned into its gradient in place."""
            np.exp(_lowered(logits), out=logits)
            total = logits @ np.ones(logits.shape[1], kind)
            lost = -np.log(logits[at, chosen] / total + 1e-12) @ share
            logits *= (share / total)[:, None]
            logits[at, chosen] -= share
            return float(lost)

        out, inner = self._with_biases()
        d_class = np.matmul(both, out, out=room("d_class", count, CLASSES))
        loss = softmax(d_class, classes)
        d_out = both.T @ d_class
        d_hidden = np.matmul(d_class, p["out"].T, out=room("d_hidden", count, HIDDEN))
        parts = [(c, slice(ends[c], ends[c + 1])) for c in range(CLASSES) if ends[c] < ends[c + 1]]
        d_place = room("d_place", count, PLACES)
        for c, rows in parts:
            np.matmul(both[rows], inner[c], out=d_place[rows])
        loss += softmax(d_place, places)
        d_inner = np.zeros((CLASSES, HIDDEN + 1, PLACES), kind)
        more = room("more", count, HIDDEN)
        for c, rows in parts:
            np.matmul(both[rows].T, d_place[rows], out=d_inner[c])
            np.matmul(d_place[rows], p["inner"][c].T, out=more[rows])
        d_hidden += more
        grads = {"out": d_out[:HIDDEN], "bias": d_out[HIDDEN], "inner": d_inner[:, :HIDDEN], "inner_bias": d_inner[:, HIDDEN]}
        d_all = room("d_all", count, HIDDEN + 2 * KEY)
        d_all[order, :HIDDEN] = d_hidden
        by_window = d_all.reshape(*shape, -1)
        d_seen = room("d_seen", *shape, VALUE + 1)
        np.divide(by_window[..., OWN:HIDDEN], sums, out=d_seen[..., :VALUE])
        np.negative(np.einsum("wsv,wsv->ws", d_seen[..., :VALUE], seen), out=d_seen[..., VALUE])
        d_scores = np.matmul(d_seen, values.transpose(0, 2, 1), out=room("d_scores", *shape, SPAN))
        d_scores *= scores
        by_window[..., OWN:HIDDEN] = scores.transpose(0, 2, 1) @ d_seen[..., :VALUE]
        by_window[..., HIDDEN:HIDDEN + KEY] = d_scores @ k
        by_window[..., HIDDEN + KEY:] = d_scores.transpose(0, 2, 1) @ q
        grads["near"] = np.bincount(self.back[self.causal], d_scores.sum(axis=0)[self.causal], SPAN).astype(kind)
        flat = inputs.reshape(-1)
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        ranked = flat[order]
        starts = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1])
        summed = np.add.reduceat(d_all.take(order, axis=0, out=room("d_ranked", *d_all.shape), mode="clip"), starts, axis=0)
        return loss, grads, ranked[starts], {
            "x": summed[:, :OWN], "v": summed[:, OWN:HIDDEN], "q": summed[:, HIDDEN:HIDDEN + KEY], "k": summed[:, HIDDEN + KEY:]}

    def train(self, count: int, pick, steps: int, batch: int = 48, rate: float = 0.02, part: tuple[int, int] | None = None) -> float:
        """Adam over batches of ``count`` windows, all once before any again; the last mean loss in nats.

        ``pick`` gives the arguments of ``gradients`` for an array of window numbers. ``part`` runs only the steps after
        the first number up to the second; parts that follow each other, by way of ``state``, equal one run.
        """
        orders, loss = {}, float("nan")
        begin, end = part or (0, steps)
        for step in range(begin + 1, end + 1):
            places = np.arange((step - 1) * batch, step * batch)
            at = np.empty(batch, np.int64)
            for epoch in np.unique(places // count):
                if epoch not in orders:
                    orders = {epoch: np.random.default_rng([11, epoch]).permutation(count)}
                of_epoch = places // count == epoch
                at[of_epoch] = orders[epoch][places[of_epoch] % count]
            windows = pick(at)
            loss, grads, used, rows = self._gradients(*windows, *[None] * (4 - len(windows)))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            even = (1 - 0.99 ** step) ** 0.5
            for name, grad in (grads | rows).items():
                first, second = self.moments[name]
                first *= 0.9
                second *= 0.99
                grad = 0.1 * grad
                if name in rows:  # the others have no gradient
                    first[used] += grad
                    second[used] += grad * grad
                else:
                    first += grad
                    np.multiply(grad, grad, out=grad)
                    second += grad
                made = np.sqrt(second)
                made += 1e-8 * even
                np.divide(first, made, out=made)
                made *= now * even / (1 - 0.9 ** step)
                self.p[name] -= made
            for name in "qk":
                np.clip(self.p[name], -1.5, 1.5, out=self.p[name])
            np.clip(self.p["near"], -20, 20, out=self.p["near"])
        return loss

    def _arrays(self) -> list[np.ndarray]:
        return [a for name in sorted(self.p) for a in (self.p[name], *self.moments[name])]

    def state(self) -> np.ndarray:
        """Weights and moments as one vector; vectors of models trained apart may be averaged."""
        return np.concatenate([a.reshape(-1) for a in self._arrays()])

    def resume(self, state: np.ndarray) -> None:
        at = 0
        for array in self._arrays():
            array[...] = state[at:at + array.size].reshape(array.shape)
            at += array.size


#: Stands in training windows for what is before the first and after the last id.
NONE = 65535


def training_windows(ids: np.ndarray) -> np.ndarray:
    """All ids of a document in rows of ``SPAN``, each led by the id before it; the last row is filled up."""
    count = -(-len(ids) // SPAN)
    padded = np.full(count * SPAN + 1, NONE, np.uint16)
    padded[1:len(ids) + 1] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, SPAN + 1)[::SPAN]


def picked(vocabulary: Vocabulary, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Input rows, classes, places and real positions of training windows."""
    rows = rows.astype(np.int64)
    before, real = rows[:, :-1], rows[:, 1:] != NONE
    wanted = np.where(real, rows[:, 1:], 0)
    inputs = np.where(before == NONE, vocabulary.start, vocabulary.inputs[np.where(before == NONE, 0, before)])
    return inputs, vocabulary.classes[wanted], vocabulary.places[wanted], real


def windows_of(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input rows, padding and targets of the overlapping windows of one document; -1 marks no target.

    Window ``w`` reads ``SPAN`` positions and scores its last ``STRIDE``, so every token is scored once.
    """
    count = -(-len(ids) // STRIDE)
    inputs = np.full(CONTEXT + count * STRIDE, vocabulary.start, np.int64)
    inputs[CONTEXT + 1:CONTEXT + len(ids)] = vocabulary.inputs[ids[:-1]]
    padded = np.ones(len(inputs), bool)
    padded[CONTEXT:CONTEXT + len(ids)] = False
    targets = np.full(count * STRIDE, -1, np.int64)
    targets[:len(ids)] = ids
    view = lambda a: np.lib.stride_tricks.sliding_window_view(a, SPAN)[::STRIDE]
    return view(inputs), view(padded), targets.reshape(count, STRIDE)


def score_documents(model: Attention, vocabulary: Vocabulary, documents: list[np.ndarray], batch: int = 96) -> np.ndarray:
    """log10 probability of each document's ids, its end token included."""
    totals = np.zeros(len(documents))
    made, owners, held = [], [], 0
    model.prepare()

    def flush():
        inputs, padded, targets = (np.concatenate(part) for part in zip(*made))
        owner = np.concatenate(owners)
        for start in range(0, len(inputs), batch):
            part = slice(start, start + batch)
            wanted = targets[part]
            real = wanted >= 0
            ids = np.where(real, wanted, 0)
            values = model.log_probabilities(
                inputs[part], padded[part], vocabulary.classes[ids], vocabulary.places[ids]) / np.log(10)
            values = np.where(real, values.astype(np.float64) + vocabulary.within[ids], 0.0)
            np.add.at(totals, owner[part], values.sum(axis=1))
        made.clear()
        owners.clear()

    for at, ids in enumerate(documents):
        made.append(windows_of(ids, vocabulary))
        owners.append(np.full(len(made[-1][0]), at))
        held += len(made[-1][0])
        if held >= 16 * batch:
            flush()
            held = 0
    if made:
        flush()
    return totals
