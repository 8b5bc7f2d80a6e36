"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, ArrayType, DoubleType, StringType, StructField

from recordlake.llm.batches import append_columns, quoted

#: Bytes of a window; the network reads each window of a text in both directions.
WINDOW = 64
#: Bytes of the shortest texts that the network is trained on.
SHORTEST = 8
#: Hidden units of a direction.
HIDDEN = 8
#: Bounds of the training sample: documents of a language, and windows of a document.
DOCUMENTS_PER_LANGUAGE = 400
WINDOWS_PER_DOCUMENT = 6
#: More values of the language column than this are an error: they are no languages.
MOST_LANGUAGES = 500
UNDETERMINED = "und"
STEPS, BATCH, RATE = 160, 128, 0.02
#: Windows that are read at once.
AT_ONCE = 2048


def squashed(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) takes the place of the hyperbolic tangent, at a fraction of its cost."""
    return x / (1 + np.abs(x))


@dataclass
class Direction:
    """A gated recurrent unit; arrays are (units, windows), so that every operation is over windows."""

    inputs: np.ndarray  # (3 * hidden, 256): update gate, reset gate, candidate of each byte
    gates: np.ndarray  # (2 * hidden, hidden)
    candidate: np.ndarray  # (hidden, hidden)

    def step(self, byte: np.ndarray, h: np.ndarray):
        n = len(h)
        x = np.take(self.inputs, byte, axis=1)
        zr = 0.5 + 0.5 * squashed(x[: 2 * n] + self.gates @ h)
        c = squashed(x[2 * n :] + self.candidate @ (zr[n:] * h))
        return zr[:n], zr[n:], c, h + zr[:n] * (c - h)

    def states(self, windows: np.ndarray, order) -> np.ndarray:
        """The state at each position: (length, hidden, count). windows: (length, count).

        The same as :meth:`step` after step, in arrays that are used again.
        """
        n, (length, count) = len(self.candidate), windows.shape
        states = np.empty((length, n, count), np.float32)
        x, zr, size = (np.empty((k * n, count), np.float32) for k in (3, 2, 2))
        c, h, half = np.empty((n, count), np.float32), np.zeros((n, count), np.float32), 0.5 * self.candidate
        for t in order:
            np.take(self.inputs, windows[t], axis=1, out=x, mode="clip")
            np.matmul(self.gates, h, out=zr)
            zr += x[: 2 * n]
            np.abs(zr, out=size)
            size += 1
            zr /= size
            zr += 1
            zr[n:] *= h
            np.matmul(half, zr[n:], out=c)
            c += x[2 * n :]
            np.abs(c, out=size[:n])
            size[:n] += 1
            c /= size[:n]
            c -= h
            c *= zr[:n]
            c *= 0.5
            h = np.add(h, c, out=states[t])
        return states

    def trained_states(self, windows, order):
        """As :meth:`states`, with what back-propagation needs."""
        h, kept = np.zeros((len(self.candidate), windows.shape[1]), np.float32), []
        for t in order:
            z, r, c, after = self.step(windows[t], h)
            kept.append((t, h, z, r, c, after))
            h = after
        return kept

    def gradients(self, windows, kept, wanted) -> list[np.ndarray]:
        """Gradients of the three arrays, back through time; ``wanted[t]`` is that of the state at t."""
        n = len(self.candidate)
        gates, candidate = np.zeros_like(self.gates), np.zeros_like(self.candidate)
        at_inputs, bytes_read = [], []
        dh = np.zeros_like(kept[0][1])
        for t, h, z, r, c, _ in reversed(kept):
            dh = dh + wanted[t]
            dc = dh * z * (1 - np.abs(c)) ** 2
            through = self.candidate.T @ dc
            candidate += dc @ (r * h).T
            dz = dh * (c - h) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dr = through * h * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            zr = np.concatenate([dz, dr])
            gates += zr @ h.T
            dh = dh * (1 - z) + through * r + self.gates.T @ zr
            at_inputs.append(np.concatenate([zr, dc]))
            bytes_read.append(windows[t])
        flat, read = np.concatenate(at_inputs, 1), np.concatenate(bytes_read)
        inputs = np.stack([np.bincount(read, row, 256) for row in flat]).astype(np.float32)
        return [inputs, gates, candidate]


@dataclass
class LanguageModel:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (languages, 2 * hidden + 1), the last column is the bias

    def weights(self) -> list[np.ndarray]:
        return [
            a for d in (self.forward, self.backward) for a in (d.inputs, d.gates, d.candidate)
        ] + [self.out]

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities of each language at every position: (length, languages, windows)."""
        length = len(windows)
        left = self.forward.states(windows, range(length))
        right = self.backward.states(windows, range(length - 1, -1, -1))
        return np.stack([self.label(a, b) for a, b in zip(left, right)])

    def label(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        n = len(left)
        scores = self.out[:, :n] @ left + self.out[:, n : 2 * n] @ right + self.out[:, -1:]
        scores = np.exp(scores - scores.max(0))
        return scores / scores.sum(0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and pooled probability of each text."""
        labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        readable = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not self.languages or not readable:
            return labels, scores
        data = [texts[i].encode() for i in readable]
        sizes = np.array([len(d) for d in data])
        counts = -(-sizes // WINDOW)
        padded = b"".join(d.ljust(c * WINDOW, b"\0") for d, c in zip(data, counts.tolist()))
        windows = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
        lengths = np.full(len(windows), WINDOW)
        lengths[np.cumsum(counts) - 1] = sizes - (counts - 1) * WINDOW
        sums = np.zeros((len(windows), len(self.languages)))
        for first in range(0, len(windows), AT_ONCE):
            some = windows[first : first + AT_ONCE].T.astype(np.intp, order="C")
            at = self.positions(some)
            real = np.arange(WINDOW)[:, None] < lengths[first : first + AT_ONCE]
            sums[first : first + AT_ONCE] = np.einsum("tlw,tw->wl", at, real.astype(np.float32))
        starts = np.r_[0, np.cumsum(counts)[:-1]]
        shares = np.add.reduceat(sums, starts) / sizes[:, None]
        for i, share in zip(readable, shares):
            best = int(share.argmax())
            labels[i], scores[i] = self.languages[best], min(1.0, float(share[best]))
        return labels, scores


def new_model(languages: list[str], rng: np.random.Generator) -> LanguageModel:
    def drawn(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    def direction():
        return Direction(
            drawn(3 * HIDDEN, 256, scale=0.3),
            drawn(2 * HIDDEN, HIDDEN, scale=HIDDEN**-0.5),
            drawn(HIDDEN, HIDDEN, scale=HIDDEN**-0.5),
        )

    return LanguageModel(languages, direction(), direction(), drawn(len(languages), 2 * HIDDEN + 1, scale=0.2))


def loss_gradients(model: LanguageModel, windows: np.ndarray, target: np.ndarray, real: np.ndarray):
    """Mean cross-entropy over the real positions, and the gradients of all weights.

    windows: (length, count) bytes; target: a language of each window; real: (length, count).
    """
    length, n = len(windows), len(model.forward.candidate)
    left = model.forward.trained_states(windows, range(length))
    right = model.backward.trained_states(windows, range(length - 1, -1, -1))
    out, loss, total = np.zeros_like(model.out), 0.0, real.sum()
    wanted_left, wanted_right = [None] * length, [None] * length
    columns = np.arange(windows.shape[1])
    for t in range(length):
        a, b = left[t][5], right[length - 1 - t][5]
        p = model.label(a, b)
        loss -= (np.log(p[target, columns] + 1e-9) * real[t]).sum()
        p[target, columns] -= 1
        p *= real[t] / total
        out += p @ np.concatenate([a, b, np.ones((1, len(columns)), np.float32)]).T
        wanted_left[t] = model.out[:, :n].T @ p
        wanted_right[t] = model.out[:, n : 2 * n].T @ p
    made = model.forward.gradients(windows, left, wanted_left)
    made += model.backward.gradients(windows, right, wanted_right)
    return loss / total, made + [out]


def train(rows: list[tuple[str, bytes]], steps: int = STEPS) -> LanguageModel:
    """Train on windows of bytes with their languages: back-propagation through time, Adam.

    The same rows, in any order, give the same model. Without rows the model knows no language.
    """
    rows = sorted((lang, data[:WINDOW]) for lang, data in rows if data)
    languages = sorted({lang for lang, _ in rows})
    rng = np.random.default_rng(7)
    model = new_model(languages, rng)
    if len(languages) < 2:
        return model
    target = np.array([languages.index(lang) for lang, _ in rows])
    by_language = [np.flatnonzero(target == k) for k in range(len(languages))]
    windows = np.frombuffer(b"".join(d.ljust(WINDOW, b"\0") for _, d in rows), np.uint8).reshape(-1, WINDOW)
    sizes = np.array([len(d) for _, d in rows])
    weights = model.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        # Languages are equally likely in a batch, however many rows they have.
        chosen = np.array([rng.choice(by_language[k]) for k in rng.integers(len(languages), size=BATCH)])
        # Half of the windows are cut, as a short text or the end of a long one is.
        cut = np.where(rng.random(BATCH) < 0.5, rng.integers(SHORTEST, WINDOW + 1, BATCH), WINDOW)
        inside = np.arange(WINDOW)[:, None] < np.minimum(sizes[chosen], cut)
        some = np.ascontiguousarray(np.where(inside, windows[chosen].T, 0))
        real = inside.astype(np.float32)
        _, gradients = loss_gradients(model, some, target[chosen], real)
        size = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, gradients, first, second):
            g = g * min(1.0, 1 / (size + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def training_windows(df: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id") -> DataFrame:
    """A bounded sample of labelled windows: ``language``, ``window``.

    About :data:`DOCUMENTS_PER_LANGUAGE` documents of each language, those with the smallest
    hashes of key and text, and windows spread evenly over each. Rows with a null text or language
    are left out.
    """
    source = df.select(
        F.col(quoted(language)).alias("language"),
        F.col(quoted(text)).alias("text"),
        F.xxhash64(F.lit(0), F.col(quoted(key)), F.col(quoted(text))).alias("drawn"),
    ).where("language is not null and text is not null and text <> ''")
    counts = source.groupBy("language").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{language} has more than {MOST_LANGUAGES} values")
    chosen = F.lit(False)
    for row in counts:
        share = min(1.0, DOCUMENTS_PER_LANGUAGE / row["count"])
        limit = min((1 << 63) - 1, int((2 * share - 1) * (1 << 63)))
        chosen = chosen | ((F.col("language") == row["language"]) & (F.col("drawn") <= limit))

    def cut(texts):
        made = []
        for t in texts:
            data = t.encode()
            places = range(0, max(1, len(data) - WINDOW + 1), WINDOW)
            few = [places[i * len(places) // WINDOWS_PER_DOCUMENT] for i in range(WINDOWS_PER_DOCUMENT)]
            made.append([data[a : a + WINDOW] for a in sorted(set(few))])
        return [made]

    field = StructField("windows", ArrayType(BinaryType()))
    found = append_columns(source.where(chosen), "text", [field], cut, ["language"])
    return found.select("language", F.explode("windows").alias("window"))


def fitted(df: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id") -> LanguageModel:
    """A model trained on a bounded sample of the labelled rows."""
    return train([tuple(r) for r in training_windows(df, text, language, key).collect()])


def predictions(df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the ``keep`` columns (all).

    Every position of a text is labelled in its window of bytes; the positions' probabilities are
    averaged, and the largest average is the score. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if the model knows no language. Texts are read
    whole, repeated rows each, an empty table stays empty, and a column with a new column's name
    is replaced.
    """
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return append_columns(df, text, fields, lambda texts: list(model.predict(texts)), keep)


def in_known_languages(df: DataFrame, model: LanguageModel, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows whose text has a language by :func:`predictions`, with ``min_score`` or more."""
    mark = "found by the operator"

    def make(texts):
        labels, scores = model.predict(texts)
        return [["x" if a != UNDETERMINED and s >= min_score else None for a, s in zip(labels, scores)]]

    found = append_columns(df, text, [StructField(mark, StringType())], make)
    return found.where(F.col(quoted(mark)).isNotNull()).select(*[quoted(c) for c in df.columns])


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: by its key alone; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
