r"""Toxicity by a bidirectional gated recurrent network with attention pooling, over characters and words.

A word is read by its characters, by one recurrent layer, and by an embedding, if it is frequent; both together
are an input of a second recurrent layer that reads windows of `WINDOW` words, `STRIDE` apart, so that each
window shares half of its words with the next, and any passage of up to 17 words lies whole in one of them. Attention pools either layer. Every window of a text is scored; the text has the
score of its worst window.

The network is trained in numpy on about `FIT_ROWS` labelled documents of each class, those with a small
hash of their id and at most `FIT_CHARS` characters. An embedding starts with how much oftener its
word occurs in toxic texts. Only a whole text has a label, so each round scores all windows of the sample and
then learns from the worst window of each text, and of the clean ones from another at random; in the first
round the worst window is the one with the most telling words.

A task keeps the projected inputs of the words it has met, so that a word costs its characters only once.

Defined cases: a NULL or empty text is one window without words, with the score of no evidence; without
labelled rows of both classes every score is the share of toxic ones, or 0; rows that repeat an id are scored
each by itself; of several labels of an id the highest counts, of several texts the one with the smallest hash is learnt from; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm import gru
from shelfstrata.llm.common import bounded_sample, held_out, ship_code, table

WINDOW, STRIDE = 32, 16
WORD_CHARS = 24
CHARACTERS, CHAR_SIZE, CHAR_HIDDEN = 64, 8, 6
VOCABULARY, WORD_SIZE, HIDDEN = 8_192, 8, 8
#: Texts of the sample that a word must occur in to have an embedding of its own.
OCCURS = 4
FIT_ROWS = 1_200
FIT_CHARS = 20_000
ROUNDS = 8
BATCH = 64
RATE = 0.01
DECISION = 0.7
#: Words whose inputs a task remembers, and windows that are scored at once.
REMEMBERED = 300_000
WINDOWS = 2_048

_WORD = re.compile(rf"\w{{1,{WORD_CHARS}}}")


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _characters(words: list[str]) -> np.ndarray:
    """A row of character numbers per word; 0 is no character."""
    width = max(1, max((len(w) for w in words), default=1))
    codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = codes.reshape(len(words), width).astype(np.int64)
    letter, digit = (codes >= 97) & (codes <= 122), (codes >= 48) & (codes <= 57)
    other = np.where(codes == 0, 0, 38 + codes % (CHARACTERS - 38))
    return np.where(letter, codes - 96, np.where(digit, codes - 20, other))


class Weights(dict):
    """The network's arrays by name, with the numbers of the words that have an embedding; 0 is any other."""

    vocabulary: dict[str, int]


def initial(vocabulary: dict[str, int] | None = None, seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    p = Weights(gru.layer(rng, CHAR_SIZE, CHAR_HIDDEN, "c") | gru.layer(rng, WORD_SIZE + 2 * CHAR_HIDDEN, HIDDEN, "w"))
    p.vocabulary = vocabulary or {}
    p["chars"] = (0.3 * rng.standard_normal((CHARACTERS, CHAR_SIZE))).astype(np.float32)
    p["words"] = (0.1 * rng.standard_normal((len(p.vocabulary) + 1, WORD_SIZE))).astype(np.float32)
    p["words"][0] = 0
    p["out"] = (rng.standard_normal(2 * HIDDEN) / 4).astype(np.float32)
    p["bias"] = np.zeros(1, dtype=np.float32)
    return p


def _telling(words: list[list[str]], labels: np.ndarray) -> dict[str, float]:
    """The frequent words, each with the logarithm of how much oftener it occurs in toxic texts."""
    seen = [Counter(), Counter()]
    for w, y in zip(words, labels):
        seen[int(y)].update(set(w))
    both = seen[0] + seen[1]
    frequent = sorted((w for w, n in both.items() if n >= OCCURS), key=lambda w: (-both[w], w))[:VOCABULARY]
    texts = [max(1, int((labels == y).sum())) for y in (0, 1)]
    return {w: float(np.log((seen[1][w] + 1) / (texts[1] + 2)) - np.log((seen[0][w] + 1) / (texts[0] + 2))) for w in frequent}


def _word_inputs(words: list[str], p: Weights, keep: dict | None = None) -> np.ndarray:
    """Per word its embedding and what the first layer reads in its characters."""
    chars, known = _characters(words), np.array([p.vocabulary.get(w, 0) for w in words], dtype=np.int64)
    if keep is None:
        steps = np.ascontiguousarray(chars.T)
        # Characters are few, so they are projected once and looked up.
        looked_up = [np.ascontiguousarray(a.T) for a in gru.projected(p["chars"], p, "c")]
        read = gru.read(lambda way, t: looked_up[way].take(steps[t], axis=1), (steps > 0).astype(np.float32), p, "c").T
    else:
        x, mask, inner = p["chars"][chars], (chars > 0).astype(np.float32), {}
        read = gru.pooled(*gru.projected(x, p, "c"), mask, p, "c", inner)
        keep.update(chars=chars, known=known, x=x, inner=inner)
    return np.concatenate([p["words"][known], read], axis=1)


class _Inputs(dict):
    """Numbers of words, and the projected inputs of the second layer that belong to the numbers; 0 is no word."""

    def __init__(self, p: Weights) -> None:
        super().__init__()
        self.p, self.new = p, []
        self.size, self.table = 1, np.zeros((1024, 2, 3 * HIDDEN), dtype=np.float32)

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = self.size + len(self.new) - 1
        return number

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def fill(self) -> np.ndarray:
        """The table, with rows for all words that were numbered since."""
        order = sorted(range(len(self.new)), key=lambda i: len(self.new[i]))
        need = self.size + len(self.new)
        if need > len(self.table):
            more = max(need, 2 * len(self.table)) - len(self.table)
            self.table = np.concatenate([self.table, np.zeros((more, *self.table.shape[1:]), dtype=np.float32)])
        for k in range(0, len(order), WINDOWS):
            part = order[k : k + WINDOWS]
            inputs = gru.projected(_word_inputs([self.new[i] for i in part], self.p), self.p, "w")
            self.table[self.size + np.array(part)] = np.stack(inputs, axis=1)
        self.size, self.new = need, []
        return self.table

    def reset(self) -> None:
        self.clear()
        self.size, self.new = 1, []


def windows(n_words: int) -> np.ndarray:
    """Where windows begin: every `STRIDE` words, until one reaches the end."""
    return np.arange(0, max(n_words - WINDOW, 0) + STRIDE, STRIDE) if n_words > WINDOW else np.zeros(1, dtype=np.int64)


def _window_numbers(numbers: np.ndarray) -> np.ndarray:
    """A row of word numbers per window of a text."""
    starts = windows(len(numbers))
    padded = np.zeros(starts[-1] + WINDOW, dtype=np.int64)
    padded[: len(numbers)] = numbers
    return padded[starts[:, None] + np.arange(WINDOW)]


def _scores(rows: np.ndarray, inputs: np.ndarray, p: Weights) -> np.ndarray:
    out = np.empty(len(rows), dtype=np.float32)
    for k in range(0, len(rows), WINDOWS):
        steps = np.ascontiguousarray(rows[k : k + WINDOWS].T)
        states = gru.read(lambda way, t: np.ascontiguousarray(inputs[:, way][steps[t]].T), (steps > 0).astype(np.float32), p, "w")
        out[k : k + WINDOWS] = p["out"] @ states + p["bias"]
    return out


def score_texts(texts: list[str | None], p: Weights, inputs: _Inputs) -> tuple[np.ndarray, np.ndarray]:
    """Each text's highest logit, and the number of the window that has it."""
    if len(inputs) > REMEMBERED:
        inputs.reset()
    held, sizes = [], []
    best, at = np.empty(len(texts), dtype=np.float32), np.zeros(len(texts), dtype=np.int64)

    def flush(first: int) -> None:
        if held:
            found = _scores(np.concatenate(held), inputs.fill(), p)
            end = np.cumsum(sizes)
            for n, (a, b) in enumerate(zip(end - sizes, end)):
                at[first + n] = found[a:b].argmax()
                best[first + n] = found[a + at[first + n]]

    first, count = 0, 0
    for n, text in enumerate(texts):
        rows = _window_numbers(inputs.numbers(_words(text)))
        held.append(rows)
        sizes.append(len(rows))
        count += len(rows)
        if count >= WINDOWS:
            flush(first)
            first, count, held, sizes = n + 1, 0, [], []
            if len(inputs) > REMEMBERED:
                inputs.reset()
    flush(first)
    return best, at


def _learn(rows: list[list[str]], labels: np.ndarray, weight: np.ndarray, p: Weights, grads: gru.Params) -> None:
    """Adds the gradient of a batch of windows, given as words."""
    words = sorted({w for r in rows for w in r})
    index = {w: i + 1 for i, w in enumerate(words)}
    numbers = np.zeros((len(rows), WINDOW), dtype=np.int64)
    for i, r in enumerate(rows):
        numbers[i, : len(r)] = [index[w] for w in r]
    inner, outer = {}, {}
    each = np.concatenate([np.zeros((1, WORD_SIZE + 2 * CHAR_HIDDEN), dtype=np.float32), _word_inputs(words or [""], p, inner)])
    x, mask = each[numbers], (numbers > 0).astype(np.float32)
    states = gru.pooled(*gru.projected(x, p, "w"), mask, p, "w", outer)
    chance = 1.0 / (1.0 + np.exp(-np.clip(states @ p["out"] + p["bias"], -30, 30)))
    d = ((chance - labels) * weight / weight.sum()).astype(np.float32)
    grads["out"] += states.T @ d
    grads["bias"] += d.sum()
    d_f, d_b = gru.pooled_back(d[:, None] * p["out"], outer, p, "w", grads)
    d_x = gru.projected_back(x, d_f, d_b, p, "w", grads)
    d_each = np.zeros_like(each)
    np.add.at(d_each, numbers.ravel(), d_x.reshape(-1, d_x.shape[-1]))
    d_each = d_each[1:]
    np.add.at(grads["words"], inner["known"], d_each[:, :WORD_SIZE])
    c_f, c_b = gru.pooled_back(d_each[:, WORD_SIZE:], inner["inner"], p, "c", grads)
    d_chars = gru.projected_back(inner["x"], c_f, c_b, p, "c", grads)
    np.add.at(grads["chars"], inner["chars"].ravel(), d_chars.reshape(-1, CHAR_SIZE))


def train(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Weights:
    """A network learnt from texts and their labels, both classes weighing the same."""
    rng, words = np.random.default_rng(seed), [_words(t) for t in texts]
    telling = _telling(words, labels)
    p = initial({w: n + 1 for n, w in enumerate(telling)}, seed)
    p["words"][1:, 0] = list(telling.values())
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    begins = [windows(len(w)) for w in words]
    class_weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    for n in range(rounds):
        if n:
            _, worst = score_texts(texts, p, _Inputs(p))
        else:
            worst = [int(np.argmax([max((telling.get(x, 0.0) for x in w[b : b + WINDOW]), default=0.0) for b in at])) for w, at in zip(words, begins)]
        chosen = [(i, begins[i][worst[i]]) for i in range(len(texts))]
        chosen += [(i, begins[i][rng.integers(len(begins[i]))]) for i in range(len(texts)) if labels[i] == 0 and len(begins[i]) > 1]
        order = rng.permutation(len(chosen))
        rate = RATE * (1.0 - n / (rounds + 1))
        for k in range(0, len(order), BATCH):
            part = [chosen[i] for i in order[k : k + BATCH]]
            grads = {k: np.zeros_like(v) for k, v in p.items()}
            rows = [words[i][b : b + WINDOW] for i, b in part]
            who = np.array([i for i, _ in part])
            _learn(rows, labels[who], class_weight[who], p, grads)
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for name, g in grads.items():
                g *= min(1.0, 1.0 / (size + 1e-9))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                ahead, spread = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                p[name] -= (rate * ahead / (np.sqrt(spread) + 1e-6)).astype(np.float32)
    return p


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Weights:
    """A network learnt from the labelled documents that are not held out."""
    usable = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # About FIT_ROWS ids of each class, whatever the size of the table.
    chosen = bounded_sample(usable, "toxic", ["doc_id"], FIT_ROWS).select("doc_id", "toxic")
    texts = docs.select("doc_id", "text").where(F.length("text") <= FIT_CHARS).join(F.broadcast(chosen), "doc_id")
    # One text of each id, the same one however rows are partitioned.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "toxic")).alias("first")
    rows = texts.groupBy("doc_id").agg(first).select("doc_id", "first.*").orderBy("doc_id").collect()
    toxic = np.array([r.toxic for r in rows], dtype=np.float32)
    if len(set(toxic)) < 2:
        p = initial()
        p["out"][:] = 0
        share = float(np.clip(toxic.mean() if len(toxic) else 0.0, 1e-6, 1 - 1e-6))
        p["bias"][:] = np.log(share / (1 - share))
        return p
    return train([r.text for r in rows], toxic, rounds)


def _scorer(p: Weights) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = _Inputs(p)
        for batch in batches:
            logits, _ = score_texts(batch.column("text").to_pylist(), p, inputs)
            chance = 1.0 / (1.0 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(chance)], ["doc_id", "score"])

    return score


def score(docs: DataFrame, p: Weights) -> DataFrame:
    """Per row of `docs`: doc_id, score (0 to 1)."""
    ship_code(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_scorer(p), "doc_id long, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= DECISION).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
