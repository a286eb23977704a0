r"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: stretches of text between the boundaries of block elements. Each block has
features of its ancestors (tags, words of class, id and role) and of its text (length, links, punctuation). The chain scores a labelling by the blocks' features and by which label follows which; Viterbi finds
the best labelling, and the blocks labelled article are the page's text.

The model is trained in numpy, by the gradient of the likelihood, on labelled pages: laid-out samples
(`page_samples`), and about `FIT_PAGES` pages of the table whose markup itself tells where the article is.
Pages are then labelled one by one, so a page of any size costs only its own blocks.

Defined cases: a NULL or empty html, and a page without an article, have the text ''; broken markup is read
as far as it goes; rows that repeat an id are extracted each by itself; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import ship_code, table
from shelfstrata.llm.page_blocks import Block, blocks_of, features
from shelfstrata.llm.page_samples import labelled_pages

SAMPLES = 900
FIT_PAGES = 100
#: Longest page, in characters and in blocks, that is learnt from; every page is extracted in full.
FIT_CHARS, FIT_BLOCKS = 100_000, 400
EPOCHS = 250
RATE = 0.3
PENALTY = 1e-3


@dataclass(frozen=True)
class Model:
    weights: dict[str, np.ndarray]  # of a feature, for the labels other and article
    follows: np.ndarray  # of a label after a label


def _emissions(model: Model, named: list[list[str]]) -> np.ndarray:
    none = np.zeros(2)
    return np.array([sum((model.weights.get(f, none) for f in names), none) for names in named])


def viterbi(scores: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """The best sequence of labels, given scores of each place and of each step."""
    best, back = scores[0], []
    for row in scores[1:]:
        reached = best[:, None] + follows
        back.append(reached.argmax(axis=0))
        best = reached.max(axis=0) + row
    labels = [int(best.argmax())]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return np.array(labels[::-1])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[list[str]], list[int]]]) -> Model:
    """A chain fitted to pages of feature names and labels, all pages a step at a time."""
    pages = [p for p in pages if p[1]]
    names = sorted({f for named, _ in pages for row in named for f in row})
    index = {f: i for i, f in enumerate(names)}
    longest, n = max(len(y) for _, y in pages), len(pages)
    page, place, feature = (
        np.array(x)
        for x in zip(*((p, t, index[f]) for p, (named, _) in enumerate(pages) for t, row in enumerate(named) for f in row))
    )
    labels, mask = np.zeros((n, longest), dtype=int), np.zeros((n, longest), dtype=bool)
    for p, (_, y) in enumerate(pages):
        labels[p, : len(y)], mask[p, : len(y)] = y, True
    weights, follows = np.zeros((len(names), 2)), np.zeros((2, 2))
    squares = [np.full_like(weights, 1e-8), np.full_like(follows, 1e-8)]
    rows, both = np.arange(n), mask[:, 1:] & mask[:, :-1]
    truth = np.zeros((n, longest, 2))
    truth[rows[:, None], np.arange(longest), labels] = mask
    steps = np.zeros((2, 2))
    np.add.at(steps, (labels[:, :-1][both], labels[:, 1:][both]), 1)
    flat = page * longest + place
    for _ in range(EPOCHS):
        scores = np.zeros((n * longest, 2))
        for k in (0, 1):
            scores[:, k] = np.bincount(flat, weights[feature, k], minlength=n * longest)
        scores = scores.reshape(n, longest, 2)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1, :, None] + follows, 1) + scores[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(follows + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        total = _log_sum(forward[:, -1], 1)[:, None, None]
        marginal = np.exp(forward + backward - total) * mask[..., None]
        pair = forward[:, :-1, :, None] + follows + (scores + backward)[:, 1:, None, :] - total[..., None]
        expected = (np.exp(np.where(both[..., None, None], pair, -np.inf))).sum(axis=(0, 1))
        rest = (truth - marginal).reshape(-1, 2)
        slope = np.stack([np.bincount(feature, rest[flat, k], minlength=len(names)) for k in (0, 1)], axis=1)
        for x, g, s in ((weights, slope / n - PENALTY * weights, squares[0]), (follows, (steps - expected) / n - PENALTY * follows, squares[1])):
            s += g * g
            x += RATE * g / np.sqrt(s)
    return Model({f: weights[i] for f, i in index.items()}, follows)


def _labels(blocks: list[Block], article: list[str]) -> list[int]:
    """Labels of blocks whose texts follow one another in `article`."""
    wanted, labels = 0, []
    for b in blocks:
        hit = wanted < len(article) and b.text == article[wanted]
        labels.append(int(hit))
        wanted += hit
    return labels


#: Elements that are no part of the article they stand in.
FOREIGN = frozenset({"nav", "aside", "footer", "form", "header"})


def _by_markup(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article with one element, else None."""
    where = [i for i, b in enumerate(blocks) if "article" in b.tags]
    if not where or where[-1] - where[0] + 1 != len(where):
        return None
    return [int("article" in b.tags and not FOREIGN & set(b.tags[b.tags.index("article") :])) for b in blocks]


def _without_marks(named: list[list[str]], drop: set[str]) -> list[list[str]]:
    return [[f for f in row if f not in drop] for row in named]


def fit(pages: DataFrame) -> Model:
    examples = []
    for n, (html, article) in enumerate(labelled_pages(SAMPLES)):
        blocks = blocks_of(html)
        examples.append((features(blocks), _labels(blocks, [" ".join(t.split()) for t in article])))
    # Each page decides for itself, given how many there are: ranking them would send a hundred of every
    # partition to the driver.
    place = F.shiftrightunsigned(F.xxhash64("page_id", "html"), 1) / F.lit(float(1 << 63))
    chosen = pages.where(F.length("html") <= FIT_CHARS).select("html", place.alias("_place"))
    chosen = chosen.where(F.col("_place") * pages.count() < FIT_PAGES).dropDuplicates(["_place"]).orderBy("_place")
    for n, row in enumerate(chosen.collect()):  # about FIT_PAGES rows
        blocks = blocks_of(row.html)
        labels = _by_markup(blocks) if len(blocks) <= FIT_BLOCKS else None
        if labels:
            # In every other page the mark itself is taken away, so that the rest is learnt too.
            examples.append((_without_marks(features(blocks), {"in:article"} if n % 2 else set()), labels))
    return train(examples)


def main_text(html: str | None, model: Model) -> str:
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    labels = viterbi(_emissions(model, features(blocks)), model.follows)
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def _extractor(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), model) for x in batch.column("html")]
            columns = [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return extract


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """Per row of `pages`: page_id, url, text (of the article), n_chars (code points)."""
    ship_code(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
