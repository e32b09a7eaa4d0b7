"""HTML extraction with a linear-chain conditional random field (operator 4).

A page becomes the sequence of its leaf blocks; each is article or not. The
features are its ancestors' tags, the words in their class, id and role, and
measures of the text; neighbours interact by transition weights. The weights
are fitted by gradient ascent on the conditional likelihood (forward-backward)
over ``TRAINING_PAGES`` labelled pages, which ``html_blocks`` generates, since
the given tables have no page labels; pages are decoded by Viterbi. Scripts,
styles, comments and markup are gone before, with the parse.

Edge cases: null, empty and textless pages give the empty text; broken or cut
markup is read as far as it goes; text without any tag is one block; a page is
judged alone, so repeated rows get the same text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.html_blocks import Leaf, labelled_pages, leaves
from pageflow.llm.scan import map_texts

TRAINING_PAGES, TRAINING_SEED = 450, 11
EPOCHS, RATE, DECAY = 6, 0.2, 1e-4
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def features(leaf: Leaf, at: int, n: int) -> list[str]:
    """Names of the binary features of the block at place ``at`` of ``n``."""
    text, words = leaf.text, leaf.text.split(" ")
    out = ["bias", "in:" + leaf.parent, "sections:" + leaf.sections]
    out += ["tag:" + t for t in sorted(leaf.tags) if t not in ("html", "body")]
    out += sorted({"name:" + name for name in leaf.names} | {"stem:" + name[:5] for name in leaf.names})
    out.append(f"words:{min(8, len(words).bit_length())}")
    out.append(f"linked:{min(4, 5 * leaf.linked // max(1, len(text)))}")
    out.append(f"end:{text[-1] if text[-1] in '.!?:;,' else 'x'}")
    out.append(f"stops:{min(4, sum(text.count(c) for c in '.!?'))}")
    if "©" in text or "copyright" in text.lower():
        out.append("copyright")
    if leaf.parent in _HEADINGS:
        out.append("heading")
    if at == 0:
        out.append("first")
    if at == n - 1:
        out.append("last")
    return out


class Crf:
    """Two labels; ``weights[feature]`` scores both, ``steps[a, b]`` scores b after a."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, steps: np.ndarray):
        self.index, self.weights, self.steps = index, weights, steps

    def scores(self, page: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum(axis=0) for f in page])

    def known(self, found: list[Leaf]) -> list[list[int]]:
        get, n = self.index.get, len(found)
        return [[k for f in features(x, i, n) if (k := get(f)) is not None] for i, x in enumerate(found)]

    def decode(self, found: list[Leaf]) -> list[int]:
        """The likeliest label sequence (Viterbi); ties go to the article."""
        if not found:
            return []
        best, back = None, []
        for row in self.scores(self.known(found)):
            if best is None:
                best = row
                continue
            reach = best[:, None] + self.steps
            back.append([1 if reach[1, b] >= reach[0, b] else 0 for b in (0, 1)])
            best = reach.max(axis=0) + row
        label = 1 if best[1] >= best[0] else 0
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: int = TRAINING_PAGES, seed: int = TRAINING_SEED) -> Crf:
    """Fits the field on generated labelled pages."""
    labelled = [(found, labels) for found, labels in labelled_pages(pages, seed) if found]
    index: dict[str, int] = {}
    data = []
    for found, labels in labelled:
        rows = [[index.setdefault(f, len(index)) for f in features(x, i, len(found))] for i, x in enumerate(found)]
        data.append((rows, np.array(labels)))
    model = Crf(index, np.zeros((len(index), 2)), np.zeros((2, 2)))
    seen, seen_steps = np.full((len(index), 2), 1e-2), np.full((2, 2), 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(data)):
            rows, labels = data[k]
            n, score = len(rows), model.scores(rows)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = score[0]
            for i in range(1, n):
                ahead[i] = score[i] + _log_sum(ahead[i - 1][:, None] + model.steps, 0)
            for i in range(n - 2, -1, -1):
                behind[i] = _log_sum(model.steps + (score[i + 1] + behind[i + 1])[None, :], 1)
            total = _log_sum(ahead[-1], 0)
            gap = np.eye(2)[labels] - np.exp(ahead + behind - total)
            flat = np.concatenate(rows)
            slope = np.zeros_like(model.weights)
            np.add.at(slope, flat, np.repeat(gap, [len(r) for r in rows], axis=0))
            use = np.unique(flat)
            g = slope[use] - DECAY * model.weights[use]
            seen[use] += g * g
            model.weights[use] += RATE * g / np.sqrt(seen[use])
            steps = np.zeros((2, 2))
            for i in range(1, n):
                steps[labels[i - 1], labels[i]] += 1
                steps -= np.exp(ahead[i - 1][:, None] + model.steps + (score[i] + behind[i])[None, :] - total)
            seen_steps += steps * steps
            model.steps += RATE * steps / np.sqrt(seen_steps)
    return model


def main_text(model: Crf, html: str | None) -> str:
    """The article's blocks in page order, joined by newlines."""
    found = leaves(html)
    return "\n".join(x.text for x, label in zip(found, model.decode(found)) if label)


def extract(pages: DataFrame, model: Crf | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per page: id, url and ``text``. The model's size is set by the training pages, not by ``pages``."""
    model = model or train()
    sent = pages.sparkSession.sparkContext.broadcast((model.index, model.weights, model.steps))

    def run(batches):
        field = Crf(*sent.value)
        for b in batches:
            texts = [main_text(field, h) for h in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_texts(pages, {"page_id": F.col(f"`{id_col}`").cast("long"), "url": F.col(f"`{url_col}`").cast("string"),
                             "text": html_col}, "page_id long, url string, text string", run)
