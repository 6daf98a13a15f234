"""Main text of HTML pages by a recurrent block labeller.

The blocks of a page are a sequence. Each is read as hashed features of the tags above it, a vector
of its hashed words, and a few figures of its text. A bidirectional LSTM in numpy passes over the
whole sequence in both directions, so that each block is judged in the context of the whole
document, and a logistic output says whether it is main text.

It is fitted on pages of the corpus that mark their main text with landmark tags, and on layouts
made from the texts of those pages under other names (``layouts``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from suarakit.llm import arrays, htmlblocks, layouts
from suarakit.llm.common import column, small_batches

PATH, WORD, STATS, HIDDEN = 16, 8, 8, 16
WORD_BUCKETS = 8192
CELLS = 1 << 16  # blocks that are labelled at once, or those of one page

#: Texts for pages of layouts if the corpus has none.
_PROSE = (
    "the river had risen over night and by the morning no boat could cross it. ",
    "they waited on the bank, talked about the harvest, and counted what was left. ",
    "nobody had seen so much water in that valley before; the old bridge was gone. ",
)


class Features(NamedTuple):
    """Blocks of several pages: features of their paths and words as flat lists, figures, and where pages begin."""

    path: np.ndarray
    path_first: np.ndarray
    word: np.ndarray
    word_first: np.ndarray
    stats: np.ndarray
    first: np.ndarray


def _figures(block: htmlblocks.Block, n_words: int, at: int, n: int) -> list[float]:
    text = block.text
    return [
        np.log1p(n_words) / 3,
        block.linked / len(text),
        len(text) / max(1, n_words) / 10,
        float(text[-1] in ".!?:;\"'”»。"),
        float(text[0].isupper()),
        float("©" in text),
        (at + 0.5) / n,
        1 / n,
    ]


def features(pages: list[tuple[list[htmlblocks.Block], list[htmlblocks.Path]]]) -> Features:
    own: dict[tuple[str, ...], list[int]] = {}
    path, path_sizes, texts = [], [], []
    for blocks, paths in pages:
        made: dict[int, np.ndarray] = {}
        for block in blocks:
            if block.path not in made:
                at = paths[block.path]
                near = own.setdefault(at.names, [htmlblocks.feature("near " + name) for name in at.names])
                made[block.path] = np.array(sorted(htmlblocks.feature(name) for name in at.above) + near, np.int64)
            path.append(made[block.path])
            path_sizes.append(len(made[block.path]))
            texts.append(block.text)
    words, counts = [], []
    for piece in arrays.pieces(pa.array(texts, pa.large_string())):
        spans = arrays.runs(piece, arrays.ALNUM)
        words.append((arrays.word_hashes(piece, spans) >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS)
        counts.append(np.diff(spans.first))
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    sizes = [len(blocks) for blocks, _ in pages]
    flat = (block for blocks, _ in pages for block in blocks)
    where = ((at, n) for n in sizes for at in range(n))
    stats = [_figures(block, n_words, *place) for block, n_words, place in zip(flat, counts.tolist(), where)]
    begin = lambda sizes: np.append(0, np.cumsum(sizes)).astype(np.int64)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Features(
        join(path), begin(path_sizes), join(words), begin(counts), np.array(stats, np.float32).reshape(-1, STATS), begin(sizes)
    )


Model = dict[str, np.ndarray]


def _start(rng: np.random.Generator) -> Model:
    width = PATH + WORD + STATS
    model = {
        "path": rng.normal(0, 0.1, (htmlblocks.BUCKETS, PATH)),
        "word": rng.normal(0, 0.05, (WORD_BUCKETS, WORD)),
        "out": rng.normal(0, 0.2, 2 * HIDDEN),
        "out_bias": np.zeros(1),
    }
    for way in ("on", "back"):
        model[f"{way}_in"] = rng.normal(0, 0.25, (width, 4 * HIDDEN))
        model[f"{way}_own"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        model[f"{way}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # remember at first
    return {name: value.astype(np.float32) for name, value in model.items()}


def _sum_rows(table: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros((len(first) - 1, table.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(table[at], first[full], axis=0)
    return out


def _inputs(model: Model, given: Features) -> np.ndarray:
    n_words = np.maximum(np.diff(given.word_first), 1)[:, None].astype(np.float32)
    words = _sum_rows(model["word"], given.word, given.word_first) / n_words
    return np.concatenate([_sum_rows(model["path"], given.path, given.path_first), words, given.stats], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _steps(first: np.ndarray, way: str) -> Iterator[np.ndarray]:
    """For each step the blocks it reads, one of each page that is long enough; long pages come first."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    sizes, low = sizes[order], first[:-1][order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # pages of more than t blocks
    for t, n in enumerate(active.tolist()):
        yield low[:n] + t if way == "on" else low[:n] + sizes[:n] - 1 - t


def _pass(model: Model, x: np.ndarray, first: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
    """State after each block in one direction; ``keep`` gets what the way back needs."""
    gates = x @ model[f"{way}_in"] + model[f"{way}_bias"]
    h = np.zeros((len(first) - 1, HIDDEN), np.float32)
    c, out = h.copy(), np.zeros((len(x), HIDDEN), np.float32)
    for at in _steps(first, way):
        n = len(at)
        z = gates[at] + h[:n] @ model[f"{way}_own"]
        i, f, o = np.split(_sigmoid(z[:, : 3 * HIDDEN]), 3, axis=1)
        g = np.tanh(z[:, 3 * HIDDEN :])
        before = (c[:n].copy(), h[:n].copy()) if keep is not None else None
        c[:n] = f * c[:n] + i * g
        shown = np.tanh(c[:n])
        h[:n] = o * shown
        out[at] = h[:n]
        if keep is not None:
            keep.append((at, i, f, o, g, shown, *before))
    return out


def probability(model: Model, given: Features) -> np.ndarray:
    """Probability that each block is main text."""
    x = _inputs(model, given)
    states = [_pass(model, x, given.first, way) for way in ("on", "back")]
    return _sigmoid(np.concatenate(states, axis=1) @ model["out"] + model["out_bias"])


def loss_and_gradient(model: Model, given: Features, label: np.ndarray, weight: np.ndarray) -> tuple[float, Model]:
    """Weighted mean of the log loss, and its gradient through all steps of both directions."""
    x, kept = _inputs(model, given), {"on": [], "back": []}
    states = np.concatenate([_pass(model, x, given.first, way, kept[way]) for way in kept], axis=1)
    p = _sigmoid(states @ model["out"] + model["out_bias"])
    share = weight / max(float(weight.sum()), 1e-9)
    loss = -float((share * np.log(np.where(label, p, 1 - p) + 1e-9)).sum())
    error = ((p - label) * share).astype(np.float32)
    grad = {"out": states.T @ error, "out_bias": error.sum(keepdims=True)}
    d_states, d_x = error[:, None] * model["out"], np.zeros_like(x)
    for way, part in (("on", slice(0, HIDDEN)), ("back", slice(HIDDEN, None))):
        d_out, own = d_states[:, part], model[f"{way}_own"]
        d_gates = np.zeros((len(x), 4 * HIDDEN), np.float32)
        d_own = np.zeros_like(own)
        d_h = np.zeros((len(given.first) - 1, HIDDEN), np.float32)
        d_c = d_h.copy()
        for at, i, f, o, g, shown, c, h in reversed(kept[way]):
            n = len(at)
            dh = d_out[at] + d_h[:n]
            dc = d_c[:n] + dh * o * (1 - shown**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * shown * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            d_gates[at] = dz
            d_own += h.T @ dz
            d_h[:n], d_c[:n] = dz @ own.T, dc * f
        grad |= {f"{way}_own": d_own, f"{way}_in": x.T @ d_gates, f"{way}_bias": d_gates.sum(axis=0)}
        d_x += d_gates @ model[f"{way}_in"].T
    grad["path"], grad["word"] = np.zeros_like(model["path"]), np.zeros_like(model["word"])
    sizes = np.diff(given.path_first)
    np.add.at(grad["path"], given.path, np.repeat(d_x[:, :PATH], sizes, axis=0))
    sizes = np.diff(given.word_first)
    d_word = d_x[:, PATH : PATH + WORD] / np.maximum(sizes, 1)[:, None]
    np.add.at(grad["word"], given.word, np.repeat(d_word, sizes, axis=0))
    return loss, grad


def train(pages: list[tuple[list[htmlblocks.Block], list[htmlblocks.Path]]], labels: list[np.ndarray], rounds: int = 8, seed: int = 5) -> Model:
    """Adam on batches of 32 pages. ``labels``: 1 main text, 0 not, -1 unknown."""
    rng = np.random.default_rng(seed)
    model = _start(rng)
    mean = {n: np.zeros_like(v) for n, v in model.items()}
    square = {n: np.zeros_like(v) for n, v in model.items()}
    step, total = 0, rounds * -(-len(pages) // 32)
    for _ in range(rounds):
        order = rng.permutation(len(pages))
        for low in range(0, len(order), 32):
            chosen = order[low : low + 32]
            given = features([pages[i] for i in chosen])
            label = np.concatenate([labels[i] for i in chosen])
            _, grad = loss_and_gradient(model, given, label == 1, (label >= 0).astype(np.float32))
            step += 1
            rate = 0.02 * (1 - step / (total + 1)) + 1e-4
            for n, g in grad.items():
                mean[n] += 0.1 * (g - mean[n])
                square[n] += 0.01 * (g * g - square[n])
                model[n] -= (rate * (mean[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


_INSIDE = {"t:article", "t:main"}
_OUTSIDE = {"t:nav", "t:footer", "t:aside", "t:form", "t:dialog"} | {
    f"c:{name}" for kind in ("menu", "footer", "sidebar", "notice", "advert", "form", "comments") for name in layouts.BOILERPLATE[kind]
}


def landmark_labels(blocks: list[htmlblocks.Block], paths: list[htmlblocks.Path]) -> np.ndarray:
    """1 below ``article`` or ``main``, 0 in parts that are plainly something else, -1 where nothing tells."""
    out = np.full(len(blocks), -1)
    for i, block in enumerate(blocks):
        above = paths[block.path].above
        if above & _OUTSIDE or "t:header" in above and not above & _INSIDE:
            out[i] = 0
        elif above & _INSIDE:
            out[i] = 1
    return out


def _split_marked(blocks: list[htmlblocks.Block]) -> tuple[list[htmlblocks.Block], np.ndarray]:
    """Blocks of a made page without their marks, and what the first mark of each says."""
    clean, labels = [], []
    for block in blocks:
        label = next((layouts.MARKS.index(c) for c in block.text if c in layouts.MARKS), -1)
        text = " ".join("".join(c for c in block.text if c not in layouts.MARKS).split())
        if text:
            clean.append(block._replace(text=text, linked=min(block.linked, len(text))))
            labels.append(label)
    return clean, np.array(labels, np.int64)


def training_pages(sample: list[str], n_layouts: int, seed: int = 11):
    """Pages with the labels of their landmarks, and layouts made from the texts of those pages."""
    pages, labels, prose, short = [], [], [], []
    for page in sample:
        blocks, paths = htmlblocks.read(page)
        label = landmark_labels(blocks, paths)
        if (label == 1).any():
            pages.append((blocks, paths))
            labels.append(label)
        for block in blocks:
            words = block.text.split()
            (prose if len(words) >= 12 else short).append(block.text)
            short.append(" ".join(words[: 1 + len(words) % 5]))
    prose = list(dict.fromkeys(p[:600] for p in prose))[:4096] or [a + b for a in _PROSE for b in _PROSE]
    short = list(dict.fromkeys(s[:80] for s in short))[:4096] or [p.split(" and ")[0] for p in _PROSE]
    escape = lambda texts: [t.replace("&", "&amp;").replace("<", "&lt;") for t in texts]
    maker = layouts.Maker(escape(prose), escape(short), seed)
    for _ in range(n_layouts):
        blocks, paths = htmlblocks.read(maker.page())
        blocks, label = _split_marked(blocks)
        if blocks:
            pages.append((blocks, paths))
            labels.append(label)
    return pages, labels


def fit(pages: DataFrame, html_column: str = "html", most: int = 256, longest: int = 1 << 16, n_layouts: int = 1200) -> Model:
    """Model fitted on at most ``most`` different pages of up to ``longest`` characters, and layouts made of their texts.

    The pages are those of smallest hash, so reruns and copies change nothing. That bounds what
    reaches the driver (16 M characters); only this sample of the training is bounded, every page
    is labelled. Without pages the layouts get a few sentences of their own.
    """
    text = column(pages, html_column).cast("string")
    given = pages.select(F.xxhash64(text).alias("h"), text.alias("html")).where((F.length("html") > 0) & (F.length("html") <= longest))
    chosen = [r.h for r in given.select("h").distinct().orderBy("h").limit(most).collect()]
    rows = given.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html")).collect() if chosen else []
    return train(*training_pages([r.html for r in sorted(rows, key=lambda r: r.h)], n_layouts))


def _extracted(model: Model, texts: list[str | None]) -> list[tuple[str, int, int]]:
    """Main text of each page, its blocks, and those kept. Pages are labelled CELLS blocks at a time."""
    out, waiting, cells = [], [], 0

    def label() -> None:
        main = probability(model, features(waiting)) > 0.5
        at = 0
        for blocks, _ in waiting:
            kept = [b.text for b, good in zip(blocks, main[at : at + len(blocks)]) if good]
            out.append(("\n\n".join(kept), len(blocks), len(kept)))
            at += len(blocks)
        waiting.clear()

    for text in texts:
        waiting.append(htmlblocks.read(text or ""))
        cells += len(waiting[-1][0])
        if cells >= CELLS or len(waiting) >= 256:
            label()
            cells = 0
    if waiting:
        label()
    return out


def main_text(
    pages: DataFrame, model: Model, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """page_id, url, text, n_blocks, n_main for every row of ``pages``; no page depends on another.

    ``text`` is the blocks labelled as main text, in page order, joined by two line feeds; character
    references are decoded and white space within a block is one blank. Null and empty html, or a
    page without main text, give an empty text. Null ids and urls stay; repeated rows get equal
    results; other columns are left out. Pages are read whole, however long.
    """
    spark = small_batches(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    given = pages.select(
        column(pages, id_column).alias("page_id"), column(pages, url_column).alias("url"), column(pages, html_column).cast("string").alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                made = _extracted(model, part.column(2).to_pylist())
                text, n_blocks, n_main = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(n_blocks, pa.int64()), pa.array(n_main, pa.int64())],
                    names=["page_id", "url", "text", "n_blocks", "n_main"],
                )

    made = StructType.fromDDL("text string, n_blocks bigint, n_main bigint")
    return given.mapInArrow(run, StructType([*given.schema.fields[:2], *made.fields]))
