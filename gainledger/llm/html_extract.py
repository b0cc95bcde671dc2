"""Main text of web pages by a tree-structured graphical model.

Every block of a page is content or not. The chance depends on features of the block and, through
potentials on parent and child, on the blocks around it. One pass of messages up the tree and one
down give the exact chance of every block; the same passes give the gradient when the potentials
are fitted to labelled pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import small_batches
from .common import to_python
from .html_tree import FEATURES, Node, features, parts_named, read_page
from .labelled_pages import labelled_pages

# Pages of the table used for fitting (the documented bound of that sample), and the nodes up to
# which a page is used for it.
SAMPLE_PAGES = 300
SAMPLE_NODES = 3_000
# Fitting: steps, step size, pull of the weights to zero.
STEPS, RATE, DECAY = 600, 0.05, 5e-5
# Kinds of children with potentials of their own: other parts, children of the page's root, the rest.
REST, ANNOUNCED, TOP = range(3)
KINDS = 3
OTHER_PARTS = {"menu", "header", "footer", "side", "advert", "notice", "form", "comments", "share"}
OTHER_TAGS = {"nav", "aside", "footer", "form", "dialog", "button", "search"}


@dataclass
class Forest:
    """Pages as arrays: parent of each node (-1 at roots), depth, kind, and (node, feature) pairs."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    node: np.ndarray
    feature: np.ndarray

    @classmethod
    def of(cls, pages: list[tuple[list[int], list[list[int]], list[int]]]) -> Forest:
        """From (parents, features, kinds) of each page."""
        parent, depth, kind, node, feature = [], [], [], [], []
        base = 0
        for parents, found, kinds in pages:
            depths = []
            for p in parents:
                depths.append(0 if p < 0 else depths[p] + 1)
            parent += [p + base if p >= 0 else -1 for p in parents]
            depth += depths
            kind += kinds
            for i, names in enumerate(found):
                node += [base + i] * len(names)
                feature += names
            base += len(parents)
        return cls(*(np.array(x, np.int64) for x in (parent, depth, kind, node, feature)))

    def layers(self) -> list[np.ndarray]:
        order = np.argsort(self.depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1) if len(order) else []


@dataclass
class Potentials:
    """Weights of features for being content, and of (kind, parent state, child state)."""

    unary: np.ndarray
    edge: np.ndarray

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """The chance of each node to be content, and of each (parent, child) state; sum-product."""
        n = len(forest.parent)
        own = np.zeros((n, 2))
        np.add.at(own[:, 1], forest.node, self.unary[forest.feature])
        layers = forest.layers()
        up = own.copy()  # own potential times the messages of the children
        message = np.zeros((n, 2))
        for nodes in layers[:0:-1]:
            message[nodes] = np.logaddexp.reduce(self.edge[forest.kind[nodes]] + up[nodes][:, None, :], axis=2)
            np.add.at(up, forest.parent[nodes], message[nodes])
        down = np.zeros((n, 2))
        pair = np.zeros((n, 2, 2))
        for nodes in layers[1:]:
            above = forest.parent[nodes]
            rest = up[above] + down[above] - message[nodes]
            joint = rest[:, :, None] + self.edge[forest.kind[nodes]]
            down[nodes] = np.logaddexp.reduce(joint, axis=1)
            joint = joint + up[nodes][:, None, :]
            pair[nodes] = np.exp(joint - np.logaddexp.reduce(joint.reshape(-1, 4), axis=1)[:, None, None])
        whole = up + down
        return np.exp(whole[:, 1] - np.logaddexp.reduce(whole, axis=1)), pair

    @classmethod
    def fit(cls, forest: Forest, label: np.ndarray, weight: np.ndarray) -> Potentials:
        """Maximises the likelihood of the labels by moment-scaled gradient steps."""
        model = cls(np.zeros(len(FEATURES)), np.zeros((KINDS, 2, 2)))
        child = np.flatnonzero(forest.parent >= 0)
        seen = np.zeros((len(label), 2, 2))
        seen[child, label[forest.parent[child]], label[child]] = 1
        shapes = [model.unary, model.edge]
        first, second = [np.zeros_like(x) for x in shapes], [np.zeros_like(x) for x in shapes]
        total = weight.sum()
        for step in range(1, STEPS + 1):
            chance, pair = model.marginals(forest)
            unary = np.zeros_like(model.unary)
            np.add.at(unary, forest.feature, ((label - chance) * weight)[forest.node])
            edge = np.zeros_like(model.edge)
            np.add.at(edge, forest.kind[child], (seen - pair)[child] * weight[child, None, None])
            for i, slope in enumerate((unary, edge)):
                slope = slope / total - DECAY * shapes[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                shapes[i] += RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return model


def announced(node: Node) -> bool:
    """Whether a node says by its tag or name that it is another part than the main text."""
    return node.tag in OTHER_TAGS or bool(parts_named(node.named) & OTHER_PARTS)


def kinds_of(nodes: list[Node]) -> list[int]:
    top = {i for i, n in enumerate(nodes) if n.tag in ("html", "body")}
    return [ANNOUNCED if announced(n) else TOP if n.parent in top else REST for n in nodes]


def as_arrays(nodes: list[Node]) -> tuple[list[int], list[list[int]], list[int]]:
    return [n.parent for n in nodes], [features(n) for n in nodes], kinds_of(nodes)


def landmark_labels(nodes: list[Node], is_main) -> list[int]:
    """1 for nodes in a main part, except parts inside it that announce something else, and for the
    containers around it below the page's body."""
    label: list[int] = []
    for node in nodes:
        inside = node.parent >= 0 and label[node.parent] == 1
        label.append(int(is_main(node) or (inside and not announced(node))))
    around = [False] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if around[i] or is_main(node):
            around[node.parent] = True
        if around[i] and not announced(node) and not node.text and node.tag not in ("html", "body"):
            label[i] = 1
    return label


def fit_extractor(pages: DataFrame, id: str = "page_id", html: str = "html") -> Potentials:
    """Fits the potentials to labelled pages.

    Labels come from the layouts of `labelled_pages` and from a bounded sample of the table: pages
    that mark their main text by an article or main element. Of each such page a second copy is
    used in which that element is a plain container, so that the model does not lean on it. Only the
    numbers of features come to the driver.
    """
    landmark = F.lower(F.col(html)).rlike(r"<(article|main)[\s>]")
    marked = pages.filter(F.col(html).isNotNull() & landmark)
    total = marked.count()
    luck = F.pmod(F.xxhash64(F.col(id), F.length(html)), F.lit(1 << 30))
    share = min(1.0, SAMPLE_PAGES / max(1, total))
    drawn = marked.select(luck.alias("luck"), F.col(html).alias("html")).filter(luck < int(share * (1 << 30)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for place, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes, _ = read_page(page)
                if len(nodes) > SAMPLE_NODES:
                    continue
                label = landmark_labels(nodes, lambda n: n.tag in ("article", "main"))
                for plain in (False, True):
                    if plain:
                        for node in nodes:
                            if node.tag in ("article", "main"):
                                node.tag, node.named = "div", {}
                    parents, found, kinds = as_arrays(nodes)
                    for column, value in zip(columns, (place, parents, [len(f) for f in found], sum(found, []), kinds, label), strict=True):
                        column.append(value)
            kinds = [pa.int64()] + [pa.list_(pa.int32())] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["luck", "parent", "n", "feature", "kind", "label"])

    rows = to_python(drawn).mapInArrow(read, "luck long, parent array<int>, n array<int>, feature array<int>, kind array<int>, label array<int>").collect()
    trees, labels = [], []
    for row in sorted(rows, key=lambda r: (r.luck, r.feature)):
        found, at = [], 0
        for n in row.n:
            found.append(row.feature[at : at + n])
            at += n
        trees.append((row.parent, found, row.kind))
        labels.append(row.label)
    table_nodes = sum(map(len, labels))
    for page in labelled_pages():
        nodes, _ = read_page(page)
        trees.append(as_arrays(nodes))
        labels.append(landmark_labels(nodes, lambda n: "data-main" in n.named))
    label = np.array(sum(labels, []), np.int64)
    # Both kinds of labelled pages weigh the same.
    weight = np.ones(len(label))
    if table_nodes:
        weight[:table_nodes] = (len(label) - table_nodes) / table_nodes
    return Potentials.fit(Forest.of(trees), label, weight)


def extract(pages: DataFrame, model: Potentials, carry: list[str], html: str = "html") -> DataFrame:
    """One row per input row: the carried columns and `main_text`, the main text of the whole page.

    The blocks that are content with a chance over one half, in page order, joined by a newline;
    character references decoded, white space inside a block turned into one space. Null, empty and
    textless pages give an empty text. Other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(*[F.col(c) for c in carry], F.coalesce(F.col(html), F.lit("")).alias("main_text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, len(carry)):
                trees, blocks, base = [], [], [0]
                for page in batch.column(len(carry)).to_pylist():
                    nodes, found = read_page(page)
                    trees.append(as_arrays(nodes))
                    blocks.append(found)
                    base.append(base[-1] + len(nodes))
                chance, _ = shared.value.marginals(Forest.of(trees))
                texts = ["\n".join(t for i, t in found if chance[b + i] > 0.5) for found, b in zip(blocks, base, strict=False)]
                columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*carry, "main_text"])

    return to_python(rows).mapInArrow(read, rows.schema)
