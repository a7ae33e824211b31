"""The main text of web pages by minimum-cut labelling of their blocks.

What a block's elements say (``article``, ``nav``, class names) and what a
classifier makes of its shape add up to its leaning towards content, the
capacity of its edge to one of the two terminals. Blocks next to each other on
the page, with one parent or with one grandparent, are tied by smoothness
edges. The minimum cut labels all blocks of a page at once.

The classifier is naive Bayes over a block's length, link density, tag and
ending, a few dozen counts. It learns from blocks whose elements tell what
they are and so judges those that none tells about.
"""

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelab.llm.html_blocks import BOILERPLATE, CONTENT, HEADINGS, MAYBE, UNKNOWN, Block, page_blocks
from ratelab.llm.mincut import least_cost_labels
from ratelab.llm.tasks import map_batches

_ENDS = frozenset(".!?…:;\"'”»。！？)")


@dataclass(frozen=True)
class CutRule:
    """Leanings and capacities. ``told`` is above all that shape and ties can
    add up to, so blocks in an article or in boilerplate stay what they are.
    ``learn_pages`` bounds the pages that the classifier learns from."""

    told: int = 40
    maybe: int = 12
    outside: int = 8
    shape: int = 10
    next_block: int = 4
    same_parent: int = 3
    same_grandparent: int = 2
    learn_pages: int = 5_000

    def __post_init__(self):
        if self.told <= self.shape + 2 * (self.next_block + self.same_parent + self.same_grandparent):
            raise ValueError("told must be above shape and ties together")


def shape_features(block: Block) -> tuple[str, ...]:
    words = block.text.count(" ") + 1
    kind = "h" if block.tag in HEADINGS else block.tag if block.tag in ("p", "li", "td", "div") else "other"
    return (
        f"words {min(words.bit_length(), 10)}",
        f"linked {min(10, 10 * block.linked // len(block.text))}",
        f"tag {kind}",
        f"ends {block.text[-1] in _ENDS}",
    )


# 8 blocks of either kind that are known before any page is seen.
_PRIOR = {
    CONTENT: ("words 6", "words 5", "linked 0", "tag p", "ends True"),
    BOILERPLATE: ("words 1", "words 2", "linked 10", "tag li", "ends False"),
}
_GROUPS = {"words": 10, "linked": 11, "tag": 6, "ends": 2}


@dataclass(frozen=True)
class ShapeModel:
    """How many blocks of either kind have a feature, and how many there are."""

    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    blocks: dict[str, int] = field(default_factory=dict)

    def leaning(self, block: Block, most: int) -> int:
        """Twice the log odds of its features, at most ``most`` either way."""
        odds = 0.0
        for name in shape_features(block):
            values = _GROUPS[name.partition(" ")[0]]
            share = []
            for kind in (CONTENT, BOILERPLATE):
                seen = self.counts.get(kind, {}).get(name, 0) + 8 * (name in _PRIOR[kind])
                share.append((seen + 1) / (self.blocks.get(kind, 0) + 8 + values))
            odds += math.log(share[0] / share[1])
        return max(-most, min(most, round(2 * odds)))


def fit_shapes(pages: DataFrame, html_col: str = "html", rule: CutRule = CutRule()) -> ShapeModel:
    """Counts over about ``rule.learn_pages`` pages at most, drawn by a hash of
    their place in the table and content. Runs two jobs; a few dozen rows reach the driver."""
    html = F.col(f"`{html_col}`")
    whole = pages.count()
    rows = pages.select(html.alias("html"))
    if whole > rule.learn_pages:
        # A hash of the whole row: copies of one page under many ids are drawn one by one.
        draw = F.xxhash64(*(F.col(f"`{f.name}`") for f in pages.schema if f.dataType.typeName() in _HASHED))
        limit = (rule.learn_pages << 64) // whole - (1 << 63)
        rows = pages.where(draw < F.lit(min(limit, (1 << 63) - 1))).select(html.alias("html"))

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for page in batch.column("html"):
                for block in page_blocks(page.as_py()):
                    if block.cue in (CONTENT, BOILERPLATE):
                        seen[block.cue, ""] += 1
                        seen.update((block.cue, name) for name in shape_features(block))
        columns = [[k for k, _ in seen], [n for _, n in seen], list(seen.values())]
        types = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "name", "n"])

    counts: dict[str, dict[str, int]] = defaultdict(dict)
    blocks = {}
    summed = map_batches(rows, run, "kind string, name string, n bigint").groupBy("kind", "name").agg(F.sum("n").alias("n"))
    for row in summed.collect():
        if row["name"]:
            counts[row["kind"]][row["name"]] = row["n"]
        else:
            blocks[row["kind"]] = row["n"]
    return ShapeModel(dict(counts), blocks)


_HASHED = frozenset("string binary byte short integer long float double boolean date timestamp decimal".split())


def ties(blocks: list[Block], rule: CutRule) -> list[tuple[int, int, int]]:
    """Smoothness edges: each block with the one before it on the page, and with the last one before it
    that has its parent or its grandparent."""
    edges = []
    parents: dict[int, int] = {}
    grandparents: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, rule.next_block))
        if block.parent in parents:
            edges.append((parents[block.parent], i, rule.same_parent))
        if block.grandparent in grandparents:
            edges.append((grandparents[block.grandparent], i, rule.same_grandparent))
        parents[block.parent] = grandparents[block.grandparent] = i
    return edges


def leanings(blocks: list[Block], model: ShapeModel, rule: CutRule) -> list[int]:
    """Above zero: rather content. Where a page has an article, what stands outside it rather is none."""
    told = any(b.cue == CONTENT for b in blocks)
    by_cue = {CONTENT: rule.told, BOILERPLATE: -rule.told}
    by_cue[MAYBE] = -rule.outside if told else rule.maybe
    by_cue[UNKNOWN] = -rule.outside if told or any(b.cue == MAYBE for b in blocks) else 0
    return [by_cue[b.cue] + model.leaning(b, rule.shape) for b in blocks]


def main_text(html: str | None, model: ShapeModel = ShapeModel(), rule: CutRule = CutRule()) -> str:
    """The content blocks of a page in order, two line feeds between them."""
    blocks = page_blocks(html)
    labels = least_cost_labels(leanings(blocks, model, rule), ties(blocks, rule))
    return "\n\n".join(block.text for block, content in zip(blocks, labels) if content)


def extract_main_text(
    pages: DataFrame,
    model: ShapeModel,
    html_col: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
    rule: CutRule = CutRule(),
) -> DataFrame:
    """Columns ``keep`` of every row, its ``text``, and its ``n_chars`` in code points.

    A page is labelled by itself, in the task that reads it: nothing is
    shuffled, and memory is bounded by a batch of pages and the graph of one
    page, which has at most three edges a block. Null and empty pages, and
    pages without content, have an empty text. Rows that repeat an id or a page
    are pages of their own; an empty table gives no row. Columns not named are
    not looked at.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py(), model, rule) for page in batch.column("_html")]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), sizes], names=[*batch.schema.names[1:], "text", "n_chars"]
            )

    named = pages.select(F.col(f"`{html_col}`").alias("_html"), *(F.col(f"`{c}`") for c in keep))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[1:]]
    return map_batches(named, run, ", ".join([*kinds, "text string", "n_chars bigint"]))
