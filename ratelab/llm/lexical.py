"""Ranked lexical search by best-first document intervals.

Documents are counted once: how many terms they hold and how often each asked
one. Tasks then take documents in blocks. In a block a term's postings stand in
document order with a sparse table of range maxima over their impacts. A search
starts with the whole block as one interval, bounded by the sum of its terms'
maxima, and always opens the interval with the highest bound: the document with
the largest impact is scored and splits it, both sides get bounds of their own,
and a narrow interval is scored whole. Once no bound reaches the worst of the
best documents so far, the rest of the block is done. The best go on from one
block of a task to the next, so later blocks open few intervals.
"""

import heapq
from bisect import insort
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelab.llm.ordered import ordered_totals
from ratelab.llm.tasks import map_batches
from ratelab.shared import cut_lineage, scratch_table_path

# Every byte but 0-9, A-Z, a-z and those of characters beyond ASCII parts terms; A-Z become a-z.
_SAME = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TABLE = bytes(c if c in _SAME else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass(frozen=True)
class SearchRule:
    """``most`` documents an item. The other numbers bound memory and change no result:
    bytes of items that a pass over the documents answers (one item at least), postings
    of a block (one document at least) and of a task, and documents of an interval that is
    scored whole."""

    most: int = 10
    item_bytes: int = 1 << 22
    postings: int = 1 << 21
    narrow: int = 64
    task_postings: int = 1 << 22

    def tasks(self, postings: int) -> int:
        """So many that one meets ``task_postings``; above 2,000 tasks, up to 2^28."""
        return max(1, min(-(-postings // self.task_postings), max(2_000, postings >> 28)))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z as a-z, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, counts``: a document's number of terms, and its asked terms by number."""

    def run(batches):
        for batch in batches:
            sizes, offsets, numbers, counts = [], [0], [], []
            for text in batch.column("text"):
                found = terms(text.as_py())
                asked = Counter(map(vocabulary.get, found))
                asked.pop(None, None)
                numbers += asked.keys()
                counts += asked.values()
                sizes.append(len(found))
                offsets.append(len(numbers))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int32())) for v in (numbers, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "counts"]
            )

    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    return map_batches(named, run, f"id {kind}, n bigint, terms array<int>, counts array<int>")


@dataclass(frozen=True)
class Collection:
    """``weights`` of the asked terms by number; documents with a term, and all their terms."""

    documents: int
    terms: int
    weights: np.ndarray

    def impacts(self, term: np.ndarray, n: np.ndarray, count: np.ndarray) -> np.ndarray:
        length = 10 + (90 * n * self.documents) // max(1, self.terms)
        return self.weights[term] * ((1_000_000_000 * count) // (1000 * count + 8 * length))


def weigh(documents: int, holding: np.ndarray) -> np.ndarray:
    """Weights of terms that so many documents hold."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))).astype(np.int64)


class Block:
    """Postings of some documents, and range maxima over each term's part of them."""

    def __init__(self, ids: pa.Array, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, known: Collection):
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        self.ids = [(i is None, i) for i in ids.take(pa.array(order)).to_pylist()]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        impact = known.impacts(term, sizes[doc], count)
        telling = impact > 0
        key = term[telling] * len(order) + place[doc[telling]]
        by_key = np.argsort(key, kind="stable")
        self.key, self.impact = key[by_key], impact[telling][by_key]
        self.width = len(order)
        self.doc = self.key % max(1, self.width)
        self.starts = np.searchsorted(self.key, np.arange(len(known.weights) + 1) * self.width)
        longest = int(np.diff(self.starts).max(initial=0))
        best = np.arange(len(self.key), dtype=np.int32)
        levels = [best]
        half = 1
        while 2 * half <= longest:
            left, right = best[:-half], best[half:]
            best = best.copy()
            best[:-half] = np.where(self.impact[right] > self.impact[left], right, left)
            levels.append(best)
            half *= 2
        self.best = np.stack(levels)
        self.log = np.zeros(longest + 2, dtype=np.int64)
        for i in range(1, len(levels)):
            self.log[1 << i :] = i

    def bound(self, low: np.ndarray, high: np.ndarray) -> tuple[int, int]:
        """Sum of the maxima of nonempty posting ranges, and the document of the largest one."""
        level = self.log[high - low]
        left, right = self.best[level, low], self.best[level, high - (1 << level)]
        best = np.where(self.impact[right] > self.impact[left], right, left)
        impact = self.impact[best]
        return int(impact.sum()), int(self.doc[best[impact.argmax()]])

    def search(self, asked: np.ndarray, best: list, rule: SearchRule) -> None:
        """Brings ``best``, sorted pairs of negative score and id, up to date with this block."""

        def push(first, last, term, low, high):
            some = low < high
            if some.any():
                term, low, high = term[some], low[some], high[some]
                bound, split = self.bound(low, high)
                if len(best) < rule.most or (-bound, self.ids[first]) < best[-1]:
                    heapq.heappush(heap, (-bound, first, last, split, term, low, high))

        def offer(score, place):
            if len(best) < rule.most or (-score, self.ids[place]) < best[-1]:
                insort(best, (-score, self.ids[place]))
                del best[rule.most :]

        heap: list = []
        push(0, self.width, asked, self.starts[asked], self.starts[asked + 1])
        while heap:
            bound, first, last, split, term, low, high = heapq.heappop(heap)
            if len(best) == rule.most and (bound, self.ids[first]) > best[-1]:
                if bound > best[-1][0]:
                    break
                continue
            if last - first <= rule.narrow:
                sizes = high - low
                upto = np.cumsum(sizes)
                at = np.repeat(low - (upto - sizes), sizes) + np.arange(upto[-1])
                scores = np.bincount(self.doc[at] - first, weights=self.impact[at]).astype(np.int64)
                enough = max(1, -best[-1][0]) if len(best) == rule.most else 1
                for i in np.flatnonzero(scores >= enough).tolist():
                    offer(int(scores[i]), first + i)
                continue
            wanted = term * self.width + split
            at = low + 0
            at[:] = np.clip(np.searchsorted(self.key, wanted), low, high)
            here = np.zeros(len(at), dtype=bool)
            inside = at < high
            here[inside] = self.key[at[inside]] == wanted[inside]
            offer(int(self.impact[at[here]].sum()), split)
            push(first, split, term, low, at)
            push(split + 1, last, term, at + here, high)


def _search_tasks(counted: DataFrame, items: Sequence[np.ndarray], known: Collection, rule: SearchRule) -> DataFrame:
    """``item, id, score``: each task's best documents of every item, items by their number here."""
    kind = counted.schema["id"].dataType.simpleString()
    id_type = counted.select("id").limit(0).toArrow().schema.field("id").type

    def run(batches):
        best: list[list] = [[] for _ in items]

        def answer(parts):
            if not parts:
                return
            table = pa.Table.from_batches(parts)
            lists = table.column("terms").combine_chunks()
            sizes = np.asarray(pc.list_value_length(lists))
            block = Block(
                table.column("id").combine_chunks(),
                table.column("n").to_numpy(),
                np.repeat(np.arange(len(sizes)), sizes),
                lists.flatten().to_numpy().astype(np.int64),
                table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64),
                known,
            )
            for asked, found in zip(items, best):
                block.search(asked, found, rule)

        parts, held = [], 0
        for batch in batches:
            upto = np.cumsum(np.asarray(pc.list_value_length(batch.column("terms"))))
            start = 0
            while start < batch.num_rows:
                done = int(upto[start - 1]) if start else 0
                end = int(np.searchsorted(upto, done + rule.postings - held, "right"))
                end = max(end, start if parts else start + 1)
                if end > start:
                    parts.append(batch.slice(start, end - start))
                    held += int(upto[end - 1]) - done
                if end < batch.num_rows:
                    answer(parts)
                    parts, held = [], 0
                start = end
        answer(parts)
        rows = [(i, id_, -score) for i, found in enumerate(best) for score, (_, id_) in found]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 3, (pa.int64(), id_type, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "id", "score"])

    return map_batches(counted, run, f"item bigint, id {kind}, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rule: SearchRule = SearchRule(),
) -> DataFrame:
    """``item, rank, id, score``: the best documents of every item, best first. Runs jobs.

    An item's score of a document sums the impacts of its distinct terms. Only
    scores above 0 count; equal scores go by ascending id, null ids last. Null
    and empty texts have no term. Documents that repeat an id rank beside each
    other; so do items, each with ranks from 1. No document, or no item with a
    term, gives no row. Only the named columns are looked at.

    Items are answered in blocks of ``rule.item_bytes``, each a pass over all
    documents: a task holds the terms of one such block, however many items
    there are. Documents stay where they are read; what moves is at most
    ``rule.most`` rows of each item from every task.
    """
    # A number for every item that its place among all gives, and blocks of so many bytes.
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    asked = asked.select("*", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), F.lit(1).alias("one"))
    placed = ordered_totals(asked, [F.col("item").asc_nulls_first(), F.col("text").asc_nulls_first()], {"no": "one", "at": "bytes"})
    placed = cut_lineage(placed.withColumn("block", F.floor(F.col("at") / rule.item_bytes)))
    blocks = [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]
    path = scratch_table_path(docs.sparkSession, "search")
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()
    for block in blocks:
        rows = placed.where(F.col("block") == block).select("no", "text").orderBy("no").collect()
        texts = [(r["no"], sorted(set(terms(r["text"])))) for r in rows]
        vocabulary = {term: i for i, term in enumerate(sorted({t for _, found in texts for t in found}))}
        where = scratch_table_path(docs.sparkSession, "counted")
        count_terms(docs, vocabulary, id_col, text_col).write.parquet(where)
        counted = docs.sparkSession.read.parquet(where)
        whole = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        holding = np.zeros(len(vocabulary), dtype=np.int64)
        for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[row["term"]] = row["count"]
        known = Collection(whole[0], whole[1] or 0, weigh(whole[0], holding))
        numbers = [np.array([vocabulary[t] for t in found], dtype=np.int64) for _, found in texts]
        # The counted table is far smaller than the texts: tasks go by its postings, not by its bytes.
        spread = counted.where(F.size("terms") > 0).repartition(rule.tasks(int(holding.sum())))
        found = _search_tasks(spread, numbers, known, rule)
        first = rows[0]["no"]
        found.withColumn("no", F.col("item") + first).select("no", "id", "score").write.mode("append").parquet(path)
    if not blocks:
        return docs.sparkSession.createDataFrame([], f"item {asked.schema['item'].dataType.simpleString()}, rank int, id {kind}, score bigint")
    found = docs.sparkSession.read.schema(f"no bigint, id {kind}, score bigint").parquet(path)
    best = Window.partitionBy("no").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= rule.most)
    return ranked.join(placed.select("no", "item"), "no").select("item", "rank", "id", "score")
