"""Ranked lexical search of all documents, many items at once: term-at-a-time for short lists, document-at-a-time for long ones.

Documents are read once and kept as what the items can meet: for each document its number of terms, and how often each term of an item
stands in it. The statistics (documents, terms, documents of each term) are sums over that table. Then each task takes its documents in
blocks, inverts a block to posting lists, and ranks it for every item:

* short lists go term at a time: their scores are summed in accumulators, which then are one more list in order of documents, bounded by
  the greatest sum;
* lists are ordered by their bounds. Those lists whose bounds together cannot reach the tenth best score so far are only looked up; the documents of the
  others, and of the accumulators, are the candidates. They are taken document by document in ascending order, a run of them at a time; a
  candidate is looked up in one more list only while what it has and the bounds of the lists left reach the tenth best, so most of the long
  lists is skipped. The tenth best grows from run to run and stays from block to block.

A candidate is dropped only where its bound is less than the tenth best: equal scores are settled by doc_id at the end. Each task leaves at most ``top`` rows
for an item; one ranked window over these gives the result. Nothing is sampled and no list is cut.

Scores are integers: weight w = floor(1000 * ln((2N + 2) / (2df + 1))); a document of n terms has m = 100 - b + (b * n * N) div L; its score sums w * ((scale * tf) div (1000 * tf + k * m))
over the item's terms, once each.

Edge cases: null texts have no terms, and items without terms no rows; rows of documents with equal ids are documents of their own (ties among equal ids go
by text hash); null doc_ids come last among equal scores; each row of the items is an item, also where item_ids repeat; empty tables give an empty result;
other columns are ignored. Items are taken in blocks of ``most_items`` rows and ``most_bytes`` of text, one pass over the documents each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, give_back, slices

#: Letters and digits of ASCII and all bytes of other characters stay, in lower case; all else is a space.
FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents of a block, and candidates taken at a time.
BLOCK, RUN = 8192, 256
#: Lists of at most this share of a block are short.
SHORT = 1 / 16

FOUND = "item int, doc_id long, mark long, score long"


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(FOLD).split()


def _counted(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for b in slices(batches, 1):
            rows: list[int] = []
            n, ends, ids, often = [], [0], [], []
            for i, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                found = terms(text)
                if found:
                    held = Counter(found)
                    met = sorted((vocabulary[t], held[t]) for t in known & held.keys())
                    rows.append(i)
                    n.append(len(found))
                    ids += [t for t, _ in met]
                    often += [c for _, c in met]
                    ends.append(len(ids))
            at, offsets = pa.array(rows, pa.int64()), pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in ((ids, pa.int32()), (often, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(2).take(at), pa.array(n, pa.int64()), *lists], names=["doc_id", "mark", "n", "terms", "often"])

    return run


def _document_counts(size: int):
    """Documents of each term in a task's rows, as (term, df)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(b.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(df[some])], names=["term", "df"])

    return run


class Best:
    """The best scores of one item so far, and the least that a document must have to join them."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.doc, self.mark = (np.zeros(0, np.int64) for _ in range(3))
        self.least = 1

    def add(self, score: np.ndarray, doc: np.ndarray, mark: np.ndarray) -> None:
        keep = score >= self.least
        if keep.any():
            self.score, self.doc, self.mark = (np.concatenate([a, b[keep]]) for a, b in ((self.score, score), (self.doc, doc), (self.mark, mark)))
            order = np.lexsort((self.mark, self.doc, -self.score))[: self.top]
            self.score, self.doc, self.mark = self.score[order], self.doc[order], self.mark[order]
            if len(order) == self.top:
                self.least = int(self.score[-1])


class Block:
    """Posting lists of some documents: for each term, documents in ascending order and what the term gives their scores."""

    def __init__(self, doc: np.ndarray, mark: np.ndarray, m: np.ndarray, ends: np.ndarray, ids: np.ndarray, often: np.ndarray, weights: np.ndarray, k: int, scale: int):
        self.doc, self.mark, self.size = doc, mark, len(doc)
        row = np.repeat(np.arange(self.size), np.diff(ends))
        order = np.argsort(ids, kind="stable")
        self.row, ids = row[order], ids[order]
        tf = often[order]
        self.part = weights[ids] * ((scale * tf) // (1000 * tf + k * m[self.row]))
        found, first = np.unique(ids, return_index=True)
        self.at = dict(zip(found.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(ids)][: len(first)], strict=True), strict=True))
        self.bound = dict(zip(found.tolist(), np.maximum.reduceat(self.part, first).tolist() if len(first) else [], strict=True))

    def rank(self, item: np.ndarray, best: Best) -> None:
        lists = sorted((self.bound[t], t) for t in item.tolist() if self.bound.get(t, 0) > 0)
        if not lists:
            return
        short = [t for _, t in lists if self.at[t][1] - self.at[t][0] <= max(1, self.size * SHORT)]
        long = [(u, t) for u, t in lists if t not in set(short)]
        # term at a time
        rows, parts = (np.concatenate([a[slice(*self.at[t])] for t in short]) if short else np.zeros(0, np.int64) for a in (self.row, self.part))
        held, back = np.unique(rows, return_inverse=True)
        sums = np.zeros(len(held), np.int64)
        np.add.at(sums, back, parts)
        # document at a time: accumulators and lists from the least bound on, with the sums of the bounds up to each
        upto = np.cumsum([u for u, _ in long]).tolist()
        top_sum = int(sums.max()) if len(sums) else 0
        if top_sum + (upto[-1] if upto else 0) < best.least:
            return
        start = 0
        while start < self.size:
            skipped = 0  # lists that can only be looked up
            while skipped < len(long) and upto[skipped] < best.least:
                skipped += 1
            ahead = [a[np.searchsorted(a, start) :][:RUN] for a in (held, *(self.row[slice(*self.at[t])] for _, t in long[skipped:]))]
            # up to the first of the lists' ends of runs, each list is known to be whole
            stop = min((int(a[-1]) + 1 for a in ahead if len(a) == RUN), default=self.size)
            candidates = np.unique(np.concatenate([a[a < stop] for a in ahead]))
            start = stop
            if not len(candidates):
                continue
            score = np.zeros(len(candidates), np.int64)
            if len(held):
                at = np.minimum(np.searchsorted(held, candidates), len(held) - 1)
                hit = held[at] == candidates
                score[hit] = sums[at[hit]]
            for k in range(len(long) - 1, -1, -1):  # greatest bound first
                keep = score + upto[k] >= best.least
                candidates, score = candidates[keep], score[keep]
                if not len(candidates):
                    break
                lo, hi = self.at[long[k][1]]
                at = np.minimum(np.searchsorted(self.row[lo:hi], candidates), hi - lo - 1) + lo
                hit = self.row[at] == candidates
                score[hit] += self.part[at[hit]]
            best.add(score, self.doc[candidates], self.mark[candidates])


def _rank(items: list[np.ndarray], weights: np.ndarray, documents: int, length: int, top: int, b: int, k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items]
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            part = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            ids, often = (part.column(c).combine_chunks() for c in ("terms", "often"))
            n = part.column("n").to_numpy()
            doc = part.column("doc_id").fill_null((1 << 63) - 1).to_numpy()
            ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            block = Block(doc, part.column("mark").to_numpy(), 100 - b + (b * n * documents) // length, ends, ids.flatten().to_numpy().astype(np.int64), often.flatten().to_numpy(), weights, k, scale)
            for item, found in zip(items, best, strict=True):
                block.rank(item, found)

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(lo, BLOCK))
                if sum(x.num_rows for x in held) >= BLOCK:
                    flush()
        if held:
            flush()
        give_back()
        cols = [np.concatenate([getattr(x, c) for x in best]) for c in ("doc", "mark", "score")]
        which = np.repeat(np.arange(len(items), dtype=np.int32), [len(x.doc) for x in best])
        doc = pa.array(cols[0], pa.int64(), mask=cols[0] == (1 << 63) - 1)
        yield pa.RecordBatch.from_arrays([pa.array(which), doc, pa.array(cols[1]), pa.array(cols[2])], names=["item", "doc_id", "mark", "score"])

    return run


def _blocks(items: DataFrame, most_items: int, most_bytes: int) -> Iterator[list[tuple]]:
    """Rows (item_id, text) in blocks of a bounded size, read partition by partition."""
    held, size = [], 0
    for r in items.toLocalIterator():
        if held and (len(held) >= most_items or size + len(r[1]) > most_bytes):
            yield held
            held, size = [], 0
        held.append(tuple(r))
        size += len(r[1])
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, *, top: int = 10, b: int = 90, k: int = 8, scale: int = 1_000_000_000, most_items: int = 2_000, most_bytes: int = 8 << 20, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", query_column: str = "text") -> DataFrame:
    """The ``top`` best documents of each item: rows (item_id, rank, doc_id, score), best first, scores above 0."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    text = F.col(text_column).cast("string")
    texts = docs.where(text.isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    asked = items.where(F.col(query_column).isNotNull()).select(F.col(item_column).alias("item_id"), F.col(query_column).cast("string").alias("text"))
    id_type = asked.schema["item_id"].dataType.simpleString()
    found = [_search_block(spark, scratch, texts, block, id_type, top, b, k, scale) for block in _blocks(asked, most_items, most_bytes)]
    if not found:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _search_block(spark: SparkSession, scratch: Scratch, texts: DataFrame, block: list[tuple], id_type: str, top: int, b: int, k: int, scale: int) -> DataFrame:
    asked = [sorted(set(terms(t.encode()))) for _, t in block]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    counted = scratch.save(texts.mapInArrow(_counted(vocabulary), "doc_id long, mark long, n long, terms array<int>, often array<long>"))
    total = counted.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select("terms").mapInArrow(_document_counts(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # terms of a block of items
        df[r["term"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    numbers = [np.array([vocabulary[t] for t in ts], np.int64) for ts in asked]
    near = counted.mapInArrow(_rank(numbers, weights, total["documents"], max(1, total["length"]), top, b, k, scale), FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "mark")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(block)], f"item int, item_id {id_type}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a block of items


def sql() -> str:
    """The same ranking in SQL, as the query registers it."""
    return r"""
with docs as (select doc_id, row_number() over () as row_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
asked as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
lengths as (select row_id, any_value(doc_id) as doc_id, count(*) as n from docs group by row_id),
total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from lengths),
tfs as (select row_id, term, count(*) as tf from docs where term in (select term from asked) group by row_id, term),
weights as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tfs, total group by term),
scores as (
  select item_id, doc_id, row_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint as score
  from asked join weights using (term) join tfs using (term) join lengths using (row_id), total group by item_id, doc_id, row_id),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from scores where score > 0)
select * from ranked where rank <= 10"""
