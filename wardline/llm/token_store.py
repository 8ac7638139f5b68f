"""Token ids of documents in ORC files that are read stripe by stripe.

The files hold one row for each document, in ascending order of doc_id over all files: the ids as an array of integers, which
ORC keeps in run-length encoded streams, and beside them what is needed to find a document without its ids. Stripes are the
parts that Spark reads in parallel; row indexes (smallest and largest values of each ``stride`` rows) and a Bloom filter on doc_id let a
reader skip stripes and row groups by the metadata alone: ``lookup`` and ``between`` push their filters down to them.

A task writes the rows of one range of doc_ids, so it numbers its ids by itself (``before``); the place in the whole sequence
is that and the ids of the ranges before, one sum for each file.

Ids are those of the ``tokenizers`` file. Where no token of the file holds white space (a file of the known kind), texts are cut there, and a bounded
table remembers the ids of their parts: a hit costs a tenth of encoding the part. Parts of plain Latin letters go on to words by the file's own
splitting pattern, which the library's model then encodes; other parts, and whole texts for a file of another kind, go through the library's full chain.

Edge cases: null and empty texts are the end id alone; null doc_ids come first; repeated doc_ids are rows of their own, ordered by text; equal rows have any order
among themselves, and a range is cut within them if need be; an empty table gives files without rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, slices, text_or_empty
from wardline.llm.packing import tokenizer

STORED = "doc_id long, part int, before long, n_tokens long, ids array<int>"
#: Parts of texts, and words, that one worker remembers, twice over at most.
PARTS, WORDS = 220_000, 180_000
#: Texts of these characters alone are composed already, have one lower-case letter for each letter, and hold no special token of a known file.
PLAIN = re.compile(r"[!-;=-~À-ÖØ-öø-ÿ]*")
#: The splitting pattern and the steps of the file whose words can be found without it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
#: The same pattern for plain texts in lower case.
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class Remembered(dict):
    """Encoded ids by text, as little-endian 32-bit integers. When it is full, only what is met again before the next time is kept."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, text):
        ids = self.older.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        self[text] = ids
        return ids


class Encoder:
    """Whole texts in UTF-8 to ids."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        spec = json.load(open(path, encoding="utf-8"))
        steps = [s for key, part in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")) for s in (spec.get(key) or {}).get(part, [])]
        known = [s["type"] for s in steps] == STEPS and steps[3]["pattern"].get("Regex") == SPLIT and spec["model"]["type"] == "BPE"
        self.by_parts = known and all("<" in t["content"] and not re.search(r"\s", t["content"]) for t in spec.get("added_tokens", []))
        # the file's letters for bytes
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        shown = {b: chr(b if b in printable else next(others)) for b in range(256)}
        self.letters = {c: "".join(shown[b] for b in chr(c).encode()) for c in [*range(33, 127), *range(192, 256)]}
        self.parts, self.words = Remembered(self.part, PARTS), Remembered(self.word, WORDS)

    def word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word.translate(self.letters))]).tobytes()

    def part(self, part: bytes) -> bytes:
        text = part.decode()
        return b"".join([self.words[w] for w in WORD.findall(text.lower())]) if PLAIN.fullmatch(text) else self.whole(text)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.split())) if self.by_parts else self.whole(text.decode())


@lru_cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode(path: str, end: int):
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for b in slices(batches, 1):
            ids = [encode(t) + closing for t in b.column(1).cast(pa.binary()).to_pylist()]
            n = np.array([len(i) // 4 for i in ids], np.int64)
            ends = np.cumsum(n)
            values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
            rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)
            cols = [b.column(0), pa.array(np.full(len(n), part), pa.int32()), pa.array(before + ends - n), pa.array(n), rows]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(ends[-1])

    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, *, end: int = 1, id_column: str = "doc_id", text_column: str = "text", stripe_bytes: int = 64 << 20, stride: int = 10_000, false_positives: float = 0.01) -> None:
    """Encode all documents and write their ids to a new folder, in ascending order of doc_id.

    Ranges are cut by id, text and place in the input, so that no id and no text makes a range of its own size; all three are the same
    when a task runs again on files.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"), F.xxhash64(text_or_empty(text_column)).alias("mark"), F.monotonically_increasing_id().alias("place"))
    dealt = texts.repartitionByRange("doc_id", "mark", "place").sortWithinPartitions("doc_id", "mark", "place")
    rows = dealt.select("doc_id", "text").mapInArrow(_encode(tokenizer_path, end), STORED)
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(false_positives), "orc.row.index.stride": str(stride), "orc.stripe.size": str(stripe_bytes), "compression": "zstd"}
    rows.write.options(**options).orc(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).orc(path)


def _starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base, part_tokens, longest): ids before each file, in it, and of its longest document; one row for each file."""
    sums = _stored(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"), F.max("n_tokens").alias("longest"))
    return sums.select("part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")).alias("base"), "part_tokens", "longest")


def _placed(rows: DataFrame, starts: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(starts), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of all documents, read by stripes; ``start`` counts the ids of all documents before."""
    return _placed(_stored(spark, path), _starts(spark, path))


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of ``read`` with these doc_ids: only row groups whose bounds and Bloom filter admit one of them are read."""
    return _placed(_stored(spark, path).where(F.col("doc_id").isin([int(i) for i in doc_ids])), _starts(spark, path))


def between(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """The rows of ``read`` that hold one of the ids at places ``low`` to ``high - 1``: as a trainer reads its share of the sequence."""
    files = [r for r in _starts(spark, path).collect() if r["base"] < high and r["base"] + r["part_tokens"] > low]  # one row for each file
    some = F.lit(False)
    for r in files:  # bounds on stored columns reach the row indexes; the exact test follows
        lo, hi = low - r["base"], high - r["base"]
        some = some | ((F.col("part") == r["part"]) & (F.col("before") < hi) & (F.col("before") > lo - r["longest"]) & (F.col("before") + F.col("n_tokens") > lo))
    return _placed(_stored(spark, path).where(some), _starts(spark, path))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("ids")
        values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).view(np.uint8)
        at = lists.offsets.to_numpy()
        crc = [zlib.crc32(values[4 * lo : 4 * hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def digest(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of rows of ``read``: the unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    return rows.mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, *, end: int = 1) -> DataFrame:
    """Write all documents, read the files back, and describe each document as it stands in them."""
    spark = docs.sparkSession
    path = f"{Scratch(spark).root}/tokens"
    write(docs, path, tokenizer_path, end=end)
    return digest(read(spark, path))
