"""Homomorphic multiset hash of documents.

A text is a multiset of short passages: paragraphs and sentences, cut further after words that end in one of a few
letters, so that an edit changes only the passages it touches. Each passage is hashed to a
wide vector; the fingerprint is the sum of its passages' vectors, so it does not depend on their order, and a passage is
inserted or deleted by adding or subtracting its vector. The vector has two parts:

* ``EXACT`` words of 32 bits, added modulo 2**32: equal multisets, and no others but for collisions, agree in them;
* sign bits of two hashes, packed as two counters of 30 bits a word and added modulo 2**60: as signs, the
  counters' cosine estimates the cosine of two multisets.

Only DataFrame functions; fingerprints are made within a row. The next document is found from ids alone, in ranges of
ids, and sends its beginning and fingerprint; no window holds a text.

Edge cases: null texts are empty, with an empty multiset (likeness 1 to another empty one, else 0); rows with equal
id and text share one next document; null ids come after all others; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, text_or_empty

#: Where passages end: lines, and white space after n, e, r or what is no ASCII letter.
CUT = r"\n+|(?<=[^a-df-mo-qs-zA-DF-MO-QS-Z\s])\s+"
EXACT, SIGNS = 6, 2
STEPS, LANES, BITS = 30, 2, 30  # packed words of a hash; counters in a word; bits of a counter
ONES = sum(1 << BITS * i for i in range(LANES))
EXACT_MASK, PACK_MASK = (1 << 32) - 1, (1 << LANES * BITS) - 1
LOWEST = -(2**63)


def passages(text: Column) -> Column:
    return F.filter(F.split(text, CUT), lambda p: p != "")


def hashes(passage: Column) -> list[Column]:
    """The hashes that a vector is made of: two exact words each, then the signs."""
    return [F.xxhash64(passage, F.lit(i)) for i in range(EXACT // 2)] + [F.xxhash64(passage, F.lit(100 + i)) for i in range(SIGNS)]


def vector(hashed: list[Column]) -> list[Column]:
    """Words of a passage's vector: how many passages (1), exact words, packed signs."""
    out = [F.lit(1).cast("long")]
    out += [w for h in hashed[: EXACT // 2] for w in (h.bitwiseAND(EXACT_MASK), F.shiftrightunsigned(h, 32))]
    return out + [F.shiftright(h, k).bitwiseAND(ONES) for h in hashed[EXACT // 2 :] for k in range(STEPS)]


_WIDTH = 1 + EXACT + SIGNS * STEPS
_MASKS = [EXACT_MASK] * (1 + EXACT) + [PACK_MASK] * (SIGNS * STEPS)


def summed(texts: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Fingerprints (arrays of longs) of the texts of each key: rows (*keys, name).

    Vectors are added up row by row before any shuffle. Counters and sums have room for 2**30 passages a text, more than
    a text of Spark's largest size can have.
    """
    cut = texts.select(*keys, F.explode_outer(passages(F.col(column))).alias("p"))
    cut = cut.select(*keys, "p", *(h.alias(f"h{i}") for i, h in enumerate(hashes(F.col("p")))))
    words = vector([F.col(f"h{i}") for i in range(EXACT // 2 + SIGNS)])
    sums = cut.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col("p").isNotNull(), w)), F.lit(0)).alias(f"w{i}") for i, w in enumerate(words)))
    return sums.select(*keys, F.array(*(F.col(f"w{i}").bitwiseAND(m) for i, m in enumerate(_MASKS))).alias(name))


def insert(mark: Column, passage: Column) -> Column:
    """The fingerprint after one more passage."""
    return F.array(*((mark[i] + v).bitwiseAND(_MASKS[i]) for i, v in enumerate(vector(hashes(passage)))))


def delete(mark: Column, passage: Column) -> Column:
    """The fingerprint after one passage less."""
    return F.array(*((mark[i] - v).bitwiseAND(_MASKS[i]) for i, v in enumerate(vector(hashes(passage)))))


def as_text(mark: Column) -> Column:
    """Hexadecimal digits of a fingerprint."""
    return F.array_join(F.transform(mark, lambda w: F.lpad(F.lower(F.hex(w)), 15, "0")), "")


def signs(mark: Column) -> Column:
    """Signed sums of the sign counters: ones less zeros."""
    packed = F.slice(mark, 2 + EXACT, SIGNS * STEPS)
    low = (1 << BITS) - 1
    lanes = lambda w: F.array(*(F.shiftright(w, BITS * i).bitwiseAND(low) * 2 - mark[0] for i in range(LANES)))
    return F.flatten(F.transform(packed, lanes))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of two multisets, 0 to 1; 1 for equal fingerprints."""
    pairs = F.zip_with(signs(a), signs(b), lambda x, y: F.struct((x * y * 1.0).alias("xy"), (x * x * 1.0).alias("xx"), (y * y * 1.0).alias("yy")))
    zero = F.struct(*(F.lit(0.0).alias(c) for c in ("xy", "xx", "yy")))
    sums = F.aggregate(pairs, zero, lambda s, p: F.struct((s.xy + p.xy).alias("xy"), (s.xx + p.xx).alias("xx"), (s.yy + p.yy).alias("yy")), lambda s: F.when((s.xx > 0) & (s.yy > 0), s.xy / F.sqrt(s.xx * s.yy)).otherwise(0.0))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sums)))


def next_rows(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """For distinct (id, mark), the next one in descending order, after the last the first; as next_id, next_mark.

    Ids are dealt in ranges and looked at within each; only the first one of each range crosses to its neighbour.
    """
    ranged = scratch.save(keys.repartitionByRange(F.col("id").desc(), F.col("mark")).withColumn("range", F.spark_partition_id()))
    order = (F.col("id").desc(), F.col("mark").asc())
    inside = Window.partitionBy("range").orderBy(*order)
    # one row a range
    heads = ranged.groupBy("range").agg(F.min(F.struct((-1 - F.col("id")).alias("down"), "mark", "id")).alias("h")).select("range", "h.id", "h.mark")
    across = Window.orderBy("range")
    first = heads.orderBy("range").limit(1).select(F.col("id").alias("first_id"), F.col("mark").alias("first_mark"))
    after = heads.select("range", F.lead("id").over(across).alias("head_id"), F.lead("mark").over(across).alias("head_mark"))
    after = after.crossJoin(F.broadcast(first)).select("range", F.coalesce("head_id", "first_id").alias("head_id"), F.coalesce("head_mark", "first_mark").alias("head_mark"))
    out = ranged.withColumn("n_id", F.lead("id").over(inside)).withColumn("n_mark", F.lead("mark").over(inside)).join(after, "range")
    return out.select("id", "mark", "n_chars", F.coalesce("n_id", "head_id").alias("next_id"), F.coalesce("n_mark", "head_mark").alias("next_mark"))


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint), one for each distinct id and text, with the fingerprint as an array of longs."""
    texts = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")).withColumn("mark", F.xxhash64("text"))
    return summed(texts.dropDuplicates(["doc_id", "mark"]), ["doc_id", "mark"], "text", "fingerprint").drop("mark")


def with_edits(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one for each input row."""
    scratch, key = Scratch(docs.sparkSession), ["id", "mark"]
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    keyed = texts.withColumns({"id": F.coalesce("doc_id", F.lit(LOWEST)), "mark": F.xxhash64("text"), "n_chars": F.length("text").cast("long")})
    copies = scratch.save(keyed.groupBy(*key, "n_chars").agg(F.count("*").alias("copies")))
    pairs = next_rows(copies.select(*key, "n_chars"), scratch)
    # the one shuffle of the texts; fingerprints are summed before it, where no row is repeated
    once = keyed.select(*key, "text").repartition(*key)
    repeated = not copies.where("copies > 1").isEmpty()
    once = once.dropDuplicates(key) if repeated else once
    prints = summed(once if repeated else keyed, key, "text", "print")
    # each document sends the one before it as much of its beginning as that one takes
    to = pairs.select(F.col("next_id").alias("id"), F.col("next_mark").alias("mark"), F.col("id").alias("to_id"), F.col("mark").alias("to_mark"), F.col("n_chars").alias("to_chars"))
    begin = once.join(to, key).select(F.col("to_id").alias("id"), F.col("to_mark").alias("mark"), F.expr("substring(text, 1, int(to_chars div 3))").alias("begin"))
    edited = once.join(begin, key).select(*key, F.concat(F.expr("substring(text, 1, int(length(text) - length(text) div 3))"), "begin").alias("edited"))
    edited = edited.withColumn("edited_sha256", F.sha2("edited", 256))
    prints, edited = scratch.save(prints), scratch.save(summed(edited, [*key, "edited_sha256"], "edited", "edited_print"))
    nexts = pairs.join(prints.select(F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("print").alias("next_print")), ["next_id", "next_mark"])
    out = edited.join(prints, key).join(nexts.select(*key, "n_chars", "next_print"), key).join(copies.select(*key, "copies"), key)
    out = out.select(
        F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
        "copies",
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")
