"""Toxicity scores from a learned lexicon, matched by Levenshtein automata.

Learning (from labelled training rows, a bounded sample; rows of one near-copy key share the weight of one):

1. Words, and stems (prefixes that many words share), whose document counts are too toxic for chance
   (a Chernoff bound with a correction for the number of words tested) make the lexicon.
2. Near spellings that clean training texts use are learned as exceptions.
3. A ridge logistic regression weighs the sums of term weights in three channels: plain use,
   near spellings, and quotation.

Scoring: the lexicon is a trie. Its product with Levenshtein automata (one edit for terms of 5 to 8 letters, two for
longer ones; stems are exact) is determinised as words run through it, so a word costs a
few table look-ups and most words die in three letters. A hit is quotation when the window around it
has quotation marks on both sides or a reporting word; it is then counted in its own channel.

Everything that is learned is a function of the rows of the sample alone, not of their order or partitions.

Edge cases: null and empty texts have no hits and get the score of that; with no labelled row, or one class only,
the lexicon is empty and the score is the smoothed share of toxic labels; null labels are skipped, of repeated ones
the largest counts; ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, slices, text_or_empty

WORD = re.compile(r"\w+")
QUOTES = "\"'«»„“”‘’‹›"
REPORTING = frozenset("said says wrote writes called calls quoted quote quotes term word insult sagte nannte wort dit mot appelé dijo llamó palabra".split())
STEM, LONGEST_STEM = 4, 12  # letters of a stem
ONE = 1 << 20  # weight of a near-copy group; integers, so that sums do not depend on their order
SHARE = 0.9  # least share of toxic documents among those with a term


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Product of a lexicon trie and Levenshtein automata, determinised on demand.

    A state is a set of (trie node, edits so far); words that leave the trie reach state 0, the dead one.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.child: list[dict[str, int]] = [{}]
        self.word: dict[int, str] = {}
        self.stem: dict[int, str] = {}
        self.reach = [0]  # most edits that any term below a node may have
        self.weight = {**stems, **words}
        for kind, terms in ((self.word, words), (self.stem, stems)):
            for term in terms:
                node, most = 0, edits_for(term) if kind is self.word else 0
                self.reach[0] = max(self.reach[0], most)
                for c in term:
                    if c not in self.child[node]:
                        self.child[node][c] = len(self.child)
                        self.child.append({})
                        self.reach.append(0)
                    node = self.child[node][c]
                    self.reach[node] = max(self.reach[node], most)
                kind[node] = term
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.moves: list[dict[str, int]] = [{}]
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:  # deletions: go down the trie without reading
            node, e = todo.pop()
            if e > self.reach[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo.extend((c, e + 1) for c in self.child[node].values())
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            out.add((node, e + 1))
            for letter, child in self.child[node].items():
                out.add((child, e + (letter != c)))
        to = self.moves[state][c] = self._state(out)
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The lexicon term that a word stands for, and its edits: fewest edits, then the longest term."""
        state, found, moves = self.start, [], self.moves
        for i, c in enumerate(word):
            to = moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if not state:
                break
            if i + 1 >= STEM and self.stem:
                found += [(0, -len(self.stem[n]), self.stem[n]) for n, e in self.sets[state] if not e and n in self.stem]
        else:
            found += [(e, -len(self.word[n]), self.word[n]) for n, e in self.sets[state] if n in self.word and e <= edits_for(self.word[n])]
        if not found:
            return None
        edits, _, term = min(found)
        return term, edits


class Model:
    """Lexicon, exceptions and weights; small, and sent to tasks as it is."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], share: float):
        self.words, self.stems, self.share = words, stems, share
        self.exceptions: frozenset[str] = frozenset()
        self.beta = np.zeros(4)

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.automaton = model, LexiconAutomaton(model.words, model.stems)
        self.known: dict[str, tuple[str, int] | None] = {}

    def find(self, word: str) -> tuple[str, int] | None:
        try:
            return self.known[word]
        except KeyError:
            if len(self.known) > 200_000:
                self.known.clear()
            hit = self.automaton.match(word)
            if hit and hit[1] and word in self.model.exceptions:
                hit = None
            self.known[word] = hit
            return hit

    def features(self, text: str) -> tuple[list[float], int]:
        """Weights summed over plain hits, near spellings and quoted hits; and the number of hits."""
        text, sums, hits = text.lower(), [0.0, 0.0, 0.0], 0
        words = set(WORD.findall(text))
        found = {w: h for w in words if (h := self.find(w))}
        if not found:
            return sums, 0
        for m in re.finditer(r"\b(?:" + "|".join(map(re.escape, sorted(found, key=len, reverse=True))) + r")\b", text):
            term, edits = found[m[0]]
            hits += 1
            left, right = text[max(0, m.start() - 48) : m.start()], text[m.end() : m.end() + 48]
            quoted = any(q in left[-24:] for q in QUOTES) and any(q in right[:24] for q in QUOTES) or bool(REPORTING & set(WORD.findall(left)[-4:]))
            sums[2 if quoted else 1 if edits else 0] += self.automaton.weight[term]
        return sums, hits

    def score(self, text: str) -> tuple[float, int]:
        sums, hits = self.features(text)
        return probability(self.model, np.array([sums]))[0], hits


def _design(sums: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(sums), 1)), np.log1p(np.maximum(sums, 0))])


def probability(model: Model, sums: np.ndarray) -> list[float]:
    if not model.words and not model.stems:
        return [model.share] * len(sums)
    return (1 / (1 + np.exp(-np.clip(_design(sums) @ model.beta, -30, 30)))).tolist()


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton's method; without evidence near spellings count half, quotation a quarter."""
    prior = np.array([-3.0, 3.0, 1.5, 0.75])
    beta, pull = prior.copy(), ridge * np.array([0.1, 1, 1, 1]) * max(1.0, math.sqrt(weight.sum()))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - pull * (beta - prior)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    beta[1:] = np.maximum(beta[1:], 0)
    return beta


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, toxic, clean): the weight of texts with the word, summed over a bounded number of words at a time."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def settled() -> pa.RecordBatch:
        rows = [(w, c if y else 0, 0 if y else c) for y, words in enumerate(counts) for w, c in words.items()]
        for words in counts:
            words.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2))], names=["word", "toxic", "clean"])

    for b in slices(batches, 1):
        for y, text, weight in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            for w in set(WORD.findall(text.lower())):
                counts[y][w] += weight
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield settled()
    yield settled()


def _copy_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key that near copies share mostly: the smallest hash of three words running."""
    import xxhash

    for b in slices(batches, 1):
        keys = []
        for text in b.column(1).to_pylist():
            words = text.lower().split()
            keys.append(min((xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.int64())], names=["y", "text", "key"])


def _channel_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for b in slices(batches, 1):
            sums = [scorer.features(t)[0] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array([s[i] for s in sums], pa.float64()) for i in range(3))], names=["y", "weight", "plain", "near", "quoted"])

    return run


def _near_words(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for b in batches:
            words = [w for w in b.column(0).to_pylist() if (h := scorer.find(w)) and h[1]]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])

    return run


def fit(labelled: DataFrame, *, alpha: float = 0.05) -> Model:
    """Learn from rows (y 0/1, text); the caller bounds how many (``training_rows``), which bounds all that is collected here."""
    scratch = Scratch(labelled.sparkSession)
    keyed = scratch.save(labelled.mapInArrow(_copy_key, "y int, text string, key long"))
    groups = keyed.groupBy("y", "key").agg(F.floor(F.lit(ONE) / F.count("*")).cast("long").alias("weight"))
    sizes = {r["y"]: r["n"] for r in groups.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    # a group is a labelled row at least, so the caller's bound on those bounds the broadcast below
    model = Model({}, {}, (toxic + 0.5) / (toxic + clean + 1.0))
    if not toxic or not clean:
        scratch.drop(keyed)
        return model
    rows = scratch.save(keyed.join(F.broadcast(groups), ["y", "key"]).select("y", "text", "weight"))
    counts = rows.mapInArrow(_word_counts, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = scratch.save(counts.select("word", F.col("toxic") / ONE, F.col("clean") / ONE).toDF("word", "toxic", "clean"))
    tested, base = max(1, words.count()), toxic / (toxic + clean)

    def telling(terms: DataFrame, n_tests: int) -> DataFrame:
        n, share = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
        bits = share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
        return terms.where((F.col("toxic") > 2) & (share >= SHARE) & (n * bits >= math.log(n_tests / alpha)))

    weigh = lambda t, c: min(6.0, math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)))
    ends = F.sequence(F.lit(STEM), F.least(F.length("word"), F.lit(LONGEST_STEM)))
    prefixes = words.where(F.length("word") >= STEM).select(F.explode(F.transform(ends, lambda n: F.substring("word", 1, n))).alias("stem"), *(F.round(F.col(c) * ONE).cast("long").alias(c) for c in ("toxic", "clean")))
    prefixes = prefixes.groupBy("stem").agg((F.sum("toxic") / ONE).alias("toxic"), (F.sum("clean") / ONE).alias("clean"), F.count_if(F.col("toxic") > 0).alias("words"))
    stems: dict[str, float] = {}
    for r in sorted(telling(prefixes.where("words >= 5 and clean * 50 <= toxic"), 6 * tested).collect(), key=lambda r: (len(r["stem"]), r["stem"])):
        if not any(r["stem"][:n] in stems for n in range(STEM, len(r["stem"]))):
            stems[r["stem"]] = weigh(r["toxic"], r["clean"])
    found = {r["word"]: weigh(r["toxic"], r["clean"]) for r in sorted(telling(words, tested).collect())}
    model.stems, model.words = stems, {w: v for w, v in found.items() if not any(w[:n] in stems for n in range(STEM, len(w) + 1))}
    clean_words = words.where("clean > 0").select("word")
    model.exceptions = frozenset(r["word"] for r in clean_words.mapInArrow(_near_words(model), "word string").collect())
    x = np.array(sorted(tuple(r) for r in rows.mapInArrow(_channel_rows(model), "y int, weight long, plain double, near double, quoted double").collect()), float).reshape(-1, 5)
    model.beta = _logistic(_design(x[:, 2:]), x[:, 0], x[:, 1] / ONE)
    scratch.drop(keyed, rows, words)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", most_rows: int = 20_000) -> DataFrame:
    """Rows (y, text) of labelled documents: a sample by id hash of at most about ``most_rows``."""
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull()).groupBy(id_column).agg(F.max(F.col(label_column).cast("int")).alias("y"))
    part = min(1.0, most_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(id_column, F.lit(6)), F.lit(1_000_000)) < int(part * 1_000_000))
    # bounded by most_rows, so a broadcast is safe
    return docs.select(id_column, text_or_empty(text_column).alias("text")).join(F.broadcast(known), id_column).select((F.col("y") > 0).cast("int").alias("y"), "text")


def _score(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for b in slices(batches, 1):
            got = [scorer.features(t) for t in b.column(1).to_pylist()]
            p = probability(model, np.array([g[0] for g in got]).reshape(-1, 3))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns) if i != 1), pa.array(p, pa.float64()), pa.array([int(x >= threshold) for x in p], pa.int32()), pa.array([g[1] for g in got], pa.int64())], names=[*(n for i, n in enumerate(b.schema.names) if i != 1), "score", "predicted", "n_terms"])

    return run


def score(docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows (doc_id, score, predicted, n_terms), one for each input row."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")).mapInArrow(_score(model, threshold), "doc_id long, score double, predicted int, n_terms long")


def keep_clean(docs: DataFrame, model: Model, *, text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose text the model does not call toxic, with their own columns."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for b in slices(batches, at):
            sums = [scorer.features(t or "")[0] for t in b.column(at).to_pylist()]
            p = probability(model, np.array(sums).reshape(-1, 3))
            yield b.filter(pa.array([x < threshold for x in p], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
