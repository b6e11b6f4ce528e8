"""Toxicity: misspelled terms by Levenshtein automata over a lexicon trie, weighed by their context.

The lexicon is learned from labelled documents: beginnings of words that stand in far more toxic than
clean documents, each drawn out to the longest form that nearly all of its uses share, so that both
fixed words and families with many endings become terms.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.memory import giving_back
from recordflow.operators.lookups import lookup, saved

#: Labelled documents per class that the model is fitted on, and terms of the lexicon, at most.
TRAIN_PER_CLASS = 6_000
LEXICON = 2_000
#: Beginnings of so many characters are candidates for terms.
STEM = range(4, 11)
#: Chance, over all candidates together, at which a term may be in the lexicon by accident.
ACCIDENT = 0.05
#: Terms of at least so many characters may be misspelled by one edit.
FUZZY_LENGTH = 5
#: Words on either side that make up the context of a term.
WINDOW = 8
THRESHOLD = 0.3
#: Characters of words whose match a worker remembers within a partition.
WORD_CHARS = 4_000_000

WORD = re.compile(r"\w+")
#: Opening marks and what closes them.
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’"}
MARK = re.compile("[" + "".join(sorted({c for pair in QUOTES.items() for c in "".join(pair)})) + "]")
#: Exact and misspelled terms used, the same when quoted, terms per hundred words, used terms that have
#: another in their window, and 1. The prior means hold where the labels say nothing: used terms are abuse, quoted ones are not.
PRIOR = np.array([2.0, 1.5, 0.2, 0.1, 0.2, 0.0, -4.0])


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Trie:
    """Terms as a trie; ``match`` runs a Levenshtein automaton of one edit over it."""

    def __init__(self, terms: list[str]):
        self.root: dict = {}
        for i, term in enumerate(terms):
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = i
        self.lengths = [len(t) for t in terms]

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best term that the word begins with: fewest edits, then longest."""
        best = None
        # An automaton state is (trie node, characters of the word read, edits made).
        stack = [(self.root, 0, 0)]
        while stack:
            node, i, edits = stack.pop()
            term = node.get("")
            if term is not None and (not edits or self.lengths[term] >= FUZZY_LENGTH):
                rank = (edits, -self.lengths[term], term)
                if best is None or rank < best:
                    best = rank
            c = word[i : i + 1]
            if c and c in node:
                stack.append((node[c], i + 1, edits))
            if not edits:
                if c:
                    stack.append((node, i + 1, 1))  # one character too many
                for d, child in node.items():
                    if d and d != c:
                        stack.append((child, i, 1))  # one missing
                        if c:
                            stack.append((child, i + 1, 1))  # one exchanged
                swapped = node.get(word[i + 1 : i + 2] or "\0", {}).get(c or "\0")
                if swapped is not None and word[i + 1] != c:
                    stack.append((swapped, i + 2, 1))
        return best and (best[2], best[0])


@dataclass
class Model:
    """Terms with the weights of their exact and misspelled forms, and the weights of the features."""

    terms: list[str]
    exact: list[float] = field(default_factory=list)
    fuzzy: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: PRIOR.tolist())


class Matcher:
    """The trie behind a quick look at a few letters, which most words do not pass.

    An edit of a term lies behind its first two or three letters, which the word then begins with, or within them; then
    the word has the next three letters at their place or next to it. Exchanged first letters are put down as such.
    """

    def __init__(self, terms: tuple[str, ...]):
        self.trie = Trie(list(terms))
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[int, set[str]] = {}
        for term in terms:
            fuzzy = len(term) >= FUZZY_LENGTH
            head = (2 if len(term) == FUZZY_LENGTH else 3) if fuzzy else min(len(term), 3)
            self.heads.setdefault(head, set()).add(term[:head])
            for i in range(head if fuzzy else 0):  # two letters exchanged
                swapped = term[:i] + term[i + 1] + term[i] + term[i + 2 :]
                self.heads[head].add(swapped[:head])
            for at in (head - 1, head, head + 1) if fuzzy else ():
                self.tails.setdefault(at, set()).add(term[head : head + 3])
        self.seen: set[str] = set()
        self.found: dict[str, tuple[int, int]] = {}
        self.chars = 0

    def hits(self, text: str | None) -> tuple[list[tuple[int, int, bool, bool]], int]:
        """(term, edits, quoted, close) of each matching word, and the number of words; ``close``
        says that another used term is in the window."""
        lowered = (text or "").lower()
        words = WORD.findall(lowered)
        distinct = set(words)
        new = distinct - self.seen
        for word in new:
            match = self.trie.match(word) if self.likely(word) else None
            if match:
                self.found[word] = match
        self.seen |= new
        self.chars += sum(map(len, new))
        marked = distinct & self.found.keys()
        out = []
        if marked:
            spans = [m.span() for m in WORD.finditer(lowered)]
            places = [k for k, word in enumerate(words) if word in marked]
            quotes = quotations(lowered)
            starts = [a for a, _ in quotes]
            inside = []
            for k in places:
                q = bisect_right(starts, spans[k][0]) - 1
                inside.append(q >= 0 and quotes[q][1] >= spans[k][1])
            used = [k for k, q in zip(places, inside) if not q]
            for k, q in zip(places, inside):
                at = bisect_left(used, k)
                near = used[max(at - 1, 0) : at] + [x for x in used[at : at + 2] if x != k][:1]
                out.append((*self.found[words[k]], q, any(abs(x - k) <= WINDOW for x in near)))
        if self.chars > WORD_CHARS:
            self.clear()
        return out, len(words)

    def likely(self, word: str) -> bool:
        return any(word[:n] in heads for n, heads in self.heads.items()) or any(
            word[at : at + 3] in tails for at, tails in self.tails.items()
        )

    def clear(self) -> None:
        self.seen.clear()
        self.found.clear()
        self.chars = 0


def quotations(text: str) -> list[tuple[int, int]]:
    """The spans between quotation marks that belong together, in order and apart from each other.

    A mark opens after the start, white space, a bracket or another mark, and closes before the end, white
    space, punctuation or another mark. Both are in one paragraph, however far apart; a mark inside a word is an apostrophe.
    """
    found = []
    start = 0
    for paragraph in text.split("\n"):
        marks = [m.start() for m in MARK.finditer(paragraph)]
        if len(marks) > 1:
            own = {paragraph[i] for i in marks}
            for opening, closing in QUOTES.items():
                if opening not in own:
                    continue
                opened = None
                for i in marks:
                    c = paragraph[i]
                    before, after = paragraph[i - 1 : i] if i else "", paragraph[i + 1 : i + 2]
                    if opened is not None and c in closing and not (after.isalnum() or after == "_"):
                        found.append((start + opened, start + i))
                        opened = None
                    elif opened is None and c == opening and not (before.isalnum() or before in tuple("_.,;:!?)]}")):
                        opened = i
        start += len(paragraph) + 1
    apart: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if apart and a <= apart[-1][1]:
            apart[-1] = apart[-1][0], max(b, apart[-1][1])
        else:
            apart.append((a, b))
    return apart


def features(model: Model, hits: list[tuple[int, int, bool, bool]], words: int) -> np.ndarray:
    sums, together = np.zeros(4), 0.0
    for term, edits, in_quotes, close in hits:
        weight = (model.fuzzy if edits else model.exact)[term]
        sums[2 * in_quotes + (edits > 0)] += weight
        together += weight * (close and not in_quotes)
    weight = 100 * (sums[0] + sums[1]) / max(words, 1)
    return np.array([*np.log1p(sums), math.log1p(weight), math.log1p(together), 1.0])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn a model from ``labels`` (``doc_id``, ``toxic``) of rows that are not held out."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model([])
    # The same rows each time, by a hash of their id.
    place = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, TRAIN_PER_CLASS / sizes[1]).otherwise(TRAIN_PER_CLASS / sizes[0])
    picked = saved(usable.filter(place < share), "toxic_ids")
    sample = lookup(docs.select("doc_id", F.col("text").cast("string")), picked, ["doc_id"], "inner")
    sample = saved(sample.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic_sample")
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Model([])

    def stems(batches):
        for batch in giving_back(batches):
            for a in range(0, batch.num_rows, 100):
                found, marks = [], []
                part = batch.slice(a, 100)
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = set(WORD.findall((text or "").lower()))
                    own = {w[:n] for w in words for n in STEM if len(w) >= n}
                    own |= {w for w in words if 1 < len(w) < STEM[0]}
                    found += own
                    marks += [label] * len(own)
                yield pa.RecordBatch.from_pydict({"stem": found, "toxic": pa.array(marks, pa.int32())})

    counts = saved(
        sample.select("text", F.col("toxic").cast("int"))
        .mapInArrow(stems, "stem string, toxic int")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .filter("t + c > 1"),
        "toxic_stems",
    )
    # The likelihood ratio of a term's counts against an even spread over the classes.
    expected_t = (F.col("t") + F.col("c")) * (toxic / (toxic + clean))
    expected_c = (F.col("t") + F.col("c")) * (clean / (toxic + clean))
    ratio = 2 * (
        F.col("t") * F.log(F.col("t") / expected_t)
        + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / expected_c)).otherwise(0.0)
    )
    bound = 2 * math.log(max(counts.count(), 1) / ACCIDENT)
    pure = F.col("t") / toxic > 10 * F.col("c") / clean
    strong = counts.filter((F.col("t") > 0) & pure & (ratio > bound)).select("stem", "t", "c", ratio.alias("ratio"))
    rows = strong.orderBy(F.desc("ratio"), "stem").limit(LEXICON * len(STEM)).collect()
    terms = drawn_out({r["stem"]: (r["t"], r["ratio"]) for r in rows})[:LEXICON]
    model = Model(terms)

    used: dict[tuple[int, bool], Counter] = {}
    examples = []
    for label, hits, words in hits_of(sample, model):
        examples.append((label, hits, words))
        for term, edits in {(t, e > 0) for t, e, *_ in hits}:
            used.setdefault((term, edits), Counter())[label] += 1

    def weight(term: int, edits: bool) -> float:
        n = used.get((term, edits), Counter())
        return max(0.0, math.log((n[1] + 1) / (toxic + 1)) - math.log((n[0] + 0.05) / (clean + 1)))

    model.exact = [weight(i, False) for i in range(len(terms))]
    model.fuzzy = [weight(i, True) for i in range(len(terms))]
    x = np.array([features(model, hits, words) for _, hits, words in examples])
    y = np.array([label for label, *_ in examples], float)
    model.weights = logistic(x, y).tolist()
    return model


def drawn_out(stems: dict[str, tuple[int, float]]) -> list[str]:
    """The shortest telling beginnings, each as long as nearly all of its uses agree; best first."""
    children: dict[str, list[str]] = {}
    for stem in stems:
        children.setdefault(stem[:-1], []).append(stem)
    out: dict[str, float] = {}
    for stem, (uses, ratio) in stems.items():
        if stem[:-1] in stems:
            continue
        term = stem
        while True:
            longer = [s for s in children.get(term, ()) if stems[s][0] >= 0.9 * uses]
            if not longer:
                break
            term = longer[0]
        out[term] = ratio
    return sorted(out, key=lambda t: (-out[t], t))


def hits_of(sample: DataFrame, model: Model) -> list[tuple[int, list[tuple[int, int, bool, bool]], int]]:
    """(label, hits, words) of the training documents, of which there are a bounded number."""
    terms = tuple(model.terms)

    def run(batches):
        matches = Matcher(terms)
        for batch in giving_back(batches):
            found = [matches.hits(t.as_py()) for t in batch.column(0)]
            flat = [[t * 8 + e * 4 + q * 2 + near for t, e, q, near in hits] for hits, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(flat, pa.list_(pa.int32())), pa.array([n for _, n in found], pa.int32())],
                ["toxic", "hits", "words"],
            )

    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(run, "toxic int, hits array<int>, words int")
    return [(r[0], [(h // 8, h // 4 % 2, h // 2 % 2 == 1, h % 2 == 1) for h in r[1]], r[2]) for r in rows.collect()]


def logistic(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Weights by Newton's method, drawn to the prior means."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return w


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` (``text`` among them) and the score in a new last column."""
    terms = tuple(model.terms)
    weights = np.array(model.weights)

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Only the text comes here and only the score goes back; the rows stay with Spark.
        matches = Matcher(terms)
        for batch in giving_back(batches):
            values = []
            for text in batch:
                x = features(model, *matches.hits(text.as_py()))
                values.append(float(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))))
            yield pa.array(values, pa.float64())

    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    body = plain[names[docs.columns.index("text")]].cast("string")
    return plain.select(*names, scores(body)).toDF(*docs.columns, column)


def mark_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``held_out``, ``score`` (0 to 1)
    and ``predicted`` (1 from ``threshold`` on).

    ``labels`` (``doc_id``, ``toxic``) may lack rows; only 0 and 1 of rows that are not held out are
    learned from, on a sample of TRAIN_PER_CLASS documents of each class. Without labels of both
    classes, no term is known and every score is the same low one. Of rows of one text, the highest
    label counts.

    A null or empty text has no terms and the score of a document without any. A row with a null id
    is scored and not held out. Rows that repeat get the same score; an empty table gives an empty
    result. Other columns are not looked at.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
