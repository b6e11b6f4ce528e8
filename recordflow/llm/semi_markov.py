"""Personal data by a semi-Markov conditional random field over candidate segments.

Base patterns fix the plain forms. A semi-Markov field then adds what they miss: features of whole
spans score candidate segments of a bounded number of tokens, and dynamic programming chooses
boundaries and kinds together. It is trained on the table itself: the base spans of a sample, also
rewritten into other notations, are the positive segments, and numbers that only look alike the
negative ones.
"""

from __future__ import annotations

import heapq
import math
import random
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordflow.operators.lookups import saved

KINDS = ("email", "ip", "card", "phone")
#: Tokens that a segment may have.
SEGMENT = 24
#: Distinct texts with base spans of a kind that the field is trained on, for each kind; base spans taken
#: from one text, in turn by kind; passes over them, and the seed.
TRAIN_DOCS, TRAIN_SPANS, PASSES, SEED = 100, 8, 4, 7

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is only tried from its start, so that long runs take linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|\S")
_AT = r" at | ?[\[(](?:at|@)[\])] ?|@"
_DOMAIN = r"[\w-]+(?:(?: dot | ?[\[(](?:dot|\.)[\])] ?|\.)[\w-]+)+"
ADDRESS = re.compile(rf"(?i)[\w.%+-]+(?:{_AT}){_DOMAIN}")
#: Places that segments of two or more tokens lie at: long numbers, an at-form before a dotted name (with
#: the name as group 1), and spelled-out dots.
ANCHOR = re.compile(
    rf"[(\[]?[0-9][0-9 ().\[\]/:-]{{5,}}[0-9]|(?i:(?:{_AT})(?=({_DOMAIN}))|\bdot\b|[\[(](?:dot|\.)[\])])"
)
NAME = frozenset("._%+-")
#: Words that stand before " at " and a site's name in prose.
PROSE = frozenset(
    "look looks looking available find found see hosted online live us more me page site visit posted read here is are was be out"
    " it them information details arrive arrived meet stay work works working".split()
)
CUES = frozenset("tel phone call fax mobile card visa mail email contact ip host server address".split())

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def small_parts(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def emails(text: str) -> list[Span]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((0, start, free))
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """The plain forms, by kind and start; failing matches are dropped and not tried again."""
    out = emails(text)
    if not DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in IP.finditer(text) if small_parts(m.group().split("."))]
    for m in CARD.finditer(text):
        digits = only_digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return out


def span_features(span: str, left: str, right: str) -> list[str]:
    """Properties of a whole span and of its neighbours, before the kind is added to each."""
    digits = only_digits(span)
    shape = re.sub(r"[^\W0-9_]+", "a", re.sub(r"[0-9]+", lambda m: f"d{min(len(m.group()), 5)}", span))
    out = [
        "bias",
        f"shape {re.sub(r'(?:a[.-]?)+', 'a', shape)[:40]}",
        f"digits {min(len(digits), 20)}",
        f"marks {''.join(sorted(set(re.findall(r'[^A-Za-z0-9]', span))))[:8]}",
        f"left {left.lower() if left.lower() in CUES else 'word' if left.isalnum() else left[:1]}",
        f"right {'word' if right.isalnum() else right[:1]}",
    ]
    if 13 <= len(digits) <= 19:
        out.append(f"luhn {luhn(digits)}")
    if re.fullmatch(r"[0-9]+(?:(?:\.|\[\.\]|\(\.\))[0-9]+){3}", span):
        out.append(f"small parts {small_parts(re.findall('[0-9]+', span))}")
    before, _, rest = span.partition(" ")
    if rest[:3].lower() == "at ":
        out.append(f"before at {'prose' if before.lower() in PROSE else 'word' if before.isalpha() else 'name'}")
    return out


@dataclass
class Window:
    """Tokens of a part of a text, with the candidate segments (first, last + 1, kind, features)."""

    text: str
    tokens: list[tuple[int, int]]
    by_end: dict[int, list[tuple[int, int, list[str]]]] = field(default_factory=lambda: defaultdict(list))

    def __post_init__(self):
        text, tokens = self.text, self.tokens
        for i, (start, _) in enumerate(tokens):
            first = text[start]
            if not (first.isalnum() or first in "+(["):
                continue
            digits = letters = ats = 0
            for j in range(i, min(i + SEGMENT, len(tokens))):
                a, b = tokens[j]
                if j > i and re.search(r"\n|\s{3}", text[tokens[j - 1][1] : a]):
                    break
                digits += b - a if text[a] in "0123456789" else 0
                letters += text[a].isalpha()
                ats += text[a:b].lower() in ("@", "at")
                if not text[b - 1].isalnum() or digits > 24:
                    continue
                if letters > 2 or ats:
                    kinds = (0,) if ats and ADDRESS.fullmatch(text[start:b]) else ()
                else:
                    kinds = (1, 2, 3) if digits >= 4 and not letters else ()
                if kinds:
                    before = text[slice(*tokens[i - 1])] if i else ""
                    after = text[slice(*tokens[j + 1])] if j + 1 < len(tokens) else ""
                    names = span_features(text[start:b], before, after)
                    for kind in kinds:
                        self.by_end[j + 1].append((i, kind, [f"{KINDS[kind]} {f}" for f in names]))


class Field:
    """Weights of features and of neighbouring labels; label 4 is "nothing", one token at a time."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = {} if weights is None else weights

    def step(self, before: int, label: int) -> float:
        return self.weights.get(f"step {before} {label}", 0.0) if before != 4 or label != 4 else 0.0

    def segments(self, window: Window, end: int) -> list[tuple[int, int, float]]:
        found = [(i, k, sum(self.weights.get(f, 0.0) for f in names)) for i, k, names in window.by_end.get(end, ())]
        return [*found, (end - 1, 4, 0.0)]

    def best(self, window: Window) -> list[tuple[int, int, int]]:
        """The best segmentation's (kind, first, last + 1), by Viterbi over segment ends."""
        table: list[dict[int, tuple[float, tuple | None]]] = [{4: (0.0, None)}]
        for end in range(1, len(window.tokens) + 1):
            row: dict[int, tuple[float, tuple | None]] = {}
            for start, label, value in self.segments(window, end):
                total, before = max((v + self.step(b, label), b) for b, (v, _) in table[start].items())
                if label not in row or total + value > row[label][0]:
                    row[label] = (total + value, (start, before))
            table.append(row)
        out, end = [], len(window.tokens)
        label = max(table[end], key=lambda k: table[end][k][0])
        while end:
            start, before = table[end][label][1]
            if label != 4:
                out.append((label, start, end))
            end, label = start, before
        return out[::-1]

    def gradient(self, window: Window, gold: set[tuple[int, int, int]]) -> dict[str, float]:
        """Of the log-likelihood of ``gold`` segments (kind, first, last + 1): observed less expected."""
        n = len(window.tokens)
        forward = [{4: 0.0}]
        steps: list[list[tuple]] = [[]]
        for end in range(1, n + 1):
            row: dict[int, list[float]] = defaultdict(list)
            made = []
            for start, label, value in self.segments(window, end):
                for before, total in forward[start].items():
                    made.append((start, before, label, value + self.step(before, label)))
                    row[label].append(total + made[-1][3])
            forward.append({k: float(np.logaddexp.reduce(v)) for k, v in row.items()})
            steps.append(made)
        whole = float(np.logaddexp.reduce(list(forward[n].values())))
        backward = [defaultdict(lambda: -math.inf) for _ in range(n + 1)]
        backward[n].update(dict.fromkeys(forward[n], 0.0))
        names = {(i, k, end): f for end, rows in window.by_end.items() for i, k, f in rows}
        out: dict[str, float] = defaultdict(float)
        for end in range(n, 0, -1):
            for start, before, label, value in steps[end]:
                after = backward[end][label]
                if after == -math.inf:
                    continue
                backward[start][before] = float(np.logaddexp(backward[start][before], after + value))
                chance = math.exp(forward[start][before] + value + after - whole)
                for f in names.get((start, label, end), ()):
                    out[f] -= chance
                if (before, label) != (4, 4):
                    out[f"step {before} {label}"] -= chance
        before, at = 4, 0
        for kind, first, last in [*sorted(gold, key=lambda g: g[1]), (4, n, n)]:
            if first > at:
                if before != 4:
                    out[f"step {before} 4"] += 1
                before = 4
            if kind != 4:
                out[f"step {before} {kind}"] += 1
                for f in names.get((first, kind, last), ()):
                    out[f] += 1
                before, at = kind, last
        return out


def windows(text: str, taken: list[Span]) -> list[Window]:
    """The parts of a text, clear of ``taken`` spans, in which segments can lie."""
    if not ANCHOR.search(text):
        return []
    out, free = [], 0
    for start, end in [*sorted((a, b) for _, a, b in taken), (len(text), len(text))]:
        regions: list[list[int]] = []
        for m in ANCHOR.finditer(text, free, max(start, free)):
            reach = 12 if "0" <= m.group()[-1] <= "9" and m.group()[0] not in "[(" else 60
            a, b = max(m.start() - reach, free), min(m.end() + reach, start)
            if m.group(1):  # however long, the whole address is in the window
                name = m.start()
                while name > free and (text[name - 1].isalnum() or text[name - 1] in NAME):
                    name -= 1
                a, b = min(a, name), max(b, m.end(1))
            if regions and a <= regions[-1][1]:
                regions[-1][1] = max(b, regions[-1][1])
            else:
                regions.append([a, b])
        out += [Window(text, [m.span() for m in TOKEN.finditer(text, a, b)]) for a, b in regions]
        free = max(free, end)
    return out


def added_spans(text: str, base: list[Span], model: Field) -> list[Span]:
    """What the field finds outside of the base spans."""
    return [
        (kind, window.tokens[first][0], window.tokens[last - 1][1])
        for window in windows(text, base)
        for kind, first, last in model.best(window)
    ]


def rewritten(kind: int, span: str, rng: random.Random) -> str:
    """The same datum in another notation."""
    digits = only_digits(span)
    if kind == 0:
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)")])
        name, _, domain = span.rpartition("@")
        return name.replace(".", "") + at + domain.replace(".", dot)
    if kind == 1:
        return span.replace(".", rng.choice(["[.]", "(.)"]))
    if kind == 2:
        body = digits[:14]
        check = next(c for c in "0123456789" if luhn(body + c))
        return rng.choice(["{} {} {}", "{}-{}-{}", "{}{}{}"]).format(body[:4], body[4:10], body[10:] + check)
    area, rest = digits[-10:-7], digits[-7:]
    return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(area, rest[:3], rest[3:])


def at_rewritten(span: str, rng: random.Random) -> str:
    """The same address with only the at-sign rewritten, half of them with fewer parts and no digits."""
    name, _, domain = span.rpartition("@")
    word = re.match(r"[A-Za-z]+", name)
    if word and rng.random() < 0.5:
        name, domain = word.group(), re.sub("[0-9]", "", domain)
    return name + rng.choice([" at ", " at ", " at ", " [at] ", "(at)", "[at]", "(@)", "@"]) + domain


def site_in_prose(rng: random.Random) -> str:
    """Prose that names a site in the form of an address."""
    site = f"{rng.choice(['www.', ''])}{rng.choice(['example', 'site', 'news'])}.{rng.choice(['com', 'org', 'co.uk'])}"
    return f"{rng.choice(sorted(PROSE))} at {site}"


def look_alike(rng: random.Random) -> str:
    """A number in a similar notation that is no personal datum."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if rng.random() < 0.4:
        body = d(rng.choice([13, 14, 15, 17]))
        return body + rng.choice([c for c in "0123456789" if not luhn(body + c)])
    return rng.choice(
        [f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(1)} {d(3)} {d(3)}", d(rng.randint(6, 12)), f"{d(3)}.{d(4)}"]
        + [f"9{d(3)}.4{d(2)}.{d(3)}.{d(2)}", f"{d(1)}.{d(2)}.{d(1)}-{d(3)}", f"{d(4)}/{d(4)}", f"{d(4)} {d(4)}", f"{d(5)}-{d(5)}-{d(5)}"]
    )


def dealt_spans(text: str) -> list[Span]:
    """The first TRAIN_SPANS base spans, taking the first of each kind, then the second of each, and so on."""
    seen: dict[int, int] = defaultdict(int)
    ranked = []
    for span in base_spans(text):
        ranked.append((seen[span[0]], span))
        seen[span[0]] += 1
    return [span for _, span in sorted(ranked)[:TRAIN_SPANS]]


def train(texts: list[str]) -> Field:
    """Fit the field by stochastic ascent of the likelihood, with steps that shrink by feature."""
    rng = random.Random(SEED)
    examples = []
    for text in texts:
        for kind, a, b in dealt_spans(text):
            left, right = text[max(a - 40, 0) : a], text[b : b + 40]
            forms = [(text[a:b], True), (rewritten(kind, text[a:b], rng), True), (look_alike(rng), False)]
            if kind == 0:
                forms += [(at_rewritten(text[a:b], rng), True), (at_rewritten(text[a:b], rng), True), (site_in_prose(rng), False)]
            for span, positive in forms:
                near = left + span + right
                region = [m.span() for m in TOKEN.finditer(near)]
                window = Window(near, region)
                inside = [i for i, (x, y) in enumerate(region) if x >= len(left) and y <= len(left) + len(span)]
                gold = {(kind, inside[0], inside[-1] + 1)} if positive and inside else set()
                if all(any(i == g[1] and k == g[0] for i, k, _ in window.by_end[g[2]]) for g in gold):
                    examples.append((window, gold))
    weights: dict[str, float] = {}
    squares: dict[str, float] = defaultdict(float)
    model = Field(weights)
    for _ in range(PASSES):
        rng.shuffle(examples)
        for window, gold in examples:
            for name, g in model.gradient(window, gold).items():
                g -= 0.002 * weights.get(name, 0.0)
                squares[name] += g * g
                weights[name] = weights.get(name, 0.0) + 0.5 * g / math.sqrt(squares[name] + 1e-6)
    return model


def fit(docs: DataFrame) -> Field:
    """Train on texts with base spans: for each kind, the TRAIN_DOCS that come first by a hash of the text.

    Each task hands on its first hashes of each kind, without repeats, so copies count once and the
    driver gets TRAIN_DOCS texts of a kind at most, whatever the table.
    """
    texts = docs.select(F.col("text").cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    # What every base span has, so that the other texts do not reach Python.
    likely = texts.filter(F.col("text").rlike(r"@|\+[0-9]|[0-9]\.[0-9]|[0-9](?:[ -]?[0-9]){15}"))

    def firsts(batches):
        found: list[set[int]] = [set() for _ in KINDS]
        for batch in batches:
            for text, value in zip(batch.column(0), batch.column(1).to_pylist()):
                for kind in {span[0] for span in base_spans(text.as_py())}:
                    found[kind].add(value)
            found = [set(heapq.nsmallest(TRAIN_DOCS, hashes)) for hashes in found]
        rows = [(kind, value) for kind, hashes in enumerate(found) for value in hashes]
        kinds, values = zip(*rows) if rows else ((), ())
        columns = [pa.array(kinds, pa.int32()), pa.array(values, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "hash"])

    marks = saved(likely.mapInArrow(firsts, "kind int, hash long").distinct(), "train_hashes")
    picked = set()
    for kind in range(len(KINDS)):
        first = marks.filter(F.col("kind") == kind).orderBy("hash").limit(TRAIN_DOCS).collect()
        picked.update(row["hash"] for row in first)
    if not picked:
        return Field()
    near = likely.filter(F.col("hash").isin(sorted(picked)))
    return train([r["text"] for r in near.groupBy("hash", "text").count().orderBy("hash", "text").collect()])


def find(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``base``, ``added``) for every row of ``docs`` (``doc_id``, ``text``).

    Both are arrays of (``kind``, ``start``, ``end``) by kind, as listed in KINDS, and start; places
    count code points, with the end exclusive. Base spans of different kinds may overlap, and added
    ones overlap nothing.

    A null or empty text has no spans. Rows that repeat or have a null id are treated like any
    other, and an empty table, or one without base spans to learn from, has no added spans. Other
    columns are not looked at.
    """
    weights = fit(docs).weights
    spans = "array<struct<kind:string,start:int,end:int>>"
    kind = dict(docs.dtypes)["doc_id"]
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def named(rows: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(rows)]

    def run(batches):
        model = Field(weights)
        for batch in batches:
            base, added = [], []
            for text in batch.column(1):
                body = text.as_py() or ""
                found = base_spans(body)
                base.append(named(found))
                added.append(named(added_spans(body, found, model)) if weights else [])
            columns = [batch.column(0), pa.array(base, arrow), pa.array(added, arrow)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "added"])

    plain = docs.select("doc_id", F.col("text").cast("string"))
    return plain.mapInArrow(run, f"doc_id {kind}, base {spans}, added {spans}")
