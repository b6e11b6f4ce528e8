"""Personal data and toxicity."""

import hashlib
import math
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordflow.llm import queries, semi_markov, toxicity

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    """The base patterns as they are written."""
    out = [(0, m) for m in EMAIL.finditer(text)]
    out += [(1, m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, m) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(3, m) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return [(kind, *m.span()) for kind, m in out]


def test_base_spans_of_mixed_texts():
    rng = random.Random(9)
    parts = list("ab1290.@-+() %_\n") + ["4111 1111 1111 1111", "10.0.0.", "+1 (256) 555-6953", "x@y.z", "255.", "é"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert semi_markov.base_spans(text) == plain_spans(text), text


def test_base_spans_take_linear_time():
    text = "1" * 200_000 + " " * 100_000 + "a" * 200_000 + "@" + "b" * 100_000 + " " + "1." * 100_000 + "+1" * 50_000
    found = semi_markov.base_spans(text)
    assert [s[0] for s in found] == [1] * 25_000 and found[0][1] == 600_002


@pytest.fixture(scope="module")
def model(documents):
    return semi_markov.Field(semi_markov.fit(documents.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")).weights)


@pytest.mark.parametrize(
    "kind,text,span",
    [
        ("phone", "er on (256) 555-6953 the of", "(256) 555-6953"),
        ("phone", "tion 256-555-6953 and", "256-555-6953"),
        ("email", "er jim [at] mail3 [dot] example [dot] com on", "jim [at] mail3 [dot] example [dot] com"),
        ("ip", "er 80[.]13[.]156[.]103 berge", "80[.]13[.]156[.]103"),
    ],
)
def test_the_field_finds_other_notations(model, kind, text, span):
    found = semi_markov.added_spans(text, semi_markov.base_spans(text), model)
    assert (kind, span) in [(semi_markov.KINDS[k], text[a:b]) for k, a, b in found]


@pytest.mark.parametrize("text", ["on 2024-01-05 er", "12:30:45 x", "at dot ha at", "at 300.400.500.600 the", "10,000,000"])
def test_the_field_leaves_look_alikes(model, text):
    assert semi_markov.added_spans(text, semi_markov.base_spans(text), model) == []


def test_windows_cover_every_address():
    parts = ["jane", "john.doe", " at ", " [at] ", "(at)", "(@)", "@", "example", "exämple", ".", " dot ", "[.]", "(dot)"]
    parts += ["com", "1", " ", " AT ", "_x", "x" * 70, "\n"]
    rng, seen = random.Random(5), 0
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(3, 30))) for _ in range(4000)]
    texts += ["name@exämple.de", "an john(at)example.org on", "jane at example.co.uk", "x" * 200 + " [at] " + "y" * 200 + ".com"]
    for text in texts:
        found = [m.span() for m in semi_markov.ADDRESS.finditer(text)]
        inside = [(w.tokens[0][0], w.tokens[-1][1]) for w in semi_markov.windows(text, []) if w.tokens]
        for a, b in found:
            seen += 1
            assert any(x <= a and b <= y for x, y in inside), (text, text[a:b])
    assert seen > 1000


@pytest.fixture(scope="module")
def trained():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    return semi_markov.train(sorted({t for t in texts if t and semi_markov.base_spans(t)}, key=lambda t: hashlib.md5(t.encode()).digest()))


@pytest.mark.parametrize(
    "text,span",
    [
        ("er john.doe [at] example.com on", "john.doe [at] example.com"),
        ("er john(at)example.org on", "john(at)example.org"),
        ("er jane at example.co.uk on", "jane at example.co.uk"),
        ("er jane@exämple.de on", "jane@exämple.de"),
    ],
)
def test_the_field_finds_rewritten_ats(trained, text, span):
    found = semi_markov.added_spans(text, semi_markov.base_spans(text), trained)
    assert ("email", span) in [(semi_markov.KINDS[k], text[a:b]) for k, a, b in found]


@pytest.mark.parametrize("text", ["er available at example.com on", "we look at news.example.org now"])
def test_the_field_leaves_sites_in_prose(trained, text):
    assert semi_markov.added_spans(text, semi_markov.base_spans(text), trained) == []


def test_training_texts_have_spans_of_every_kind_and_no_copies(spark, monkeypatch):
    """Next to many rows with years and prices, and a text copied more often than the sample is large."""
    plain = spark.range(3000).selectExpr("concat('in ', 1000 + id, ' for ', id, '.50 each') AS text")
    copies = spark.range(1000).selectExpr("'call +1 (256) 555-6953 now' AS text")
    rare = [("mail bob.1@mail2.example.com on",), ("host 10.0.0.1 is",), ("card 4111 1111 1111 1111 on",), ("tel +49 30 1234 567 a",)]
    docs = plain.union(copies).union(spark.createDataFrame(rare, plain.schema)).repartition(5)
    seen = []
    monkeypatch.setattr(semi_markov, "train", lambda texts: seen.extend(texts) or semi_markov.Field())
    semi_markov.fit(docs)
    assert sorted(seen) == sorted(["call +1 (256) 555-6953 now", *(t for t, in rare)])


def test_spans_of_one_text_are_dealt_over_the_kinds():
    text = " ".join(f"bob.{i}@mail.example.com" for i in range(20)) + " 10.0.0.1 and 4111 1111 1111 1111, +1 (256) 555-6953"
    assert {s[0] for s in semi_markov.dealt_spans(text)} == {0, 1, 2, 3} and len(semi_markov.dealt_spans(text)) == 8


def test_the_gradient_is_that_of_the_likelihood():
    """Against the sum over all segmentations, by numeric differences."""
    window = semi_markov.windows("a (256) 555-6953 b", [])[0]
    gold = {(3, i, end) for end, rows in window.by_end.items() for i, k, _ in rows if k == 3}
    first = next(iter(sorted(gold)))
    names = [n for rows in window.by_end.values() for *_, f in rows for n in f][:6]
    weights = {n: 0.1 * i for i, n in enumerate(names)}

    def likelihood(w):
        field = semi_markov.Field(w)

        def total(end):  # log-sum over segmentations of the first tokens, by last label
            if end == 0:
                return {4: [0.0]}
            out = {}
            for start, label, value in field.segments(window, end):
                for before, sums in total(start).items():
                    out.setdefault(label, []).extend(s + value + field.step(before, label) for s in sums)
            return out

        every = [s for sums in total(len(window.tokens)).values() for s in sums]
        own = field.step(4, 3) + field.step(3, 4) * (first[2] < len(window.tokens))
        own += sum(w.get(n, 0.0) for i, k, f in window.by_end[first[2]] if (i, k) == (first[1], 3) for n in f)
        return own - math.log(sum(map(math.exp, every)))

    gradient = semi_markov.Field(weights).gradient(window, {first})
    for name in names:
        up, down = ({**weights, name: weights[name] + d} for d in (1e-5, -1e-5))
        assert abs((likelihood(up) - likelihood(down)) / 2e-5 - gradient.get(name, 0.0)) < 1e-4


def test_spans_of_odd_rows(odd, empty):
    rows = {r.doc_id: r for r in semi_markov.find(odd).collect()}
    assert [s.kind for s in rows[8].base] == ["email", "ip", "phone"] and rows[3].base == rows[4].base == []
    assert semi_markov.find(odd).count() == odd.count() and semi_markov.find(empty).count() == 0


def test_pii_query_equals_the_plain_patterns(spark, small, documents):
    rows = {r.doc_id: r for r in queries.op1_semi_markov(spark, small).collect()}
    for doc in documents.collect():
        spans = [f"{semi_markov.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(doc.text or "")]
        row = rows[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row.spans.split(",")) or not spans


def edits(a, b):
    row = range(len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_the_automaton_equals_the_edit_distance():
    terms = ["idiot", "idle", "scumbag", "lowei", "tra"]
    trie = toxicity.Trie(terms)
    rng = random.Random(2)
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(word) + 1)
            word[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "o", "e"])
        word = "".join(word) + rng.choice(["", "", "s", "xyz"])
        want = None
        for k, term in enumerate(terms):
            distance = min(edits(word[:n], term) for n in range(len(word) + 1))
            if distance == 0 or (distance == 1 and len(term) >= toxicity.FUZZY_LENGTH):
                want = min(want or (9,), (distance, -len(term), k))
        got = trie.match(word)
        assert got == (want and (want[2], want[0])) or swap(word, terms), word


def test_words_that_match_pass_the_quick_look():
    rng = random.Random(8)
    for _ in range(300):
        terms = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 10))) for _ in range(3)]
        matcher = toxicity.Matcher(tuple(terms))
        for _ in range(40):
            word = list(rng.choice(terms) + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 3))))
            at = rng.randrange(len(word))
            edit = rng.choice(["none", "drop", "add", "change", "swap"])
            if edit == "drop":
                del word[at]
            elif edit == "add":
                word.insert(at, rng.choice("abcde"))
            elif edit == "change":
                word[at] = rng.choice("abcde")
            elif edit == "swap" and at:
                word[at - 1], word[at] = word[at], word[at - 1]
            word = "".join(word)
            assert matcher.likely(word) or matcher.trie.match(word) is None, (word, terms)


def swap(word, terms):
    """Whether exchanging two neighbours makes a term, which also counts as one edit."""
    return any((word[:i] + word[i + 1] + word[i] + word[i + 2 :]).startswith(t) for i in range(len(word) - 1) for t in terms)


def in_quotes(text, word="zorbfoo"):
    at = text.index(word)
    return any(a < at and at + len(word) <= b for a, b in toxicity.quotations(text))


def test_quotations():
    assert in_quotes('he said "you zorbfoo there" and left')
    assert in_quotes("er sagte „du zorbfoo“ und ging") and in_quotes("il dit « zorbfoo » et part")
    assert not in_quotes('"hello" you zorbfoo " there"')
    assert not in_quotes("don't you zorbfoo isn't it")
    # At the start of the text, far away, between two quotations, never closed, over two paragraphs.
    assert in_quotes('"zorbfoo is bad" he said') and in_quotes("'zorbfoo'")
    assert in_quotes('"' + "a b " * 50 + "zorbfoo " + "c d " * 50 + 'e" he said')
    assert not in_quotes('"yes" said the man and zorbfoo "no" said she')
    assert not in_quotes('he said "you zorbfoo') and not in_quotes('a "b\n zorbfoo" c')
    assert not in_quotes("the dogs' zorbfoo and the cats' food") and not in_quotes("‘tis a zorbfoo, that ‘ill")
    assert in_quotes("“a ‘b’ zorbfoo” c") and toxicity.quotations("") == []


def test_quoted_terms_at_any_place(spark):
    df = planted(spark)
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    quoted = ['"blockhead is bad" he said', '"' + "mo ri " * 11 + 'blockhead" he said']
    used = ['"yes" said the man and blockhead "no" said she', 'blockhead" he said']
    cases = spark.createDataFrame(list(enumerate(quoted + used)), "doc_id long, text string")
    scores = [r.score for r in toxicity.score(cases, model).orderBy("doc_id").collect()]
    assert max(scores[:2]) < toxicity.THRESHOLD <= min(scores[2:]), scores


def planted(spark):
    rng = random.Random(11)
    words = [a + b + c for a in ("ka", "mo", "ri", "te") for b in ("lu", "na", "si") for c in ("do", "pe", "wi")]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            text.insert(rng.randrange(30), "blockhead")
        rows.append((i, " ".join(text) + ".", int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_misspelled_and_quoted_terms(spark):
    df = planted(spark)
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert model.terms == ["blockhead"]
    texts = ["you blockhead", "you blokhead", "you blcokhead", 'a "blockhead" is a word used in the lessons', "good day"]
    cases = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = [r.score for r in toxicity.score(cases, model).orderBy("doc_id").collect()]
    assert min(scores[:3]) >= toxicity.THRESHOLD > max(scores[3:]), scores


def test_held_out_labels_are_not_learned_from(spark):
    df = planted(spark)
    wrong = F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    one = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    two = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", wrong.alias("toxic")))
    assert one == two
    rows = df.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op8_levenshtein_lexicon(spark, folder).filter("held_out").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id"
    ).select("predicted", "toxic").collect()
    right = sum(r.predicted and r.toxic for r in rows)
    assert right / sum(r.predicted for r in rows) > 0.9 and right / sum(r.toxic for r in rows) >= 0.9


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (77, 1), (2, None)], "doc_id long, toxic int")
    rows = toxicity.mark_toxic(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.mark_toxic(empty, labels).count() == 0 and toxicity.mark_toxic(odd, labels.limit(0)).count() == len(rows)
    scored = toxicity.score(odd, toxicity.Model([]), "own")
    assert scored.columns == [*odd.columns, "own"]
