"""The filter audit against applying every order to every document."""

import re
from itertools import permutations

from recordflow.llm import filter_audit


def failures(rows):
    """For each (doc_id, text, source) the letters of the filters that it fails."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search("[#$%&*|]", t) is not None,
            i is not None and t in first and i > first[t],
        ]
        out.append({c for c, failed in zip("ABCDE", tests) if failed})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = failures(rows)
    out = {}
    for part in {s or "" for _, _, s in rows}:
        shapley = dict.fromkeys("ABCDE", 0)
        mine = [(i, f) for (i, _, s), f in zip(rows, fails) if (s or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                shapley[c] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in f for _, f in mine) - len(gone), sum(f == {c} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(docs, labels):
    return {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit_filters(docs, labels).collect()}


def triples(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_documents_equal_every_order(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    want = brute(triples(documents), [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert found(documents, labels) == want and len(want) == 600 * 20


def test_odd_rows_equal_every_order(spark, odd, empty):
    rows = [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (9, 1, 1), (77, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality long, toxic long")
    assert found(odd, labels) == brute(triples(odd), rows)
    assert found(odd, labels.limit(0)) == brute(triples(odd), [])
    assert found(empty, labels) == {}


def test_white_space_and_limits(spark):
    texts = [
        " \x1c ".join(["w"] * 99), " ".join("abc"), "\x0b\x0c a \r\n", " ".join(f"w{i}" for i in range(200)),
        " ".join(["x", "y"] * 100), "A" + "b" * 49, "A" + "b" * 48, "a|b", "",
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(spark.createDataFrame(rows, "doc_id long, text string, source string"), labels) == brute(rows, [])


def test_ranks_are_those_of_the_sorted_orders():
    orders = ["".join(p) for p in permutations("ABCDE")]
    for mask, step, start, end in filter_audit.removals():
        failed = {c for i, c in enumerate("ABCDE") if mask >> i & 1}
        for order in orders[start:end]:
            assert not failed & set(order[: step - 1]) and order[step - 1] in failed
    for mask in range(1, 32):
        assert sum(end - start for m, _, start, end in filter_audit.removals() if m == mask) == 120
