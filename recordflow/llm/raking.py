"""Mixing sources to target weights by iterative proportional fitting (raking).

Tokens are summed into cells, one for each combination of the dimensions' values. In turn for each
dimension the cells are scaled so that its marginals meet their targets, until all do; the rate of a
cell then is the chance with which its documents are drawn. Without a sample size the rates are scaled
so that the largest is 1; with one they are bounded by 1, so that a rare cell scales no other one down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.operators.lookups import lookup, saved, saved_rows

ROUNDS = 12
#: Rounds between two writes of the cells, which cut the plan.
STRIDE = 3
NO_VALUE = "(none)"
#: Powers of the totals to which the registered query draws each dimension's shares.
POWERS = {"source": 0.8, "lang": 0.9, "topic": 0.9}
#: Share of the tokens that the pipeline's mixing stage draws, near what the scaled rates keep of sf0.1 (0.632).
SAMPLE = 0.65
#: Bounded rounds end when no rate moves by more over a stride, or after so many.
SETTLED, MOST_ROUNDS = 1e-4, 60


def tempered(power: float):
    """Targets in proportion to a power of what there is: 1 keeps the shares, 0 makes them equal."""
    return lambda total: F.pow(total, F.lit(float(power)))


def rates(cells: DataFrame, targets: dict) -> DataFrame:
    """The cells (dimensions, ``tokens``) with ``rate``: how much of each to take, 1 for the most."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    plan = cells.withColumn("rate", F.lit(1.0))
    for name, target in targets.items():
        own = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("own"))
        if callable(target):
            share = own.select(name, target(F.col("own")).alias("share"))
        else:
            given = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])
            share = own.select(name, F.coalesce(given[F.col(name)], F.lit(0.0)).cast("double").alias("share"))
        share = saved(share, "mix_shares")
        whole = share.agg(F.sum("share")).first()[0] or 1.0
        plan = plan.join(share.select(name, (F.col("share") * (total / whole)).alias(f"goal_{name}")), name)
    plan = saved(plan, "mix_cells")
    for i in range(1, ROUNDS + 1):
        for name in targets:
            there = F.sum(F.col("tokens") * F.col("rate")).over(Window.partitionBy(name))
            factor = F.when(there > 0, F.col(f"goal_{name}") / there).otherwise(1.0)
            plan = plan.withColumn("rate", F.col("rate") * factor)
        if i % STRIDE == 0:
            plan = saved(plan, "mix_cells")
    most = plan.filter("tokens > 0").agg(F.max("rate")).first()[0] or 1.0
    return plan.select(
        *targets,
        F.round("rate", 6).alias("weight"),
        F.when(F.col("tokens") > 0, F.least(F.round(F.col("rate") / most, 9), F.lit(1.0)))
        .otherwise(1.0)
        .alias("probability"),
    )


def bounded_rates(cells: DataFrame, targets: dict, sample: float, rounds: int | None = None) -> DataFrame:
    """``rates`` for a sample of ``sample`` of all tokens, with ``rate`` itself as the probability.

    A value that has less than its share of the sample is wanted whole, and the others share the rest.
    Cells at 1 stay whole while the others of their value are scaled up, until the rates settle, or
    for so many ``rounds``.
    """
    if not 0 < sample <= 1:
        raise ValueError("sample must be above 0 and at most 1")
    size = float(cells.agg(F.sum("tokens")).first()[0] or 0) * sample
    plan = cells.withColumn("rate", F.lit(float(sample)))
    for name, target in targets.items():
        own = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("own"))
        if callable(target):
            share = target(F.col("own"))
        else:
            given = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])
            share = F.coalesce(given[F.col(name)], F.lit(0.0)).cast("double")
        goals = own.select(name, "own", share.alias("share")).withColumn("goal", F.lit(0.0))
        goals = saved(goals, "mix_goals")
        whole = -1
        while True:  # each time more values are whole, so this ends
            short = F.col("goal") >= F.col("own")
            sums = goals.agg(
                F.sum(F.when(short, F.col("own")).otherwise(0.0)).alias("taken"),
                F.sum(F.when(short, 0.0).otherwise(F.col("share"))).alias("share"),
                F.sum(short.cast("long")).alias("whole"),
            ).first()
            if (sums["whole"] or 0) == whole:
                break
            whole = sums["whole"] or 0
            scale = max(size - (sums["taken"] or 0.0), 0.0) / (sums["share"] or 1.0)
            goal = F.when(short, F.col("own")).otherwise(F.least(F.col("share") * scale, F.col("own")))
            goals = saved(goals.withColumn("goal", goal), "mix_goals")
        plan = plan.join(goals.select(name, F.col("goal").alias(f"goal_{name}")), name)
    plan = saved(plan.withColumn("last", F.col("rate")), "mix_cells")
    for i in range(1, (rounds or MOST_ROUNDS) + 1):
        for name in targets:
            value, goal = Window.partitionBy(name), F.col(f"goal_{name}")
            full = F.sum(F.when(F.col("rate") >= 1, F.col("tokens")).otherwise(0)).over(value)
            free = F.sum(F.when(F.col("rate") < 1, F.col("tokens") * F.col("rate")).otherwise(0.0)).over(value)
            rate = (
                F.when(full + free >= goal, F.col("rate") * goal / F.greatest(full + free, F.lit(1e-300)))
                .when((F.col("rate") < 1) & (free > 0), F.least(F.col("rate") * (goal - full) / free, F.lit(1.0)))
                .otherwise(F.col("rate"))
            )
            plan = plan.withColumn("rate", rate)
        if i % STRIDE == 0:
            plan = saved(plan, "mix_cells")
            if rounds:
                continue
            moved = plan.filter("tokens > 0").agg(F.max(F.abs(F.col("rate") - F.col("last")))).first()[0] or 0.0
            if moved <= SETTLED:
                break
            plan = plan.withColumn("last", F.col("rate"))
    weight = F.when(F.col("tokens") > 0, F.col("rate")).otherwise(1.0)
    return plan.select(*targets, F.round("rate", 6).alias("weight"), F.round(weight, 9).alias("probability"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the id and seed only."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def rake(
    docs: DataFrame,
    dimensions: dict[str, Column],
    tokens: Column,
    targets: dict,
    seed: str = "mix",
    sample: float | None = None,
    rounds: int | None = None,
) -> DataFrame:
    """All rows of ``docs`` (``doc_id`` and what the columns below read), in a struct ``doc``, with
    the dimensions, ``n_tokens``, ``weight``, ``probability`` and ``kept``.

    ``dimensions`` gives a text column for each dimension, ``tokens`` a size, and ``targets`` for each
    dimension a function of its values' totals or a dictionary of shares; values that are not in a
    dictionary get nothing. ``weight`` is a cell's tokens wanted per token there is. Probabilities are
    weights in proportion, with the largest at 1, so the sample has the wanted marginals (as far as
    the cells that exist allow) and no document is taken twice; but then one rare cell that is wanted
    more than others scales all of them down. With ``sample``, the share of all tokens to draw, rates
    are bounded by 1 instead: what there is too little of is taken whole, and the rest makes up the
    sample. A document is kept or not by a hash of its id, alike in every run.

    A null dimension is a value of its own, and a null size counts as 0; a cell without tokens is kept
    whole, as it weighs nothing. Rows that repeat an id are kept or dropped together. An empty table
    gives an empty result. Extra columns stay in ``doc``, whatever their names.
    """
    named = {name: F.coalesce(column.cast("string"), F.lit(NO_VALUE)) for name, column in dimensions.items()}
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        *[column.alias(name) for name, column in named.items()],
        F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"),
    )
    cells = saved(rows.groupBy(*dimensions).agg(F.sum("n_tokens").alias("tokens")), "mix_totals")
    found = rates(cells, targets) if sample is None else bounded_rates(cells, targets, sample, rounds)
    fitted, entries = saved_rows(found, "mix_rates")
    mixed = lookup(rows, fitted, list(dimensions), entries=entries)
    return mixed.withColumn("kept", draw(F.col("doc.doc_id"), seed) < F.col("probability"))


def by_form(docs: DataFrame, sample: float | None = None, rounds: int | None = None) -> DataFrame:
    """``rake`` by source, language and topic, as the registered query, whose SQL writes ``rounds`` out, and the
    pipeline's mixing stage use it.

    The tables have no topic: a document's form stands in for one. Nor have they token counts: ``n_tokens`` is a
    quarter of the bytes. The shares of sources and languages are drawn towards equal ones.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    topic = F.when(text.rlike("[0-9]{4}"), "numbers").when(text.contains("\n"), "lines").otherwise("prose")
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}
    targets = {name: tempered(power) for name, power in POWERS.items()}
    return rake(docs, dimensions, F.ceil(F.octet_length(text) / 4), targets, sample=sample, rounds=rounds)


#: Steps after which the goals of the query's few dimensions stand; each one makes another value whole.
GOAL_STEPS = 8


def oracle() -> str:
    """The registered query in SQL, with the rounds written out."""
    goals, steps, last = [], [], "start"
    for name, power in POWERS.items():
        goals.append(f"""g0_{name} AS (
            SELECT {name}, sum(tokens) AS own, pow(sum(tokens), {power}) AS share, 0.0::DOUBLE AS goal FROM cells GROUP BY {name})""")
        for i in range(GOAL_STEPS):
            goals.append(f"""g{i + 1}_{name} AS (
                SELECT {name}, own, share, CASE WHEN goal >= own THEN own ELSE least(share * scale, own) END AS goal
                FROM g{i}_{name}, (SELECT greatest(size - coalesce(sum(own) FILTER (goal >= own), 0.0), 0.0)
                    / coalesce(nullif(sum(share) FILTER (goal < own), 0.0), 1.0) AS scale
                    FROM g{i}_{name}, sized GROUP BY size))""")
    for i in range(ROUNDS):
        for name in POWERS:
            steps.append(f"""f{i}_{name} AS (
                SELECT *, sum(CASE WHEN rate >= 1 THEN tokens ELSE 0.0 END) OVER (PARTITION BY {name}) AS full_,
                    sum(CASE WHEN rate < 1 THEN tokens * rate ELSE 0.0 END) OVER (PARTITION BY {name}) AS free_ FROM {last}
            ), s{i}_{name} AS (
                SELECT * EXCLUDE (rate, full_, free_), CASE
                    WHEN full_ + free_ >= goal_{name} THEN rate * goal_{name} / greatest(full_ + free_, 1e-300)
                    WHEN rate < 1 AND free_ > 0 THEN least(rate * (goal_{name} - full_) / free_, 1.0)
                    ELSE rate END AS rate
                FROM f{i}_{name})""")
            last = f"s{i}_{name}"
    joined = " ".join(f"JOIN (SELECT {n}, goal AS goal_{n} FROM g{GOAL_STEPS}_{n}) USING ({n})" for n in POWERS)
    return f"""
        WITH rows AS (
            SELECT doc_id, coalesce(source, '{NO_VALUE}') AS source, coalesce(lang, '{NO_VALUE}') AS lang,
                CASE WHEN regexp_matches(coalesce(text, ''), '[0-9]{{4}}') THEN 'numbers'
                    WHEN contains(coalesce(text, ''), chr(10)) THEN 'lines' ELSE 'prose' END AS topic,
                ceil(strlen(coalesce(text, '')) / 4)::BIGINT AS n_tokens
            FROM documents
        ), cells AS (
            SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL
        ), sized AS (SELECT sum(tokens) * {SAMPLE}::DOUBLE AS size FROM cells
        ), {", ".join(goals)}, start AS (
            SELECT *, {SAMPLE}::DOUBLE AS rate FROM cells {joined}
        ), {", ".join(steps)}, rated AS (
            SELECT source, lang, topic, round(CASE WHEN tokens > 0 THEN rate ELSE 1.0 END, 6) AS weight,
                round(CASE WHEN tokens > 0 THEN rate ELSE 1.0 END, 9) AS probability
            FROM {last}
        )
        SELECT doc_id, source, lang, topic, n_tokens, weight, probability,
            ('0x' || substr(md5('mix:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < probability AS kept
        FROM rows JOIN rated USING (source, lang, topic)
    """
