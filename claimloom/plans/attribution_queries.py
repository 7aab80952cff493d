"""Attribution queries whose SQL computes the same values in another way."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom import settings as S
from claimloom.operators import attribution, candidates, tree_attribution
from claimloom.operators.encoders import feature_names
from claimloom.plans import least_squares, training
from claimloom.plans.registry import query
from claimloom.plans.sql import FOLDS

_KEYS = ["BENE_ID", S.CODE_COLUMNS[0], S.FLAG_COLUMN, S.CODE_COLUMNS[1]]
_NAMES = [
    f"{S.CODE_COLUMNS[0]}_freq", f"{S.CODE_COLUMNS[1]}_freq", f"{S.FLAG_COLUMN}_U", f"{S.FLAG_COLUMN}_Y", *S.NUMERIC_COLUMNS,
]
_LINEAR = f"""{least_squares.weights(1.0)}, contributions AS (
  SELECT {', '.join(_KEYS)}, {', '.join(f'round(x{i} * w{i}, 9) AS c{i}' for i in range(len(_NAMES)))}
  FROM a0, weights WHERE fold = 'test')"""
_LONG = " UNION ALL ".join(
    f"SELECT {', '.join(_KEYS)}, '{n}' AS feature, c{i} AS c FROM contributions" for i, n in enumerate(_NAMES)
)


def _linear(t) -> tuple[DataFrame, list[str]]:
    """The ridge model's contributions on the test fold, against the mean of the whole training fold."""
    train, test = training.split(t.model_rows())
    data = training.encode(train, test)
    _, fitted = data.fit(candidates.fitting_regressors(data.train)["ridge_regression"])
    names = feature_names(candidates.preprocessor_of(fitted))
    values = attribution.linear_values(fitted, test, train)
    # One output; digits beyond the ninth are rounding noise that would order ties at random.
    flat = F.transform("shap", lambda v: F.round(v[0], 9))
    return values.select(*_KEYS, flat.alias("c")), names


@query(
    "linear_attribution",
    f"""WITH {_LINEAR} SELECT {', '.join(_KEYS)},
      {', '.join(f'round(c{i}, 6) AS c{i}' for i in range(len(_NAMES)))} FROM contributions""",
)
def linear_attribution(t):
    rows, names = _linear(t)
    return rows.select(*_KEYS, *[F.round(F.col("c")[i], 6).alias(f"c{i}") for i in range(len(names))])


@query(
    "top_contributions",
    f"""WITH {_LINEAR}, long AS ({_LONG}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(_KEYS)} ORDER BY abs(c) DESC, feature) AS rank FROM long)
    SELECT {', '.join(_KEYS)}, rank, feature, round(c, 6) AS contribution,
      CASE WHEN c > 0 THEN 'increases' ELSE 'decreases' END AS direction FROM ranked WHERE rank <= 2""",
)
def top_contributions(t):
    rows, names = _linear(t)
    best = attribution.top_contributions(names, F.col("c"), 2)
    return rows.select(*_KEYS, F.posexplode(best).alias("place", "c")).select(
        *_KEYS, (F.col("place") + 1).alias("rank"), "c.feature", "c.contribution", "c.direction"
    )


@query(
    "impact_table",
    f"""WITH {_LINEAR}, long AS ({_LONG}) SELECT BENE_ID, feature, round(c, 6) AS contribution,
      CASE WHEN c > 0 THEN 'increases' ELSE 'decreases' END AS direction, abs(round(c, 6)) AS impact FROM long""",
)
def impact_table(t):
    rows, names = _linear(t)
    best = attribution.top_contributions(names, F.col("c"), len(names))
    table = attribution.impact_table(rows.withColumn("top_contributions", best), "BENE_ID")
    return table.withColumns({c: F.round(c, 6) for c in ("contribution", "impact")})


# A tree in which every node of a level splits the level's feature at the node's own mean; the first
# feature comes twice on each path.
_LEVELS = [S.INCOME, "PRVDR_STATE_CD_inp", "Number_of_Claims_inp", S.INCOME]
_INPUTS = list(dict.fromkeys(_LEVELS))


def mean_tree(train: DataFrame, levels: list[str], target: str) -> DataFrame:
    """Nodes of a tree of means over a training table, in the form of ``tree_attribution.NODES``.

    Node 1 is the root; node ``n`` has the children ``2n`` and ``2n + 1``. Leaf values are means of ``target``.
    """
    inputs = list(dict.fromkeys(levels))
    rows, depth = train.withColumn("node", F.lit(1)), len(levels)
    nodes = None
    for level in range(depth + 1):
        of = levels[level] if level < depth else target
        found = rows.groupBy("node").agg(F.avg(F.col(of).cast("double")).alias("mean"), F.count(F.lit(1)).alias("n"))
        # At most 2^level rows.
        full = train.sparkSession.range(2**level, 2 ** (level + 1)).select(F.col("id").cast("int").alias("node"))
        found = full.join(F.broadcast(found), "node", "left").fillna(0)
        leaf = level == depth
        step = found.select(
            F.lit(0).alias("tree"), "node",
            (F.lit(-1) if leaf else F.col("node") * 2).alias("left"),
            (F.lit(-1) if leaf else F.col("node") * 2 + 1).alias("right"),
            F.lit(-1 if leaf else inputs.index(of)).alias("feature"),
            (F.lit(None).cast("double") if leaf else F.col("mean")).alias("threshold"),
            F.col("n").cast("double").alias("cover"), F.array(F.col("mean")).alias("values"),
        )
        nodes = step if nodes is None else nodes.unionByName(step)
        if not leaf:
            side = F.when(F.col(of) <= F.col("mean"), 0).otherwise(1)
            rows = rows.join(F.broadcast(found.select("node", "mean")), "node")
            rows = rows.withColumn("node", F.col("node") * 2 + side).drop("mean")
    return nodes


def _mean_tree_sql() -> str:
    parts = [f"{FOLDS}", "t0 AS (SELECT *, 1 AS node FROM train)"]
    for i, c in enumerate(_LEVELS):
        parts.append(f"m{i} AS (SELECT node, avg({c}) AS m, count(*) AS n FROM t{i} GROUP BY node)")
        parts.append(
            f"t{i + 1} AS (SELECT t.* EXCLUDE (node), 2 * t.node + CASE WHEN {c} <= m THEN 0 ELSE 1 END AS node "
            f"FROM t{i} t JOIN m{i} USING (node))"
        )
    last = len(_LEVELS)
    parts.append(f"m{last} AS (SELECT node, avg(LOG_TOTAL_CHARGE) AS m, count(*) AS n FROM t{last} GROUP BY node)")
    # A leaf's path, per feature: whether the row follows it (o) and the share of rows that would (z).
    joins = " ".join(
        f"LEFT JOIN m{i} n{i} ON n{i}.node = leaf // {2 ** (last - i)}" for i in range(last + 1)
    )
    step = [
        (f"CASE WHEN (x.{c} <= n{i}.m) = (leaf // {2 ** (last - i - 1)} % 2 = 0) THEN 1.0 ELSE 0.0 END",
         f"coalesce(n{i + 1}.n / CAST(n{i}.n AS DOUBLE), 0.0)")
        for i, c in enumerate(_LEVELS)
    ]
    shares = [
        f"{' * '.join(pair[k] for pair, c in zip(step, _LEVELS) if c == name)} AS {kind}{f}"
        for f, name in enumerate(_INPUTS) for k, kind in enumerate("oz")
    ]
    parts.append(f"x AS (SELECT DISTINCT {', '.join(_INPUTS)} FROM test)")
    parts.append(
        f"paths AS (SELECT x.*, n{last}.m AS v, {', '.join(shares)} FROM x, range({2 ** last}, {2 ** (last + 1)}) l(leaf) {joins})"
    )

    def value(i: int, j: int, k: int) -> str:
        return (
            f"sum(coalesce(v, 0) * (o{i} - z{i}) * (z{j} * z{k} / 3 + (o{j} * z{k} + z{j} * o{k}) / 6 + o{j} * o{k} / 3))"
        )

    parts.append(
        f"explained AS (SELECT {', '.join(_INPUTS)}, sum(coalesce(v, 0) * z0 * z1 * z2) AS base, "
        f"{value(0, 1, 2)} AS c0, {value(1, 0, 2)} AS c1, {value(2, 0, 1)} AS c2 FROM paths GROUP BY ALL)"
    )
    return ", ".join(parts)


@query(
    "tree_attribution",
    f"""WITH {_mean_tree_sql()} SELECT BENE_ID, {', '.join(f't.{c}' for c in _INPUTS)}, round(base, 6) AS base,
      round(c0, 6) AS c0, round(c1, 6) AS c1, round(c2, 6) AS c2 FROM test t JOIN explained e
      ON {' AND '.join(f't.{c} = e.{c}' for c in _INPUTS)}""",
)
def tree_attribution_query(t):
    """Exact values of a tree that is given as a table of nodes, for every test row."""
    train, test = t.train_test()
    vector = F.array(*[F.col(c).cast("double") for c in _INPUTS])
    rows = test.select("BENE_ID", *_INPUTS, vector.alias("__x"))
    nodes = mean_tree(train, _LEVELS, S.LOG_TOTAL)
    values = tree_attribution.tree_values(nodes, rows.select("__x").distinct(), len(_INPUTS), 1)
    return rows.join(values, "__x").select(
        "BENE_ID", *_INPUTS, F.round(F.col("base")[0], 6).alias("base"),
        *[F.round(F.col("shap")[i][0], 6).alias(f"c{i}") for i in range(len(_INPUTS))],
    )
