"""SQL of a least-squares fit: predictions for the test fold by successive orthogonalisation.

Each feature is made orthogonal to the ones before it, on the training rows; the target's
share of every orthogonal feature adds up to the prediction. A ridge penalty is one
more training row per feature, with that feature alone.
"""

from claimloom import settings as S
from claimloom.plans.sql import FOLDS

INP, OUT = S.CODE_COLUMNS
KEYS = f"BENE_ID, {INP}, {S.FLAG_COLUMN}, {OUT}, {', '.join(S.NUMERIC_COLUMNS)}, LOG_TOTAL_CHARGE"


def _frequency(column: str, name: str) -> str:
    return (
        f"{name} AS (SELECT {column} AS v, count(*) / CAST((SELECT count({column}) FROM train) AS DOUBLE) AS f "
        f"FROM train WHERE {column} IS NOT NULL GROUP BY 1)"
    )


_SCALED = [
    f"(x.{c} - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM train)"
    for c in S.NUMERIC_COLUMNS
]
_COLUMNS = [
    "coalesce(i.f, (SELECT min(f) FROM fi))",
    "coalesce(o.f, (SELECT min(f) FROM fo))",
    f"CASE WHEN x.{S.FLAG_COLUMN} = 'U' THEN 1.0 ELSE 0.0 END",
    f"CASE WHEN x.{S.FLAG_COLUMN} = 'Y' THEN 1.0 ELSE 0.0 END",
    *_SCALED,
]


def weights(penalty: float) -> str:
    """Common table expressions with ``a0`` (centred features ``x0``, ``x1`` ...) and ``weights``, one row of
    coefficients ``w0``, ``w1`` ...: a row that has one feature alone is predicted to be its coefficient.
    """
    n = len(_COLUMNS)
    picked = ", ".join(f"max(p) FILTER (WHERE fold = 'unit{i}') AS w{i}" for i in range(n))
    return f"{_fit(penalty, _COLUMNS, True)},\nweights AS (SELECT {picked} FROM a{n})"


def predictions(penalty: float = 0.0) -> str:
    """Common table expressions that end in ``predicted`` (``KEYS``, ``p``), one row per test row.

    Without a penalty one level of the flag is left out, which changes no prediction.
    """
    columns = _COLUMNS if penalty else [c for i, c in enumerate(_COLUMNS) if i != 3]
    return f"{_fit(penalty, columns)},\npredicted AS (SELECT {KEYS}, p FROM a{len(columns)} WHERE fold = 'test')"


def inference() -> str:
    """Common table expressions that end in ``inference``: estimate, error, t and two-sided p of each term.

    A row that has one feature alone, made orthogonal like the others, gives the estimate as its prediction and the
    variance as the sum of its squared shares; the row at the features' zero does so for the intercept. p is the
    finite series of the t distribution for whole degrees of freedom.
    """
    columns = [c for i, c in enumerate(_COLUMNS) if i != 3]
    k = len(columns)
    return f"""{_fit(0.0, columns, True, True)},
    facts AS (SELECT count(*) - {k + 1} AS df, sum(r * r) / (count(*) - {k + 1}) AS s2 FROM a{k} WHERE fold = 'train'),
    terms AS (SELECT fold AS unit, p AS estimate, sqrt(s2 * v) AS std_error, df, p / sqrt(s2 * v) AS t
      FROM a{k}, facts WHERE fold LIKE 'unit%'),
    steps AS (SELECT unnest(range(0, df // 2)) AS i, df FROM facts),
    series AS (SELECT i, df, sum(CASE WHEN i = 0 THEN 0.0 WHEN df % 2 = 1 THEN ln(2.0 * i / (2 * i + 1))
      ELSE ln((2.0 * i - 1) / (2 * i)) END) OVER (ORDER BY i) AS c FROM steps),
    sums AS (SELECT unit, sum(exp(c + (2 * i + x.df % 2) * -0.5 * ln(1 + t * t / x.df))) AS total
      FROM terms x, series GROUP BY unit),
    inference AS (SELECT unit, estimate, std_error, t, greatest(0.0, 1 - CASE WHEN df % 2 = 1
        THEN 2 / pi() * (atan(abs(t) / sqrt(df)) + sin(atan(abs(t) / sqrt(df))) * total)
        ELSE sin(atan(abs(t) / sqrt(df))) * total END) AS p
      FROM terms JOIN sums USING (unit))"""


def _fit(penalty: float, columns: list[str], units: bool = False, variances: bool = False) -> str:
    n = len(columns)
    names = [f"x{i}" for i in range(n)]
    parts = [
        FOLDS,
        _frequency(INP, "fi"),
        _frequency(OUT, "fo"),
        f"""encoded AS (SELECT x.*, {', '.join(f'CAST({c} AS DOUBLE) AS {x}' for c, x in zip(columns, names))}
        FROM folds x LEFT JOIN fi i ON i.v = x.{INP} LEFT JOIN fo o ON o.v = x.{OUT})""",
        f"""means AS (SELECT avg(LOG_TOTAL_CHARGE) AS my, {', '.join(f'avg({x}) AS m{x}' for x in names)}
        FROM encoded WHERE fold = 'train')""",
    ]
    none = ", 0.0::DOUBLE AS v" if variances else ""
    rows = f"SELECT {KEYS}, fold, {', '.join(f'{x} - m{x} AS {x}' for x in names)}, LOG_TOTAL_CHARGE - my AS r, my AS p{none} FROM encoded, means"
    def alone(i: int, size: float, fold: str) -> str:
        return (
            f"SELECT {', '.join(f'NULL AS {k.strip()}' for k in KEYS.split(','))}, '{fold}' AS fold, "
            + ", ".join(f"{size if i == j else 0.0} AS {x}" for j, x in enumerate(names))
            + f", 0.0 AS r, 0.0 AS p{none}"
        )

    if penalty:
        rows = " UNION ALL ".join([rows, *(alone(i, penalty**0.5, "train") for i in range(n))])
    if units:
        rows = " UNION ALL ".join([rows, *(alone(i, 1.0, f"unit{i}") for i in range(n))])
    if variances:
        rows += (
            f" UNION ALL SELECT {', '.join(f'NULL AS {k.strip()}' for k in KEYS.split(','))}, 'unit_origin' AS fold, "
            + ", ".join(f"-m{x} AS {x}" for x in names)
            + ", 0.0 AS r, my AS p, 1.0 / (SELECT count(*) FROM train) AS v FROM means"
        )
    parts.append(f"a0 AS ({rows})")
    for j, x in enumerate(names):
        later = [*names[j + 1 :], "r"]
        shares = ", ".join(f"sum({x} * {k}) / sum({x} * {x}) AS b{k}" for k in later)
        if variances:
            shares += f", sum({x} * {x}) AS squares"
        parts.append(f"s{j} AS (SELECT {shares} FROM a{j} WHERE fold = 'train')")
        kept = ", ".join(f"{k} - b{k} * {x} AS {k}" for k in later)
        error = f", v + {x} * {x} / squares AS v" if variances else ""
        parts.append(f"a{j + 1} AS (SELECT {KEYS}, fold, {kept}, p + br * {x} AS p{error} FROM a{j}, s{j})")
    return ",\n".join(parts)
