"""A quality classifier that is a sparse ensemble of rules.

Statistics of a text are Spark column expressions. On labelled rows, small boosted trees are grown over them;
every path from a root to a node is a rule, a conjunction of comparisons. A logistic model with an L1
penalty weighs the rules, and those with a weight are compiled back into one Spark expression, the score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that a model is fitted on, about.
SAMPLE = 4000
TREES, DEPTH, RATE = 30, 3, 0.3
THRESHOLDS = 24
PENALTY = 0.0005


def split_words(text: Column) -> Column:
    """The words of a text between white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def statistics(text: Column, words: Column | None = None) -> dict[str, Column]:
    """Statistics of a whole text; all are 0 for a null or empty one. Counts are taken in one scan each.

    All are rates, which a good text keeps at any length: shares of distinct words, say, fall as texts grow.
    words, if given, is a column of split_words(text): it is read often, and an expression would split each time.
    """
    text = F.coalesce(text, F.lit(""))
    size = F.length(text)
    per = lambda x, n: F.when(n > 0, x / n).otherwise(0.0)
    words = split_words(text) if words is None else words
    n_words = F.size(words)
    # words that are the same as the one so many places later
    echoes = lambda k: F.size(F.filter(F.zip_with(words, F.slice(words, 1 + k, 1 << 30), lambda a, b: a == b), lambda x: x)).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "mean_word": per((size - n_words).cast("double"), n_words),
        "echoes": per(echoes(1), n_words),
        "echoes_of_two": per(echoes(2), n_words),
        "upper": per(count(r"\p{Lu}").cast("double"), size),
        "digits": per(count(r"[0-9]").cast("double"), size),
        "symbols": per(count(r"[#$%&*+<=>@^_~{}\[\]\\/]").cast("double"), n_words),
        "bars": per(count(r"\|").cast("double"), n_words),
        "bangs": per(count(r"[!?]").cast("double"), n_words),
        "stops": per(count(r"[.,;:]").cast("double"), n_words),
        "lines": per(count(r"\n").cast("double"), n_words),
    }


NAMES = ["mean_word", "echoes", "echoes_of_two", "upper", "digits", "symbols", "bars", "bangs", "stops", "lines"]


@dataclass(frozen=True)
class Rule:
    """A conjunction: each part is (statistic, is it above?, threshold)."""

    parts: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, at in self.parts:
            out &= (x[:, k] > at) == above
        return out

    def column(self, stats: list[Column]) -> Column:
        parts = [stats[k] > at if above else stats[k] <= at for k, above, at in self.parts]
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out


@dataclass
class RuleModel:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the rules that hold)))."""

    bias: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, stats: list[Column]) -> Column:
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(stats), F.lit(float(weight))).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for rule, weight in self.rules:
            total += weight * rule.holds(x)
        return 1 / (1 + np.exp(-total))


def _grow(x: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, residual: np.ndarray, weight: np.ndarray, rows: np.ndarray, path: tuple, depth: int, out: list[Rule], step: np.ndarray) -> None:
    """One tree on the residuals, by the largest gain in weighted squared sums; its paths go to out, its leaf values to step."""
    g, w = residual[rows], weight[rows]
    best = (1e-9, -1, -1)
    if depth and len(rows) >= 20:
        for k, own in enumerate(cuts):
            if not len(own):
                continue
            gs = np.cumsum(np.bincount(bins[rows, k], g, len(own) + 1))
            ws = np.cumsum(np.bincount(bins[rows, k], w, len(own) + 1))
            n = np.cumsum(np.bincount(bins[rows, k], minlength=len(own) + 1))[:-1]
            left, right = gs[:-1] ** 2 / (ws[:-1] + 1e-3), (gs[-1] - gs[:-1]) ** 2 / (ws[-1] - ws[:-1] + 1e-3)
            gain = np.where((n >= 8) & (len(rows) - n >= 8), left + right - gs[-1] ** 2 / (ws[-1] + 1e-3), 0.0)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), k, at)
    if best[1] < 0:
        step[rows] = g.sum() / (w.sum() + 1e-3)
        return
    _, k, at = best
    above = bins[rows, k] > at
    for side in (False, True):
        further = (*path, (k, side, float(cuts[k][at])))
        out.append(Rule(further))
        _grow(x, cuts, bins, residual, weight, rows[above == side], further, depth - 1, out, step)


def tree_rules(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[Rule]:
    """The distinct paths of boosted trees for a logistic loss."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, THRESHOLDS + 2)[1:-1])) for k in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    value = np.zeros(len(x))
    rules: list[Rule] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-value))
        step = np.zeros(len(x))
        _grow(x, cuts, bins, w * (y - p), w * p * (1 - p), np.arange(len(x)), (), DEPTH, rules, step)
        value += RATE * np.clip(step, -4, 4)
    return list(dict.fromkeys(rules))


def lasso(z: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all weights but the bias, by accelerated proximal gradients."""
    share = w / w.sum()
    a = np.hstack((np.ones((len(z), 1)), z))
    rate = 4.0 / max(1e-9, np.linalg.eigvalsh((a * share[:, None]).T @ a)[-1])
    beta = np.zeros(a.shape[1])
    ahead, t = beta, 1.0
    for _ in range(steps):
        grad = a.T @ (share * (1 / (1 + np.exp(-(a @ ahead))) - y))
        new = ahead - rate * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0.0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, beta, t = new + (t - 1) / t2 * (new - beta), new, t2
    return float(beta[0]), beta[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float = PENALTY) -> RuleModel:
    """The weighted rules of labelled statistics. With one class, or no rows, a model with a bias only."""
    if len(y) == 0 or len(np.unique(y)) < 2:
        rate = (float((w * y).sum()) + 1) / (float(w.sum()) + 2)
        return RuleModel(float(np.log(rate / (1 - rate))))
    rules = tree_rules(x, y, w)
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    # rules that hold for the same rows are one rule
    _, first = np.unique(z, axis=1, return_index=True)
    rules, z = [rules[k] for k in sorted(first)], z[:, sorted(first)]
    bias, weights = lasso(z, y, w, penalty)
    return RuleModel(bias, [(r, float(b)) for r, b in zip(rules, weights, strict=True) if abs(b) > 1e-6])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """A model of the labelled rows of docs, from about sample rows of each class, weighted back to the classes' shares.

    Rows with a null label or id are left out; of several labels of an id the least counts, of several texts the one
    with the least hash. The sample is of the rows with the least hash of their id. Its ids are broadcast, and its
    statistics reach the driver: both are bounded by the parameter.
    """
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg((F.min(label_col) > 0).cast("int").alias("__y"))
    sizes = {r["__y"]: r["count"] for r in own.groupBy("__y").count().collect()}
    unit = F.pmod(F.xxhash64("__id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(0.0)
    for y, n in sizes.items():
        keep = F.when(F.col("__y") == y, F.lit(sample / n)).otherwise(keep)
    picked = own.where(unit < keep)
    stats = statistics(F.col("__text"), F.col("__words"))
    rows = (
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .join(F.broadcast(picked), "__id")
        .groupBy("__id", "__y")
        .agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
        .withColumn("__words", split_words(F.col("__text")))
        .select("__y", *[stats[n].alias(n) for n in NAMES])
        .toPandas()
        .sort_values(["__y", *NAMES], kind="stable")
    )
    x, y = rows[NAMES].to_numpy(float), rows["__y"].to_numpy(float)
    w = np.ones(len(y))
    for k, n in sizes.items():
        if (got := (y == k).sum()) and n:
            w[y == k] = n / got
    return fit_rules(x, y, w * (len(w) / w.sum()) if len(w) else w)


def score_column(text: Column, model: RuleModel) -> Column:
    """The score of a text as one expression. Words and statistics are bound to variables inside it: wherever the
    optimiser moves or repeats the column, a text is split once and scanned once for each statistic."""

    def of_words(words: Column) -> Column:
        stats = statistics(text, words)
        pinned = F.array(F.array(*[stats[n].cast("double") for n in NAMES]))
        return F.transform(pinned, lambda s: model.column([s[k] for k in range(len(NAMES))]))[0]

    return F.transform(F.array(split_words(text)), of_words)[0]


def score(docs: DataFrame, model: RuleModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row, from its whole text alone, however long. Null and empty texts have one score of
    their own; repeated rows are answered each; an empty table has no results; other columns are not read."""
    return docs.select(F.col(id_col).alias("doc_id"), score_column(F.col(text_col), model).alias("score"))
