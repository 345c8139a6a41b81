"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Shallow trees of a random forest, grown on the labelled rows, are read as conjunctive
rules: the path to every node. A logistic regression with lasso penalty weighs the rules;
those with a weight are compiled into one column expression. Trees and weights are fitted by
Spark on all labelled rows.

Nulls and odd rows: a null text has the statistics of an empty one, and a score; rows with a
null label do not teach; labels of one kind only (or none) give that kind's share (or 0.5) as
every score, and so do statistics that are the same in all rows; repeated rows teach each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.text_statistics import NAMES
from taxaweave.llm.steps import written

Rule = tuple[tuple[str, bool, float], ...]


@dataclass
class Ensemble:
    """Rules with their weights; a rule is conditions (statistic, whether above, threshold)."""

    intercept: float
    weights: dict[Rule, float]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(condition(rule), F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def condition(rule: Rule) -> Column:
    met = F.lit(True)
    for name, above, threshold in rule:
        met = met & ((F.col(name) > threshold) if above else (F.col(name) <= threshold))
    return met


def paths(node, names: tuple[str, ...], path: tuple = ()) -> list[Rule]:
    """The rule of every node below a tree's root, each bound stated once and as tight as it stands."""
    found = []
    if path:
        tight: dict[tuple[str, bool], float] = {}
        for name, above, threshold in path:
            old = tight.get((name, above), threshold)
            tight[name, above] = max(old, threshold) if above else min(old, threshold)
        found.append(tuple(sorted((name, above, t) for (name, above), t in tight.items())))
    if node.subtreeDepth() > 0:
        split = node.split()
        name, threshold = names[split.featureIndex()], round(float(split.threshold()), 6)
        found += paths(node.leftChild(), names, (*path, (name, False, threshold)))
        found += paths(node.rightChild(), names, (*path, (name, True, threshold)))
    return found


def fit(
    rows: DataFrame, label: str, names: tuple[str, ...] = NAMES, trees: int = 24, depth: int = 3, penalty: float = 0.0003, seed: int = 7
) -> Ensemble:
    """Fit on ``rows`` with the statistics ``names`` and a 0/1 ``label``."""
    import math

    rows = written(rows.where(F.col(label).isin(0, 1)).select(*names, F.col(label).cast("double").alias("label")))
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        share = next(iter(kinds), 0.5)
        return Ensemble(math.log((share + 1e-6) / (1 - share + 1e-6)), {})
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label", featureSubsetStrategy="onethird"
    ).fit(VectorAssembler(inputCols=list(names), outputCol="features").transform(rows))
    rules = sorted({rule for tree in forest.trees for rule in paths(tree._call_java("rootNode"), names)})
    if not rules:  # statistics that tell nothing apart
        share = kinds.get(1.0, 0) / sum(kinds.values())
        return Ensemble(math.log((share + 1e-6) / (1 - share + 1e-6)), {})
    table = rows.select(
        "label", array_to_vector(F.array(*[condition(rule).cast("double") for rule in rules])).alias("features")
    )
    model = LogisticRegression(
        featuresCol="features", labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False
    ).fit(table)
    weights = {rule: float(w) for rule, w in zip(rules, model.coefficients.toArray(), strict=True) if abs(w) > 1e-9}
    return Ensemble(float(model.intercept), weights)
