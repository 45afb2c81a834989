"""Per-client contributions in log-odds, what-if runs and readable summaries, for whole tables.

Linear scores are explained in Column algebra. Boosted trees use the published path-dependent
tree Shapley values: the node table of a saved model is bounded by trees x 2^depth, travels to
the tasks once, and each Arrow batch of clients is explained with array operations.
Ranking happens inside each row's array, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import session
from riskloom.functions import columns as C
from riskloom.functions import constants as K
from riskloom.operators import features as features_ops
from riskloom.operators import learning
from riskloom.operators.learning import Bundle

# ---------------------------------------------------------------- linear scores


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-C.col(x)))


def linear_margin(coefficients: Mapping[str, float], intercept: float, means: Mapping[str, float]) -> Column:
    """Log-odds of a linear score; a missing value counts as the mean."""
    terms = [F.coalesce(F.col(c).cast("double"), F.lit(means[c])) * w for c, w in coefficients.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def linear_contributions(coefficients: Mapping[str, float], means: Mapping[str, float]) -> Column:
    """Array of (feature, value, contribution): coefficient x distance from the mean."""
    return F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            ((F.coalesce(F.col(c).cast("double"), F.lit(means[c])) - means[c]) * w).alias("shap_value"),
        )
        for c, w in coefficients.items()
    ])


def linear_base(coefficients: Mapping[str, float], intercept: float, means: Mapping[str, float]) -> float:
    return intercept + sum(w * means[c] for c, w in coefficients.items())


# ---------------------------------------------------------------- tree scores


def node_table(bundle: Bundle) -> pd.DataFrame:
    """Nodes of the boosted model (bounded by its settings), from its saved form."""
    model = bundle.champion.stages[-1]
    spark = bundle_session()
    path = session.scratch_path(spark, "trees")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()


def bundle_session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def leaf_paths(nodes: pd.DataFrame, weights: Sequence[float]) -> list[dict]:
    """Per leaf: weighted value and, per distinct feature, its cover ratio and its conditions."""
    out = []
    for tree, part in nodes.groupby("treeID"):
        rows = {r["id"]: r for r in part.to_dict("records")}
        stack = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = rows[node_id]
            if node["leftChild"] < 0:
                out.append({"value": node["prediction"] * weights[int(tree)], "path": path})
                continue
            split = node["split"]
            for child, goes_left in ((node["leftChild"], True), (node["rightChild"], False)):
                f = split["featureIndex"]
                ratio, tests = path.get(f, (1.0, ()))
                cover = rows[child]["rawCount"] / max(node["rawCount"], 1)
                rule = (tuple(split["leftCategoriesOrThreshold"]), split["numCategories"] >= 0, goes_left)
                stack.append((child, {**path, f: (ratio * cover, (*tests, rule))}))
    return out


def satisfies(x: np.ndarray, tests: tuple) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for values, categorical, goes_left in tests:
        left = np.isin(x, values) if categorical else x <= values[0]
        hit &= left if goes_left else ~left
    return hit.astype("float64")


def leaf_shares(value: float, zero: Sequence[float]) -> list[np.ndarray]:
    """Per path feature of one leaf, its contribution for every outcome of the path's tests (bit i: test i passed)."""
    d = len(zero)
    outcomes = np.arange(1 << d)
    one = [(outcomes >> i & 1).astype("float64") for i in range(d)]
    out = []
    for i in range(d):
        poly = [np.ones(len(outcomes))]
        for j in range(d):
            if j == i:
                continue
            grown = [np.zeros(len(outcomes)) for _ in range(len(poly) + 1)]
            for k, p in enumerate(poly):
                grown[k] += p * zero[j]
                grown[k + 1] += p * one[j]
            poly = grown
        share = sum(p * (factorial(k) * factorial(d - 1 - k) / factorial(d)) for k, p in enumerate(poly))
        out.append(value * (one[i] - zero[i]) * share)
    return out


def tree_shapley(x: np.ndarray, leaves: list[dict]) -> tuple[np.ndarray, float]:
    """Contributions (rows x features) and base value of a sum of trees.

    For one leaf the game is a product over its path features: present ones count their test,
    absent ones their cover ratio. Its Shapley values follow from the coefficients of the
    polynomial over the other features, grouped by how many are present. They depend on the row
    only through which of the path's tests it passes, so they are worked out once for each of
    the 2^features outcomes and looked up by row.
    """
    phi = np.zeros(x.shape[::-1])
    base = 0.0
    tested: dict[tuple, np.ndarray] = {}
    for leaf in leaves:
        items = list(leaf["path"].items())
        base += leaf["value"] * float(np.prod([r for _, (r, _) in items])) if items else leaf["value"]
        passed = np.zeros(len(x), dtype="int64")
        for i, (f, (_, tests)) in enumerate(items):
            if (f, tests) not in tested:
                tested[f, tests] = satisfies(x[:, f], tests).astype("int64")
            passed += tested[f, tests] << i
        for (f, _), shares in zip(items, leaf_shares(leaf["value"], [ratio for _, (ratio, _) in items])):
            phi[f] += shares[passed]
    phi = phi.T
    return phi, base


def tree_contributions(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Key, base value, margin, raw and served probability, and one contribution per model column."""
    spec = bundle.spec
    model = bundle.champion.stages[-1]
    leaves = leaf_paths(node_table(bundle), list(model.treeWeights))
    owners = learning.tree_input_owner(spec)
    names = learning.input_names(spec)
    fold = np.zeros((len(owners), len(names)))
    for position, owner in enumerate(owners):
        fold[position, names.index(owner)] = 1.0
    shaped = bundle.champion.transform(learning.as_inputs(df, spec, bundle.levels, "label")).select(
        F.col(spec.key),
        vector_to_array("features").alias("_x"),
        vector_to_array("probability")[1].alias("raw_probability"),
    )
    schema = T.StructType([
        shaped.schema[spec.key],
        T.StructField("raw_probability", T.DoubleType()),
        T.StructField("base_value", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("_phi", T.ArrayType(T.DoubleType())),
    ])
    key = spec.key

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.vstack(pdf["_x"].to_numpy())
            phi, base = tree_shapley(x, leaves)
            # the classifier's probability is the logistic of twice the summed trees
            per_column = 2.0 * (phi @ fold)
            yield pd.DataFrame({
                key: pdf[key],
                "raw_probability": pdf["raw_probability"],
                "base_value": 2.0 * base,
                "margin": 2.0 * base + per_column.sum(axis=1),
                "_phi": list(per_column),
            })

    found = shaped.mapInPandas(explain, schema)
    served = learning.calibrate(found, bundle.calibration, "raw_probability", "probability_default")
    zipped = F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col("_phi")[i].alias("shap_value")) for i, n in enumerate(names)
    ])
    return served.withColumn("contributions", zipped).drop("_phi")


def consistency(df: DataFrame) -> DataFrame:
    """Largest gap between the probability rebuilt from the contributions and the model's."""
    gap = F.abs(sigmoid("margin") - F.col("raw_probability"))
    return df.agg(F.count(gap).alias("n"), F.max(gap).alias("max_abs_error"))


# ---------------------------------------------------------------- ranking inside the row


def ranked(contributions: Column | str, top: int, positive: bool, values: Column | None = None) -> Column:
    """The ``top`` strongest contributions of one sign, ranked inside the row's array, with the features' values."""
    kept = F.filter(
        C.col(contributions), lambda c: (c["shap_value"] > 0) if positive else (c["shap_value"] < 0)
    )
    keyed = F.transform(
        kept, lambda c: F.struct((-F.abs(c["shap_value"])).alias("o"), c["feature"].alias("f"), c.alias("c"))
    )
    best = F.slice(F.sort_array(keyed), 1, top)
    return F.transform(
        best,
        lambda s, i: F.struct(
            (i + 1).alias("rank"),
            s["f"].alias("feature"),
            *([] if values is None else [F.element_at(values, s["f"]).alias("value")]),
            s["c"]["shap_value"].alias("shap_value"),
            F.lit(K.RISK_UP if positive else K.RISK_DOWN).alias("effect"),
            C.origin_table(s["f"]).alias("source_table"),
        ),
    )


def total(contributions: Column | str) -> Column:
    return F.aggregate(C.col(contributions), F.lit(0.0), lambda a, c: a + c["shap_value"])


def top_contributions(
    df: DataFrame, top: int = 10, contributions: str = "contributions", features: Sequence[str] = ()
) -> DataFrame:
    """Top risk and protective contributions, the sum of the rest and the probability at the base value.

    ``features`` are the columns whose values are listed beside their contributions.
    """
    values = shown_values(df, features) if features else None
    base = {"base_probability": sigmoid("base_value")} if "base_value" in df.columns else {}
    with_top = df.withColumns(
        {
            "top_risk_drivers": ranked(contributions, top, True, values),
            "top_protective_factors": ranked(contributions, top, False, values),
            **base,
        }
    )
    rest = total(contributions) - total("top_risk_drivers") - total("top_protective_factors")
    return with_top.withColumn("sum_other_features", rest)


def driver_rows(df: DataFrame, key: str = K.ID) -> DataFrame:
    """One row per client and listed contribution."""
    both = F.concat("top_risk_drivers", "top_protective_factors")
    return df.select(key, F.explode(both).alias("d")).select(key, "d.*")


def change_drivers(before: DataFrame, after: DataFrame, key: str = K.ID, top: int = 10) -> DataFrame:
    """Contribution differences between two runs, strongest first, per client."""
    joined = before.select(key, F.col("contributions").alias("_b")).join(
        after.select(key, F.col("contributions").alias("_a")), key
    )
    old = F.map_from_entries(F.transform("_b", lambda c: F.struct(c["feature"], c["shap_value"])))
    new = F.map_from_entries(F.transform("_a", lambda c: F.struct(c["feature"], c["shap_value"])))
    mapped = joined.select(key, old.alias("_o"), new.alias("_n"))
    names = F.array_union(F.map_keys("_o"), F.map_keys("_n"))

    def difference(f: Column) -> Column:
        after_value = F.coalesce(F.element_at("_n", f), F.lit(0.0))
        return after_value - F.coalesce(F.element_at("_o", f), F.lit(0.0))

    rows = F.transform(names, lambda f: F.struct((-F.abs(difference(f))).alias("o"), f.alias("feature"), difference(f).alias("shap_value")))
    strong = F.filter(rows, lambda r: r["o"] < -1e-9)
    best = F.slice(F.sort_array(strong), 1, top)
    return mapped.select(key, F.posexplode(best).alias("_p", "r")).select(
        key,
        (F.col("_p") + 1).alias("rank"),
        "r.feature",
        "r.shap_value",
        F.when(F.col("r.shap_value") > 0, K.RISK_UP).otherwise(K.RISK_DOWN).alias("effect"),
        C.origin_table("r.feature").alias("source_table"),
    )


# ---------------------------------------------------------------- what-if

Scorer = Callable[[DataFrame], DataFrame]


def bundle_scorer(bundle: Bundle) -> Scorer:
    return lambda df: learning.score(df, bundle).withColumnRenamed(K.SCORE, "probability_default")


def simulate(
    df: DataFrame, scorer: Scorer, changes: Mapping[str, object], threshold: float, key: str = K.ID, width: float = 0.0
) -> DataFrame:
    """Score before and after the changes, difference and whether the decision moved.

    Both scores are taken of the same row, one after the other, so nothing is shuffled or joined.
    """
    taken = "probability_default"
    first = scorer(df).withColumnRenamed(taken, "base_probability")
    second = scorer(features_ops.apply_changes(first, changes)).withColumnRenamed(taken, "changed_probability")
    base, changed = F.col("base_probability"), F.col("changed_probability")
    return second.select(
        key,
        "base_probability",
        C.decide(base, threshold, width).alias("base_decision"),
        "changed_probability",
        C.decide(changed, threshold, width).alias("changed_decision"),
        (changed - base).alias("delta_probability"),
        (C.decide(changed, threshold, width) != C.decide(base, threshold, width)).alias("decision_changed"),
    )


MAX_SWEEP = 100


def sweep(
    df: DataFrame, scorer: Scorer, column: str, values: Sequence[float], threshold: float, key: str = K.ID,
    changes: Mapping[str, object] | None = None,
) -> DataFrame:
    """Every client at every value of one column (at most 100 points), with decisions."""
    if len(values) > MAX_SWEEP:
        raise ValueError(f"a sweep takes at most {MAX_SWEEP} values")
    if column not in df.columns:
        raise ValueError(f"unknown column {column!r}")
    points = F.array(*[F.lit(float(v)) for v in values])
    grown = df.withColumn("_value", F.explode(points))
    changed = features_ops.apply_changes(grown, {**(changes or {}), column: F.col("_value")})
    return scorer(changed).select(
        key, F.col("_value").alias("value"), "probability_default",
        C.decide("probability_default", threshold).alias("decision"),
    )


def switch_points(swept: DataFrame, key: str = K.ID) -> DataFrame:
    """Values at which a client's decision differs from the one before (a bounded sequence per client)."""
    ordered = F.sort_array(F.collect_list(F.struct("value", "decision")))
    rows = swept.groupBy(key).agg(ordered.alias("s"))
    moved = F.filter(
        F.transform(
            F.slice("s", F.lit(2), F.size("s")),
            lambda x, i: F.struct(x["value"].alias("value"), F.col("s")[i]["decision"].alias("from_decision"), x["decision"].alias("to_decision")),
        ),
        lambda x: x["from_decision"] != x["to_decision"],
    )
    return rows.select(key, F.explode(moved).alias("m")).select(key, "m.*")


# ---------------------------------------------------------------- text


# Fixed value: what stands for a missing value in the text.
ABSENT = "ausente"


def local_number(c: Column) -> Column:
    """A point for thousands and a comma before two decimals; whole numbers have none."""
    whole = c == F.floor(c)
    return F.translate(F.when(whole, F.format_number(c, 0)).otherwise(F.format_number(c, 2)), ",.", ".,")


def shown_values(df: DataFrame, features: Sequence[str]) -> Column:
    """Feature name -> value as text: numbers in local form, categories as they are, null when missing."""
    shown = [
        local_number(F.col(c).cast("double")) if isinstance(df.schema[c].dataType, T.NumericType) else F.col(c).cast("string")
        for c in features
    ]
    return F.create_map(*[x for c, v in zip(features, shown) for x in (F.lit(c), v)])


def half_up(c: Column, digits: int) -> Column:
    """Rounded as a decimal number is, so a score that ends in 5 goes up wherever it is printed."""
    return F.round(c.cast("decimal(18,9)"), digits).cast("double")


def listing(items: Column | str, values: Column | str) -> Column:
    """The first three contributions as 'name = value (+0.123)'."""
    first = F.slice(C.col(items), 1, 3)
    parts = F.transform(
        first,
        lambda d: F.concat(
            d["feature"], F.lit(" = "), F.coalesce(F.element_at(C.col(values), d["feature"]), F.lit(ABSENT)),
            F.lit(" ("), F.format_string("%+.3f", half_up(d["shap_value"], 3)), F.lit(")"),
        ),
    )
    return F.array_join(parts, "; ")


def narrate(df: DataFrame, threshold: float, values: Column, key: str = K.ID, decision: str = "decision") -> DataFrame:
    """A sentence per client; ``values`` maps feature names to their text (``shown_values``)."""
    p = F.col("probability_default")
    head = F.concat(
        F.lit("Cliente "), F.col(key).cast("string"), F.lit(": risco estimado de "),
        F.format_string("%.1f%%", half_up(p * 100, 1)), F.lit(", "),
        F.when(p >= threshold, "acima").otherwise("abaixo"), F.lit(" do corte de "),
        F.lit(f"{threshold:.1%}"), F.lit(" → "), F.col(decision), F.lit("."),
    )
    with_values = df.withColumn("_values", values)
    risk = F.when(
        F.size("top_risk_drivers") > 0,
        F.concat(F.lit(" Principais fatores de risco: "), listing("top_risk_drivers", "_values"), F.lit(".")),
    ).otherwise("")
    safe = F.when(
        F.size("top_protective_factors") > 0,
        F.concat(F.lit(" Fatores favoráveis: "), listing("top_protective_factors", "_values"), F.lit(".")),
    ).otherwise("")
    return with_values.withColumn("narrative", F.concat(head, risk, safe)).drop("_values")


# ---------------------------------------------------------------- importance


def gain_importance(bundle: Bundle) -> DataFrame:
    """Share of the impurity gain per model column (a row per column of the model)."""
    spark = bundle_session()
    gains = bundle.champion.stages[-1].featureImportances.toArray()
    folded: dict[str, float] = dict.fromkeys(learning.input_names(bundle.spec), 0.0)
    for owner, gain in zip(learning.tree_input_owner(bundle.spec), gains):
        folded[owner] += float(gain)
    return spark.createDataFrame(list(folded.items()), "feature string, importance double")


def split_importance(bundle: Bundle) -> DataFrame:
    """Number of splits per model column."""
    spark = bundle_session()
    owners = learning.tree_input_owner(bundle.spec)
    counts: dict[str, float] = dict.fromkeys(learning.input_names(bundle.spec), 0.0)
    for split, left in zip(*(node_table(bundle)[c] for c in ("split", "leftChild"))):
        if left >= 0:
            counts[owners[split["featureIndex"]]] += 1.0
    return spark.createDataFrame(list(counts.items()), "feature string, importance double")
