"""MLlib model jobs: classifier, linear models, forest, boosting (M2, M3, M5,
M6, M8, M9) and feature-list helpers.

Models are MLlib ``Pipeline``s (``VectorAssembler`` + estimator), so fitting is
distributed (``treeAggregate`` over partitions) and ``transform`` keeps the
row key beside the prediction (trap T5).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.plans.newton import Logit, fit_logit

TARGETS = ["visitors", "log_visitors"]
IDS = ["air_store_id", "id", "air_store_id2"]

# The predictor lists of the linear models.
OLS_FEATURES_1 = ["median_visitors", "max_visitors", "min_visitors", "rv1_x",
                  "count_observations", "rv2_x", "longitude", "rs2_x", "rs1_x",
                  "day", "month", "air_area_name4", "air_area_name", "air_area_name2",
                  "wom", "date_int", "dow", "air_genre_name1", "air_genre_name0",
                  "air_genre_name", "holiday_flg", "year", "air_area_name0"]
OLS_FEATURES_2 = ["median_visitors", "max_visitors", "min_visitors", "rv2_x", "rs2_x",
                  "day", "month", "air_area_name", "day_of_week", "air_genre_name",
                  "holiday_flg"]


def model_features(df: DataFrame, leakage_safe: bool = True) -> list[str]:
    """Every numeric column but targets, ids, ``visit_date``, ``subset``.

    ``leakage_safe`` drops the ``visitors_diff*`` columns: lag k + diff k
    equals the target exactly (trap T1).
    """
    skip = set(TARGETS + IDS + ["visit_date", "subset", "fold", "ordinal"])
    out = [f.name for f in df.schema.fields
           if f.name not in skip and isinstance(f.dataType, T.NumericType)]
    if leakage_safe:
        out = [c for c in out if not c.startswith("visitors_diff")]
    return out


def regression_pipeline(estimator, features: list[str], label: str = "log_visitors") -> Pipeline:
    estimator = estimator.setFeaturesCol("features").setLabelCol(label)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features",
                                            handleInvalid="keep"), estimator])


def linear_regression(fit_intercept: bool = True) -> LinearRegression:
    """M5 (and M3 with ``fit_intercept=False``): ordinary least squares."""
    return LinearRegression(regParam=0.0, fitIntercept=fit_intercept, solver="normal")


def lasso(alpha: float = 0.001) -> LinearRegression:
    """M6: (1/2n)||y - b - Xw||² + alpha ||w||₁ on unstandardised features."""
    return LinearRegression(elasticNetParam=1.0, regParam=alpha, standardization=False,
                            maxIter=1000, tol=1e-9)


def lasso_alpha(estimator) -> float | None:
    """The penalty of an estimator with the objective of ``lasso``; None for any other."""
    if (isinstance(estimator, LinearRegression) and estimator.getElasticNetParam() == 1.0
            and estimator.getRegParam() > 0 and not estimator.getStandardization()
            and estimator.getFitIntercept() and estimator.getLoss() == "squaredError"):
        return estimator.getRegParam()
    return None


def random_forest(num_trees: int = 1000, max_depth: int = 3, seed: int = 0
                  ) -> RandomForestRegressor:
    """M8: 1000 trees of depth 3."""
    return RandomForestRegressor(numTrees=num_trees, maxDepth=max_depth,
                                 featureSubsetStrategy="sqrt", seed=seed,
                                 subsamplingRate=1.0, bootstrap=True)


def gradient_boosting(max_iter: int = 1000, step_size: float = 0.01, max_depth: int = 5,
                      seed: int = 0) -> GBTRegressor:
    """M9: 1000 rounds at rate 0.01.  MLlib grows trees level-wise to
    ``max_depth``; the original's learner grew them leaf-wise (31 leaves)."""
    return GBTRegressor(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth,
                        seed=seed, checkpointInterval=10)


@dataclass
class LargePartyModel:
    fit: Logit
    features: list[str]
    threshold: float = 0.5

    def flag(self, df: DataFrame, out: str = "large_party") -> DataFrame:
        """P(large party) >= threshold -> 1.0, else 0.0."""
        odds = F.lit(0.0)
        for c, b in zip(self.features, self.fit.coefficients):
            odds = odds + F.lit(float(b)) * F.col(c).cast("double")
        sure = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
        return df.withColumn(out, F.when(sure >= self.threshold, 1.0).otherwise(0.0))

    @property
    def coefficients(self):
        return self.fit.coefficients


def large_party_classifier(train: DataFrame, features: list[str], label: str = "large_party",
                           threshold: float = 0.5) -> LargePartyModel:
    """M2: maximum-likelihood logit without intercept, by Newton steps (``plans.newton``).

    The step budget and tolerance are those of the original's Newton solver (35 steps, 1e-8).
    """
    return LargePartyModel(fit_logit(train, features, label), features, threshold)
